"""Column expressions over ARRAY<DOUBLE> vectors (all stay inside the JVM)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def total(vector) -> Column:
    return F.aggregate(_col(vector), F.lit(0.0), lambda acc, x: acc + x)


def dot(left, right) -> Column:
    return total(F.zip_with(_col(left), _col(right), lambda x, y: x * y))


def norm(vector) -> Column:
    return F.sqrt(F.aggregate(_col(vector), F.lit(0.0), lambda acc, x: acc + x * x))


def unit(vector) -> Column:
    """Divide by the length; a zero vector stays zero."""
    length = norm(vector)
    return F.when(length > 0, F.transform(_col(vector), lambda x: x / length)).otherwise(_col(vector))

