"""Seeded draws as pure functions of an id: the same on any number of tasks."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_WORD = float(2 ** 32)


def digest(tag: str, seed: int, *ids) -> Column:
    """Hex md5 of ``tag:seed:id[:id...]``."""
    parts = [F.lit(f"{tag}:{seed}")]
    parts += [i.cast("string") if isinstance(i, Column) else F.col(i).cast("string") for i in ids]
    return F.md5(F.concat_ws(":", *parts))


def word(hex_digest: Column, index: int) -> Column:
    """The index-th 32-bit word of a hex digest."""
    return F.conv(F.substring(hex_digest, 8 * index + 1, 8), 16, 10).cast("long")


def small_int(tag: str, seed: int, key, below: int) -> Column:
    """A draw from 0 .. below-1."""
    return F.pmod(word(digest(tag, seed, key), 0), F.lit(below)).cast("int")


def normal(tag: str, seed: int, *ids) -> Column:
    """A standard normal draw (Box-Muller over two words of one digest)."""
    h = digest(tag, seed, *ids)
    first = (word(h, 0) + F.lit(1.0)) / F.lit(_WORD)
    second = word(h, 1) / F.lit(_WORD)
    return F.sqrt(F.lit(-2.0) * F.log(first)) * F.cos(F.lit(2.0 * math.pi) * second)


def normal_vector(tag: str, seed: int, key, dims: int, sd: float) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    return F.transform(F.sequence(F.lit(0), F.lit(dims - 1)),
                       lambda d: normal(tag, seed, key, d) * F.lit(sd))
