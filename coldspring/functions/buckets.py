"""Fixed groupings: history length, mean rating, age code, and model lift."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

OPEN_END = 10 ** 9
# History-length groups as (lowest, highest, label), both ends included.
HISTORY = [(0, 0, "0"), (1, 1, "1"), (2, 2, "2"), (3, 3, "3"), (4, 4, "4"), (5, 19, "5-19"), (20, 49, "20-49"), (50, 99, "50-99"),
           (100, 199, "100-199"), (200, OPEN_END, "200+")]
# Age codes and their labels.
AGE_LABELS = {1: "Under 18", 18: "18-24", 25: "25-34", 35: "35-44", 45: "45-49", 50: "50-55",
              56: "56+"}
# Right-closed edges of the mean-rating bands.
RATING_BANDS = [(2.99, "mostly dislikes (<3)"), (3.99, "lukewarm (3-4)"), (5.0, "mostly likes (>=4)")]


def history_bucket(n: Column) -> Column:
    return F.coalesce(*[F.when(n.between(low, high), label) for low, high, label in HISTORY])


def history_table(spark: SparkSession) -> DataFrame:
    """One row per group: place, label, and the history length that stands for it (the middle, or the start of the open group)."""
    rows = [(place, label, float(low) if high == OPEN_END else 0.5 * (low + high)) for place, (low, high, label) in enumerate(HISTORY)]
    return spark.createDataFrame(rows, "bucket_no int, history string, n_mid double")


def rating_band(mean: Column) -> Column:
    out, low = F, 0.0
    for high, label in RATING_BANDS:
        out = out.when((mean > low) & (mean <= high), label)
        low = high
    return out


def age_label(code: Column) -> Column:
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in AGE_LABELS.items()))
    return F.coalesce(table[code], F.lit(""))


def segment(gender: Column, age: Column) -> Column:
    """NULL when either part is missing, so that the global fallback applies."""
    return F.when(gender.isNotNull() & age.isNotNull(),
                  F.concat_ws("-", gender, age.cast("string")))


def lift_percent(a: Column, b: Column) -> Column:
    return F.when(b > 0, F.round((a / b - 1) * 100).cast("int"))
