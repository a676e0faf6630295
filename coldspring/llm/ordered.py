"""Prefix scans over a range-sorted table, with DataFrame operations only.

A table is cut into ordered ranges, written once (range bounds come from a sample, so the cut must
not be taken twice), scanned inside each range by a window, and joined with what the ranges before
it hold: one row per range, or per range and group. A group or key of any size spans many ranges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldspring.workspace import Workspace


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def cut(df: DataFrame, workspace: Workspace, columns: list[str], name: str) -> DataFrame:
    """``df`` range-sorted by ``columns`` and written, with the number of each row's range as ``_range``."""
    ranged = df.repartitionByRange(partitions(df), *columns).withColumn("_range", F.spark_partition_id())
    return workspace.stage(ranged, name)


def running_sums(ranged: DataFrame, group: list[str], order: list[str], sums: dict[str, str]) -> DataFrame:
    """The rows of ``ranged`` (from ``cut`` by group + order) plus, for each ``sums`` entry (new column ->
    column), the sum of the rows of the same group before this one in ``order``, and ``<new column>_all``,
    the sum of the whole group.

    Group and order columns must not be null. Rows that agree in all order columns get their places
    in any order. An empty table gives an empty table.
    """
    # Per group at most one row per range.
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(*group, "_range").agg(*[F.sum(c).alias(f"_s_{n}") for n, c in sums.items()])
    for n in sums:
        offsets = (offsets.withColumn(f"_o_{n}", F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)))
                   .withColumn(f"{n}_all", F.sum(f"_s_{n}").over(Window.partitionBy(*group))))
    offsets = offsets.drop(*[f"_s_{n}" for n in sums])
    inside = (Window.partitionBy(*group, "_range").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    out = ranged.join(offsets, [*group, "_range"])
    for n, c in sums.items():
        out = out.withColumn(n, F.coalesce(F.sum(c).over(inside), F.lit(0)) + F.col(f"_o_{n}")).drop(f"_o_{n}")
    return out.drop("_range")


def sweep(points: DataFrame, marks: DataFrame, workspace: Workspace, key: str, state: str, spread: Column,
          name: str) -> DataFrame:
    """``points`` plus the ``state`` of the last of ``marks`` whose key is at most the point's key
    (null before the first mark). ``marks`` has exactly (key, state); its keys are distinct.
    ``spread``: an expression over the points that tells points with equal keys apart, so that a
    frequent key is cut over several ranges.
    """
    both = (points.withColumn("_kind", F.lit(1)).withColumn("_tie", spread)
            .unionByName(marks.withColumn("_kind", F.lit(0)).withColumn("_tie", F.lit(0).cast("long")),
                         allowMissingColumns=True))
    order = [key, "_kind", "_tie"]
    ranged = cut(both, workspace, order, name)
    upto = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row per range, hence a few thousand rows at most: one task may scan them.
    last = ranged.groupBy("_range").agg(
        F.max(F.when(F.col("_kind") == 0, F.struct(key, state)))[state].alias("_own"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = last.select("_range", F.last("_own", ignorenulls=True).over(earlier).alias("_carry"))
    return (ranged.withColumn("_here", F.last(state, ignorenulls=True).over(upto))
            .filter(F.col("_kind") == 1)
            .join(carry, "_range")
            .withColumn(state, F.coalesce("_here", "_carry"))
            .drop("_here", "_carry", "_range", "_kind", "_tie"))
