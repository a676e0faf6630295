"""Joins and ordered positions that stay balanced when one key holds most rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coldspring.config import ScaleConfig
from coldspring.workspace import Workspace


def row_limit(total_rows: int, scale: ScaleConfig) -> int:
    """Rows one group may have before it is split.

    Grows with the table, so that there are at most ``max_hot_rows`` groups above
    it and the hot-key lists that get broadcast have a fixed bound.
    """
    return max(scale.rows_per_task, math.ceil(total_rows / scale.max_hot_rows))


def hot_keys(counts: DataFrame, key: str, n: str, limit: int) -> DataFrame:
    """(key, _parts) for keys with more than ``limit`` rows."""
    return (counts.filter(F.col(n) > limit)
            .select(key, F.ceil(F.col(n) / limit).cast("long").alias("_parts")))


def spread_join(left: DataFrame, right: DataFrame, key: str, hot: DataFrame | None, spread,
                how: str = "inner", tasks: int | None = None) -> DataFrame:
    """Join many-rows-per-key ``left`` with one-row-per-key ``right``.

    Rows of a hot key are cut into ``_parts`` by the hash of the ``spread`` columns and
    meet one copy of the right row per part; other keys join as usual.
    ``tasks``: both sides are dealt into that many, so that what a task sorts does not grow with the table.
    """
    if hot is None:
        return _meet(left, right, [key], how, tasks)
    hot = F.broadcast(hot)
    spread = [spread] if isinstance(spread, str) else list(spread)
    cut = (left.join(hot, key, "left")
           .withColumn("_part", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_parts")), F.lit(0)))
           .drop("_parts"))
    copies = (right.join(hot, key, "left")
              .withColumn("_part", F.explode(F.sequence(
                  F.lit(0).cast("long"), F.coalesce(F.col("_parts") - 1, F.lit(0)))))
              .drop("_parts"))
    return _meet(cut, copies, [key, "_part"], how, tasks).drop("_part")


def _meet(left: DataFrame, right: DataFrame, keys: list[str], how: str, tasks: int | None) -> DataFrame:
    if tasks is not None:
        left, right = left.repartition(tasks, *keys), right.repartition(tasks, *keys)
    return left.join(right, keys, how)


def tasks_for(df: DataFrame, rows: int, scale: ScaleConfig) -> int:
    """Tasks of at most about ``rows_per_task`` rows for ``rows`` rows."""
    few = min(df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / 20_000))
    return max(1, few, math.ceil(rows / scale.rows_per_task))


def dealt(df: DataFrame, keys: list[str], rows: int, scale: ScaleConfig) -> DataFrame:
    """``df`` of at most ``rows`` rows dealt by ``keys``, at most about ``rows_per_task`` to a task. A grouping by the keys follows without
    a map-side combine, whose table of groups would grow with the file splits where most groups have one row."""
    return df.repartition(tasks_for(df, rows, scale), *keys)


def count_hot(df: DataFrame, key: str, scale: ScaleConfig, rows: int | None = None) -> DataFrame | None:
    """The hot keys of ``df`` by one counting pass: with map-side combine, or dealt if ``rows``, the number of rows at most, is known."""
    keys = df if rows is None else dealt(df.select(key), [key], rows, scale)
    counts = keys.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    top, total = counts.agg(F.max("_rows"), F.sum("_rows")).first()
    limit = row_limit(total or 0, scale)
    return hot_keys(counts, key, "_rows", limit) if (top or 0) > limit else None


def lookup(left: DataFrame, right: DataFrame, key: str, spread, scale: ScaleConfig, how: str = "inner",
           rows: int | None = None) -> DataFrame:
    """``spread_join`` that finds the hot keys of ``left`` itself. ``left`` is read twice, so stage it if it is costly.
    ``rows``: how many rows ``left`` has at most, if known; counting and join are then dealt."""
    hot = count_hot(left, key, scale, rows)
    return spread_join(left, right, key, hot, spread, how, None if rows is None else tasks_for(left, rows, scale))


def with_position(df: DataFrame, keys: list[str], order: list[str], limit: int,
                  hot: DataFrame | None = None, known_cold: bool = False,
                  sums: dict[str, str] | None = None, tasks: int | None = None) -> DataFrame:
    """Exact 0-based place ``_pos`` of each row in its group, the group size ``_size``, and
    for each ``sums`` entry (name -> column) the running sum up to and including the row.

    If a group has more than ``limit`` rows, the table is range-partitioned by keys and order and written (the bounds
    are sampled, so they must not be drawn twice). A window counts inside each range, and the rows of the group in
    earlier ranges come from one row per group and range. ``order`` is ascending and must be unique within a group for
    a stable result. ``df`` is read several times when there are hot groups, so stage it first. ``tasks``: into how many
    the groups are dealt if none is hot.
    """
    sums = sums or {}
    lone = not keys
    if lone:
        df, keys = df.withColumn("_all", F.lit(0)), ["_all"]
    if hot is None and not known_cold:
        hot = df.groupBy(*keys).count().filter(F.col("count") > limit).select(*keys)
        if hot.isEmpty():
            hot = None
    elif known_cold:
        hot = None

    if hot is None:
        group = Window.partitionBy(*keys)
        upto = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        df = df if tasks is None else df.repartition(tasks, *keys)
        out = (df.withColumn("_pos", F.row_number().over(group.orderBy(*order)) - 1)
               .withColumn("_size", F.count(F.lit(1)).over(group)))
        for name, column in sums.items():
            out = out.withColumn(name, F.sum(column).over(upto))
        return out.drop("_all") if lone else out

    ranges = max(2, math.ceil(df.count() / limit))
    ranged = Workspace(df.sparkSession).stage(
        df.repartitionByRange(ranges, *keys, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(column).alias(f"_sum_{name}") for name, column in sums.items()])
    offsets = counted.select(
        *[F.col(k).alias(f"_o_{k}") for k in [*keys, "_range"]], F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_size"),
        *[F.coalesce(F.sum(f"_sum_{name}").over(before), F.lit(0)).alias(f"_off_{name}") for name in sums])
    group = Window.partitionBy(*keys, "_range")
    upto = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    same = [F.col(k).eqNullSafe(F.col(f"_o_{k}")) for k in [*keys, "_range"]]
    out = ranged.withColumn("_pos", F.row_number().over(group.orderBy(*order)) - 1)
    for name, column in sums.items():
        out = out.withColumn(name, F.sum(column).over(upto))
    out = out.join(offsets, same).withColumn("_pos", F.col("_pos") + F.col("_before"))
    for name in sums:
        out = out.withColumn(name, F.col(name) + F.col(f"_off_{name}")).drop(f"_off_{name}")
    out = out.drop("_range", "_before", *[f"_o_{k}" for k in [*keys, "_range"]])
    return out.drop("_all") if lone else out


def first_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int,
                    rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group. Spark limits each group on the map side first
    (window group limit), so no task receives more than ``n`` rows per map task and key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)
