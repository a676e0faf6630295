"""Global and smoothed demographic popularity (natural-log shares)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspring.config import ScaleConfig
from coldspring.functions.buckets import segment
from coldspring.operators.skew import spread_join, with_position
from coldspring.workspace import Workspace


def share(n_item: Column, total_pairs: int, n_items: int) -> Column:
    return (n_item + 1.0) / F.lit(float(total_pairs + n_items))


def global_scores(item_stats: DataFrame, total_pairs: int, n_items: int) -> DataFrame:
    return item_stats.select("item_id", F.log(share(F.col("n_item"), total_pairs, n_items)).alias("score"))


def user_segments(users: DataFrame) -> DataFrame:
    return (users.select("user_id", segment(F.col("gender"), F.col("age")).alias("segment"))
            .filter(F.col("segment").isNotNull()))


def segment_counts(train_pairs: DataFrame, segments: DataFrame, hot_users: DataFrame | None) -> DataFrame:
    """Distinct (user, item) pairs of the members, per segment and item (sparse)."""
    joined = spread_join(train_pairs.select("user_id", "item_id"), segments, "user_id", hot_users, "item_id")
    return joined.groupBy("segment", "item_id").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Segments:
    """The segments of users. The score ln((n + m g) / (total + m)) of an item with global share g that n members of a
    segment have rated is ln g + base + delta: base = ln(m / (total + m)) belongs to the segment, delta = ln(1 + n / (m g))
    is 0 unless a member has rated the item. So only the deltas are stored per item and segment."""
    table: DataFrame      # segment, segment_no, base
    base: np.ndarray      # by number; one more for users without a segment, 0

    @property
    def n(self) -> int:
        return len(self.base) - 1


def number_segments(segments_of: DataFrame, seg_counts: DataFrame, smoothing: float, scale: ScaleConfig, workspace: Workspace) -> Segments:
    """Segments by name. One number per segment reaches the driver and the executors; more than ``max_hot_rows`` are an error."""
    if smoothing <= 0:
        raise ValueError("the smoothing of segment scores must be above 0")
    names = workspace.stage(segments_of.select("segment").distinct(), "segment-names")
    n = names.count()
    if n > scale.max_hot_rows:
        raise ValueError(f"{n} segments of users")
    numbered = with_position(names, [], ["segment"], scale.rows_per_task, known_cold=n <= scale.rows_per_task)
    totals = seg_counts.groupBy("segment").agg(F.sum("n").alias("_total"))
    table = workspace.stage(numbered.join(totals, "segment", "left").select(
        "segment", F.col("_pos").cast("int").alias("segment_no"),
        F.log(F.lit(float(smoothing)) / (F.coalesce("_total", F.lit(0)) + F.lit(float(smoothing)))).alias("base")), "segments")
    rows = table.select("segment_no", "base").toArrow().sort_by("segment_no")
    return Segments(table, np.append(rows.column("base").to_numpy(), 0.0))


def segment_vectors(item_stats: DataFrame, seg_counts: DataFrame, segments: Segments, total_pairs: int, n_items: int,
                    smoothing: float) -> DataFrame:
    """(item_id, n_item, popularity, seg_no, seg_delta): the global score, and the deltas of the segments that have rated
    the item, by number (an item has at most one entry per segment)."""
    g = share(F.col("n_item"), total_pairs, n_items)
    entry = F.struct("segment_no", F.col("n").alias("n"))
    lists = (seg_counts.join(F.broadcast(segments.table.select("segment", "segment_no")), "segment")
             .groupBy("item_id").agg(F.sort_array(F.collect_list(entry)).alias("_s")))
    none = F.array().cast("array<struct<segment_no:int,n:bigint>>")
    rows = item_stats.join(lists, "item_id", "left").withColumn("_s", F.coalesce("_s", none)).withColumn("_prior", smoothing * g)
    return rows.select("item_id", "n_item", F.log(g).alias("popularity"), F.col("_s.segment_no").alias("seg_no"),
                       F.transform("_s", lambda s: F.log1p(s["n"] / F.col("_prior"))).alias("seg_delta"))


def segment_table(vectors: DataFrame, segments: Segments) -> DataFrame:
    """(segment, item_id, score) with every catalog item in each segment."""
    numbers = F.sequence(F.lit(0), F.lit(segments.n - 1)) if segments.n else F.array().cast("array<int>")
    every = vectors.select("item_id", "popularity", F.map_from_arrays("seg_no", "seg_delta").alias("_d"), F.explode(numbers).alias("segment_no"))
    return every.join(F.broadcast(segments.table), "segment_no").select(
        "segment", "item_id", (F.col("popularity") + F.col("base") + F.coalesce(F.col("_d")[F.col("segment_no")], F.lit(0.0))).alias("score"))


def percentile(item_stats: DataFrame, n_items: int, limit: int) -> DataFrame:
    """Place in (n_item, item_id) order over n_items - 1; ties get distinct places."""
    placed = with_position(item_stats, [], ["n_item", "item_id"], limit, known_cold=n_items <= limit)
    return placed.select("item_id", "n_item",
                         (F.col("_pos") / F.lit(float(max(n_items - 1, 1)))).alias("pct"))


def head_items(item_stats: DataFrame, total_pairs: int, n_items: int, limit: int) -> DataFrame:
    """Flag the most-rated items that together hold half of all training pairs: every item
    whose predecessors hold less than half."""
    ranked = item_stats.withColumn("_desc", -F.col("n_item"))
    placed = with_position(ranked, [], ["_desc", "item_id"], limit, known_cold=n_items <= limit,
                           sums={"_upto": "n_item"})
    return placed.select("item_id", "n_item",
                         ((F.col("_upto") - F.col("n_item")) / F.lit(float(max(total_pairs, 1)))
                          < 0.5).alias("is_head"))
