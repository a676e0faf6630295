"""Time-ordered train/test split with deliberately created cold users and items."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.config import ScaleConfig, SplitConfig
from coldspring.functions import hashing
from coldspring.operators import skew
from coldspring.sources.tables import Dataset
from coldspring.workspace import Workspace


@dataclass
class Split:
    ratings: DataFrame       # canonical ratings + in_train BOOLEAN
    cold_users: DataFrame    # user_id, keep_n
    cold_items: DataFrame    # item_id, keep_n


def counts_per(ratings: DataFrame, key: str) -> DataFrame:
    return ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


def lowest_by_hash(ids: DataFrame, key: str, tag: str, seed: int, size: int, limit: int,
                   n_ids: int | None = None) -> DataFrame:
    """``size`` ids drawn without replacement: the lowest in seeded hash order."""
    hashed = ids.select(key, hashing.digest(tag, seed, key).alias("_h"))
    placed = skew.with_position(hashed, [], ["_h", key], limit, known_cold=n_ids is not None and n_ids <= limit)
    return placed.filter(F.col("_pos") < size).select(key)


def pick_cold(counts: DataFrame, key: str, at_least: int, share: float, cfg: SplitConfig,
              limit: int) -> DataFrame:
    """Ids turned cold, with the number (0 .. cold_below-1) of ratings each keeps."""
    facts = counts.agg(F.count(F.lit(1)).alias("total"),
                       F.count_if(F.col("n") >= at_least).alias("eligible")).first()
    size = min(facts.eligible, round(share * facts.total))
    picked = lowest_by_hash(counts.filter(F.col("n") >= at_least), key, f"cold-{key}", cfg.seed, size, limit,
                            facts.eligible)
    return picked.withColumn("keep_n", hashing.small_int(f"keep-{key}", cfg.seed, key, cfg.cold_below))


def meet_cold(ratings: DataFrame, cold: DataFrame, key: str, hot: DataFrame | None, spread: str, n_ratings: int, scale: ScaleConfig) -> DataFrame:
    """Ratings with the ``cold`` row of their key, if there is one. A short list is broadcast, so that no rating is moved or
    sorted; for a long one both sides are dealt, at most about ``rows_per_task`` ratings to a task."""
    if cold.count() <= scale.broadcast_ids:
        return ratings.join(F.broadcast(cold), key, "left")
    return skew.spread_join(ratings, cold, key, hot, spread, "left", skew.tasks_for(ratings, n_ratings, scale))


def make_split(ratings: DataFrame, cfg: SplitConfig, scale: ScaleConfig, workspace: Workspace) -> Split:
    """Flag every rating as train or test.

    both cold             -> test
    item_cold (user warm) -> the first keep_n ratings of the item train
    user_cold (item warm) -> the first keep_n ratings of the user train
    both_warm             -> the newest floor(test_share * size) of the user test
    """
    users = workspace.stage(counts_per(ratings, "user_id"), "user-counts")
    items = workspace.stage(counts_per(ratings, "item_id"), "item-counts")
    facts = users.agg(F.sum("n").alias("rows"), F.max("n").alias("top")).first()
    limit = skew.row_limit(facts.rows or 0, scale)
    top_item = items.agg(F.max("n")).first()[0] or 0
    hot_users = skew.hot_keys(users, "user_id", "n", limit) if (facts.top or 0) > limit else None
    hot_items = skew.hot_keys(items, "item_id", "n", limit) if top_item > limit else None

    cold_users = workspace.stage(
        pick_cold(users, "user_id", cfg.min_user_ratings, cfg.cold_user_share, cfg, limit), "cold-users")
    cold_items = workspace.stage(
        pick_cold(items, "item_id", cfg.min_item_ratings, cfg.cold_item_share, cfg, limit), "cold-items")

    n_ratings = facts.rows or 0
    flagged = meet_cold(ratings, cold_users.withColumnRenamed("keep_n", "_keep_user"), "user_id", hot_users, "item_id", n_ratings, scale)
    flagged = meet_cold(flagged, cold_items.withColumnRenamed("keep_n", "_keep_item"), "item_id", hot_items, "user_id", n_ratings, scale)
    user_cold, item_cold = F.col("_keep_user").isNotNull(), F.col("_keep_item").isNotNull()
    flagged = flagged.withColumn(
        "case_id", F.when(user_cold & item_cold, "both_cold").when(item_cold, "item_cold")
        .when(user_cold, "user_cold").otherwise("both_warm"))
    flagged = flagged.withColumn(
        "_key", F.when(F.col("case_id") == "item_cold", F.col("item_id")).otherwise(F.col("user_id")))

    calm = hot_users is None and hot_items is None
    if not calm:
        flagged = workspace.stage(flagged, "split-cases")
    placed = skew.with_position(flagged, ["case_id", "_key"], ["ts", "user_id", "item_id"], limit,
                                known_cold=calm, tasks=skew.tasks_for(flagged, n_ratings, scale))
    n_test = F.floor(F.col("_size") * F.lit(cfg.test_share))
    in_train = (F.when(F.col("case_id") == "both_cold", F.lit(False))
                .when(F.col("case_id") == "item_cold", F.col("_pos") < F.col("_keep_item"))
                .when(F.col("case_id") == "user_cold", F.col("_pos") < F.col("_keep_user"))
                .otherwise(F.col("_pos") < F.col("_size") - n_test))
    out = placed.select("user_id", "item_id", "rating", "ts", "case_id", in_train.alias("in_train"))
    return Split(out, cold_users, cold_items)


def sample_users(dataset: Dataset, n: int, seed: int, scale: ScaleConfig, workspace: Workspace) -> Dataset:
    """``n`` users with ratings, drawn by seeded hash: all their ratings, and their rows of the users table. The catalog stays whole."""
    users = workspace.stage(counts_per(dataset.ratings, "user_id"), "sample-counts")
    n_users, rows, top = users.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    limit = skew.row_limit(rows or 0, scale)
    hot = skew.hot_keys(users, "user_id", "n", limit) if (top or 0) > limit else None
    picked = workspace.stage(lowest_by_hash(users, "user_id", "sample", seed, n, limit, n_users), "sampled-users")
    ratings = skew.spread_join(dataset.ratings, picked, "user_id", hot, "item_id", "left_semi")
    known = None if dataset.users is None else dataset.users.join(picked, "user_id", "left_semi")
    return replace(dataset, ratings=ratings, users=known, stored=False)
