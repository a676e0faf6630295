"""The user x item history the models are fitted on, as long tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.config import ScaleConfig
from coldspring.operators.skew import dealt


def collapse(ratings: DataFrame, rows: int | None = None, scale: ScaleConfig = ScaleConfig()) -> DataFrame:
    """One row per (user, item); repeated pairs are summed. ``rows``: how many rows there are at most, if known."""
    if rows is not None:
        ratings = dealt(ratings, ["user_id", "item_id"], rows, scale)
    return ratings.groupBy("user_id", "item_id").agg(F.sum("rating").alias("rating"))


def user_stats(train_pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """n_user for every user with any rating, 0 where none of them is in train."""
    seen = train_pairs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_user"))
    return (ratings.select("user_id").distinct().join(seen, "user_id", "left")
            .select("user_id", F.coalesce("n_user", F.lit(0)).cast("long").alias("n_user")))


def item_stats(train_pairs: DataFrame, items: DataFrame) -> DataFrame:
    """n_item for every catalog item, 0 where it has no training rating."""
    seen = train_pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_item"))
    return (items.select("item_id").distinct().join(seen, "item_id", "left")
            .select("item_id", F.coalesce("n_item", F.lit(0)).cast("long").alias("n_item")))
