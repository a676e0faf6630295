"""The canonical data set, and the adapter that reads it from the star-schema tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspring.config import ScaleConfig
from coldspring.operators.skew import count_hot, dealt, lookup, spread_join, tasks_for

RATINGS = "user_id long, item_id long, rating double, ts long"
ITEMS = "item_id long, title string, year int, genres array<string>"
USERS = "user_id long, gender string, age int, occupation int"
TAGS = "item_id long, tag string"


@dataclass
class Dataset:
    name: str
    ratings: DataFrame            # user_id, item_id, rating, ts
    items: DataFrame              # item_id, title, year, genres
    users: DataFrame | None       # user_id, gender, age, occupation
    tags: DataFrame | None        # item_id, tag (one row per tag)
    stored: bool = False          # the frames are plain reads of written tables, so nobody needs to write them again


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rating_rows(spark: SparkSession, folder: str, items: DataFrame | None = None, scale: ScaleConfig = ScaleConfig()) -> DataFrame:
    """One row per order line: who bought which part, when, and a 1-5 rating from quantity. ``items``: lines of
    other parts are dropped, before they are joined.

    Orders and lines are dealt by order, so that what a task sorts does not grow with the table; a very long order is spread."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("item_id"),
        (F.lit(1.0) + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating"))
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"), F.unix_timestamp("o_orderdate").alias("ts"))
    n_lines = lines.count()
    known = lines if items is None else drop_orphans(lines, items, scale, "order_id", n_lines)
    hot = count_hot(lines, "order_id", scale, n_lines)
    return spread_join(known, orders, "order_id", hot, "item_id", tasks=tasks_for(lines, n_lines, scale)).select("user_id", "item_id", "rating", "ts")


def drop_orphans(ratings: DataFrame, items: DataFrame, scale: ScaleConfig = ScaleConfig(), spread: str = "user_id",
                 rows: int | None = None) -> DataFrame:
    """Keep ratings whose item is in the catalog. A short id list is broadcast; for a long one
    the ratings of hot items are spread by ``spread``. ``rows``: how many ratings there are at most, if known."""
    known = items.select("item_id").distinct()
    if known.count() <= scale.broadcast_ids:
        return ratings.join(F.broadcast(known), "item_id", "left_semi")
    return lookup(ratings, known, "item_id", spread, scale, "left_semi", rows)


def load_tables(spark: SparkSession, folder: str) -> Dataset:
    """One rating per (user, item): the highest rating and the earliest time. Ratings of parts that are not in the
    catalog are dropped."""
    items = table(spark, folder, "part").select(
        F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"),
        (F.lit(1950) + F.col("p_size")).cast("int").alias("year"),
        F.array("p_type", "p_brand").alias("genres"))
    known = rating_rows(spark, folder, items)
    n_lines = table(spark, folder, "lineitem").count()
    ratings = dealt(known, ["user_id", "item_id"], n_lines, ScaleConfig()).groupBy("user_id", "item_id").agg(
        F.max("rating").alias("rating"), F.min("ts").alias("ts"))
    nation = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    customer = table(spark, folder, "customer")
    users = customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("gender"),
        F.col("n_regionkey").cast("int").alias("age"), F.lit(0).alias("occupation"))
    return Dataset("tables", ratings, items, users, None)
