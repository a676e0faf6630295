"""Groupings by (user, item) whose groups are mostly single rows."""

from pyspark.sql import functions as F

from coldspring.config import ScaleConfig
from coldspring.operators import interactions


def test_collapse_sends_rows_once_and_bounds_what_a_task_takes(spark):
    ratings = spark.range(5000).select((F.col("id") % 50).alias("user_id"), (F.col("id") % 2451).alias("item_id"), F.lit(1.5).alias("rating"))
    plain = interactions.collapse(ratings)
    cut = interactions.collapse(ratings, 5000, ScaleConfig(rows_per_task=500))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    assert cut.rdd.getNumPartitions() == 10
    executed = cut._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert executed.count("Exchange") == 1      # no second shuffle of combined rows


def test_collapse_keeps_null_keys(spark):
    ratings = spark.createDataFrame([(None, 1, 2.0), (None, 1, 3.0), (1, None, 1.0)], "user_id long, item_id long, rating double")
    assert sorted(interactions.collapse(ratings, 3).collect(), key=str) == sorted(interactions.collapse(ratings).collect(), key=str)
