"""Ranking metrics from ranked lists: one conditional aggregation per (model, user)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "all users"


def warm_slice(cold_below: int) -> str:
    return f"warm users (>= {cold_below} ratings)"


def cold_slice(cold_below: int) -> str:
    return f"cold users (< {cold_below} ratings)"


def cold_item_slice(cold_below: int) -> str:
    return f"cold items (< {cold_below} ratings)"


def exact_slice(n: int) -> str:
    return f"cold users with exactly {n}"


def flag_hits(lists: DataFrame, truth: DataFrame) -> DataFrame:
    """Add ``hit`` to lists that lack it. (user, item) pairs are unique in ``truth``, so the
    join key has no hot value even when one item is in every list."""
    marked = truth.select("user_id", "item_id", F.lit(True).alias("_hit"))
    return (lists.join(marked, ["user_id", "item_id"], "left")
            .withColumn("hit", F.coalesce("_hit", F.lit(False))).drop("_hit"))


def ideal_dcg(n_relevant: Column, k: int) -> Column:
    sums, running = [], 0.0
    for rank in range(1, k + 1):
        running += 1.0 / math.log2(rank + 1)
        sums.append(F.lit(running))
    return F.element_at(F.array(*sums), F.least(n_relevant, F.lit(k)).cast("int"))


def metric_names(ks) -> list[str]:
    return [f"{m}@{k}" for k in ks for m in ("precision", "recall", "ndcg", "hit")]


def per_user(lists: DataFrame, eval_users: DataFrame, models: list[str], ks, list_k: int,
             n_users: int) -> DataFrame:
    """A row per (model, user) with precision, recall, ndcg and hit at each k, plus novelty
    and diversity of the first ``list_k``. Users with an empty list count with zeros.

    ``lists``: model, user_id, rank, hit, n_item, sim_before.
    ``eval_users``: user_id, n_relevant (> 0), n_train.
    """
    rank, hit = F.col("rank"), F.col("hit")
    gain = F.when(hit, 1.0 / F.log2(rank + 1.0)).otherwise(0.0)
    aggs = []
    for k in ks:
        aggs += [F.count_if(hit & (rank <= k)).alias(f"_hits{k}"),
                 F.sum(F.when(rank <= k, gain).otherwise(0.0)).alias(f"_dcg{k}")]
    top = rank <= list_k
    bits = -F.log2((F.col("n_item") + 1.0) / F.lit(n_users + 1.0))
    aggs += [F.avg(F.when(top, bits)).alias("novelty"), F.count_if(top).alias("_len"),
             F.sum(F.when(top, F.col("sim_before"))).alias("_sim")]
    found = lists.groupBy("model", "user_id").agg(*aggs)
    every = eval_users.select("user_id", "n_relevant", "n_train",
                              F.explode(F.array(*[F.lit(m) for m in models])).alias("model"))
    joined = every.join(found, ["model", "user_id"], "left")
    out = ["model", "user_id", "n_relevant", "n_train"]
    for k in ks:
        hits = F.coalesce(F.col(f"_hits{k}"), F.lit(0))
        out += [(hits / F.lit(float(k))).alias(f"precision@{k}"),
                (hits / F.col("n_relevant")).alias(f"recall@{k}"),
                (F.coalesce(F.col(f"_dcg{k}"), F.lit(0.0)) / ideal_dcg(F.col("n_relevant"), k)).alias(f"ndcg@{k}"),
                F.when(hits > 0, 1.0).otherwise(0.0).alias(f"hit@{k}")]
    pairs = F.col("_len") * (F.col("_len") - 1)
    out += ["novelty", F.when(F.col("_len") >= 2, 1.0 - 2.0 * F.col("_sim") / pairs).alias("diversity")]
    return joined.select(*out)


def slices_of(n_train: Column, cold_below: int) -> Column:
    """The slices a user belongs to, as an array (a user is in several)."""
    exact = F
    for n in range(cold_below):
        exact = exact.when(n_train == n, F.lit(exact_slice(n)))
    return F.when(n_train >= cold_below, F.array(F.lit(ALL), F.lit(warm_slice(cold_below)))).otherwise(
        F.array(F.lit(ALL), F.lit(cold_slice(cold_below)), exact))


def slice_names(cold_below: int) -> list[str]:
    """Every slice that ``slices_of`` can name."""
    return [ALL, warm_slice(cold_below), cold_slice(cold_below), *[exact_slice(n) for n in range(cold_below)]]


def coverage(lists: DataFrame, list_k: int, n_items: int, slices: Column) -> DataFrame:
    """Share of the whole catalog found in the first ``list_k`` of anybody in the slice. Items are collected in bitmaps by
    groups of users with the same slices; overlapping slices merge the bitmaps of their groups."""
    kept = lists.filter(F.col("rank") <= list_k).select(
        "model", slices.alias("_slices"), F.bitmap_bucket_number("item_id").alias("_bucket"), F.bitmap_bit_position("item_id").alias("_bit"))
    groups = kept.groupBy("model", "_slices", "_bucket").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    return (groups.select("model", "_bucket", "_bits", F.explode("_slices").alias("slice"))
            .groupBy("slice", "model", "_bucket").agg(F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_n"))
            .groupBy("slice", "model").agg((F.sum("_n") / F.lit(float(n_items))).alias("coverage")))


def summarise(frame: DataFrame, lists: DataFrame, ks, list_k: int, n_items: int, slices: Column, names: list[str],
              models: list[str]) -> DataFrame:
    """(slice, model, users, mean of every metric, coverage, novelty, diversity) for each of the slices ``names`` and each
    model. A slice without users has 0 users and no means."""
    means = [F.avg(f"`{name}`").alias(name) for name in metric_names(ks)]
    grouped = (frame.withColumn("slice", F.explode(slices)).groupBy("slice", "model")
               .agg(F.count(F.lit(1)).alias("users"), *means, F.avg("novelty").alias("novelty"), F.avg("diversity").alias("diversity")))
    share = coverage(lists, list_k, n_items, slices)
    every = (frame.sparkSession.range(1).select(F.explode(F.array(*[F.lit(n) for n in names])).alias("slice"))
             .select("slice", F.explode(F.array(*[F.lit(m) for m in models])).alias("model")))
    out = every.join(grouped, ["slice", "model"], "left").join(share, ["slice", "model"], "left")
    return out.select("slice", "model", F.coalesce("users", F.lit(0)).alias("users"), *[f"`{n}`" for n in metric_names(ks)],
                      *[F.coalesce(n, F.lit(0.0)).alias(n) for n in ("novelty", "diversity", "coverage")])


def robustness(summary: DataFrame, k: int, cold_below: int) -> DataFrame:
    """NDCG per main slice and the worst ratio to the best model over the three hard slices.
    Only models scored on every slice take part."""
    hard = {"warm_users": warm_slice(cold_below), "cold_users": cold_slice(cold_below),
            "cold_items": cold_item_slice(cold_below)}
    score = F.col(f"`ndcg@{k}`")
    scored = summary.filter(F.col("slice") == hard["cold_items"]).select("model")
    wide = (summary.join(scored, "model", "left_semi").groupBy("model").agg(
        F.max(F.when(F.col("slice") == ALL, score)).alias("all_users"),
        *[F.max(F.when(F.col("slice") == name, score)).alias(label) for label, name in hard.items()]))
    best = wide.agg(*[F.max(label).alias(f"_best_{label}") for label in hard])
    ratios = [F.col(label) / F.col(f"_best_{label}") for label in hard]
    # ``best`` is one row.
    return (wide.join(F.broadcast(best), F.lit(True))
            .select("model", "all_users", *hard, F.least(*ratios).alias("worst_vs_best")))


def best_per_column(summary: DataFrame, names: list[str], digits: int = 9) -> DataFrame:
    """For each metric a flag whether the model has the slice's highest value (values that agree
    to ``digits`` decimals are equal)."""
    rounded = summary.select("slice", "model", *[F.round(f"`{n}`", digits).alias(n) for n in names])
    tops = rounded.groupBy("slice").agg(*[F.max(f"`{n}`").alias(f"_top_{n}") for n in names])
    return rounded.join(tops, "slice").select(
        "slice", "model", *[(F.col(f"`{n}`") == F.col(f"`_top_{n}`")).alias(f"best_{n}") for n in names])


def geometric_mean(value: Column) -> Column:
    return F.exp(F.avg(F.log(F.greatest(value, F.lit(1e-9)))))
