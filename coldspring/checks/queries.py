"""The registered queries: every operator run over the whole star-schema tables.

Queries with an SQL counterpart use one factor and no text block, as neither a rank-r fit nor
an SVD can be written in SQL; everything else is the library as it is used elsewhere.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coldspring.config import AlsConfig, ContentConfig, EngineConfig
from coldspring.functions import buckets, text
from coldspring.operators import als, content, gather, interactions, metrics, popularity, protocol, scorer, weights
from coldspring.operators import split as splitting
from coldspring.operators.skew import spread_join
from coldspring.plans import analysis, evaluate, serving, tune
from coldspring.plans.experiment import Experiment
from coldspring.sources.tables import drop_orphans, load_tables, rating_rows, table
from coldspring.workspace import Workspace

# Settings shared with the SQL counterparts.
PLAIN = EngineConfig(score_digits=9, als=AlsConfig(factors=1, regularization=1.0, iterations=2),
                     content=ContentConfig(text_weight=0.0))
RANK2 = EngineConfig(score_digits=6, als=AlsConfig(factors=2, regularization=1.0, iterations=2), content=ContentConfig(text_weight=0.0))
FULL = EngineConfig(als=AlsConfig(factors=16, regularization=10.0, iterations=3))
ALS_POINTS = [{"factors": f, "regularization": r, "alpha": a} for f in (1, 2) for r, a in ((1.0, 1.0), (5.0, 0.25), (20.0, 1.0))]


class Borrowed(Experiment):
    """An experiment that takes the ``names`` from another one, each when it is first asked for."""

    def __init__(self, owner: Experiment, cfg: EngineConfig, names: tuple):
        self._owner, self._names = owner, names
        super().__init__(owner.dataset, cfg, owner.workspace)

    def __getattribute__(self, name: str):
        own = object.__getattribute__(self, "__dict__")
        if name in own.get("_names", ()):
            return getattr(own["_owner"], name)
        return object.__getattribute__(self, name)


class Lab:
    """The experiments behind the queries, fitted once per session and data folder."""

    _open: dict = {}

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.workspace = Workspace(spark)

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> "Lab":
        key = (spark.sparkContext.applicationId, folder)
        if key not in cls._open:
            cls._open[key] = cls(spark, folder)
        return cls._open[key]

    @cached_property
    def plain(self) -> Experiment:
        return Experiment(load_tables(self.spark, self.folder), PLAIN, self.workspace)

    @cached_property
    def validation(self) -> Experiment:
        return tune.validation_experiment(self.plain.dataset, PLAIN, self.workspace)

    @cached_property
    def results(self) -> evaluate.Results:
        return evaluate.evaluate(self.plain)

    @cached_property
    def rank2(self) -> Experiment:
        """The plain experiment with two factors instead of one."""
        return Borrowed(self.plain, RANK2, ("split", "train_pairs", "user_stats", "item_stats", "sizes", "liked", "user_segments", "segments", "n_deltas",
                                            "popularity_vectors", "percentiles", "features", "by_user", "by_item", "profiles"))

    @cached_property
    def new_pairs(self) -> gather.EdgeBlocks:
        _, ratings = self.new_requests
        pairs = self.workspace.stage(ratings.select(F.col("request_id").alias("target"), F.col("item_id").alias("src"),
                                                    F.col("rating").alias("w")), "fold-pairs")
        return gather.build_blocks(pairs, pairs.count(), PLAIN.scale, self.workspace, "fold",
                                   shipped=self.plain._vector_bytes("n_items") > als.renewed(PLAIN.scale).broadcast_bytes)

    @cached_property
    def full(self) -> Experiment:
        made = Experiment(load_tables(self.spark, self.folder), FULL, self.workspace)
        made.split = self.plain.split           # the same settings give the same split
        return made

    @cached_property
    def full_results(self) -> evaluate.Results:
        return evaluate.evaluate(self.full)

    @cached_property
    def new_requests(self) -> tuple[DataFrame, DataFrame]:
        """Each supplier as a person outside the training data: the parts it ships are the
        rated items (mean rating of its lines), its nation's region stands for the age."""
        lines = table(self.spark, self.folder, "lineitem")
        ratings = lines.groupBy(F.col("l_suppkey").alias("request_id"), F.col("l_partkey").alias("item_id")).agg(
            F.avg(F.lit(1.0) + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating"))
        nation = table(self.spark, self.folder, "nation").select("n_nationkey", "n_regionkey")
        supplier = table(self.spark, self.folder, "supplier")
        requests = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
            F.col("s_suppkey").cast("long").alias("request_id"),
            F.when(F.col("s_suppkey") % 3 == 0, F.lit(None)).otherwise(F.lit("BUILDING")).alias("gender"),
            F.col("n_regionkey").cast("int").alias("age"))
        return requests, ratings.withColumn("request_id", F.col("request_id").cast("long"))


# Added before rounding, so that a mean that ends in exactly half a digit rounds the same way
# whatever order it was summed in.
NUDGE = 1e-11


def tidy(df: DataFrame) -> DataFrame:
    """Integers as BIGINT and doubles rounded to six decimals, so that engines agree. Ranking
    scores are rounded already."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.LongType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in ("score", "cosine"):
            c = F.round(c + F.lit(NUDGE), 6) + F.lit(0.0)
        out.append(c.alias(f.name))
    return df.select(*out)


# --- split and history --------------------------------------------------------

def interactions_collapse(lab):
    return interactions.collapse(rating_rows(lab.spark, lab.folder))


def drop_orphan_ratings(lab):
    stocked = lab.plain.dataset.items.filter(F.array_contains("genres", "PROMO"))
    return drop_orphans(lab.plain.dataset.ratings, stocked, PLAIN.scale).select("user_id", "item_id", "rating", "ts")


def cold_pick_users(lab):
    return lab.plain.split.cold_users


def cold_pick_items(lab):
    return lab.plain.split.cold_items


def cold_start_split(lab):
    return lab.plain.split.ratings.select("user_id", "item_id", "rating", "ts", "case_id", "in_train")


def split_counts(lab):
    return lab.plain.split.ratings.groupBy("case_id", "in_train").agg(F.count(F.lit(1)).alias("n"))


def interaction_stats(lab):
    users = lab.plain.user_stats.select(F.lit("user").alias("side"), F.col("user_id").alias("id"), F.col("n_user").alias("n"))
    return users.unionByName(lab.plain.item_stats.select(F.lit("item").alias("side"), F.col("item_id").alias("id"),
                                                         F.col("n_item").alias("n")))


def sample_users(lab):
    return splitting.sample_users(lab.plain.dataset, 500, 0, PLAIN.scale, lab.workspace).ratings


def sample_users_table(lab):
    return splitting.sample_users(lab.plain.dataset, 500, 0, PLAIN.scale, lab.workspace).users.select("user_id", "gender", "age")


def truth_relevant(lab):
    return lab.plain.liked


def validation_split(lab):
    return lab.validation.split.ratings.select("user_id", "item_id", "case_id", "in_train")


# --- text and projections -----------------------------------------------------

def raw_titles(lab):
    """Part names dressed up in the title forms the parser has to handle."""
    name, n = F.initcap("p_name"), F.col("p_partkey") % 6
    year = F.concat(F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")"))
    return table(lab.spark, lab.folder, "part").select(
        F.col("p_partkey").alias("item_id"),
        F.when(n == 0, F.concat(name, F.lit(", The"), year)).when(n == 1, F.concat(F.lit("  "), name, year))
        .when(n == 2, F.concat(name, F.lit(", A"))).when(n == 3, F.concat(name, F.lit(", An (also, The)"), year))
        .when(n == 4, F.concat(name, F.lit(" (alias)"), year, F.lit("  "))).otherwise(name).alias("raw"))


def title_year_split(lab):
    return raw_titles(lab).select("item_id", text.clean_title(F.col("raw")).alias("title"),
                                  text.title_year(F.col("raw")).alias("year"))


def genre_parse(lab):
    raw = F.when(F.col("p_partkey") % 9 == 0, text.NO_GENRES).otherwise(F.concat_ws("|", "p_type", "p_brand"))
    parsed = table(lab.spark, lab.folder, "part").select(F.col("p_partkey").alias("item_id"), text.genre_list(raw).alias("g"))
    return parsed.select("item_id", F.size("g").alias("n"), F.explode_outer("g").alias("genre"))


def history_buckets(lab):
    return (lab.plain.user_stats.groupBy(buckets.history_bucket(F.col("n_user")).alias("history"))
            .agg(F.count(F.lit(1)).alias("users")))


def display_titles(lab):
    year = F.when(F.col("item_id") % 10 != 0, F.col("year"))
    return lab.plain.dataset.items.select("item_id", text.display_title(F.col("title"), year).alias("shown"))


# --- popularity ----------------------------------------------------------------

def popularity_global(lab):
    e = lab.plain
    scores = popularity.global_scores(e.item_stats, e.sizes["n_pairs"], e.sizes["n_items"])
    return scores.withColumn("score", F.round(F.col("score") + NUDGE, 6))


def popularity_segment(lab):
    scores = popularity.segment_table(lab.plain.popularity_vectors, lab.plain.segments)
    return scores.withColumn("score", F.round(F.col("score") + NUDGE, 6))


def popularity_percentile(lab):
    return lab.plain.percentiles.select("item_id", "pct")


def head_tail_items(lab):
    e = lab.plain
    return popularity.head_items(e.item_stats, e.sizes["n_pairs"], e.sizes["n_items"], PLAIN.scale.rows_per_task)


# --- content and factors ---------------------------------------------------------

def item_feature_blocks(lab):
    return content.unit_block_rows(lab.plain.dataset.items, PLAIN.content)


def tfidf_titles(lab):
    e = lab.plain
    return content.tfidf_table(e.dataset.items, e.dataset.tags, e.sizes["n_items"], FULL.content, FULL.scale, lab.workspace)


def user_profiles(lab):
    return lab.plain.profiles.select(F.col("id").alias("user_id"), F.posexplode("vec").alias("feature_no", "value"))


def similar_items(lab):
    return analysis.similar_items(lab.plain, 5)


def als_rank1_factors(lab):
    f = lab.plain.factors
    rows = f.users.select(F.lit("user").alias("side"), "id", F.get("vec", F.lit(0)).alias("value"))
    return rows.unionByName(f.items.select(F.lit("item").alias("side"), "id", F.get("vec", F.lit(0)).alias("value")))


def als_rank1_fold_in(lab):
    folded = als.fold_in(lab.new_pairs, lab.plain.factors, PLAIN.als)
    return folded.select(F.col("id").alias("request_id"), F.get("vec", F.lit(0)).alias("value"))


def als_rank2_factors(lab):
    f = lab.rank2.factors
    rows = f.users.select(F.lit("user").alias("side"), "id", F.posexplode("vec").alias("dim", "value"))
    return rows.unionByName(f.items.select(F.lit("item").alias("side"), "id", F.posexplode("vec").alias("dim", "value")))


def als_rank2_fold_in(lab):
    folded = als.fold_in(lab.new_pairs, lab.rank2.factors, RANK2.als)
    return folded.select(F.col("id").alias("request_id"), F.posexplode("vec").alias("dim", "value"))


def als_gram(lab):
    """Sums of outer products of the factor vectors, as the solver uses them."""
    e, rows = lab.rank2, []
    for side, df in (("user", e.factors.users), ("item", e.factors.items)):
        total = gather.gram(df, "vec", RANK2.als.factors)
        cells = [F.struct(F.lit(i).alias("row"), F.lit(j).alias("col"), F.lit(float(total[i, j])).alias("gram")) for i in range(2) for j in range(2)]
        rows.append(df.agg(F.count(F.lit(1)).alias("vectors"))
                    .select(F.lit(side).alias("side"), "vectors", F.inline(F.array(*cells))))
    return rows[0].unionByName(rows[1])


def topk_als_rank2(lab):
    lists = evaluate.ranked(lab.rank2, lab.results.users, {scorer.CF: {"signal": "cf"}}, 10, "rank2-lists")
    return lists.select("user_id", "rank", "item_id", "score", "hit")


# --- blending and ranking ---------------------------------------------------------

def zscore_per_user(lab):
    pairs = lab.plain.dataset.ratings.select("user_id", "item_id")
    z = evaluate.pair_signals(lab.plain, pairs)
    return z.select("user_id", "item_id", "z_cf", "z_content", F.col("z_demographic").alias("z_popularity"))


def adaptive_weights(lab, mode="adaptive"):
    e = lab.plain
    rows = spread_join(e.dataset.ratings.select("user_id", "item_id"), e.user_stats, "user_id", e.hot_users, "item_id")
    rows = spread_join(rows, e.item_stats, "item_id", e.hot_items, "user_id")
    w = weights.pair_weights(F.col("n_user"), F.col("n_item"), PLAIN.blend, mode, PLAIN.split.cold_below)
    return rows.select("user_id", "item_id", *[w[s].alias(f"w_{s}") for s in weights.SIGNALS])


def switch_weights(lab):
    return adaptive_weights(lab, "switch")


def user_mean_weights(lab):
    return serving.mean_weights(lab.plain)


def _top(lab, model):
    return lab.results.lists.filter((F.col("model") == model) & (F.col("rank") <= 10)).select(
        "user_id", "rank", "item_id", "score")


def mmr_rerank(lab):
    return _top(lab, scorer.MMR).drop("score")


def hybrid_explain(lab):
    e = lab.plain
    lists = serving.recommend_users(e, lab.results.users, lab.results.users.count(), ["adaptive"], 10)
    return lists.select("user_id", "rank", "item_id", "score", "hit", *scorer.PARTS)


def price_distance(users: dict, items: dict, shared: float) -> np.ndarray:
    """Score of a model from outside: how near the price is to what the user pays, in steps of a factor ``shared``."""
    return -np.abs(users["taste"][:, None] - items["price"][None, :]) / np.log(shared)


def price_bound(users: dict, items: dict, shared: float) -> np.ndarray:
    low, high = items["price"].min(), items["price"].max()
    return -np.maximum(np.maximum(low - users["taste"], users["taste"] - high), 0) / np.log(shared)


def price_order(items: dict, shared: float) -> np.ndarray:
    return items["price"]


def two_per_decade(lists: dict, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Re-ranker from outside: rank order, but no third item of a decade."""
    decade, used = lists["decade"], lists["used"]
    earlier = np.tril(decade[:, :, None] == decade[:, None, :], -1).sum(axis=2)
    allowed = used & (earlier < 2)
    picks = np.argsort(~allowed, axis=1, kind="stable")[:, :k]
    return picks, np.take_along_axis(allowed, picks, axis=1)


def own_models(lab) -> dict[str, dict]:
    """A model from outside the library (with columns of its own for users and items), bare and re-ranked."""
    e = lab.plain
    prices = table(lab.spark, lab.folder, "part").select(
        F.col("p_partkey").cast("long").alias("item_id"), F.log(F.col("p_retailprice").cast("double")).alias("price"),
        text.decade(F.lit(1950) + F.col("p_size")).cast("double").alias("decade"))
    paid = spread_join(e.train_pairs, prices, "item_id", e.hot_items, "user_id")
    own = protocol.OwnModel(price_distance, paid.groupBy("user_id").agg(F.avg("price").alias("taste")), prices, 2.0, price_bound, price_order)
    return {scorer.POPULARITY: {"signal": "popularity"}, "Price": {"own": own},
            "Price, two per decade": {"own": own, "rerank": protocol.Reranker(two_per_decade, 50)}}


def custom_scorer_topk(lab):
    lists = evaluate.ranked(lab.plain, lab.results.users, own_models(lab), 10, "own-lists")
    return lists.select("model", "user_id", "rank", "item_id", "score", "hit")


def topk_content_sparse(lab):
    lists = evaluate.ranked_by_sparse_content(lab.plain, lab.results.users, 10, "sparse-lists")
    return lists.select("user_id", "rank", "item_id", "score")


# --- metrics ---------------------------------------------------------------------

def ranking_metrics(lab):
    names = metrics.metric_names(PLAIN.ks)
    return lab.results.per_user.select("model", "user_id", "n_relevant", "n_train",
                        *[F.col(f"`{n}`").alias(n.replace("@", "_")) for n in names])


def hit_flags(lab):
    lists = lab.results.lists.filter(F.col("rank") <= 10).drop("hit")
    flagged = metrics.flag_hits(lists, lab.plain.liked)
    return flagged.groupBy("model", "rank").agg(
        F.count_if("hit").alias("hits"), F.count(F.lit(1)).alias("rows"))


def beyond_accuracy(lab):
    return lab.results.summary.filter(F.col("slice") == metrics.ALL).select(
        "model", "users", "coverage", "novelty", "diversity")


def _summary(lab):
    return lab.results.summary


def slice_metrics(lab):
    rows = _summary(lab).filter(F.col("slice") != metrics.cold_item_slice(5))
    return rows.select("slice", "model", "users", *[F.col(f"`{m}@10`").alias(m) for m in ("precision", "recall", "ndcg", "hit")],
                       "coverage", "novelty", "diversity")


def cold_item_slice(lab):
    rows = _summary(lab).filter(F.col("slice") == metrics.cold_item_slice(5))
    return rows.select("model", "users", *[F.col(f"`{m}@10`").alias(m) for m in ("precision", "recall", "ndcg", "hit")],
                       "coverage", "novelty", "diversity")


def robustness_table(lab):
    return metrics.robustness(lab.results.summary, 10, 5)


def best_models(lab):
    names = ["precision", "recall", "ndcg", "hit"]
    rows = _summary(lab).withColumnsRenamed({f"{n}@10": n for n in names})
    return metrics.best_per_column(rows, [*names, "coverage", "novelty", "diversity"])


def geo_mean_objective(lab):
    hard = [metrics.warm_slice(5), metrics.cold_slice(5), metrics.cold_item_slice(5)]
    return _summary(lab).filter(F.col("slice").isin(hard)).groupBy("model").agg(
        metrics.geometric_mean(F.col("`ndcg@10`")).alias("objective"))


def model_lift(lab):
    """NDCG of each model against global popularity on every slice, in percent."""
    rows = _summary(lab).select("slice", "model", F.round("`ndcg@10`", 6).alias("ndcg"))
    base = rows.filter(F.col("model") == scorer.POPULARITY).select("slice", F.col("ndcg").alias("base"))
    return rows.join(base, "slice").select("slice", "model", buckets.lift_percent(F.col("ndcg"), F.col("base")).alias("lift"))


def dataset_facts(lab):
    return evaluate.dataset_facts(lab.plain, lab.results)


# --- failure analysis --------------------------------------------------------------

def ndcg_by_history(lab):
    return analysis.ndcg_by_history(lab.results.per_user, analysis.HISTORY_MODELS, 10)


def weights_by_history(lab):
    return analysis.weights_by_history(lab.plain)


def mainstream_quintiles(lab):
    return analysis.mainstream_quintiles(lab.plain, lab.results.per_user, 10)


def popularity_bias(lab):
    return analysis.popularity_bias(lab.plain, lab.results, 10)


def genre_recall(lab):
    return analysis.genre_recall(lab.plain, lab.results, 10)


def cold_user_rating_bands(lab):
    return analysis.cold_user_rating_bands(lab.plain, lab.results.per_user, 10)


def case_studies(lab):
    cases = analysis.case_studies(lab.plain, lab.results, 10)
    return cases.select("user_id", "liked_count", *[F.concat_ws(" | ", c).alias(c) for c in
                                                    ("history", "recommended", "actually_liked")])


def hardest_cold_items(lab):
    rows = analysis.hardest_cold_items(lab.plain, lab.results, 10)
    return rows.withColumn("nearest_by_content", F.concat_ws(" | ", "nearest_by_content"))


def content_ablation(lab):
    return analysis.content_ablation(lab.plain, lab.results, 10)


def content_ablation_text(lab):
    return analysis.content_ablation(lab.full, lab.full_results, 10)


def lsa_embedding(lab):
    vecs, _ = lab.full.embedding
    return vecs.select(F.col("id").alias("item_id"), F.size("vec").alias("dims"),
                       F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x).alias("energy"))


def lsa_rank2_embedding(lab):
    """The two leading directions (sign left open)."""
    e, cfg = lab.plain, ContentConfig(text_dims=2)
    weights_ = content.tfidf_table(e.dataset.items, e.dataset.tags, e.sizes["n_items"], cfg, PLAIN.scale, lab.workspace)
    vecs, _ = content.text_embedding(weights_, e.sizes["n_items"], cfg, PLAIN.scale, lab.workspace)
    return vecs.select(F.col("id").alias("item_id"), F.abs(F.get("vec", F.lit(0))).alias("first"), F.abs(F.get("vec", F.lit(1))).alias("second"))


def als_topk(lab):
    return lab.full_results.lists.filter((F.col("model") == scorer.CF) & (F.col("rank") <= 10)).select(
        "user_id", "rank", "item_id", "score")


def full_slice_metrics(lab):
    return lab.full_results.summary.select("slice", "model", "users", F.col("`ndcg@10`").alias("ndcg"), "coverage",
                                           "novelty", "diversity")


def blend_grid(lab):
    return tune.blend_grid(lab.validation)


def als_grid(lab):
    return tune.als_grid(lab.validation, ALS_POINTS)


# --- serving -----------------------------------------------------------------------

def recommend_new_users(lab):
    requests, ratings = lab.new_requests
    lists = serving.recommend_new_users(lab.plain, requests, ratings, ["adaptive"], 10)
    return lists.select("request_id", "history_size", "rank", "item_id", "score", *scorer.PARTS)


def catalog_search(lab):
    part = table(lab.spark, lab.folder, "part")
    queries = (part.select(F.substring_index("p_name", " ", 1).alias("query"))
               .unionByName(part.select(F.upper(F.substr("p_name", F.lit(2), F.lit(4))).alias("query")))
               .unionByName(part.select(F.substr("p_name", F.lit(1), F.lit(1)).alias("query"))).distinct())
    return serving.search(lab.plain, queries).select("query", "rank", "item_id", "title", "n_item")


def user_history_top(lab):
    return serving.user_history(lab.plain).select("user_id", "rank", "item_id", "title", "rating", "n_item")


def user_summary(lab):
    return serving.user_summary(lab.plain)


def example_users(lab):
    return serving.example_users(lab.plain)


def dataset_meta(lab):
    rows = serving.meta(lab.plain)
    pairs = lambda c, *names: F.array_join(F.transform(c, lambda r: F.concat_ws(" ", *[r[n].cast("string") for n in names])), " | ")
    return rows.withColumns({"models": F.array_join("models", " | "), "age_groups": pairs("age_groups", "value", "label"),
                             "examples": pairs("examples", "label", "user_id", "ratings")})


def requests_from_orders(lab):
    """Each order as a request, with faults set by its key: the lines are the ratings."""
    key = F.col("o_orderkey")
    lines = table(lab.spark, lab.folder, "lineitem").select(
        "l_orderkey", F.struct(
            F.when(F.col("l_orderkey") % 11 == 0, F.col("l_partkey") + 1_000_000_000).otherwise(F.col("l_partkey")).alias("item_id"),
            F.when(F.col("l_orderkey") % 13 == 0, 9.0)
            .otherwise(F.lit(1.0) + F.floor((F.col("l_quantity") - 1) / 10)).alias("rating")).alias("r"))
    given = lines.groupBy("l_orderkey").agg(F.collect_list("r").alias("ratings"))
    keys = F.array(*[F.lit(k) for k in serving.MODEL_KEYS])
    return (table(lab.spark, lab.folder, "orders").join(given, key == F.col("l_orderkey"), "left")
            .select(key.alias("request_id"),
                    F.when(key % 23 == 0, "nope").otherwise(F.get(keys, (key % 6).cast("int"))).alias("model"),
                    (key % 55).cast("int").alias("k"),
                    F.when(key % 3 == 0, F.lit(None)).when(key % 17 == 0, "abc")
                    .when(key % 19 == 0, (F.col("o_custkey") + 1_000_000_000).cast("string"))
                    .otherwise(F.col("o_custkey").cast("string")).alias("user_id"),
                    F.coalesce("ratings", F.array().cast("array<struct<item_id:bigint,rating:double>>")).alias("ratings"),
                    F.when(key % 7 == 0, "X").when(key % 2 == 0, "M").otherwise("F").alias("gender"),
                    F.when(key % 29 == 0, 26).otherwise(25).alias("age")))


def request_validation(lab):
    checked = serving.validate_requests(lab.plain, requests_from_orders(lab))
    return checked.select("request_id", "valid", F.concat_ws(",", "errors").alias("errors"))


_LISTS = {"topk_popularity": scorer.POPULARITY, "topk_popularity_segment": scorer.DEMOGRAPHIC, "topk_als_rank1": scorer.CF,
          "topk_content": scorer.CONTENT, "hybrid_fixed_topk": scorer.FIXED, "hybrid_switch_topk": scorer.SWITCH,
          "hybrid_topk": scorer.ADAPTIVE}

_NAMED = [interactions_collapse, drop_orphan_ratings, cold_pick_users, cold_pick_items, cold_start_split, split_counts,
          interaction_stats, sample_users, sample_users_table, truth_relevant, validation_split, title_year_split, genre_parse,
          history_buckets, display_titles, popularity_global, popularity_segment, popularity_percentile, head_tail_items,
          item_feature_blocks, tfidf_titles, user_profiles, similar_items, als_rank1_factors, als_rank1_fold_in,
          als_rank2_factors, als_rank2_fold_in, als_gram, topk_als_rank2, zscore_per_user, adaptive_weights, switch_weights, user_mean_weights, mmr_rerank, hybrid_explain, custom_scorer_topk, topk_content_sparse,
          ranking_metrics, hit_flags, beyond_accuracy, slice_metrics, cold_item_slice, robustness_table, best_models,
          geo_mean_objective, model_lift, dataset_facts, ndcg_by_history, weights_by_history, mainstream_quintiles,
          popularity_bias, genre_recall, cold_user_rating_bands, case_studies, hardest_cold_items, content_ablation, content_ablation_text,
          lsa_embedding, lsa_rank2_embedding, als_topk, full_slice_metrics, blend_grid, als_grid, recommend_new_users, catalog_search,
          user_history_top, user_summary, example_users, dataset_meta, request_validation]


def registered() -> dict:
    def run(build):
        return lambda spark, folder: tidy(build(Lab.of(spark, folder)))

    out = {f.__name__: run(f) for f in _NAMED}
    for name, model in _LISTS.items():
        out[name] = run(lambda lab, model=model: _top(lab, model))
    return out
