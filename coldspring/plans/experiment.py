"""Data set -> split -> fitted state: the tables every later job reads."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coldspring.config import AlsConfig, EngineConfig
from coldspring.operators import als, content, gather, interactions, popularity, scorer
from coldspring.operators import split as splitting
from coldspring.operators.skew import hot_keys, row_limit
from coldspring.sources.tables import Dataset
from coldspring.workspace import Workspace


class Experiment:
    """Fitted state, computed on first use; each table is written once to the workspace."""

    def __init__(self, dataset: Dataset, cfg: EngineConfig, workspace: Workspace,
                 ratings_with_split: DataFrame | None = None):
        """``ratings_with_split`` (ratings + in_train) replaces the split of this class, for a
        validation split of training data or for fitting on everything. It is a written table if the data set is."""
        self.cfg, self.workspace = cfg, workspace
        self.spark: SparkSession = workspace.spark
        tables = {name: getattr(dataset, name) for name in ("ratings", "items", "users", "tags")}
        if not dataset.stored:
            tables = {name: None if t is None else workspace.stage(t, name) for name, t in tables.items()}
        self._given_is_stored = dataset.stored
        self.dataset = Dataset(dataset.name, **tables, stored=True)
        self._given_split = ratings_with_split

    # --- split and history --------------------------------------------------

    @cached_property
    def split(self) -> splitting.Split:
        if self._given_split is not None:
            empty = self.spark.createDataFrame([], "user_id long, keep_n int")
            given = self._given_split if self._given_is_stored else self.workspace.stage(self._given_split, "split")
            return splitting.Split(given, empty,
                                   empty.withColumnRenamed("user_id", "item_id"))
        made = splitting.make_split(self.dataset.ratings, self.cfg.split, self.cfg.scale, self.workspace)
        made.ratings = self.workspace.stage(made.ratings, "split")
        return made

    @cached_property
    def train_pairs(self) -> DataFrame:
        return self.workspace.stage(interactions.collapse(
            self.split.ratings.filter("in_train"), self.split.ratings.count(), self.cfg.scale), "train-pairs")

    @cached_property
    def user_stats(self) -> DataFrame:
        return self.workspace.stage(interactions.user_stats(self.train_pairs, self.dataset.ratings), "user-stats")

    @cached_property
    def item_stats(self) -> DataFrame:
        return self.workspace.stage(interactions.item_stats(self.train_pairs, self.dataset.items), "item-stats")

    @cached_property
    def sizes(self) -> dict:
        users = self.user_stats.agg(F.count(F.lit(1)).alias("n"), F.max("n_user").alias("top")).first()
        items = self.item_stats.agg(F.count(F.lit(1)).alias("n"), F.max("n_item").alias("top"),
                                    F.sum("n_item").alias("pairs")).first()
        return {"n_users": users.n, "n_items": items.n, "n_pairs": items.pairs or 0,
                "top_user": users.top or 0, "top_item": items.top or 0}

    @cached_property
    def limit(self) -> int:
        return row_limit(self.sizes["n_pairs"], self.cfg.scale)

    @cached_property
    def hot_users(self) -> DataFrame | None:
        """Users with more training pairs than one task should take (usually none)."""
        return hot_keys(self.user_stats, "user_id", "n_user", self.limit) \
            if self.sizes["top_user"] > self.limit else None

    @cached_property
    def hot_items(self) -> DataFrame | None:
        return hot_keys(self.item_stats, "item_id", "n_item", self.limit) \
            if self.sizes["top_item"] > self.limit else None

    @cached_property
    def liked(self) -> DataFrame:
        """(user_id, item_id) of test ratings that count as relevant, one row per pair."""
        return self.workspace.stage(
            self.split.ratings.filter(~F.col("in_train") & (F.col("rating") >= self.cfg.split.relevant_from))
            .select("user_id", "item_id").distinct(), "liked")

    # --- popularity -----------------------------------------------------------

    @cached_property
    def user_segments(self) -> DataFrame:
        if self.dataset.users is None:
            return self.spark.createDataFrame([], "user_id long, segment string")
        return self.workspace.stage(
            popularity.user_segments(self.dataset.users.join(self.user_stats.select("user_id"), "user_id", "left_semi")),
            "user-segments")

    @cached_property
    def segment_counts(self) -> DataFrame:
        return self.workspace.stage(
            popularity.segment_counts(self.train_pairs, self.user_segments, self.hot_users), "segment-counts")

    @cached_property
    def segments(self) -> popularity.Segments:
        """The distinct (gender, age) labels, numbered."""
        return popularity.number_segments(self.user_segments, self.segment_counts, self.cfg.popularity_smoothing, self.cfg.scale, self.workspace)

    @cached_property
    def n_deltas(self) -> int:
        return self.segment_counts.count()

    @cached_property
    def popularity_vectors(self) -> DataFrame:
        return self.workspace.stage(popularity.segment_vectors(
            self.item_stats, self.segment_counts, self.segments, self.sizes["n_pairs"], self.sizes["n_items"],
            self.cfg.popularity_smoothing), "popularity")

    @cached_property
    def percentiles(self) -> DataFrame:
        return self.workspace.stage(
            popularity.percentile(self.item_stats, self.sizes["n_items"], self.cfg.scale.rows_per_task), "percentiles")

    # --- content and factors --------------------------------------------------

    @cached_property
    def embedding(self) -> tuple[DataFrame, int]:
        vecs, dims = content.text_embedding(
            content.tfidf_table(self.dataset.items, self.dataset.tags, self.sizes["n_items"], self.cfg.content,
                                self.cfg.scale, self.workspace),
            self.sizes["n_items"], self.cfg.content, self.cfg.scale, self.workspace)
        return self.workspace.stage(vecs, "embedding"), dims

    @cached_property
    def feature_blocks(self) -> content.FeatureBlocks:
        return content.feature_blocks(self.dataset.items, self.sizes["n_items"],
                                      self.embedding if self.cfg.content.text_weight > 0 else None,
                                      self.cfg.scale, self.workspace)

    @cached_property
    def features(self) -> content.ItemFeatures:
        made = self.feature_blocks.weighted(self.cfg.content)
        return replace(made, table=self.workspace.stage(made.table, "item-features"))

    def _vector_bytes(self, side: str) -> int:
        return 8 * (self.cfg.als.factors + 1) * self.sizes[side]

    @cached_property
    def by_user(self) -> gather.EdgeBlocks:
        """Training pairs in blocks by user; the profiles and the factor fit both read them."""
        return als.rating_blocks(self.train_pairs, self.sizes["n_pairs"], self.cfg.scale, self.workspace,
                                 "user_id", "item_id", self.user_stats, "n_user", self._vector_bytes("n_items"))

    @cached_property
    def by_item(self) -> gather.EdgeBlocks:
        return als.rating_blocks(self.train_pairs, self.sizes["n_pairs"], self.cfg.scale, self.workspace,
                                 "item_id", "user_id", self.item_stats, "n_item", self._vector_bytes("n_users"))

    @cached_property
    def profiles(self) -> DataFrame:
        return self.workspace.stage(content.user_profiles(self.by_user, self.features, self.cfg.scale), "profiles")

    def fit_factors(self, cfg: AlsConfig) -> als.Factors:
        return als.fit(self.by_user, self.by_item, self.item_stats, self.user_stats, cfg, self.cfg.scale, self.workspace)

    @cached_property
    def factors(self) -> als.Factors:
        return self.fit_factors(self.cfg.als)

    # --- what the scorer reads --------------------------------------------------

    def catalog_rows(self, features: content.ItemFeatures, factor_rows: DataFrame | None, dims: int) -> DataFrame:
        """One row per item for the scorer; items without a factor row get the zero vector."""
        zero = F.array_repeat(F.lit(0.0), dims)
        rows = (self.popularity_vectors.join(features.table, "item_id")
                .join(self.percentiles.select("item_id", "pct"), "item_id"))
        if factor_rows is None:
            rows = rows.withColumn("factors", zero)
        else:
            rows = rows.join(factor_rows.select(F.col("id").alias("item_id"), F.col("vec").alias("_vec")), "item_id", "left")
            rows = rows.withColumn("factors", F.coalesce("_vec", zero))
        return rows.select("item_id", "n_item", "pct", "factors", "features", "popularity", "seg_no", "seg_delta",
                           (content.TIE_BREAK * F.log1p(F.col("n_item").cast("double"))).alias("tie_break"))

    @cached_property
    def catalog(self) -> scorer.Catalog:
        dims = self.cfg.als.factors
        table = self.workspace.stage(self.catalog_rows(self.features, self.factors.items, dims), "catalog")
        n = table.count()
        if n != self.sizes["n_items"]:
            raise ValueError(f"catalog has {n} rows for {self.sizes['n_items']} items")
        return scorer.Catalog(table, n, dims, self.features.dims, self.segments.base, self.n_deltas)

    @cached_property
    def moments(self) -> dict:
        return scorer.catalog_moments(self.catalog)

    def user_rows(self, profiles: DataFrame, feature_dims: int, factor_rows: DataFrame | None, dims: int) -> DataFrame:
        """user_id, n_user, segment_no, factors, profile for every known user."""
        return assemble_users(self.user_stats, self.user_segments, self.segments, profiles, feature_dims, factor_rows, dims)

    @cached_property
    def user_state(self) -> DataFrame:
        return self.workspace.stage(self.user_rows(self.profiles, self.features.dims, self.factors.users,
                                                   self.cfg.als.factors), "user-state")

    @cached_property
    def marks(self) -> DataFrame:
        """Seen (train) and liked (relevant test) items: user_id, item_id, kind."""
        return (self.train_pairs.select("user_id", "item_id", F.lit("seen").alias("kind"))
                .unionByName(self.liked.select("user_id", "item_id", F.lit("liked").alias("kind"))))

    def models(self) -> dict[str, dict]:
        return scorer.registry(self.cfg, self.dataset.users is not None)


def assemble_users(stats: DataFrame, segments_of: DataFrame, segments: popularity.Segments, profiles: DataFrame,
                   feature_dims: int, factor_rows: DataFrame | None, factor_dims: int) -> DataFrame:
    numbers = segments_of.join(F.broadcast(segments.table.select("segment", "segment_no")), "segment").select("user_id", "segment_no")
    rows = (stats.select("user_id", "n_user").join(numbers, "user_id", "left")
            .withColumn("segment_no", F.coalesce("segment_no", F.lit(segments.n)).cast("int"))
            .join(profiles.select(F.col("id").alias("user_id"), F.col("vec").alias("_p")), "user_id", "left")
            .withColumn("profile", F.coalesce("_p", F.array_repeat(F.lit(0.0), feature_dims))))
    if factor_rows is None:
        rows = rows.withColumn("factors", F.array_repeat(F.lit(0.0), factor_dims))
    else:
        rows = (rows.join(factor_rows.select(F.col("id").alias("user_id"), F.col("vec").alias("_f")), "user_id", "left")
                .withColumn("factors", F.coalesce("_f", F.array_repeat(F.lit(0.0), factor_dims))))
    return rows.select("user_id", "n_user", "segment_no", "factors", "profile")


def eval_users(experiment: Experiment, truth: DataFrame, seed: int = 0) -> DataFrame:
    """(user_id, n_relevant, n_train) of users with a relevant test item; capped by seeded
    hash when ``max_eval_users`` asks for a sample."""
    users = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_relevant"))
    cap = experiment.cfg.max_eval_users
    if cap is not None:
        users = experiment.workspace.stage(users, "eval-candidates")
        kept = splitting.lowest_by_hash(users, "user_id", "eval", seed, cap, experiment.cfg.scale.rows_per_task)
        users = users.join(kept, "user_id", "left_semi")
    return users.join(experiment.user_stats.select("user_id", F.col("n_user").alias("n_train")), "user_id")
