"""Item features [genres | decade | text], user taste profiles and similar items."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.config import ContentConfig, ScaleConfig
from coldspring.functions import hashing, text, vectors
from coldspring.operators import gather
from coldspring.operators.skew import hot_keys, row_limit, spread_join, with_position
from coldspring.workspace import Workspace

RATING_MIDPOINT = 2.5
TIE_BREAK = 1e-6


@dataclass
class ItemFeatures:
    table: DataFrame     # item_id, features
    n_items: int
    dims: int


def text_rows(items: DataFrame, tags: DataFrame | None) -> DataFrame:
    """(item_id, text): the title and each tag. Tokens never span two of them, so the bag of
    words equals that of the joined text and no long string has to be built per item."""
    rows = items.select("item_id", F.coalesce("title", F.lit("")).alias("text"))
    if tags is not None:
        rows = rows.unionByName(tags.select("item_id", F.coalesce("tag", F.lit("")).alias("text")))
    return rows


def term_counts(rows: DataFrame, cfg: ContentConfig) -> DataFrame:
    stop = text.english_stop_words() if cfg.stop_words is None else cfg.stop_words
    return (rows.select("item_id", F.explode(text.tokens(F.col("text"), stop)).alias("term"))
            .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("tf")))


def vocabulary(counts: DataFrame, n_items: int, cfg: ContentConfig) -> DataFrame:
    """(term, df, idf) of terms found in at least ``min_df`` items."""
    return (counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
            .filter(F.col("df") >= cfg.min_df)
            .withColumn("idf", F.log(F.lit(1.0 + n_items) / (F.col("df") + 1.0)) + 1.0))


def tfidf(counts: DataFrame, vocab: DataFrame, hot_terms: DataFrame | None) -> DataFrame:
    """(item_id, term, w): (1 + ln tf) * idf, unit length per item."""
    raw = (spread_join(counts, vocab, "term", hot_terms, "item_id")
           .withColumn("_w", (F.log(F.col("tf").cast("double")) + 1.0) * F.col("idf")))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("item_id")))
    return raw.select("item_id", "term", (F.col("_w") / length).alias("w"))


def tfidf_table(items: DataFrame, tags: DataFrame | None, n_items: int, cfg: ContentConfig,
                scale: ScaleConfig, workspace: Workspace) -> DataFrame:
    counts = workspace.stage(term_counts(text_rows(items, tags), cfg), "term-counts")
    vocab = workspace.stage(vocabulary(counts, n_items, cfg), "vocabulary")
    top, total = vocab.agg(F.max("df"), F.sum("df")).first()
    limit = row_limit(total or 0, scale)
    hot = hot_keys(vocab, "term", "df", limit) if (top or 0) > limit else None
    return tfidf(counts, vocab, hot)


def text_embedding(weights: DataFrame, n_items: int, cfg: ContentConfig, scale: ScaleConfig,
                   workspace: Workspace) -> tuple[DataFrame, int]:
    """(id, vec): uncentred truncated SVD of the TF-IDF rows, as U * Sigma.

    Found by block Lanczos iteration with full re-orthogonalisation (see ``_lanczos_embedding``): each pass multiplies by
    the sparse matrix and its transpose with a gather. Vectors of terms below ``broadcast_bytes`` and matrices of the width of the
    basis reach the driver, vectors of items do not.
    """
    weights = workspace.stage(weights, "tfidf")
    counts = workspace.stage(weights.groupBy("term").agg(F.count(F.lit(1)).alias("n")), "term-sizes")
    n_terms, top, total = counts.agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    dims = min(cfg.text_dims, n_terms - 1)
    if dims < 1:
        return weights.select(F.col("item_id").alias("id"), F.array().cast("array<double>").alias("vec")).limit(0), 0
    numbered = workspace.stage(
        with_position(counts.select("term"), [], ["term"], scale.rows_per_task,
                      known_cold=n_terms <= scale.rows_per_task)
        .select("term", F.col("_pos").cast("long").alias("term_no")), "terms")
    limit = row_limit(total, scale)
    hot = hot_keys(counts, "term", "n", limit) if top > limit else None
    cells = spread_join(weights, numbered, "term", hot, "item_id").select("item_id", "term_no", "w")
    return _lanczos_embedding(workspace.stage(cells, "tfidf-cells"), total, n_items, n_terms, dims, cfg, scale,
                               workspace), dims


def _lanczos_embedding(cells: DataFrame, n_cells: int, n_items: int, n_terms: int, dims: int,
                       cfg: ContentConfig, scale: ScaleConfig, workspace: Workspace) -> DataFrame:
    """The leading directions of A'A over a growing orthonormal basis [P | N] of the term space, A being items x terms.

    A pass takes W = A'A N and splits it by the basis: the part inside extends the projected matrix T = [P N]' A'A [P N],
    the rest, made orthonormal, is the next N with N R = rest. A direction q of T has the residual R q_N, a norm taken
    as it is and not as a difference. The iteration ends when all kept directions have settled; if the basis spans every
    term, nothing is left over and that is so at once. A basis wider than ``svd_basis`` blocks is replaced by its leading
    directions (thick restart). The lengths of the rows of A come in with one more gather at the end.
    """
    width = min(n_terms, dims + max(dims, cfg.svd_oversample))
    to_items = gather.build_blocks(cells.select(F.col("item_id").alias("target"), F.col("term_no").alias("src"), "w"),
                                   n_cells, scale, workspace, "svd-items")

    @cache
    def to_terms() -> gather.EdgeBlocks:
        return gather.build_blocks(cells.select(F.col("term_no").alias("target"), F.col("item_id").alias("src"), "w"),
                                   n_cells, scale, workspace, "svd-terms")

    def settled(df: DataFrame, n: int, wide: int, name: str) -> gather.Vectors:
        return gather.Vectors(df, n, wide, scale).settle(workspace, name)

    def squared(block: gather.Vectors, step: int) -> DataFrame:
        """A'A times the block. Vectors of items are kept, or shuffled, only if terms or the cells of an item are too many for one task."""
        if block.local is not None and not to_items.has_split:
            return gather.gather_there_and_back(to_items, block)
        by_item = settled(gather.gather_sum(to_items, block), n_items, block.dims, f"svd-items-{step}")
        return gather.gather_sum(to_terms(), by_item)

    def orthonormal(gram: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(F, R) for columns W with this Gram matrix: W F is orthonormal, without directions below ``least``, and W = (W F) R."""
        values, turn = np.linalg.eigh(gram)
        length = np.sqrt(np.maximum(values, 0.0))
        kept = length > least
        return turn[:, kept] / length[kept], length[kept, None] * turn[:, kept].T

    draws = settled(numbered_normals(cells, cfg.seed, width), n_terms, width, "svd-draws")
    newest = draws.times(orthonormal(draws.gram(), 0.0)[0])
    newest = newest.times(orthonormal(newest.gram(), 0.5)[0]).settle(workspace, "svd-start")
    basis, projected, old = newest, np.zeros((0, 0)), 0
    worst = np.inf
    for step in range(cfg.svd_passes):
        b = newest.dims
        image = gather.Vectors(squared(newest, step), n_terms, b, scale)
        both = gather.side_by_side(basis, image).settle(workspace, f"svd-basis-{step}")
        have = basis.dims
        # Twice, as the first subtraction leaves rounding errors of the size of W.
        inside = both.gram()[:have, have:]
        less = np.block([[np.eye(have), -inside], [np.zeros((b, have)), np.eye(b)]])
        again = both.times(less).gram()
        inside2 = again[:have, have:]
        inside = inside + inside2
        projected = np.block([[projected, inside[:old]], [inside[:old].T, (inside[old:] + inside[old:].T) / 2]])
        values, turn = np.linalg.eigh(projected)
        values, turn = values[::-1], turn[:, ::-1]
        fresh, rest = orthonormal(again[have:, have:] - inside2.T @ inside2, 1e-11 * values[0])
        residual = np.linalg.norm(rest @ turn[old:, :dims], axis=0)
        kept = values[:dims] > 1e-14 * values[0]
        worst = (residual[kept] / values[:dims][kept]).max(initial=0.0)
        if worst <= cfg.svd_tolerance or not fresh.shape[1]:
            leading = turn[:, :dims] * (values[:dims] > 1e-14 * values[0])
            return workspace.stage(gather.gather_sum(to_items, basis.times(leading).settle(workspace, "svd-directions")), "svd-embedding")
        if have + fresh.shape[1] > cfg.svd_basis * width:
            lead = turn[:, :dims + (width - dims) // 2]
            projected = np.diag(values[:lead.shape[1]])
        else:
            lead = np.eye(have)
        # [P | N] turned, and the next N, in one linear map of [P | N | W]
        keep = np.vstack([lead, np.zeros((b, lead.shape[1]))])
        next_block = less @ np.vstack([-inside2 @ fresh, fresh])
        basis = both.times(np.hstack([keep, next_block])).settle(workspace, f"svd-next-{step}")
        old = lead.shape[1]
        newest = basis.times(np.eye(basis.dims)[:, old:])
    raise RuntimeError(f"the text embedding has not settled after {cfg.svd_passes} passes (residual {worst:.1e}): raise "
                       "svd_passes, svd_oversample or svd_tolerance")


def numbered_normals(cells: DataFrame, seed: int, width: int) -> DataFrame:
    return cells.select(F.col("term_no").alias("id")).distinct().select(
        "id", hashing.normal_vector("svd", seed, "id", width, 1.0).alias("vec"))


def block_rows(items: DataFrame) -> DataFrame:
    """Sparse [genres | decade] blocks, each of unit length: (item_id, feature, value). No
    genres or no year gives no rows."""
    kinds = F.array_distinct("genres")
    genre = (items.select("item_id", F.explode(kinds).alias("g"), F.size(kinds).alias("n"))
             .select("item_id", F.concat(F.lit("genre:"), "g").alias("feature"), (1.0 / F.sqrt("n")).alias("value")))
    decade = (items.filter(F.col("year").isNotNull())
              .select("item_id", F.concat(F.lit("decade:"), text.decade(F.col("year"))).alias("feature"),
                      F.lit(1.0).alias("value")))
    return genre.unionByName(decade)


def _block_weight(cfg: ContentConfig):
    return F.when(F.col("feature").startswith("genre:"), F.lit(cfg.genre_weight)).otherwise(F.lit(cfg.year_weight))


def unit_block_rows(items: DataFrame, cfg: ContentConfig) -> DataFrame:
    """Weighted ``block_rows`` of unit length per item (the features when there is no text)."""
    rows = block_rows(items).withColumn("value", F.col("value") * _block_weight(cfg))
    length = F.sqrt(F.sum(F.col("value") * F.col("value")).over(Window.partitionBy("item_id")))
    return rows.select("item_id", "feature", F.when(length > 0, F.col("value") / length)
                       .otherwise(F.lit(0.0)).alias("value"))


@dataclass
class FeatureBlocks:
    """The unit blocks before weighting; every choice of weights is a projection of them."""
    table: DataFrame          # item_id, blocks
    n_items: int
    n_decades: int
    n_genres: int
    text_dims: int

    def _weights(self, cfg: ContentConfig) -> np.ndarray:
        return np.concatenate([np.full(self.n_decades, cfg.year_weight), np.full(self.n_genres, cfg.genre_weight),
                               np.full(self.text_dims, cfg.text_weight)])

    def weighted(self, cfg: ContentConfig) -> ItemFeatures:
        """Dense unit rows [decades | genres | text]."""
        return self._projected([self._weights(cfg)], [slice(None)])

    def side_by_side(self, cfgs: list[ContentConfig]) -> tuple[ItemFeatures, list[tuple[int, int]]]:
        """The unit rows of several choices of weights, one after the other without the blocks they switch off, and the
        place (first, end) of each."""
        weights = [self._weights(cfg) for cfg in cfgs]
        kept = [np.flatnonzero(w) for w in weights]
        ends = np.cumsum([len(k) for k in kept])
        return self._projected(weights, kept), [(int(end) - len(k), int(end)) for end, k in zip(ends, kept)]

    def _projected(self, weights: list[np.ndarray], columns: list) -> ItemFeatures:
        dims = len(weights[0])

        def run(batches):
            for batch in batches:
                blocks, parts = kernels.to_matrix(batch.column(1), dims), []
                for w, kept in zip(weights, columns):
                    m = (blocks * w)[:, kept]
                    length = np.linalg.norm(m, axis=1, keepdims=True)
                    parts.append(np.divide(m, length, out=m, where=length > 0))
                yield pa.RecordBatch.from_arrays([batch.column(0), kernels.to_list_column(np.hstack(parts))], ["item_id", "features"])

        wide = sum(len(w[k]) for w, k in zip(weights, columns))
        return ItemFeatures(self.table.mapInArrow(run, "item_id long, features array<double>"), self.n_items, wide)


def feature_blocks(items: DataFrame, n_items: int, embedding: tuple[DataFrame, int] | None, scale: ScaleConfig,
                   workspace: Workspace) -> FeatureBlocks:
    rows = workspace.stage(block_rows(items), "feature-rows")
    counts = workspace.stage(rows.groupBy("feature").agg(F.count(F.lit(1)).alias("n")), "feature-counts")
    top, total, n_names, n_genres = counts.agg(F.max("n"), F.sum("n"), F.count(F.lit(1)),
                                               F.count_if(F.col("feature").startswith("genre:"))).first()
    # Names sort decades before genres.
    numbered = workspace.stage(
        with_position(counts.select("feature"), [], ["feature"], scale.rows_per_task, known_cold=n_names <= scale.rows_per_task)
        .select("feature", F.col("_pos").alias("feature_no")), "feature-names")
    limit = row_limit(total or 0, scale)
    hot = hot_keys(counts, "feature", "n", limit) if (top or 0) > limit else None
    cells = spread_join(rows, numbered, "feature", hot, "item_id")
    dense = gather.densify(cells, "item_id", "feature_no", "value", n_names)
    zeros = lambda n: F.array_repeat(F.lit(0.0), n)
    table = (items.select("item_id").join(dense.withColumnRenamed("id", "item_id"), "item_id", "left")
             .select("item_id", F.coalesce("vec", zeros(n_names)).alias("blocks")))
    text_dims = 0
    if embedding is not None:
        vecs, text_dims = embedding
        table = (table.join(vecs.select(F.col("id").alias("item_id"), vectors.unit("vec").alias("_text")), "item_id", "left")
                 .select("item_id", F.concat("blocks", F.coalesce("_text", zeros(text_dims))).alias("blocks")))
    return FeatureBlocks(workspace.stage(table, "feature-blocks"), n_items, n_names - n_genres, n_genres, text_dims)


def user_profiles(by_user: gather.EdgeBlocks, features: ItemFeatures, scale: ScaleConfig) -> DataFrame:
    """(id, vec): unit sum of (rating - midpoint) * item features over the (user, item, rating) edges."""
    rows = features.table.select(F.col("item_id").alias("id"), F.col("features").alias("vec"))
    summed = gather.gather_sum(by_user, gather.Vectors(rows, features.n_items, features.dims, scale), RATING_MIDPOINT)
    return summed.select("id", vectors.unit("vec").alias("vec"))
