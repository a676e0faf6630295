"""Implicit-feedback matrix factorisation by alternating least squares.

confidence = 1 + alpha * rating, preference 1 for every rated pair, plain lambda * I (not
scaled by the number of ratings, unlike the built-in recommender). Ids without ratings
have no row in the factor tables, which stands for the zero vector.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.config import AlsConfig, ScaleConfig
from coldspring.functions import hashing
from coldspring.operators import gather
from coldspring.workspace import Workspace

INIT_SD = 0.01


@dataclass
class Factors:
    users: DataFrame     # id, vec
    items: DataFrame     # id, vec
    item_vectors: gather.Vectors
    item_gram: np.ndarray


def initial_items(item_stats: DataFrame, cfg: AlsConfig) -> DataFrame:
    spread = item_stats.repartition(item_stats.sparkSession.sparkContext.defaultParallelism)
    return spread.select(F.col("item_id").alias("id"), hashing.normal_vector(
        "als", cfg.seed, "item_id", cfg.factors, INIT_SD).alias("vec"))


def regularised_gram(vectors: gather.Vectors, cfg: AlsConfig) -> np.ndarray:
    return vectors.gram() + cfg.regularization * np.eye(cfg.factors)


def rating_blocks(train_pairs: DataFrame, n_pairs: int, scale: ScaleConfig, workspace: Workspace,
                  target: str, src: str, stats: DataFrame, n: str, src_bytes: int = 0) -> gather.EdgeBlocks:
    """The training pairs cut into blocks by ``target``, with the rating as edge weight.
    ``src_bytes``: size of the vectors that will be gathered."""
    return gather.build_blocks(
        train_pairs.select(F.col(target).alias("target"), F.col(src).alias("src"), F.col("rating").alias("w")),
        n_pairs, scale, workspace, f"by-{target}", stats.select(F.col(target).alias("target"), F.col(n).alias("n")),
        shipped=src_bytes > renewed(scale).broadcast_bytes)


def renewed(scale: ScaleConfig) -> ScaleConfig:
    """For vectors that each half-step makes anew: what the driver collects adds up over the half-steps."""
    return replace(scale, broadcast_bytes=min(scale.broadcast_bytes, scale.renewed_bytes))


def fit(by_user: gather.EdgeBlocks, by_item: gather.EdgeBlocks, item_stats: DataFrame, user_stats: DataFrame,
        cfg: AlsConfig, scale: ScaleConfig, workspace: Workspace) -> Factors:
    items, users = _alternate(by_user, by_item, item_stats, user_stats, [cfg], scale, workspace)
    return Factors(users.as_table(workspace, "als-users"), items.as_table(workspace, "als-items"), items,
                   regularised_gram(items, cfg))


def fit_together(by_user: gather.EdgeBlocks, by_item: gather.EdgeBlocks, item_stats: DataFrame, user_stats: DataFrame,
                 points: list[AlsConfig], scale: ScaleConfig, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """(users, items), both (id, vec), of several settings with the same number of factors, iterations and seed: vec holds
    the factors of the points one after the other. The passes over the edges are those of a single fit."""
    if len({(p.factors, p.iterations, p.seed) for p in points}) > 1:
        raise ValueError("points that are fitted together differ in regularization and alpha only")
    items, users = _alternate(by_user, by_item, item_stats, user_stats, points, scale, workspace)
    return users.as_table(workspace, "als-users"), items.as_table(workspace, "als-items")


def _alternate(by_user, by_item, item_stats, user_stats, points: list[AlsConfig], scale, workspace) -> tuple[gather.Vectors, gather.Vectors]:
    n_items, n_users = item_stats.count(), user_stats.count()
    scale = renewed(scale)
    r, cfg = points[0].factors, points[0]
    width = r * len(points)

    def half_step(blocks: gather.EdgeBlocks, fixed: gather.Vectors, n: int, name: str) -> gather.Vectors:
        whole = fixed.gram()
        grams = [whole[i * r:(i + 1) * r, i * r:(i + 1) * r] + p.regularization * np.eye(r) for i, p in enumerate(points)]
        solved = gather.gather_ridges(blocks, fixed, grams, [p.alpha for p in points])
        return gather.Vectors(solved, n, width, scale).settle(workspace, name)

    start = gather.Vectors(initial_items(item_stats, cfg), n_items, r, scale)
    items = start.times(np.tile(np.eye(r), len(points))) if len(points) > 1 else start
    items = items.settle(workspace, "als-init")
    users = None
    for step in range(cfg.iterations):
        users = half_step(by_user, items, n_users, f"als-users-{step}")
        items = half_step(by_item, users, n_items, f"als-items-{step}")
    return items, users


def fold_in(by_new_user: gather.EdgeBlocks, factors: Factors, cfg: AlsConfig) -> DataFrame:
    """(id, vec) for users outside the training data, item vectors fixed.
    A user all of whose items lack a vector has no row (the zero vector).

    ``by_new_user``: blocks of (user, item, rating) edges.
    """
    return gather.gather_ridge(by_new_user, factors.item_vectors, factors.item_gram, cfg.alpha)
