"""Exact nearest neighbours of unit vectors by cosine, without comparing every pair.

Vectors are assigned to pivots (a seeded draw of them) and ordered by pivot and angle to it; a block is a run of that
order. A query at angle a from a pivot and a vector at angle b from the same pivot are at least |a - b| apart, so the
block's smallest and largest angle bound every cosine it can hold. A query keeps its list so far; a block whose bound
is below the last entry is skipped, and so is one that could only tie with it and holds no smaller id. The latter is
what keeps a large group of equal vectors from being compared pair by pair.

The blocks are broadcast in shards of a checked size, one at a time; the lists travel with the queries. Zero vectors
(cosine 0 with everything) stand apart from the pivots.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.config import ScaleConfig
from coldspring.functions import hashing
from coldspring.operators.skew import with_position
from coldspring.workspace import Workspace

NO_PIVOT = -1
BLOCK_ROWS = 512
QUERY_ROWS = 256
# Angles are known to some 1e-8 where vectors nearly agree.
ANGLE_SLACK = 1e-7


def _assign(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, vec, pivot, angle): the nearest pivot, or ``NO_PIVOT`` for a zero vector."""
    shared = vectors.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for batch in batches:
            m = kernels.to_matrix(batch.column(1), pivots.shape[1])
            cosine = m @ shared.value.T
            nearest = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(m)), nearest], -1, 1))
            zero = ~m.any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(np.where(zero, NO_PIVOT, nearest).astype(np.int32)), pa.array(np.where(zero, 0.0, angle))],
                ["id", "vec", "pivot", "angle"])

    return vectors.select("id", "vec").mapInArrow(run, "id long, vec array<double>, pivot int, angle double")


def _blocks(table: pa.Table, dims: int) -> dict:
    """One shard: its rows by block, ids rising inside a block, with the bounds of each block."""
    block = table.column("block").to_numpy()
    ids = table.column("id").to_numpy()
    order = np.lexsort((ids, block))
    table, block, ids = table.take(pa.array(order)), block[order], ids[order]
    starts = np.flatnonzero(np.diff(block, prepend=-1)) if len(block) else np.zeros(0, dtype=int)
    angle = table.column("angle").to_numpy()
    return {"id": ids, "vec": kernels.to_matrix(table.column("vec"), dims), "start": np.append(starts, len(ids)), "pivot": table.column("pivot").to_numpy()[starts],
            "low": np.minimum.reduceat(angle, starts) if len(starts) else angle, "high": np.maximum.reduceat(angle, starts) if len(starts) else angle,
            "first": ids[starts]}


def _bounds(queries: np.ndarray, pivots: np.ndarray, shard: dict) -> np.ndarray:
    """Largest possible cosine of each query with a row of each block."""
    zero = shard["pivot"] == NO_PIVOT
    out = np.zeros((len(queries), len(zero)))
    if not zero.all():
        angle = np.arccos(np.clip(queries @ pivots.T, -1, 1))[:, np.where(zero, 0, shard["pivot"])]
        apart = np.maximum(np.maximum(shard["low"] - angle, angle - shard["high"]) - ANGLE_SLACK, 0.0)
        out = np.where(zero, 0.0, np.cos(apart))
    out[~queries.any(axis=1)] = 0.0
    return out


def _search(ids: np.ndarray, queries: np.ndarray, lists: np.ndarray, scores: np.ndarray, shard: dict, pivots: np.ndarray, digits: int) -> tuple[int, int]:
    """Merge a shard into ``lists`` and ``scores`` (queries x k, best first; id -1 where empty). Returns the numbers of
    pairs compared and skipped."""
    k, compared, skipped = lists.shape[1], 0, 0
    bounds = np.round(_bounds(queries, pivots, shard), digits)
    sizes = np.diff(shard["start"])
    for b in np.lexsort((shard["first"], -bounds.max(axis=0, initial=-1.0))):
        last, last_id = scores[:, -1], lists[:, -1]
        active = np.flatnonzero((bounds[:, b] > last) | ((bounds[:, b] == last) & (shard["first"][b] < last_id)))
        compared += len(active) * int(sizes[b])
        skipped += (len(ids) - len(active)) * int(sizes[b])
        if not len(active):
            continue
        rows = slice(shard["start"][b], shard["start"][b + 1])
        cosine = queries[active] @ shard["vec"][rows].T
        cosine[ids[active][:, None] == shard["id"][rows][None, :]] = -np.inf
        row, rank, place, value = kernels.best_rows(cosine, k, digits)
        new_scores, new_ids = np.full((len(active), k), -np.inf), np.full((len(active), k), np.iinfo(np.int64).max)
        new_scores[row, rank - 1], new_ids[row, rank - 1] = value, shard["id"][rows][place]
        both_scores, both_ids = np.hstack([scores[active], new_scores]), np.hstack([lists[active], new_ids])
        order = np.lexsort((both_ids, -both_scores), axis=1)[:, :k]
        scores[active], lists[active] = np.take_along_axis(both_scores, order, axis=1), np.take_along_axis(both_ids, order, axis=1)
    return compared, skipped


def nearest(vectors: DataFrame, n: int, dims: int, k: int, digits: int, scale: ScaleConfig, workspace: Workspace,
            queries: DataFrame | None = None, notes: dict | None = None, seed: int = 0) -> DataFrame:
    """(id, rank, neighbour_id, cosine): the ``k`` nearest other vectors of each query, by cosine rounded to ``digits``
    decimals, then id.

    ``vectors``: (id, vec), ``n`` rows of unit or zero length; ids are distinct. ``queries``: (id) restricts the
    queries, by default all are. ``notes`` receives ``compared`` and ``skipped``, in pairs.
    """
    context = vectors.sparkSession.sparkContext
    row_bytes = 8 * (dims + 4)
    n_pivots = max(1, min(math.ceil(math.sqrt(n)), max(16, scale.broadcast_bytes // (8 * row_bytes))))
    placed = with_position(vectors.select("id", hashing.digest("pivot", seed, "id").alias("_h")), [], ["_h", "id"], scale.rows_per_task,
                           known_cold=n <= scale.rows_per_task)
    chosen = vectors.join(F.broadcast(placed.filter(F.col("_pos") < n_pivots).select("id")), "id", "left_semi")
    drawn = chosen.select("id", "vec").toArrow().sort_by("id")
    pivots = np.unique(kernels.to_matrix(drawn.column("vec"), dims), axis=0)
    pivots = pivots[pivots.any(axis=1)]
    if not len(pivots):      # any direction will do
        pivots = np.eye(1, dims)

    assigned = workspace.stage(_assign(vectors, pivots), "neighbour-pivots")
    ordered = with_position(assigned, [], ["pivot", "angle", "id"], scale.rows_per_task, known_cold=n <= scale.rows_per_task)
    # A block lies within one pivot, as its bounds refer to it: the number of the pivot is part of its name.
    shard_rows = max(BLOCK_ROWS, (scale.shard_bytes if n * row_bytes > scale.broadcast_bytes else n * row_bytes + 1) // row_bytes)
    block_rows = max(1, min(BLOCK_ROWS, math.ceil(math.sqrt(n))))
    shards = workspace.stage(ordered.select(
        "id", "vec", "pivot", "angle", F.floor(F.col("_pos") / shard_rows).cast("int").alias("shard"),
        (F.floor(F.col("_pos") / block_rows) * (n_pivots + 1) + F.col("pivot") + 1).alias("block")).repartition("shard").sortWithinPartitions("shard"), "neighbour-shards")

    asked = assigned if queries is None else assigned.join(queries.select("id"), "id", "left_semi")
    tasks = max(3 * context.defaultParallelism, math.ceil(n / 50_000))
    # Queries near each other share their bounds, so they travel together.
    asked = asked.repartitionByRange(tasks, "pivot", "angle").sortWithinPartitions("pivot", "angle").select(
        "id", "vec", F.array().cast("array<long>").alias("n_id"), F.array().cast("array<double>").alias("n_cosine"))
    now, path = workspace.stage_at(asked, "neighbours-0")
    counters = (context.accumulator(0), context.accumulator(0))
    for shard in range(max(1, math.ceil(n / shard_rows))):
        rows = shards.filter(F.col("shard") == shard).toArrow()
        if not rows.num_rows:
            continue
        shared = context.broadcast((_blocks(rows, dims), pivots))

        def run(batches, shared=shared):
            blocks, fixed = shared.value
            for batch in batches:
                for at in range(0, batch.num_rows, QUERY_ROWS):
                    part = batch.slice(at, QUERY_ROWS)
                    lists, scores = _padded(part.column(2), k, np.iinfo(np.int64).max), _padded(part.column(3), k, -np.inf)
                    ids = part.column(0).to_numpy()
                    done = _search(ids, kernels.to_matrix(part.column(1), dims), lists, scores, blocks, fixed, digits)
                    counters[0].add(done[0])
                    counters[1].add(done[1])
                    kept = np.isfinite(scores)
                    offsets = pa.array(np.append(0, np.cumsum(kept.sum(axis=1))).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(offsets, pa.array(lists[kept])),
                                                      pa.ListArray.from_arrays(offsets, pa.array(scores[kept]))], ["id", "vec", "n_id", "n_cosine"])

        before = path
        now, path = workspace.stage_at(now.mapInArrow(run, "id long, vec array<double>, n_id array<long>, n_cosine array<double>"), f"neighbours-{shard + 1}")
        workspace.remove(before)
        shared.destroy()
    if notes is not None:
        notes["compared"], notes["skipped"] = counters[0].value, counters[1].value
    both = F.arrays_zip("n_id", "n_cosine")
    return now.select("id", F.posexplode(both).alias("_p", "_n")).select(
        "id", (F.col("_p") + 1).alias("rank"), F.col("_n.n_id").alias("neighbour_id"), F.col("_n.n_cosine").alias("cosine"))


def _padded(column: pa.Array, k: int, fill) -> np.ndarray:
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False)
    out = np.full((len(lengths), k), fill, dtype=values.dtype)
    out[np.arange(k)[None, :] < lengths[:, None]] = values
    return out
