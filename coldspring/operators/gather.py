"""Edge-weighted gathers: bring the vectors of ``src`` ids to the ``target`` ids that need them.

Used for factor solves, user profiles and the text embedding. Edges are cut into blocks by
target. A target with more edges than a block takes is spread over several blocks by its
src, and the partial results are summed. Each block receives every vector it needs once,
not once per edge, so the shuffle carries (distinct src, block) vectors.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.config import ScaleConfig
from coldspring.operators.skew import hot_keys, row_limit, spread_join
from coldspring.workspace import Workspace


@dataclass
class EdgeBlocks:
    edges: DataFrame     # block, target, src, w, split; partitioned by block
    n_blocks: int
    has_split: bool
    workspace: Workspace
    name: str
    scale: ScaleConfig

    @cached_property
    def hot_sources(self) -> DataFrame | None:
        """Sources that more blocks need than one task should send."""
        counts = self.needed.groupBy("src").agg(F.count(F.lit(1)).alias("n"))
        top, total = counts.agg(F.max("n"), F.sum("n")).first()
        limit = row_limit(total or 0, self.scale)
        return self.workspace.stage(hot_keys(counts, "src", "n", limit), f"{self.name}-hot-sources") \
            if (top or 0) > limit else None

    @cached_property
    def needed(self) -> DataFrame:
        """(src, block): which vectors each block asks for."""
        return self.workspace.stage(self.edges.select("src", "block").distinct(), f"{self.name}-needed")


def tree_sum(df: DataFrame, column: str, width: int, fan_in: int = 32) -> np.ndarray:
    """Elementwise sum of an ARRAY<DOUBLE> column: per task, then over ``fan_in`` tasks, so
    the driver receives at most ``fan_in`` vectors."""
    def add(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += kernels.to_matrix(batch.column(0), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([kernels.to_list_column(total[None, :])], ["v"])

    few = df.select(column).mapInArrow(add, "v array<double>")
    if df.rdd.getNumPartitions() > fan_in:      # ``df`` is a staged table: no job runs here
        few = few.repartition(fan_in).mapInArrow(add, "v array<double>")
    return np.sum([np.array(row.v) for row in few.collect()], axis=0)


TRIANGLE_PIECE = 8192     # cells of a packed triangle that are summed together
MANY_TASKS = 512          # partial sums one task adds up


def gram(df: DataFrame, column: str, dims: int, centre: np.ndarray | None = None) -> np.ndarray:
    """Sum of outer products of a vector column (dims x dims). Each task packs the upper triangle of its sum in pieces;
    the pieces are summed in tasks of their own, so the driver receives one triangle, whatever the number of tasks."""
    cells = dims * (dims + 1) // 2
    cuts = range(0, max(cells, 1), TRIANGLE_PIECE)

    def outer(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                m = kernels.to_matrix(batch.column(0), dims)
                total += kernels.outer_sum(m if centre is None else m - centre).reshape(dims, dims)
        packed = kernels.pack_triangle(total)
        for number, at in enumerate(cuts):
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int32()), kernels.to_list_column(packed[None, at:at + TRIANGLE_PIECE])], ["piece", "v"])

    def add(key, table):
        width = min(TRIANGLE_PIECE, cells - cuts[key[0].as_py()])
        total = kernels.to_matrix(table.column("v"), width).sum(axis=0)
        return pa.table({"piece": pa.array([key[0].as_py()], pa.int32()), "v": kernels.to_list_column(total[None, :])})

    parts = df.select(column).mapInArrow(outer, "piece int, v array<double>")
    if df.rdd.getNumPartitions() > MANY_TASKS:      # ``df`` is a staged table: no job runs here
        slots = parts.withColumn("slot", F.pmod(F.spark_partition_id(), F.lit(MANY_TASKS // 8)))
        parts = slots.groupBy("piece", "slot").applyInArrow(add, "piece int, v array<double>")
    summed = parts.groupBy("piece").applyInArrow(add, "piece int, v array<double>").toArrow().sort_by("piece")
    return kernels.unpack_triangle(summed.column("v").combine_chunks().flatten().to_numpy(), dims)


def densify(cells: DataFrame, key: str, place: str, value: str, width: int) -> DataFrame:
    """(id, vec) dense vectors from (key, place, value) rows; a key has at most ``width`` rows."""
    lists = cells.groupBy(F.col(key).alias("id")).agg(
        F.collect_list(F.struct(F.col(place).cast("long").alias("p"), F.col(value).cast("double").alias("v"))).alias("cells"))

    def run(batches):
        for batch in batches:
            pairs = batch.column(1)
            flat = pairs.flatten()
            dense = kernels.scatter(np.diff(pairs.offsets.to_numpy()), flat.field("p").to_numpy(),
                                    flat.field("v").to_numpy(), width)
            yield pa.RecordBatch.from_arrays([batch.column(0), kernels.to_list_column(dense)], ["id", "vec"])

    return lists.mapInArrow(run, "id long, vec array<double>")


def build_blocks(edges: DataFrame, n_edges: int, scale: ScaleConfig, workspace: Workspace, name: str,
                 degrees: DataFrame | None = None, shipped: bool = False) -> EdgeBlocks:
    """``edges``: (target, src, w). ``degrees``: (target, n), computed here if not given.
    ``shipped``: the source vectors are too large to be broadcast."""
    size = scale.shipped_edges_per_block if shipped else scale.edges_per_block
    n_blocks = max(1, math.ceil(n_edges / size))
    degrees = degrees if degrees is not None else edges.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    top = degrees.agg(F.max("n")).first()[0] or 0
    has_split = top > size
    if has_split:
        parts = F.ceil(F.col("n") / size).cast("long").alias("_of")
        big = workspace.stage(degrees.filter(F.col("n") > size).select("target", parts), f"{name}-split-targets")
        if n_blocks <= scale.max_hot_rows:      # and so at most that many split targets
            edges = edges.join(F.broadcast(big), "target", "left")
        else:
            limit = row_limit(n_edges, scale)
            hot = hot_keys(degrees, "target", "n", limit) if top > limit else None
            edges = spread_join(edges, big, "target", hot, "src", "left")
        edges = (edges.withColumn("_salt", F.coalesce(F.pmod(F.xxhash64("src"), F.col("_of")), F.lit(0)))
                 .withColumn("split", F.col("_of").isNotNull()))
    else:
        edges = edges.withColumn("_salt", F.lit(0)).withColumn("split", F.lit(False))
    blocked = edges.select(
        F.pmod(F.xxhash64("target", "_salt"), F.lit(n_blocks)).cast("int").alias("block"),
        "target", "src", F.col("w").cast("double").alias("w"), "split")
    # Checkpointed rather than written as a table: a checkpoint keeps the partitioning, so no
    # pass over the edges (one per half-step of the factor fit) shuffles them again.
    edges = workspace.checkpoint(blocked.repartition(_tasks(n_blocks, blocked), "block").sortWithinPartitions("block"))
    return EdgeBlocks(edges, n_blocks, has_split, workspace, name, scale)


def _tasks(n_blocks: int, df: DataFrame) -> int:
    """Tasks for ``n_blocks`` blocks: one for a few blocks each, so that hashing evens out."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return max(1, min(n_blocks, max(8 * cores, math.ceil(n_blocks / 8))))


def _arrays(edges: pa.Table):
    def col(name):
        return edges.column(name).to_numpy()
    return col("target"), col("src"), col("w"), col("split")


class Vectors:
    """``n`` vectors as a table (id, vec) and, if they take at most ``broadcast_bytes``, also as
    arrays (ids, matrix) that can be broadcast."""

    def __init__(self, table: DataFrame, n: int, dims: int, scale: ScaleConfig):
        self.n, self.dims, self.scale = n, dims, scale
        self.table = table

    @property
    def is_small(self) -> bool:
        return self.n * (self.dims + 1) * 8 <= self.scale.broadcast_bytes

    @cached_property
    def local(self) -> tuple[np.ndarray, np.ndarray] | None:
        if not self.is_small:
            return None
        rows = self.table.select("id", "vec").toArrow().sort_by("id")      # sorted once, not by each block that looks an id up
        return rows.column("id").to_numpy(), kernels.to_matrix(rows.column("vec"), self.dims)

    def settle(self, workspace: Workspace, name: str) -> "Vectors":
        """Compute the vectors once: as arrays if they are small, else as a written table."""
        if self.local is None:
            self.table = workspace.stage(self.table, name)
        return self

    def as_table(self, workspace: Workspace, name: str) -> DataFrame:
        if self.local is not None:
            ids, matrix = self.local
            rows = pa.table({"id": pa.array(ids), "vec": kernels.to_list_column(matrix)})
            return workspace.stage(workspace.spark.createDataFrame(rows, "id long, vec array<double>"), name)
        return self.table

    @property
    def spark(self):
        return self.table.sparkSession

    def gram(self) -> np.ndarray:
        if self.local is not None:
            return kernels.outer_sum(self.local[1]).reshape(self.dims, self.dims)
        return gram(self.table, "vec", self.dims)

    def times(self, matrix: np.ndarray) -> "Vectors":
        """Each vector times a small matrix."""
        def run(batches):
            for batch in batches:
                m = kernels.to_matrix(batch.column(1), matrix.shape[0]) @ matrix
                yield pa.RecordBatch.from_arrays([batch.column(0), kernels.to_list_column(m)], ["id", "vec"])

        out = Vectors(self.table.select("id", "vec").mapInArrow(run, "id long, vec array<double>"),
                      self.n, matrix.shape[1], self.scale)
        if self.local is not None:
            out.local = (self.local[0], self.local[1] @ matrix)
        return out


def side_by_side(left: Vectors, right: Vectors) -> Vectors:
    """The vectors of ``left``, each followed by that of ``right`` with the same id (zeros if there is none)."""
    zeros = F.array_repeat(F.lit(0.0), right.dims)
    joined = (left.table.select("id", F.col("vec").alias("_a")).join(right.table.select("id", F.col("vec").alias("_b")), "id", "left")
              .select("id", F.concat("_a", F.coalesce("_b", zeros)).alias("vec")))
    out = Vectors(joined, left.n, left.dims + right.dims, left.scale)
    if left.is_small and right.is_small:
        (ids, a), (other, b) = left.local, right.local
        order = np.argsort(other)
        place = np.minimum(np.searchsorted(other, ids, sorter=order), max(len(other) - 1, 0))
        at = order[place] if len(other) else place
        known = other[at] == ids if len(other) else np.zeros(len(ids), dtype=bool)
        out.local = (ids, np.hstack([a, np.where(known[:, None], b[at], 0.0) if len(other) else np.zeros((len(ids), right.dims))]))
    return out


PACKED_FROM = 8     # narrower vectors travel as they are


def packed(rows: DataFrame, dims: int) -> DataFrame:
    """``rows`` (key, vec) for a shuffle, as (key, at, value): the entries of ``vec`` that are not zero and their places;
    all entries and no places where that is shorter."""
    key = rows.columns[0]
    if dims < PACKED_FROM:
        return rows.select(key, F.array().cast("array<int>").alias("at"), F.col("vec").alias("value"))

    def run(batches):
        for batch in batches:
            lists = [pa.ListArray.from_arrays(*map(pa.array, cells)) for cells in kernels.pack_rows(kernels.to_matrix(batch.column(1), dims))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], [key, "at", "value"])

    return rows.mapInArrow(run, f"{key} long, at array<int>, value array<double>")


BUNDLE_BYTES = 8 * 1024 * 1024     # packed rows a task holds before it sends them


def bundled(rows: DataFrame) -> DataFrame:
    """``packed`` rows (src, block, at, value) for the shuffle to the blocks: those of one block and task stand in one row of lists."""
    def lists(held):
        table = pa.Table.from_batches(held).sort_by("block").combine_chunks()
        src, block, at, value = (c.chunk(0) for c in table.columns)
        number, first = np.unique(block.to_numpy(), return_index=True)
        ends = np.append(first, len(block)).astype(np.int32)
        out = [pa.array(number, pa.int32()), pa.ListArray.from_arrays(pa.array(ends), src)]
        for cells in (at, value):
            offsets = cells.offsets.to_numpy() - cells.offsets[0].as_py()
            out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.diff(offsets).astype(np.int32))))
            out.append(pa.ListArray.from_arrays(pa.array(offsets[ends]), cells.flatten()))
        return pa.RecordBatch.from_arrays(out, ["block", "src", "n_at", "at", "n_value", "value"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= BUNDLE_BYTES:
                yield lists(held)
                held, size = [], 0
        if held:
            yield lists(held)

    return rows.select("src", "block", "at", "value").mapInArrow(
        run, "block int, src array<long>, n_at array<int>, at array<int>, n_value array<int>, value array<double>")


def unbundled(table: pa.Table, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids and the matrix of ``bundled`` rows."""
    def flat(name: str) -> np.ndarray:
        parts = [c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks]
        return np.concatenate(parts) if parts else np.zeros(0, np.float64 if name == "value" else np.int64)
    return flat("src"), kernels.unpack_rows(flat("n_at"), flat("at"), flat("n_value"), flat("value"), dims)


def _per_block(blocks: EdgeBlocks, vectors: Vectors, fn, schema: str) -> DataFrame:
    """Run ``fn(edge arrays, vector ids, vector matrix)`` on every block.

    A small vector table goes to the executors once; a larger one is joined with the
    (src, block) needs and shuffled to the blocks.
    """
    if vectors.local is not None:
        shared = vectors.spark.sparkContext.broadcast(vectors.local)

        def alone(edges: pa.Table) -> pa.Table:
            return fn(_arrays(edges), *shared.value)

        return blocks.edges.groupBy("block").applyInArrow(alone, schema)

    dims = vectors.dims

    def met(edges: pa.Table, shipped: pa.Table) -> pa.Table:
        return fn(_arrays(edges), *unbundled(shipped, dims))

    shipped = spread_join(blocks.needed, packed(vectors.table.select(F.col("id").alias("src"), "vec"), dims), "src",
                          blocks.hot_sources, "block")
    return blocks.edges.groupBy("block").cogroup(bundled(shipped).groupBy("block")).applyInArrow(met, schema)


def gather_sum(blocks: EdgeBlocks, vectors: Vectors, less: float = 0.0) -> DataFrame:
    """(id, vec): sum of (w - less) * vector(src) per target."""
    def run(edges, ids, matrix) -> pa.Table:
        targets, sources, weights, split = edges
        ids_out, sums = kernels.weighted_sums(targets, sources, weights - less, ids, matrix)
        return pa.table({"id": pa.array(ids_out, pa.int64()), "vec": kernels.to_list_column(sums),
                         "partial": pa.array(np.isin(ids_out, np.unique(targets[split])))})

    out = _per_block(blocks, vectors, run, "id long, vec array<double>, partial boolean")
    if not blocks.has_split:
        return out.select("id", "vec")
    out = blocks.workspace.stage(out, f"{blocks.name}-sums")
    return out.filter(~F.col("partial")).select("id", "vec").unionByName(_sum_parts(out.filter("partial"), vectors.dims))


def gather_there_and_back(blocks: EdgeBlocks, vectors: Vectors) -> DataFrame:
    """(id, vec) per src: the sum of w * (``gather_sum`` of the target) over its edges, that is A'A V for the matrix A of the edges. The sums
    of the targets stay in their block: each block passes on one partial sum per src. No target is spread over blocks."""
    def run(edges, ids, matrix) -> pa.Table:
        targets, sources, weights, _ = edges
        there, sums = kernels.weighted_sums(targets, sources, weights, ids, matrix)
        back, parts = kernels.weighted_sums(sources, targets, weights, there, sums)
        return pa.table({"id": pa.array(back, pa.int64()), "vec": kernels.to_list_column(parts)})

    if blocks.has_split:
        raise ValueError("targets are spread over blocks")
    return _sum_parts(_per_block(blocks, vectors, run, "id long, vec array<double>"), vectors.dims)


def _sum_parts(parts: DataFrame, dims: int) -> DataFrame:
    """Sum the vectors of one id: within each task as they come, then in hash slots, then
    over the slots of an id, so that no step holds all parts of a hot id."""
    room = max(1, (64 * 1024 * 1024) // (8 * dims))

    def combine(batches):
        held, rows = [], 0

        def flush():
            ids, vectors = np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held])
            order = np.argsort(ids, kind="stable")
            unique, starts = np.unique(ids[order], return_index=True)
            return unique, np.add.reduceat(vectors[order], starts, axis=0)
        for batch in batches:
            if batch.num_rows:
                held.append((batch.column(0).to_numpy(), kernels.to_matrix(batch.column(1), dims)))
                rows += batch.num_rows
            if rows >= room:
                held = [flush()]
                rows = len(held[0][0])
                if rows >= room // 2:      # little left to add up here
                    yield pa.RecordBatch.from_arrays([pa.array(held[0][0]), kernels.to_list_column(held[0][1])], ["id", "vec"])
                    held, rows = [], 0
        if held:
            ids, vectors = flush()
            yield pa.RecordBatch.from_arrays([pa.array(ids), kernels.to_list_column(vectors)], ["id", "vec"])

    def add(key, batches):
        total = kernels.to_matrix(batches.column("vec"), dims).sum(axis=0)
        return pa.table({"id": pa.array([key[0].as_py()], pa.int64()),
                         "vec": kernels.to_list_column(total[None, :])})

    combined = parts.select("id", "vec").mapInArrow(combine, "id long, vec array<double>")
    slots = combined.withColumn("_slot", F.pmod(F.hash("vec"), F.lit(64)))
    first = slots.groupBy("id", "_slot").applyInArrow(add, "id long, vec array<double>")
    return first.groupBy("id").applyInArrow(add, "id long, vec array<double>")


def gather_ridge(blocks: EdgeBlocks, vectors: Vectors, gram_matrix: np.ndarray, alpha: float = 1.0) -> DataFrame:
    """(id, vec): the ridge solution of each target with any edge. ``gram_matrix`` holds
    Y'Y + lambda I; the confidence of an edge is 1 + alpha * w."""
    return gather_ridges(blocks, vectors, [gram_matrix], [alpha])


def gather_ridges(blocks: EdgeBlocks, vectors: Vectors, grams: list[np.ndarray], alphas: list[float]) -> DataFrame:
    """``gather_ridge`` for several settings at once: the vectors of all of them stand one after the other in ``vec``, so
    each vector travels to a block once and each edge is read once. Of a target that is spread over several blocks,
    each block passes on its part of the equations as packed triangles and right sides."""
    dims = len(grams[0])
    packed_size = dims * (dims + 1) // 2 + dims

    def part(m: np.ndarray, point: int, size: int) -> np.ndarray:
        return np.ascontiguousarray(m[:, point * size:(point + 1) * size])

    def run(edges, known, matrix) -> pa.Table:
        targets, sources, weights, split = edges
        solved, parts = [], []
        for point, (g, alpha) in enumerate(zip(grams, alphas)):
            ids, done, split_ids, open_parts = kernels.ridge_rows(
                targets, sources, alpha * weights, known, part(matrix, point, dims), g, np.unique(targets[split]))
            solved.append(done)
            parts.append(open_parts)
        none_a = pa.nulls(len(split_ids), pa.list_(pa.float64()))
        none_b = pa.nulls(len(ids), pa.list_(pa.float64()))
        return pa.table({
            "id": pa.array(np.concatenate([ids, split_ids]), pa.int64()),
            "vec": pa.chunked_array([kernels.to_list_column(np.hstack(solved)), none_a]),
            "part": pa.chunked_array([none_b, kernels.to_list_column(np.hstack(parts))])})

    out = _per_block(blocks, vectors, run, "id long, vec array<double>, part array<double>")
    if not blocks.has_split:
        return out.select("id", "vec")
    out = blocks.workspace.stage(out, f"{blocks.name}-parts")

    def solve(batches):
        for batch in batches:
            packed = kernels.to_matrix(batch.column(1), packed_size * len(grams))
            solved = np.hstack([kernels.solve_packed(part(packed, point, packed_size), g) for point, g in enumerate(grams)])
            yield pa.RecordBatch.from_arrays([batch.column(0), kernels.to_list_column(solved)], ["id", "vec"])

    packed = out.filter(F.col("part").isNotNull()).select("id", F.col("part").alias("vec"))
    summed = _sum_parts(packed, packed_size * len(grams))
    return (out.filter(F.col("part").isNull()).select("id", "vec")
            .unionByName(summed.mapInArrow(solve, "id long, vec array<double>")))
