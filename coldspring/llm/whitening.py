"""Whitening of embeddings: each vector projected on the leading eigenvectors of the covariance, at unit variance.

The covariance is summed up in tasks over the distinct vectors. Its leading eigenvalues are found by slicing the
spectrum: the signs of the pivots of V - sI = L D L' count the eigenvalues on each side of s (Sylvester), so
halving intervals gives every wanted eigenvalue an interval of its own together with its number. Rayleigh quotient
iteration then converges cubically inside the interval, and two more counts beside the value found certify that it
has this number. What reaches the driver is a matrix of dims x dims.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.workspace import Workspace

FAN_IN = 32
EPS = np.finfo(float).eps
LARGEST = 2.0 ** 53    # entries beyond it (after scaling) have no exact long value and count as not finite


@dataclass(frozen=True)
class WhitenConfig:
    components: int = 16
    scale: float = 64.0        # entry c becomes floor(scale * c) + offset
    offset: int = 1_000_000


@dataclass(frozen=True)
class Whitening:
    config: WhitenConfig
    n: int                     # distinct vectors
    sums: list[int]            # of their entries, by dimension
    values: np.ndarray         # leading eigenvalues, falling
    vectors: np.ndarray        # dims x components
    trace: float
    identity_error: float


def inertia(matrix: np.ndarray, shift: float) -> tuple[int, int]:
    """(eigenvalues below, eigenvalues above) ``shift``, from the pivots of L D L' with 1 x 1 and 2 x 2 pivots."""
    a = matrix - shift * np.eye(len(matrix))
    n, k, below, zero = len(a), 0, 0, 0
    bound = (1 + math.sqrt(17)) / 8     # keeps the growth of the entries least
    while k < n:
        two = False
        if k + 1 < n:
            column = np.abs(a[k + 1:, k])
            r = k + 1 + int(column.argmax())
            largest = column[r - k - 1]
            if abs(a[k, k]) < bound * largest:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                across = row.max()
                if abs(a[k, k]) * across < bound * largest * largest:
                    two = abs(a[r, r]) < bound * across
                    to = k + 1 if two else k
                    a[[to, r]] = a[[r, to]]
                    a[:, [to, r]] = a[:, [r, to]]
        if two:
            (p, q), (_, s) = a[k:k + 2, k:k + 2]
            det = p * s - q * q
            below += 1 if det < 0 else 2 if p + s < 0 else 0
            rest = a[k + 2:, k:k + 2]
            a[k + 2:, k + 2:] -= rest @ (np.array([[s, -q], [-q, p]]) / det) @ rest.T
            k += 2
        else:
            pivot = a[k, k]
            if pivot == 0:
                zero += 1
            else:
                below += pivot < 0
                rest = a[k + 1:, k]
                a[k + 1:, k + 1:] -= np.outer(rest / pivot, rest)
            k += 1
    return below, n - below - zero


def _intervals(matrix: np.ndarray, wanted: int, norm: float) -> list[tuple[float, float, int, int]]:
    """(low, high, first, last): the eigenvalues number first to last, and no others, are above low and at most high.
    One number each, unless eigenvalues agree within rounding."""
    above = lambda s: inertia(matrix, s)[1]
    todo, done = [(-norm, norm, 0, len(matrix))], []
    while todo:
        low, high, before, upto = todo.pop()
        if upto == before or before >= wanted:
            continue
        if upto == before + 1 or high - low <= 8 * EPS * norm:
            done.append((low, high, before + 1, upto))
            continue
        middle = (low + high) / 2
        split = min(max(above(middle), before), upto)
        todo += [(low, middle, split, upto), (middle, high, before, split)]
    return sorted(done, key=lambda i: i[2])


def _solve(matrix: np.ndarray, shift: float, x: np.ndarray, norm: float) -> np.ndarray:
    while True:
        try:
            y = np.linalg.solve(matrix - shift * np.eye(len(matrix)), x)
            if np.isfinite(y).all() and y.any():
                return y / np.linalg.norm(y)
        except np.linalg.LinAlgError:
            pass
        shift += 4 * EPS * norm       # the shift is an eigenvalue to the last digit


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, with unit eigenvectors as columns. Raises
    ArithmeticError if a value cannot be certified. The largest entry of each vector is positive."""
    dims = len(matrix)
    wanted = min(wanted, dims)
    norm = float(np.abs(matrix).sum(axis=1).max()) if dims else 0.0
    if not norm:
        return np.zeros(0), np.zeros((dims, 0))
    norm *= 1 + 16 * EPS
    values, vectors = [], np.zeros((dims, 0))
    draw = np.random.default_rng(13)

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            x = x - vectors @ (vectors.T @ x)
        return x / np.linalg.norm(x)

    for low, high, first, last in _intervals(matrix, wanted, norm):
        for number in range(first, min(last, wanted) + 1):
            while True:
                shift, x, best = (low + high) / 2, apart(draw.standard_normal(dims)), math.inf
                for step in range(60):
                    x = apart(_solve(matrix, shift, x, norm))
                    image = matrix @ x
                    value = float(x @ image)
                    residual = float(np.linalg.norm(image - value * x))
                    if step > 1 and residual >= best / 2 and best <= 1e3 * EPS * norm:
                        break
                    best = min(best, residual)
                    # the quotient takes over as soon as it points into the interval
                    shift = value if low - 4 * EPS * norm <= value <= high + 4 * EPS * norm and step else (low + high) / 2
                slack = 4 * residual + 64 * EPS * norm
                if residual <= 1e4 * EPS * norm and inertia(matrix, value - slack)[1] >= number > inertia(matrix, value + slack)[1]:
                    break
                if high - low <= 8 * EPS * norm:
                    raise ArithmeticError(f"eigenvalue {number} could not be certified")
                middle = (low + high) / 2      # a neighbour was caught: halve the interval and start again
                low, high = (middle, high) if inertia(matrix, middle)[1] >= number else (low, middle)
            values.append(value)
            vectors = np.column_stack([vectors, x])
    order = np.argsort(-np.array(values), kind="stable")
    values, vectors = np.array(values)[order], vectors[:, order]
    return values, vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])


def _whole_numbers(vectors: DataFrame, column: str, config: WhitenConfig) -> Column:
    """The vector as longs, null if it is null or holds a null or an entry that is not finite."""
    scaled = F.transform(column, lambda c: c.cast("double") * config.scale)
    usable = F.forall(scaled, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < LARGEST), F.lit(False)))
    return F.when(usable, F.transform(scaled, lambda c: F.floor(c) + F.lit(config.offset).cast("long")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: longs, or Python numbers where longs could overflow."""
    middle = np.array([round(s / n) for s in sums], dtype=np.int64)
    rest = [s - n * int(m) for s, m in zip(sums, middle)]
    near = x - middle
    if (int(np.abs(near).max(initial=0)) + 1) * n < 1 << 62:
        return near * n - np.array(rest, dtype=np.int64)
    return near.astype(object) * n - np.array(rest, dtype=object)


def _squares(d: np.ndarray) -> list[int | None]:
    """Exact row sums of squares; null where a long cannot hold them."""
    top = int(np.abs(d).max(initial=0))
    if d.dtype != object and top * top * max(1, d.shape[1]) < 1 << 62:
        return (d * d).sum(axis=1).tolist()
    exact = [sum(int(v) * int(v) for v in row) for row in d]
    return [v if v < 1 << 63 else None for v in exact]


def _summed(table: DataFrame, width: int, add) -> np.ndarray:
    """Sum of ``add(batch)`` over the batches of ``table``, over ``FAN_IN`` tasks at the end."""
    def first(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += add(batch)
        yield pa.RecordBatch.from_arrays([kernels.to_list_column(total[None, :])], ["v"])

    def again(batches):
        total = np.zeros(width)
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch.column(0), width).sum(axis=0)
        yield pa.RecordBatch.from_arrays([kernels.to_list_column(total[None, :])], ["v"])

    parts = table.mapInArrow(first, "v array<double>").repartition(FAN_IN).mapInArrow(again, "v array<double>").collect()
    return np.sum([np.array(p.v) for p in parts], axis=0)


def fit(vectors: DataFrame, workspace: Workspace, column: str = "embedding", config: WhitenConfig = WhitenConfig()) -> Whitening:
    """The whitening of the distinct vectors of ``column``.

    Rows whose vector is null or holds a null or an entry that is not finite (or too large for an exact long) take no
    part. If vectors differ in length, only the most frequent length counts (ties: the longest). Components of zero
    variance (within rounding) do not exist, so one distinct vector, empty vectors and an empty table give a whitening
    without components.
    """
    x = vectors.select(_whole_numbers(vectors, column, config).alias("x")).filter("x is not null")
    # partial aggregation leaves one row per task of a frequent vector
    distinct = workspace.stage(x.groupBy("x").agg(F.count(F.lit(1)).alias("times")), "distinct-vectors")
    lengths = distinct.groupBy(F.size("x").alias("dims")).agg(F.sum("times").alias("times"), F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("times"), F.desc("dims")).first()
    if common is None or not common["dims"]:
        return Whitening(config, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    dims, n = common["dims"], common["n"]
    table = distinct.filter(F.size("x") == dims).select("x")

    def add_up(batches):
        total = np.zeros(dims, dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                total += _matrix(batch.column(0), dims).sum(axis=0)
        yield pa.RecordBatch.from_arrays([kernels.to_list_column(total[None, :])], ["v"])

    places = table.mapInArrow(add_up, "v array<bigint>").select(F.posexplode("v").alias("place", "v"))
    found = dict(places.groupBy("place").agg(F.sum(F.col("v").cast("decimal(38,0)"))).collect())
    sums = [int(found[i]) for i in range(dims)]

    def outer(batch):
        centred = _deviations(_matrix(batch.column(0), dims), n, sums).astype(float) / n
        return (centred.T @ centred).ravel()

    v = _summed(table, dims * dims, outer).reshape(dims, dims) / n
    v = (v + v.T) / 2
    values, axes = leading_pairs(v, config.components)
    trace = float(np.trace(v))
    real = values > dims * EPS * trace
    values, axes = values[real], axes[:, real]
    k = len(values)
    if not k:
        return Whitening(config, n, sums, values, axes, trace, 0.0)

    def whitened_outer(batch):
        w = _project(_matrix(batch.column(0), dims), n, sums, values, axes)[1]
        return (w.T @ w).ravel()

    error = float(np.abs(_summed(table, k * k, whitened_outer).reshape(k, k) / n - np.eye(k)).max())
    return Whitening(config, n, sums, values, axes, trace, error)


def _project(x: np.ndarray, n: int, sums: list[int], values: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _deviations(x, n, sums)
    return d, (d.astype(float) / n) @ axes / np.sqrt(values)


def whiten(vectors: DataFrame, whitening: Whitening, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and component.

    Rows that take no part in a fit (see ``fit``) have no result; neither has any row of a whitening without
    components. Repeated ids and vectors are whitened one by one. ``deviation`` (sum over dimensions of
    (n * x - S)^2, exact) is null where a long cannot hold it.
    """
    kind = vectors.schema[id_column].dataType.simpleString()
    schema = f"id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    dims, k = whitening.vectors.shape
    x = (vectors.select(vectors[id_column].alias("id"), _whole_numbers(vectors, column, whitening.config).alias("x"))
         .filter((F.size("x") == dims) if k else F.lit(False)))

    def run(batches):
        share = whitening.values / whitening.trace
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            d, w = _project(_matrix(batch.column(1), dims), whitening.n, whitening.sums, whitening.values, whitening.vectors)
            at = pa.array(np.repeat(np.arange(rows), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, whitening.n)),
                 pa.array(_squares(d), pa.int64()).take(at), pa.array(w.ravel()), pa.array(np.tile(share, rows)),
                 pa.array(np.full(rows * k, whitening.identity_error))],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, schema).withColumnRenamed("id", id_column)
