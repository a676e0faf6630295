"""Quality by Bradley-Terry ranking: document scores from preference pairs, cut at a quantile."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.kernels import to_list_column, to_matrix
from coldspring.llm import textkit
from coldspring.llm.line_quality import Lines, _BANG, _DIGIT, _LOWER, _MARK, _PIPE, _SYMBOL, _UPPER
from coldspring.operators.skew import with_position
from coldspring.workspace import Workspace

CUT = 0.3   # scores from here on are predicted as good; fixed by the contract
WIDTH = 17  # features of a document


@dataclass(frozen=True)
class PairConfig:
    pairs: int = 60_000      # at least as many preference pairs; every labelled document is in one or more
    penalty: float = 1e-3
    rounds: int = 60
    rows_per_task: int = 5_000           # labelled rows that one task puts in order
    broadcast_labels: int = 2_000_000    # up to so many labels go to the texts; beyond, both are shuffled


def doc_features(texts: list[bytes]) -> np.ndarray:
    """Features of whole texts: sizes, shares of kinds of characters, and repetition of words, runs and lines."""
    lines = Lines(texts)
    words, data = lines.words, lines.data
    base = lines.base()
    edges = words.text_starts
    n_words = base["n_words"].astype(float)
    some = np.maximum(n_words, 1)
    chars = np.maximum(base["word_chars"], 1).astype(float)

    def count(table):
        sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
        return (sums[edges[1:]] - sums[edges[:-1]]).astype(float)

    text = np.repeat(np.arange(len(texts)), np.diff(words.first))
    joined = textkit.mixed(lines.hashes + textkit.mixed(text.astype(np.uint64)))
    value, first = np.unique(joined, return_index=True)
    distinct = np.bincount(text[first], minlength=len(texts)).astype(float) if len(text) else np.zeros(len(texts))
    same = np.append(False, (lines.hashes[1:] == lines.hashes[:-1]) & (text[1:] == text[:-1])) if len(text) else np.empty(0, dtype=bool)
    adjacent = np.bincount(text, weights=same, minlength=len(texts)) if len(text) else np.zeros(len(texts))
    n_lines = np.maximum(np.diff(lines.text_first), 1).astype(float)
    ends = np.zeros(len(texts))
    if len(lines.starts):
        owner = np.repeat(np.arange(len(texts)), np.diff(lines.text_first))
        final = data[words.ends[lines.last - 1] - 1]
        ends = np.bincount(owner, weights=np.isin(final, list(b".!?\"'")), minlength=len(texts))
        marked = (lines._count(_SYMBOL) + lines._count(_PIPE) + lines._count(_BANG)) > 0.2 * (lines.last - lines.first)
        bad_words = np.bincount(owner, weights=marked * (lines.last - lines.first), minlength=len(texts))
    else:
        bad_words = np.zeros(len(texts))
    return np.stack([
        np.log1p(n_words) / 8, (n_words < 10).astype(float), np.log(chars / some + 1), count(_SYMBOL) / chars, count(_PIPE) / some, count(_BANG) / some,
        count(_UPPER) / chars, count(_DIGIT) / chars, count(_MARK) / some, count(_LOWER) / chars,
        distinct / some, adjacent / some, base["n_repeat_words"] / some, base["n_dup_lines"] / n_lines, ends / n_lines, bad_words / some,
        (base["n_repeat_words"] > 0.3 * some).astype(float)], axis=1)


@dataclass
class Ranking:
    """A linear score over scaled features; ``cut`` is the score at the quantile from which documents are good."""
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: float

    def raw(self, features: np.ndarray) -> np.ndarray:
        return np.clip((features - self.mean) / self.scale, -6, 6) @ self.weight

    def score(self, features: np.ndarray) -> np.ndarray:
        """0 to 1, rising with the ranking; the cut is at CUT."""
        return 1 / (1 + np.exp(-np.clip(self.raw(features) - self.cut + math.log(CUT / (1 - CUT)), -500, 500)))


def fit_ranking(features: np.ndarray, good: np.ndarray, config: PairConfig) -> Ranking:
    """Logistic loss on the feature differences of (good, bad) pairs; a pair is one draw of each side, every document
    of the rarer side is in as many pairs. The cut is the quantile of all scores that has the share of bad documents
    below it."""
    n = features.shape[1]
    if not len(good) or good.all() or not good.any():
        return Ranking(np.zeros(n), np.ones(n), np.zeros(n), math.log(CUT / (1 - CUT)))
    scale = features.std(axis=0)
    model = Ranking(features.mean(axis=0), np.where(scale > 1e-9, scale, 1.0), np.zeros(n), 0.0)
    x = np.clip((features - model.mean) / model.scale, -6, 6)
    draw = np.random.default_rng(5)
    up, down = np.flatnonzero(good), np.flatnonzero(~good)
    a = up[draw.permutation(np.resize(np.arange(len(up)), config.pairs))]
    b = down[draw.permutation(np.resize(np.arange(len(down)), config.pairs))]
    gap = x[a] - x[b]
    for _ in range(config.rounds):
        p = 1 / (1 + np.exp(-np.clip(gap @ model.weight, -30, 30)))
        gradient = gap.T @ (1 - p) / len(gap) - config.penalty * model.weight
        bend = (gap * (p * (1 - p))[:, None]).T @ gap / len(gap) + config.penalty * np.eye(n)
        step = np.linalg.solve(bend, gradient)
        model.weight = model.weight + step
        if np.abs(step).max() < 1e-7:
            break
    raw = x @ model.weight
    below = np.sort(raw)
    at = int((~good).sum())
    model.cut = float((below[at - 1] + below[min(at, len(below) - 1)]) / 2)
    return model


_SUMS = "_n long, _sums array<double>"


def _summed(rows: DataFrame, part) -> tuple[int, np.ndarray]:
    """(rows, sum of ``part`` of the feature matrix of each batch): tasks send one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, 0.0
        for batch in batches:
            if batch.num_rows:
                n, total = n + batch.num_rows, total + part(to_matrix(batch.column(0), WIDTH))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["_n", "_sums"])
    found = sorted(rows.mapInArrow(run, _SUMS).collect())       # so that sums do not depend on which task ends first
    return sum(r["_n"] for r in found), sum((np.array(r["_sums"]) for r in found), np.zeros(1))


def fit_everything(features: DataFrame, config: PairConfig, workspace: Workspace) -> Ranking:
    """``fit_ranking`` over a table of any size: all rows of ``features`` (_id, _row, _good, _features) take part.
    Every document is in a pair, those of the rarer side in more. The cut is the quantile of all scores that has the share of bad documents
    below it."""
    sides = {r["_good"]: r["n"] for r in features.groupBy("_good").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_good, n_bad = sides.get(True, 0), sides.get(False, 0)
    if not n_good or not n_bad:
        return Ranking(np.zeros(WIDTH), np.ones(WIDTH), np.zeros(WIDTH), math.log(CUT / (1 - CUT)))
    only = features.select("_features")
    n, total = _summed(only, lambda x: x.sum(axis=0))
    mean = total / n
    scale = np.sqrt(_summed(only, lambda x: ((x - mean) ** 2).sum(axis=0))[1] / n)
    model = Ranking(mean, np.where(scale > 1e-9, scale, 1.0), np.zeros(WIDTH), 0.0)

    # Documents take the slots of the pairs in turn, in the order of a hash; the bad ones begin one later in each round.
    n_pairs = max(config.pairs, n_good, n_bad)
    order = ["_h", "_id", "_row"]
    limit = config.rows_per_task
    placed = workspace.stage(with_position(features.withColumn("_h", F.xxhash64("_id")), ["_good"], order, limit,
                                           known_cold=max(n_good, n_bad) <= limit), "ranking-places")
    turn = lambda size: F.explode(F.sequence(F.lit(0), F.floor((F.lit(n_pairs - 1) - F.least("_pos", F.lit(n_pairs - 1))) / size) + 1))
    good = (placed.filter("_good").withColumn("_turn", turn(n_good))
            .select((F.col("_turn") * n_good + F.col("_pos")).alias("_slot"), F.col("_features").alias("_a")))
    bad = (placed.filter("NOT _good").withColumn("_turn", F.explode(F.sequence(F.lit(0), F.lit(math.ceil(n_pairs / n_bad) - 1))))
           .select((F.col("_turn") * n_bad + F.pmod(F.col("_pos") + F.col("_turn"), F.lit(n_bad))).alias("_slot"), F.col("_features").alias("_b")))

    def gaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.clip((to_matrix(batch.column(c), WIDTH) - model.mean) / model.scale, -6, 6) for c in ("_a", "_b"))
            yield pa.RecordBatch.from_arrays([to_list_column(a - b)], names=["_gap"])
    paired = workspace.stage(good.filter(F.col("_slot") < n_pairs).join(bad.filter(F.col("_slot") < n_pairs), "_slot").select("_a", "_b")
                             .mapInArrow(gaps, "_gap array<double>"), "ranking-pairs")
    for _ in range(config.rounds):
        weight = model.weight

        def part(gap: np.ndarray) -> np.ndarray:
            p = 1 / (1 + np.exp(-np.clip(gap @ weight, -30, 30)))
            return np.concatenate([gap.T @ (1 - p), ((gap * (p * (1 - p))[:, None]).T @ gap).ravel()])
        n, total = _summed(paired, part)
        gradient = total[:WIDTH] / n - config.penalty * weight
        bend = total[WIDTH:].reshape(WIDTH, WIDTH) / n + config.penalty * np.eye(WIDTH)
        step = np.linalg.solve(bend, gradient)
        model.weight = weight + step
        if np.abs(step).max() < 1e-7:
            break

    def raws(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(model.raw(to_matrix(batch.column("_features"), WIDTH)))], names=["_raw"])
    scored = workspace.stage(only.mapInArrow(raws, "_raw double"), "ranking-scores")
    at = with_position(scored, [], ["_raw"], limit, known_cold=n_good + n_bad <= limit)
    ends = [r["_raw"] for r in at.filter(F.col("_pos").isin(n_bad - 1, n_bad)).select("_raw").collect()]
    model.cut = float(sum(ends) / len(ends))
    return model


def learn_ranking(docs: DataFrame, labels: DataFrame, config: PairConfig = PairConfig(), id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality") -> Ranking:
    """The ranking learned from all rows of ``labels``; rows without id or label are left out."""
    marked = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"))
    few = marked.count() <= config.broadcast_labels
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(marked) if few else marked, "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = textkit.utf8(batch.column("_text"))
            good = pa.array(batch.column("_label").to_numpy() == 1)
            for a, b in textkit.pieces(texts):
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), good.slice(a, b - a), to_list_column(doc_features(texts[a:b]))],
                                                 names=["_id", "_good", "_features"])
    workspace = Workspace(docs.sparkSession)
    try:
        made = rows.mapInArrow(run, "_id long, _good boolean, _features array<double>").withColumn("_row", F.xxhash64("_features"))
        return fit_everything(workspace.stage(made, "ranking-features"), config, workspace)
    finally:
        workspace.close()


def score_documents(docs: DataFrame, ranking: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, score, predicted) per row of ``docs``: score from 0 to 1, the higher the likelier good, predicted is 1 from
    0.3 on. Null and empty texts are scored as texts without words. Only the id and text columns are read, whole
    texts count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = textkit.utf8(batch.column("_text"))
            for a, b in textkit.pieces(texts):
                score = ranking.score(doc_features(texts[a:b]))
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), pa.array(score), pa.array((score >= CUT).astype(np.int32))],
                                                 names=["_id", "score", "predicted"])
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(run, "_id long, score double, predicted int").withColumnRenamed("_id", id_col)
