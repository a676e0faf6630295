"""Quality rules by line labelling: a linear-chain conditional random field marks lines as content or boilerplate."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.llm import textkit

SYMBOLS = b"#*$%&|<>"   # fixed by the contract of the base counts
CONTENT, BOILERPLATE = 0, 1


@dataclass(frozen=True)
class LineConfig:
    sample: int = 3000          # labelled documents the field is fitted on, those with the least hash of their id
    sample_lines: int = 200     # lines of a sampled document that are used for fitting
    rounds: int = 120           # steps of gradient ascent
    penalty: float = 1e-3
    least_share: float = 0.5    # share of a document's words that must stand in content lines
    least_words: int = 50
    repeat_percent: int = 50


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(chars)] = True
    return out


_SYMBOL, _PIPE, _BANG = _table(SYMBOLS), _table(b"|"), _table(b"!?")
_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)) + bytes(range(128, 256)))
_DIGIT, _MARK = _table(bytes(range(48, 58))), _table(b".,;:")
_STOP = _table(b".!?\"')")
_HEAD = ~((np.arange(256) & 0xC0) == 0x80)

FEATURES = ["one", "log_words", "word_length", "symbols", "pipes", "bangs", "upper", "digits", "marks", "ends", "same_word", "seen",
            "very_short", "long_words", "links"]


class Lines:
    """Counts and features of the lines of some texts. Lines are split at \\n; those without a word are left out."""

    def __init__(self, texts: list[bytes]):
        self.words = words = textkit.Words(texts)
        data = words.bytes
        ends = np.flatnonzero(data == 10)
        starts = np.append(0, ends[:-1] + 1)
        first = np.searchsorted(words.starts, starts)
        last = np.searchsorted(words.starts, ends)
        keep = last > first
        self.starts, self.ends, self.first, self.last = starts[keep], ends[keep], first[keep], last[keep]
        self.text_first = np.searchsorted(self.starts, words.text_starts)   # first line of each text
        self.hashes = words.hashes()
        self.data = data

    def _count(self, table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[self.data], dtype=np.int64)])
        return sums[self.ends] - sums[self.starts]

    def features(self) -> np.ndarray:
        n_words = (self.last - self.first).astype(float)
        spelled = np.concatenate([[0], np.cumsum(self.words.ends - self.words.starts)])
        letters = np.maximum(spelled[self.last] - spelled[self.first], 1).astype(float)
        same = np.concatenate([[0], np.cumsum(np.append(False, self.hashes[1:] == self.hashes[:-1]))])
        final = self.words.ends[self.last - 1] - 1
        return np.stack([
            np.ones(len(n_words)), np.log1p(n_words) / 4, np.minimum(letters / n_words / 10, 3),
            self._count(_SYMBOL) / letters * 4, self._count(_PIPE) / n_words, self._count(_BANG) / n_words,
            self._count(_UPPER) / letters, self._count(_DIGIT) / letters * 2, self._count(_MARK) / n_words,
            _STOP[self.data[final]].astype(float), (same[self.last] - same[np.minimum(self.first + 1, self.last)]) / n_words,
            self.seen().astype(float), (n_words < 4).astype(float), (letters / n_words > 14).astype(float),
            self._count(_table(b"/@")) / n_words], axis=1)

    def seen(self) -> np.ndarray:
        """Whether a line equals an earlier line of its text."""
        out = np.zeros(len(self.starts), dtype=bool)
        raw = self.data.tobytes()
        for a, b in zip(self.text_first[:-1], self.text_first[1:]):
            known = set()
            for i in range(a, b):
                line = raw[self.starts[i]:self.ends[i]]
                out[i] = line in known
                known.add(line)
        return out

    def base(self) -> dict[str, np.ndarray]:
        """Per text: words, characters in words, symbols, repeated lines, words in repeated 3-word windows."""
        words, texts = self.words, len(self.words.first) - 1
        inside = ~textkit.SPACES[self.data]
        chars = np.concatenate([[0], np.cumsum(_HEAD[self.data] & inside, dtype=np.int64)])
        symbols = np.concatenate([[0], np.cumsum(_SYMBOL[self.data], dtype=np.int64)])
        edges = words.text_starts
        n = len(self.hashes)
        text = np.repeat(np.arange(texts), np.diff(words.first))
        covered = np.zeros(n + 3, dtype=np.int64)
        if n >= 3:
            whole = np.flatnonzero(text[:-2] == text[2:])
            h = textkit.mixed(self.hashes[:-2] * np.uint64(3) + textkit.mixed(self.hashes[1:-1] * np.uint64(5) + textkit.mixed(self.hashes[2:])))
            h = textkit.mixed(h[whole] + textkit.mixed(text[whole].astype(np.uint64)))
            order = np.argsort(h)
            same = h[order][1:] == h[order][:-1]
            twice = np.append(False, same) | np.append(same, False)
            at = whole[order[twice]]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + 3, -1)
        repeated = np.concatenate([[0], np.cumsum(np.cumsum(covered)[:n] > 0)])
        seen = np.concatenate([[0], np.cumsum(self.seen())])
        return {"n_words": np.diff(words.first), "word_chars": chars[edges[1:]] - chars[edges[:-1]],
                "n_symbols": symbols[edges[1:]] - symbols[edges[:-1]], "n_dup_lines": seen[self.text_first[1:]] - seen[self.text_first[:-1]],
                "n_repeat_words": repeated[words.first[1:]] - repeated[words.first[:-1]]}


@dataclass
class Field:
    """Weights of a chain of two states: ``line`` of a boilerplate line against a content line, ``step`` from state to state."""
    line: np.ndarray
    step: np.ndarray

    def decode(self, features: np.ndarray) -> np.ndarray:
        """The most likely states of one text (Viterbi). Ties go to content."""
        score = (features @ self.line).tolist()
        (cc, cb), (bc, bb) = self.step.tolist()
        content = boiler = 0.0
        back = []
        for i, s in enumerate(score):
            if i:
                from_c, from_b = content + cc >= boiler + bc, content + cb >= boiler + bb
                back.append((CONTENT if from_c else BOILERPLATE, CONTENT if from_b else BOILERPLATE))
                content, boiler = (content + cc if from_c else boiler + bc), (content + cb if from_b else boiler + bb)
            boiler += s
        state = CONTENT if content >= boiler else BOILERPLATE
        out = [state]
        for pair in reversed(back):
            state = pair[state]
            out.append(state)
        return np.array(out[::-1], dtype=np.int8)


def _logistic(features: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float, rounds: int = 40) -> np.ndarray:
    """Weighted logistic regression by Newton steps."""
    w = np.zeros(features.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(features @ w, -30, 30)))
        gradient = features.T @ (weight * (target - p)) - penalty * len(target) * w
        bend = (features * (weight * p * (1 - p))[:, None]).T @ features + penalty * len(target) * np.eye(len(w))
        step = np.linalg.solve(bend, gradient)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w


def fit_field(texts: list[tuple[bytes, int]], config: LineConfig) -> Field:
    """A field from documents with a quality label."""
    return fit_rows([(Lines([text]).features()[:config.sample_lines], label) for text, label in texts], config)


def fit_rows(rows: list[tuple[np.ndarray, int]], config: LineConfig) -> Field:
    """A field from the features of the lines of documents and the documents' labels.

    The label says nothing of single lines, so a logistic model of single lines first tells which lines of bad documents
    look like those of good ones; they count as content. The chain is then fitted on these lines by maximum likelihood (gradient
    ascent with forward and backward sums over all texts at once)."""
    parts, good = [x for x, _ in rows if len(x)], [label for x, label in rows if len(x)]
    n_features = len(FEATURES)
    if not parts or len(set(good)) < 2:
        return Field(np.concatenate([[-1.0], np.zeros(n_features - 1)]), np.zeros((2, 2)))
    flat = np.concatenate(parts)
    sizes = np.array([len(p) for p in parts])
    bad = np.repeat(1 - np.array(good), sizes).astype(float)
    weight = np.where(bad == 1, 0.5 / max(bad.sum(), 1), 0.5 / max((1 - bad).sum(), 1)) * len(bad)
    w = _logistic(flat, bad, weight, config.penalty)
    chance = 1 / (1 + np.exp(-flat @ w))
    target = ((bad == 1) & (chance > 0.5)).astype(np.int64)

    longest, n = int(sizes.max()), len(parts)
    x = np.zeros((n, longest, n_features))
    y = np.zeros((n, longest), dtype=np.int64)
    mask = np.arange(longest)[None, :] < sizes[:, None]
    x[mask], y[mask] = flat, target
    line, step = w.copy(), np.zeros((2, 2))
    pairs = mask[:, 1:]
    seen_steps = np.zeros((2, 2))
    np.add.at(seen_steps, (y[:, :-1][pairs], y[:, 1:][pairs]), 1)
    seen_lines = flat.T @ target
    speed, total = 1.0, mask.sum()
    moment_line, moment_step = np.zeros_like(line), np.zeros_like(step)
    for _ in range(config.rounds):
        score = np.zeros((n, longest, 2))
        score[:, :, 1] = x @ line
        forward = np.zeros((n, longest, 2))
        backward = np.zeros((n, longest, 2))
        forward[:, 0] = score[:, 0]
        for t in range(1, longest):
            moved = np.logaddexp(forward[:, t - 1, 0, None] + step[0], forward[:, t - 1, 1, None] + step[1]) + score[:, t]
            forward[:, t] = np.where(mask[:, t, None], moved, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            after = backward[:, t + 1] + score[:, t + 1]
            moved = np.logaddexp(step[:, 0][None] + after[:, 0, None], step[:, 1][None] + after[:, 1, None])
            backward[:, t] = np.where(mask[:, t + 1, None], moved, 0.0)
        whole = np.logaddexp(forward[:, -1, 0], forward[:, -1, 1])
        chance = np.exp(np.clip(forward[:, :, 1] + backward[:, :, 1] - whole[:, None], -60, 0)) * mask
        want_line = (seen_lines - np.einsum("nt,ntf->f", chance, x)) / total - config.penalty * line
        both = (forward[:, :-1, :, None] + step[None, None] + (score + backward)[:, 1:, None, :] - whole[:, None, None, None])
        want_step = (seen_steps - (np.exp(np.clip(both, -60, 0)) * pairs[:, :, None, None]).sum(axis=(0, 1))) / total - config.penalty * step
        moment_line = 0.9 * moment_line + want_line
        moment_step = 0.9 * moment_step + want_step
        line, step = line + speed * moment_line, step + speed * moment_step
    return Field(line, step)


def _verdicts(texts: list[bytes], field: Field, config: LineConfig) -> dict[str, np.ndarray]:
    lines = Lines(texts)
    base, features = lines.base(), lines.features()
    counts = (lines.last - lines.first).astype(np.int64)
    failed = (base["n_words"] < config.least_words) | (100 * base["n_repeat_words"] > config.repeat_percent * base["n_words"])
    content = np.zeros(len(texts), dtype=np.int64)
    for i, (p, q) in enumerate(zip(lines.text_first[:-1], lines.text_first[1:])):
        if q > p:
            content[i] = counts[p:q][field.decode(features[p:q]) == CONTENT].sum()
    return base | {"content_words": content, "base_failed": failed, "kept": ~failed & (content >= config.least_share * base["n_words"])}


def _judge(field: Field, config: LineConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = textkit.utf8(batch.column("_text"))
            for a, b in textkit.pieces(texts):
                found = _verdicts(texts[a:b], field, config)
                yield pa.RecordBatch.from_arrays([batch.column("_id").slice(a, b - a), *[pa.array(v) for v in found.values()]], names=["_id", *found])
    return run


def _keep(text_at: int, field: Field, config: LineConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = textkit.utf8(batch.column(text_at))
            for a, b in textkit.pieces(texts):
                yield batch.slice(a, b - a).filter(pa.array(_verdicts(texts[a:b], field, config)["kept"]))
    return run


def _line_rows(config: LineConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Lines([text]).features()[:config.sample_lines].astype(float).tobytes() for text in textkit.utf8(batch.column("_text"))]
            yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), pa.array(found, pa.binary())], names=["_id", "_label", "_rows"])
    return run


def fit_lines(docs: DataFrame, labels: DataFrame, config: LineConfig = LineConfig(), id_col: str = "doc_id", text_col: str = "text",
              label_col: str = "quality") -> Field:
    """The field fitted on at most ``sample`` labelled documents and ``sample_lines`` lines of each.

    Their features are made in the tasks; only those reach the driver. An id that is repeated gives its least text and its
    least label, so reruns agree. Null ids, texts and labels are left out. Without documents of both labels, every line is content.
    """
    drawn = (labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("_id"))
             .agg(F.min(F.col(label_col).cast("int")).alias("_label")).orderBy(F.xxhash64("_id"), "_id").limit(config.sample))
    chosen = (docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(drawn), "_id")
              .filter(F.col("_text").isNotNull()).groupBy("_id").agg(F.min("_text").alias("_text"), F.min("_label").alias("_label")))
    rows = chosen.mapInArrow(_line_rows(config), "_id long, _label int, _rows binary").collect()
    rows.sort(key=lambda r: r["_id"])
    return fit_rows([(np.frombuffer(r["_rows"]).reshape(-1, len(FEATURES)), r["_label"]) for r in rows], config)


def judge_documents(docs: DataFrame, field: Field, config: LineConfig = LineConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content_words, base_failed, kept) per row of ``docs``.

    Words are runs of bytes other than ASCII white space. A document fails the base rules with fewer than ``least_words`` words,
    or if more than ``repeat_percent`` of its words stand in 3-word windows that occur twice. Else it is kept if at least
    ``least_share`` of its words stand in lines that the field marks as content. Null and empty texts have no words and fail.
    An empty table gives an empty table. Ids may be null or repeat; only the id and text columns are read.
    """
    schema = ("_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_words long, "
              "base_failed boolean, kept boolean")
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(_judge(field, config), schema).withColumnRenamed("_id", id_col)


def keep_documents(docs: DataFrame, field: Field, config: LineConfig = LineConfig(), text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all their columns."""
    return docs.mapInArrow(_keep(docs.columns.index(text_col), field, config), docs.schema)
