"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may appear with k = floor(share * m) edits. Cut into k + 1 pieces, at least
one piece survives unchanged, so exact piece hits (one automaton for all pieces) find every place to look
at. There the bit-parallel edit distance of Myers decides. A short item counts only between word boundaries.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LeakConfig:
    share: float = 0.08          # edits allowed per character of a test item
    least: int = 32              # shorter items must begin and end at word boundaries of the text, to tell a leak from chance
    block_bytes: int = 16 << 20  # test items sent to the tasks at once; more are matched block by block


# Letters of scripts that put no space between words, or endings right behind them: a boundary is on either side.
DENSE = re.compile("[\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1100-\u11ff\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u3130-\u318f"
                   "\u31f0-\u31ff\u3400-\u9fff\ua960-\ua97f\uac00-\ud7ff\uf900-\ufaff\uff66-\uffdc\U0001b000-\U0001b16f\U00020000-\U0003ffff]")


def boundary(text: str, at: int) -> bool:
    """Whether a word may begin or end before character ``at``."""
    if at <= 0 or at >= len(text):
        return 0 <= at <= len(text)
    a, b = text[at - 1], text[at]
    return not (a.isalnum() and b.isalnum()) or bool(DENSE.match(a) or DENSE.match(b))


def normal(text: str) -> str:
    """Lower-cased, with each run of white space as one space."""
    return " ".join(text.lower().split())


def pieces(text: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces of nearly equal length with their offsets."""
    cuts = [len(text) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, text[a:b]) for a, b in zip(cuts, cuts[1:]) if b > a]


def myers(masks: dict[str, int], size: int, text: str) -> tuple[int, int]:
    """(least edit distance of the pattern to a substring of ``text``, where that substring ends).

    ``masks`` has for each character of the pattern the positions as bits. Python's long integers hold
    the whole column of differences, so one step is a few operations whatever the pattern's length."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    best, end = size, 0
    for at, char in enumerate(text, 1):
        same = masks.get(char, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(horizontal | up))
        fall = up & horizontal
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
            if score < best:
                best, end = score, at
        rise = (rise << 1) & full
        up = ((fall << 1) & full) | (full & ~(vertical | rise))
        down = rise & vertical
    return best, end


def anchored(masks: dict[str, int], size: int, text: str) -> Iterator[int]:
    """The edit distance of the pattern to each beginning of ``text``, from one character on. As ``myers``, but a later begin costs."""
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, score = full, 0, size
    for char in text:
        same = masks.get(char, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        rise = down | (full & ~(horizontal | up))
        fall = up & horizontal
        score += 1 if rise & top else -1 if fall & top else 0
        rise = ((rise << 1) | 1) & full
        up = ((fall << 1) & full) | (full & ~(vertical | rise))
        down = rise & vertical
        yield score


def words_distance(masks: dict[str, int], size: int, edits: int, text: str, starts: list[int]) -> int:
    """Least edit distance of the pattern to a stretch of ``text`` between word boundaries that begins at most ``edits`` from one of
    ``starts``; ``edits`` + 1 if there is none within the budget."""
    best = edits + 1
    for begin in sorted({s + d for s in starts for d in range(-edits, edits + 1)}):
        if begin < 0 or begin >= len(text) or not boundary(text, begin):
            continue
        for end, far in enumerate(anchored(masks, size, text[begin:begin + size + edits]), begin + 1):
            if far < best and boundary(text, end):
                best = far
        if not best:
            break
    return best


class Matcher:
    """The pieces of some test items as one automaton."""

    def __init__(self, items: list[tuple[int, str]], config: LeakConfig):
        self.items, self.least = [], config.least
        places = defaultdict(list)
        for number, text in items:
            text = normal(text or "")
            if not text:
                continue
            edits = math.floor(config.share * len(text))
            masks: dict[str, int] = defaultdict(int)
            for i, char in enumerate(text):
                masks[char] |= 1 << i
            for at, piece in pieces(text, edits):
                places[piece].append((len(self.items), at))
            self.items.append((number, text, edits, dict(masks)))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def leaks(self, text: str | None) -> list[tuple[int, int]]:
        """(item, distance) of the items that occur in ``text`` within their budget."""
        if not text or not self.items:
            return []
        text = normal(text)
        spans = defaultdict(list)
        for last, (size, where) in self.automaton.iter(text):
            for item, at in where:
                spans[item].append(last + 1 - size - at)
        found = []
        for item, starts in spans.items():
            number, wanted, edits, masks = self.items[item]
            if len(wanted) < self.least:
                best = words_distance(masks, len(wanted), edits, text, starts)
                if best <= edits:
                    found.append((number, best))
                continue
            if wanted in text:
                found.append((number, 0))
                continue
            best = edits + 1
            reach = -1
            begin = None
            # Places whose stretches of text overlap are looked at together.
            for start in [*sorted(set(starts)), None]:
                if begin is not None and (start is None or start - edits > reach):
                    best = min(best, myers(masks, len(wanted), text[max(begin, 0):max(reach, 0)])[0])
                    begin = None
                if start is not None:
                    begin = start - edits if begin is None else begin
                    reach = start + len(wanted) + edits
            if best <= edits:
                found.append((number, best))
        return found


def _match(items: list[tuple[int, str]], config: LeakConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, config)
        for batch in batches:
            out = [(number, *leak) for number, text in zip(batch.column("_id").to_pylist(), batch.column("_text").to_pylist())
                   for leak in matcher.leaks(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["_id", "_item", "_distance"])
    return run


def _clean(text_at: int, items: list[tuple[int, str]], config: LeakConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(items, config)
        for batch in batches:
            yield batch.filter(pa.array([not matcher.leaks(text) for text in batch.column(text_at).to_pylist()], pa.bool_()))
    return run


def _blocks(benchmark: DataFrame, config: LeakConfig, item_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """The test items in blocks of about ``block_bytes`` at most."""
    items = benchmark.select(F.col(item_col).cast("long").alias("_item"), F.col(text_col).alias("_text")).filter("_item is not null and _text is not null")
    total = items.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    blocks = max(1, math.ceil(2 * total / config.block_bytes))
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("_item"), F.lit(blocks)) == block) if blocks > 1 else items
        yield [(r["_item"], r["_text"]) for r in part.orderBy("_item", "_text").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, config: LeakConfig = LeakConfig(), id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row (id, item, distance) for each document and test item that occurs in it with at most floor(share * length)
    edits, by characters, after lower-casing and joining white space. ``distance`` is 0 for a verbatim leak, else the least
    edit distance.

    Null and empty texts match nothing; an item shorter than ``least`` characters counts only where it begins and ends at word
    boundaries, by the same budget of edits; equal items are reported each.
    Rows that share an id are reported each. Without documents or items there are no rows. Only the named columns are read. The test items are the query set: they go to the
    tasks in blocks of at most ``block_bytes``, each block meets all documents.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    found = [rows.mapInArrow(_match(items, config), "_id long, _item long, _distance long") for items in _blocks(benchmark, config, item_col, item_text_col)]
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.select(F.col("_id").alias(id_col), F.col("_item").alias(item_col), F.col("_distance").alias("distance"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, config: LeakConfig = LeakConfig(), text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which ``find_leaks`` finds no test item, with all their columns."""
    for items in _blocks(benchmark, config, item_col, item_text_col):
        docs = docs.mapInArrow(_clean(docs.columns.index(text_col), items, config), docs.schema)
    return docs
