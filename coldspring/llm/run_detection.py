"""Periodic runs of words: stretches that repeat a short unit at least four times.

Per batch of texts (words numbered through, a separator of its own after each text) a suffix array is built by
prefix doubling, and a wavelet matrix over its places answers range-successor queries: the next occurrence of a
block at or after a place. Blocks of 2, 4, 8, ... words at aligned places ask for their occurrences in the
neighbouring window where a run of the matching periods must repeat them. One or two occurrences give a
candidate period each; three or more stand in arithmetic progression and give one together. A candidate is
extended to both sides by longest common extensions from the classes of the prefix doubling.

Why no run is missed: let a run have period q and length 4q or more (6 for q = 1), and b the block size with
(2b - 1) / 3 <= q < (4b - 1) / 3. The first aligned block in the run starts less than b words after the run,
and it and its copy q words on both end inside. If the window holds three occurrences, they are at most b / 3
apart, so the block has that period p; the stretch of period p around the block ends inside the run, hence the
stretch around the copy ends exactly q words later.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from coldspring.llm import textkit

LEAST_LENGTH = 6
LEAST_REPEATS = 4
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class SuffixOrder:
    """Suffix array of a sequence by prefix doubling; the classes of all substrings of 2^k symbols are kept.

    Class numbers are places in the suffix array: the suffixes that begin with the substring take the places
    from its class number on. The last symbol must be unlike all others. Needs about 4 bytes per symbol and
    level, and as many levels as the longest repeated substring has binary digits.
    """

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        first = np.flatnonzero(np.diff(symbols[order], prepend=symbols[order[0]] - 1))
        sizes = np.diff(first, append=n)
        rank[order] = np.repeat(first, sizes)
        shared = np.repeat(sizes, sizes)
        active, held = order[shared > 1], shared[shared > 1]
        self.classes: list[np.ndarray] = []
        self.repeated: list[tuple[np.ndarray, np.ndarray]] = []   # per level: places of repeated substrings, class sizes
        width = 1
        while len(active):
            self.classes.append(rank.astype(np.int32))
            self.repeated.append((active, held))
            key = rank[active] * n + rank[active + width]
            inside = np.argsort(key, kind="stable")
            active, key = active[inside], key[inside]
            own = rank[active]
            at = np.arange(len(active))
            class_start = np.maximum.accumulate(np.where(np.diff(own, prepend=-1) != 0, at, 0))
            cuts = np.flatnonzero(np.diff(key, prepend=-1))
            sizes = np.diff(cuts, append=len(active))
            rank[active] = own + np.repeat(cuts, sizes) - class_start
            held = np.repeat(sizes, sizes)
            active, held = active[held > 1], held[held > 1]
            width *= 2
        self.array = np.empty(n, dtype=np.int64)
        self.array[rank] = np.arange(n)

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at ``i`` and ``j`` (i != j)."""
        done = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.classes) - 1, -1, -1):
            c = self.classes[level]
            done += (c[i + done] == c[j + done]).astype(np.int64) << level
        return done

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common suffix of the stretches that end before ``i`` and before ``j`` (i < j)."""
        done = np.zeros(len(i), dtype=np.int64)
        for level in range(len(self.classes) - 1, -1, -1):
            c, width = self.classes[level], 1 << level
            a, b = i - done - width, j - done - width
            done += ((a >= 0) & (c[np.maximum(a, 0)] == c[np.maximum(b, 0)])).astype(np.int64) << level
        return done


class RangeSuccessor:
    """Wavelet matrix over a permutation: bit vectors with counts per 64 bits, one level per binary digit."""

    def __init__(self, values: np.ndarray):
        self.n, self.digits = len(values), max(1, int(len(values) - 1).bit_length())
        self.levels = []
        for digit in range(self.digits - 1, -1, -1):
            ones = (values >> digit & 1).astype(bool)
            packed = np.zeros((self.n >> 6) * 64 + 64, dtype=np.uint8)
            packed[:self.n] = ones
            words = np.packbits(packed, bitorder="little").view(np.uint64)
            counts = np.zeros(len(words), dtype=np.int64)
            np.cumsum(np.bitwise_count(words[:-1]), out=counts[1:])
            zeros = self.n - int(np.count_nonzero(ones))
            self.levels.append((words, counts, zeros))
            values = np.concatenate([values[~ones], values[ones]])

    @staticmethod
    def _ones(level: tuple, at: np.ndarray) -> np.ndarray:
        words, counts, _ = level
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return counts[word] + np.bitwise_count(words[word] & below)

    def _smaller(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """How many values of places lo..hi-1 are below ``x`` (x within the digits)."""
        found = np.zeros(len(lo), dtype=np.int64)
        for level, digit in zip(self.levels, range(self.digits - 1, -1, -1)):
            a, b = self._ones(level, lo), self._ones(level, hi)
            up = (x >> digit & 1).astype(bool)
            found += np.where(up, (hi - b) - (lo - a), 0)
            lo, hi = np.where(up, level[2] + a, lo - a), np.where(up, level[2] + b, hi - b)
        return found

    def _nth(self, lo: np.ndarray, hi: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The value with ``nth`` smaller ones among the places lo..hi-1."""
        value = np.zeros(len(lo), dtype=np.int64)
        for level, digit in zip(self.levels, range(self.digits - 1, -1, -1)):
            a, b = self._ones(level, lo), self._ones(level, hi)
            zeros = (hi - b) - (lo - a)
            up = nth >= zeros
            value |= up.astype(np.int64) << digit
            nth = np.where(up, nth - zeros, nth)
            lo, hi = np.where(up, level[2] + a, lo - a), np.where(up, level[2] + b, hi - b)
        return value

    def successor(self, lo: np.ndarray, hi: np.ndarray, x: np.ndarray) -> np.ndarray:
        """The smallest value of at least ``x`` among the places lo..hi-1, or the number of values if there is none."""
        out = np.full(len(lo), self.n, dtype=np.int64)
        ask = np.flatnonzero(x < self.n)
        below = self._smaller(lo[ask], hi[ask], x[ask])
        some = below < hi[ask] - lo[ask]
        ask = ask[some]
        out[ask] = self._nth(lo[ask], hi[ask], below[some])
        return out


def _candidates(order: SuffixOrder) -> tuple[np.ndarray, np.ndarray]:
    """(place, period) pairs among which every run has one of its places and its period."""
    tree = RangeSuccessor(order.array)
    n = tree.n
    places, periods = [], []
    for level in range(1, len(order.repeated)):
        block = 1 << level
        least, limit = -(-(2 * block - 1) // 3), -(-(4 * block - 1) // 3)
        active, held = order.repeated[level]
        aligned = active % block == 0
        s, size = active[aligned], held[aligned]
        lo = order.classes[level][s].astype(np.int64)
        hi = lo + size
        end = np.minimum(s + limit, n)
        one = tree.successor(lo, hi, s + least)
        some = one < end
        s, lo, hi, end, one = s[some], lo[some], hi[some], end[some], one[some]
        two = tree.successor(lo, hi, one + 1)
        more = np.flatnonzero(two < end)
        three = np.full(len(s), n, dtype=np.int64)
        three[more] = tree.successor(lo[more], hi[more], two[more] + 1)
        series = three < end
        alone = ~series
        places.append(s[alone])
        periods.append((one - s)[alone])
        pair = alone & (two < end)
        places.append(s[pair])
        periods.append((two - s)[pair])
        s, one, step = s[series], one[series], (two - one)[series]
        q = one - s + order.forward(one, one + step) - order.forward(s, s + step)
        places.append(s[q > 0])
        periods.append(q[q > 0])
    if not places:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    return np.concatenate(places), np.concatenate(periods)


def find_runs(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, smallest period) of all runs of a sequence whose last symbol occurs once, by start and period."""
    if len(symbols) <= LEAST_LENGTH:
        return (np.empty(0, dtype=np.int64),) * 3
    order = SuffixOrder(symbols)
    s, q = _candidates(order)
    s, q = s[s + q < len(symbols)], q[s + q < len(symbols)]
    left = order.backward(s, s + q)
    start, length = s - left, left + order.forward(s, s + q) + q
    good = length >= np.maximum(LEAST_LENGTH, LEAST_REPEATS * q)
    start, length, q = start[good], length[good], q[good]
    # the same stretch with a multiple of its period is the same run
    at = np.lexsort((q, length, start))
    start, length, q = start[at], length[at], q[at]
    new = np.ones(len(start), dtype=bool)
    new[1:] = (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    start, length, q = start[new], length[new], q[new]
    at = np.lexsort((q, start))
    return start[at], length[at], q[at]


@dataclass
class _Piece:
    """The words of some texts as numbers, with a separator after each text."""
    words: pa.Array          # large_binary, all words
    first: np.ndarray        # first word of each text, and the number of words
    symbols: np.ndarray
    places: np.ndarray       # place of each word among the symbols


def _piece(texts: list[bytes]) -> _Piece:
    found = textkit.Words(texts)
    sizes = found.ends - found.starts
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    letters = found.bytes[~textkit.SPACES[found.bytes]]
    words = pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    counts = np.diff(found.first)
    owner = np.repeat(np.arange(len(texts)), counts)
    places = np.arange(len(numbers)) + owner
    top = int(numbers.max()) + 1 if len(numbers) else 0
    symbols = np.empty(len(numbers) + len(texts), dtype=np.int64)
    symbols[places] = numbers
    symbols[found.first[1:] + np.arange(len(texts))] = top + np.arange(len(texts))
    return _Piece(words, found.first, symbols, places)


def text_runs(texts: list[bytes]) -> tuple[np.ndarray, pa.Array, pa.Array]:
    """Of some texts: the numbers of words, the runs (start, length, period) of each, and each text collapsed."""
    piece = _piece(texts)
    start, length, period = find_runs(piece.symbols)
    heads = piece.first[:-1] + np.arange(len(texts))
    owner = np.searchsorted(heads, start, side="right") - 1
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    runs = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(
        [pa.array(start - heads[owner]), pa.array(length), pa.array(period)], fields=list(_RUNS.value_type)))
    # a word goes if a run holds it after its first period
    edges = np.zeros(len(piece.symbols) + 1, dtype=np.int64)
    np.add.at(edges, start + period, 1)
    np.add.at(edges, start + length, -1)
    kept = np.cumsum(edges)[piece.places] == 0
    counts = np.concatenate([[0], np.cumsum(kept)])[piece.first]
    lists = pa.LargeListArray.from_arrays(pa.array(counts.astype(np.int64)), piece.words.filter(pa.array(kept)))
    return np.diff(piece.first), runs, pc.binary_join(lists, pa.scalar(b" ", pa.large_binary()))


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``runs`` (start word, length, period; by start, then period)
    and ``collapsed`` (the text without the words that only repeat a run's first period, joined by one space).

    A word is a stretch without ASCII white space. A run has its smallest period q at least four times and six words
    or more, and cannot be extended. Null and empty texts have no words, no runs and an empty ``collapsed``. Rows that
    repeat an id or a text are judged alone; an empty table gives an empty table; other columns are not looked at.
    No shuffle: texts are looked at in batches of about ``textkit.PIECE`` bytes, a longer text alone (about 4 bytes a
    word for each binary digit of its longest repeat, besides some 100 bytes a word).
    """
    textkit.small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = textkit.utf8(batch.column(1))
            for a, b in textkit.pieces(texts):
                n_words, runs, collapsed = text_runs(texts[a:b])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_words, pa.int64()), runs.cast(_RUNS), collapsed.cast(pa.binary()).cast(pa.string())],
                    ["id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_column].dataType.simpleString()
    out = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text")).mapInArrow(
        run, f"id {kind}, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")
    return out.withColumnRenamed("id", id_column)
