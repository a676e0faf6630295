"""NumPy helpers over the bytes of a batch of texts. They run inside tasks, on bounded pieces."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

# Large buffers go back to the system when they are freed, not to a pool of this process: several workers share one executor.
pa.set_memory_pool(pa.system_memory_pool())

PIECE = 1 << 19  # bytes of text looked at together; one longer text is a piece of its own
BASE = np.uint64(0x5851F42D4C957F2D)
SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_BYTES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Texts are long rows: at most 512 of them (Spark's default is 10,000) go to a Python worker at once. The setting
    is the session's, as Spark reads it when a plan runs; it changes no result."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def utf8(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """The texts of an Arrow column as bytes, nulls as empty."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes], limit: int = PIECE) -> Iterator[tuple[int, int]]:
    """Index ranges of consecutive texts with at most ``limit`` bytes together."""
    start, held = 0, 0
    for at, value in enumerate(texts):
        if held and held + len(value) > limit:
            yield start, at
            start, held = at, 0
        held += len(value) + 1
    if start < len(texts):
        yield start, len(texts)


def mixed(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n, BASE, dtype=np.uint64), np.full(n, pow(int(BASE), -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << 20
    while size < n:
        size *= 2
    return _powers(size)


class Words:
    """The words of some texts: maximal runs of bytes other than ASCII white space."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        joined = b"\n".join(texts) + b"\n"
        self.bytes = np.frombuffer(joined, dtype=np.uint8)
        if lower:
            self.bytes = LOWER[self.bytes]
        space = SPACES[self.bytes]
        change = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            change = np.concatenate([[0], change])
        self.starts, self.ends = change[0::2], change[1::2]
        sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_starts = np.concatenate([[0], np.cumsum(sizes)])
        # first word of each text, and one past the last of all
        self.first = np.searchsorted(self.starts, self.text_starts)

    def hashes(self) -> np.ndarray:
        up, down = _power_tables(len(self.bytes) + 1)
        sums = np.empty(len(self.bytes) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(_BYTES[self.bytes] * up[:len(self.bytes)], out=sums[1:])
        lengths = (self.ends - self.starts).astype(np.uint64)
        return mixed((sums[self.ends] - sums[self.starts]) * down[self.starts] + lengths)


def shingle_sets(texts: list[bytes], width: int) -> list[np.ndarray]:
    """Per text, the sorted distinct hashes of its lower-cased ``width``-word runs; a shorter text is one run."""
    words = Words(texts, lower=True)
    h = words.hashes()
    n = len(h)
    rolled = np.zeros(max(0, n - width + 1), dtype=np.uint64)
    for k in range(width):
        rolled = mixed(rolled * np.uint64(0x9E3779B97F4A7C15) + h[k:n - width + 1 + k]) if len(rolled) else rolled
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            out.append(np.unique(rolled[a:b - width + 1]))
        elif b > a:
            seed = np.uint64(b - a)
            for value in h[a:b]:
                seed = mixed(np.array([seed * np.uint64(0x9E3779B97F4A7C15) + value], dtype=np.uint64))[0]
            out.append(np.array([seed], dtype=np.uint64))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """Hash of every ``width``-byte window, by doubling."""
    done, done_width = None, 0
    block, block_width, left = _BYTES[data], 1, width
    while left:
        factor = np.uint64(pow(int(BASE), block_width, 1 << 64))
        if left & 1:
            if done is None:
                done, done_width = block, block_width
            else:
                m = len(block) - done_width
                done = done[:max(m, 0)] * factor + block[done_width:]
                done_width += block_width
        left >>= 1
        if left:
            m = len(block) - block_width
            block = block[:max(m, 0)] * factor + block[block_width:]
            block_width *= 2
    return mixed(done)
