"""Repeated passages by a common-prefix interval tree over an enhanced suffix array, cut into bounded parts.

A window of ``length`` bytes is dealt out by the least hash of its ``gram``-byte strings, so equal windows
meet, and the windows of one such anchor are a short segment of text. Pass one finds anchors that occur in
two texts. Pass two cuts their segments out of the texts. Pass three sorts the suffixes of the distinct
segments that share anchors, scans their common prefixes with a stack, and keeps the intervals whose
members have different bytes on their left (or a segment border): these are the repeats that cannot be
extended, with all their occurrences. Each occurrence learns the smallest document of its interval; pass
four joins the pieces of a text and removes what a smaller document has.

Blocks of many small values travel as one binary value per map task and bucket, which also combines on the
map side: a task sends at most one entry of an anchor that it has seen in two texts, and each distinct
segment once. Exact copies of a text are represented by the copy with the smallest id.
"""

from __future__ import annotations

import hashlib
import math
import struct
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.llm import textkit
from coldspring.llm.ordered import partitions
from coldspring.workspace import Workspace

BLOCK = 1 << 14  # occurrences packed into one value
LONGEST = 47  # windows of a segment, so that a segment of 50-byte windows has at most 96 bytes


@dataclass(frozen=True)
class RepeatConfig:
    length: int = 50                # bytes of a passage that counts as repeated
    gram: int = 16                  # bytes of an anchor
    bucket_bytes: int = 8 << 20    # text per bucket of passes one, two and four
    bucket_windows: int = 100_000   # suffixes sorted together, unless one anchor has more
    flush_bytes: int = 6 << 20      # text a map task looks at before it sends
    hot_texts: int = 1_000_000      # most entries of the list of much copied texts
    hot_segments: int = 50_000      # distinct segments of one anchor that are sorted together, at least
    hot_keys: int = 2_000_000       # most entries of the list of anchors with more


def _pack(*arrays: np.ndarray) -> bytes:
    return struct.pack("<I", len(arrays[0])) + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def _unpack(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    """The arrays of all blobs, end to end."""
    columns: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = struct.unpack_from("<I", blob)[0], 4
        for column, kind in zip(columns, kinds):
            column.append(np.frombuffer(blob, dtype=kind, count=n, offset=at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(c) if c else np.empty(0, dtype=k) for c, k in zip(columns, kinds)]


def _pack_entries(key: np.ndarray, handle: np.ndarray, at: np.ndarray, windows: np.ndarray) -> bytes:
    """Entries in few bytes: 6 of the key (a chance match of the rest only costs a look), each handle once with the number of its
    entries in a row, and integers as planes of bytes, which compress well."""
    edges = np.flatnonzero(np.append(True, handle[1:] != handle[:-1])) if len(handle) else np.empty(0, dtype=np.int64)
    runs = np.diff(np.append(edges, len(handle))).astype(np.uint32)
    planes = [np.ascontiguousarray(v.astype(f"<u{w}").view(np.uint8).reshape(-1, w).T).tobytes() for v, w in ((runs, 4), (at, 4))]
    return b"".join([struct.pack("<II", len(key), len(edges)), np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes(),
                     handle[edges].tobytes(), *planes, windows.tobytes()])


def _unpack_entries(blobs: list[bytes]) -> tuple[np.ndarray, ...]:
    """(key, handle, first window, windows) of all blobs, end to end."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    for blob in blobs:
        n, m = struct.unpack_from("<II", blob)
        data, at = np.frombuffer(blob, dtype=np.uint8), 8
        key = np.zeros((n, 8), dtype=np.uint8)
        key[:, :6] = data[at:at + 6 * n].reshape(n, 6)
        at += 6 * n
        handle = data[at:at + 8 * m].copy().view(np.uint64)
        at += 8 * m
        runs = np.ascontiguousarray(data[at:at + 4 * m].reshape(4, m).T).view(np.uint32).ravel()
        at += 4 * m
        place = np.ascontiguousarray(data[at:at + 4 * n].reshape(4, n).T).view(np.uint32).ravel()
        at += 4 * n
        for column, value in zip(out, (key.view(np.uint64).ravel(), np.repeat(handle, runs), place, data[at:at + n])):
            column.append(value)
    kinds = (np.uint64, np.uint64, np.uint32, np.uint8)
    return tuple(np.concatenate(c) if c else np.empty(0, dtype=k) for c, k in zip(out, kinds))


def _handle(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), dtype=np.uint64).reshape(-1, 2)[:, 0].copy()


def _split(buckets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, rows in their old order) for each bucket."""
    order = np.argsort(buckets, kind="stable")
    edges = np.flatnonzero(np.diff(buckets[order])) + 1
    for part in np.split(order, edges):
        if len(part):
            yield int(buckets[part[0]]), part


def _distinct_texts(batches: Iterator[pa.RecordBatch], hot: dict[bytes, int], flush: int) -> Iterator[tuple[list, list, list]]:
    """(ids, digests, texts) of bounded size, each text once with its smallest id. Of a much copied text only the
    copy with the smallest id is looked at."""
    ids, digests, texts, place, held = [], [], [], {}, 0
    parts = (batch.slice(at, 256) for batch in batches for at in range(0, batch.num_rows, 256))
    for part in parts:
        for number, text in zip(part.column("_id").to_pylist(), textkit.utf8(part.column("_text"))):
            if number is None or not text:
                continue
            digest = hashlib.md5(text).digest()
            if hot.get(digest, number) != number:
                continue
            if digest in place:
                ids[place[digest]] = min(ids[place[digest]], number)
                continue
            place[digest] = len(ids)
            ids.append(number)
            digests.append(digest)
            texts.append(text)
            held += len(text)
            if held >= flush:
                yield ids, digests, texts
                ids, digests, texts, place, held = [], [], [], {}, 0
    if ids:
        yield ids, digests, texts


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(hash, text, first window, windows) of every run of windows with the same least hash. Runs are cut at LONGEST."""
    out = []
    span = length - gram + 1
    # A very long text is looked at in slices that share length - 1 bytes.
    slices = [(i, at, t[at:at + textkit.PIECE + length - 1]) for i, t in enumerate(texts) for at in range(0, max(len(t) - length + 1, 1), textkit.PIECE)]
    bodies = [s[2] for s in slices]
    owner, shift = (np.array([s[k] for s in slices], dtype=np.int64) for k in (0, 1))
    for a, b in textkit.pieces(bodies):
        data = np.frombuffer(b"".join(bodies[a:b]), dtype=np.uint8)
        if len(data) < length:
            continue
        least, width = textkit.rolling(data, gram), 1
        while width * 2 <= span:
            least, width = np.minimum(least[:-width], least[width:]), width * 2
        n = len(data) - length + 1
        least = np.minimum(least[:n], least[span - width:span - width + n])
        sizes = np.fromiter((len(t) for t in bodies[a:b]), dtype=np.int64, count=b - a)
        text = np.repeat(np.arange(b - a, dtype=np.int32), sizes)
        inside = text[:n] == text[length - 1:]
        new = np.ones(n, dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (text[1:n] != text[:n - 1]) | (inside[1:] != inside[:-1])
        edges = np.append(np.flatnonzero(new), n)
        starts, runs = edges[:-1], np.diff(edges)
        keep = inside[starts]
        starts, runs = starts[keep], runs[keep]
        cuts = -(-runs // LONGEST)
        if cuts.size and cuts.max() > 1:
            nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
            starts = np.repeat(starts, cuts) + nth * LONGEST
            runs = np.minimum(LONGEST, np.repeat(runs, cuts) - nth * LONGEST)
        first = np.cumsum(sizes) - sizes
        piece = text[starts]
        out.append((least[starts], owner[a + piece].astype(np.int32), (starts - first[piece] + shift[a + piece]).astype(np.uint32), runs.astype(np.uint8)))
    if not out:
        return tuple(np.empty(0, dtype=k) for k in (np.uint64, np.int32, np.uint32, np.uint8))
    return tuple(np.concatenate(c) for c in zip(*out))


def _repeated(key: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """For each entry, whether its key has entries of two owners."""
    order = np.argsort(key, kind="stable")
    k, o = key[order], owner[order]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.empty(0, dtype=np.int64)
    if not len(starts):
        return np.zeros(0, dtype=bool)
    several = np.minimum.reduceat(o, starts) != np.maximum.reduceat(o, starts)
    out = np.empty(len(k), dtype=bool)
    out[order] = np.repeat(several, np.diff(np.append(starts, len(k))))
    return out


def _send_anchors(config: RepeatConfig, buckets: int, hot: dict[bytes, int]):
    """Kind 0: entries by key; one without windows says that its key was seen in two texts. Kind 1: entries that are known to
    repeat, by text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, digests, texts in _distinct_texts(batches, hot, config.flush_bytes):
            key, text, at, windows = anchors(texts, config.length, config.gram)
            key = key & np.uint64((1 << 48) - 1)
            handle = _handle(digests)[text]
            known = _repeated(key, handle)
            flags = np.unique(key[known])
            rows = []
            free = np.flatnonzero(~known)
            keys = np.concatenate([key[free], flags])
            entries = (keys, np.concatenate([handle[free], np.zeros(len(flags), np.uint64)]),
                       np.concatenate([at[free], np.zeros(len(flags), np.uint32)]), np.concatenate([windows[free], np.zeros(len(flags), np.uint8)]))
            rows += [(b, 0, _pack_entries(*(e[p] for e in entries))) for b, p in _split((textkit.mixed(keys) % np.uint64(buckets)).astype(np.int64))]
            rows += _by_text(key[known], handle[known], at[known], windows[known], buckets)
            yield _rows(rows)
    return run


def _by_text(key, handle, at, windows, buckets: int) -> list[tuple]:
    return [(b, 1, _pack_entries(key[p], handle[p], at[p], windows[p])) for b, p in _split((handle % np.uint64(buckets)).astype(np.int64))]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                       pa.array([r[2] for r in rows], pa.binary())], names=["_bucket", "_kind", "_blob"])


def _match_anchors(buckets: int):
    def run(table: pa.Table) -> pa.Table:
        kinds, blobs, owners = (table.column(c).to_pylist() for c in ("_kind", "_blob", "_bucket"))
        key, handle, at, windows = _unpack_entries([b for b, k in zip(blobs, kinds) if k == 0])
        twice = _repeated(key, handle)
        flagged = key[windows == 0]
        keep = (twice | np.isin(key, flagged)) & (windows > 0)
        rows = _by_text(key[keep], handle[keep], at[keep], windows[keep], buckets)
        rows += [(o, 1, b) for b, k, o in zip(blobs, kinds, owners) if k == 1]
        return pa.Table.from_batches([_rows(rows)])
    return run


def _send_texts(config: RepeatConfig, buckets: int, hot: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for ids, digests, texts in _distinct_texts(batches, hot, config.flush_bytes):
            ids = np.array(ids, dtype=np.int64)
            rows = []
            for bucket, part in _split((_handle(digests) % np.uint64(buckets)).astype(np.int64)):
                own = [texts[i] for i in part]
                head = _pack(ids[part], np.array([len(t) for t in own], dtype=np.int64)) + b"".join(digests[i] for i in part)
                rows.append((bucket, 0, squeeze.compress(head + b"".join(own))))
            yield _rows(rows)
    return run


def _texts(blobs: list[bytes]) -> tuple[np.ndarray, list[bytes], list[bytes]]:
    """(ids, digests, texts) of a bucket, each text once, in the order of the digests."""
    found: dict[bytes, tuple[int, bytes]] = {}
    for blob in blobs:
        data = zstandard.ZstdDecompressor().decompress(blob)
        ids, sizes = _unpack([data], np.int64, np.int64)
        at = 4 + 16 * len(ids)
        text_at = at + 16 * len(ids)
        for i, size in zip(ids.tolist(), sizes.tolist()):
            digest = data[at:at + 16]
            if digest not in found or i < found[digest][0]:
                found[digest] = (i, data[text_at:text_at + size])
            at, text_at = at + 16, text_at + size
    order = sorted(found)
    return np.array([found[d][0] for d in order], dtype=np.int64), order, [found[d][1] for d in order]


def _pack_segments(bucket: int, key: np.ndarray, place: np.ndarray, low: np.ndarray, high: np.ndarray, segments: list[bytes]) -> bytes:
    sizes = np.array([len(x) for x in segments], dtype=np.uint8)
    planes = [np.ascontiguousarray(v.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes() for v in (key.view(np.int64), low, high - low)]
    head = struct.pack("<Iq", len(segments), bucket) + b"".join([*planes, place.astype(np.uint32).tobytes(), sizes.tobytes()])
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(segments))


def _unpack_segments(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """(bucket, key, place, low, high) and the segments of all blobs, end to end."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    segments: list[bytes] = []
    for blob in blobs:
        data = zstandard.ZstdDecompressor().decompress(blob)
        n, bucket = struct.unpack_from("<Iq", data)
        raw, at = np.frombuffer(data, dtype=np.uint8), 12
        values = []
        for _ in range(3):
            values.append(np.ascontiguousarray(raw[at:at + 8 * n].reshape(8, n).T).view(np.int64).ravel())
            at += 8 * n
        place = raw[at:at + 4 * n].copy().view(np.uint32)
        at += 4 * n
        edges = np.cumsum(raw[at:at + n], dtype=np.int64) + at + n
        segments += [data[a:b] for a, b in zip([at + n, *edges[:-1].tolist()], edges.tolist())]
        for column, value in zip(out, (np.full(n, bucket), values[0], place.astype(np.int64), values[1], values[1] + values[2])):
            column.append(value)
    return (*(np.concatenate(c) if c else np.empty(0, dtype=np.int64) for c in out), segments)


def _cut_segments(config: RepeatConfig, buckets: int):
    """Kind 0: the occurrences in a bucket of texts. Kind 1: its distinct segments with their smallest and largest id, by anchor."""
    def run(texts: pa.Table, entries: pa.Table) -> pa.Table:
        if not texts.num_rows or not entries.num_rows:
            return pa.Table.from_batches([_rows([])])
        bucket = texts.column("_bucket")[0].as_py()
        ids, digests, bodies = _texts(texts.column("_blob").to_pylist())
        key, handle, at, windows = _unpack_entries(entries.column("_blob").to_pylist())
        handles = _handle(digests)
        by_handle = np.argsort(handles, kind="stable")
        text = by_handle[np.minimum(np.searchsorted(handles[by_handle], handle), len(handles) - 1)]
        sizes = np.array([len(b) for b in bodies], dtype=np.int64)
        span = windows.astype(np.int64) + config.length - 1
        fits = (handles[text] == handle) & (at + span <= sizes[text])
        key, text, at, span = key[fits], text[fits], at[fits].astype(np.int64), span[fits]
        if not len(key):
            return pa.Table.from_batches([_rows([])])
        joined = b"".join(bodies)
        start = (np.cumsum(sizes) - sizes)[text] + at
        # Equal segments of equal anchors, by a 64-bit hash of the segment.
        marks = _segment_hashes(np.frombuffer(joined, dtype=np.uint8), start, span)
        order = np.lexsort((span, marks, key))
        k, m, s = key[order], marks[order], span[order]
        new = np.ones(len(k), dtype=bool)
        new[1:] = (k[1:] != k[:-1]) | (m[1:] != m[:-1]) | (s[1:] != s[:-1])
        place = np.empty(len(k), dtype=np.int64)
        place[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        low = np.minimum.reduceat(ids[text[order]], heads)
        high = np.maximum.reduceat(ids[text[order]], heads)
        first = order[heads]
        key, begin, end = key[first], start[first], start[first] + span[first]
        columns = (text.astype(np.uint32), at.astype(np.uint32), place.astype(np.uint32))
        rows = [(bucket, 0, _pack(*(c[i:i + BLOCK] for c in columns))) for i in range(0, len(text), BLOCK)]
        for target, part in _split((textkit.mixed(key) % np.uint64(buckets)).astype(np.int64)):
            segments = [joined[a:b] for a, b in zip(begin[part].tolist(), end[part].tolist())]
            rows.append((target, 1, _pack_segments(bucket, key[part], part, low[part], high[part], segments)))
        return pa.Table.from_batches([_rows(rows)])
    return run


def _key_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 64):
            key = _unpack_segments(batch.slice(at, 64).column("_blob").to_pylist())[1]
            value, count = np.unique(key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(count, pa.int64())], names=["_key", "_n"])


def _crowded_rows(hot: np.ndarray):
    """The segments of crowded anchors as rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                bucket, key, place, low, high, segments = _unpack_segments(batch.slice(at, 64).column("_blob").to_pylist())
                pick = np.flatnonzero(np.isin(key, hot))
                yield pa.RecordBatch.from_arrays([pa.array(v[pick]) for v in (bucket, key, place, low, high)] + [pa.array([segments[i] for i in pick], pa.binary())],
                                                 names=["_bucket", "_key", "_place", "_low", "_high", "_blob"])
    return run


def _segment_hashes(data: np.ndarray, start: np.ndarray, span: np.ndarray) -> np.ndarray:
    """A 64-bit hash of data[start:start + span], computed slice by slice."""
    out = np.empty(len(start), dtype=np.uint64)
    order = np.argsort(start, kind="stable")
    step = textkit.PIECE
    at = 0
    while at < len(order):
        base = int(start[order[at]])
        to = int(np.searchsorted(start[order], base + step))
        part = order[at:to]
        piece = data[base:int((start[part] + span[part]).max())]
        up, down = textkit._power_tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, dtype=np.uint64)
        np.cumsum(textkit._BYTES[piece] * up[:len(piece)], out=sums[1:])
        a = start[part] - base
        out[part] = textkit.mixed((sums[a + span[part]] - sums[a]) * down[a])
        at = to
    return out


def suffix_array(segments: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(segment, offset, rest, prefix) of all suffixes with ``length`` bytes or more, sorted. ``rest`` is the length of a
    suffix, ``prefix`` what it shares with the one before it."""
    sizes = np.array([len(s) for s in segments], dtype=np.int64)
    words = -(-(LONGEST + length - 1) // 8)
    wide = 8 * words + LONGEST + 8   # zeros after each segment, so that no suffix runs into the next
    grid = np.zeros((len(segments), wide), dtype=np.uint8)
    flat = np.frombuffer(b"".join(segments), dtype=np.uint8)
    row = np.repeat(np.arange(len(segments)), sizes)
    grid[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    line = grid.ravel()
    eight = np.zeros(len(line), dtype=np.uint64)   # the eight bytes from each place on, as a number that sorts like them
    for b in range(8):
        eight[:len(line) - b] |= line[b:].astype(np.uint64) << np.uint64(56 - 8 * b)
    counts = sizes - length + 1
    segment = np.repeat(np.arange(len(segments)), counts)
    offset = np.arange(len(segment)) - np.repeat(np.cumsum(counts) - counts, counts)
    rest = sizes[segment] - offset
    base = segment * wide + offset
    order = np.lexsort((rest, *[eight[base + 8 * w] for w in range(words - 1, -1, -1)]))
    base, segment, offset, rest = base[order], segment[order], offset[order], rest[order]
    prefix = np.zeros(len(order), dtype=np.int64)
    same = np.arange(1, len(order))
    for w in range(words):
        differ = eight[base[same] + 8 * w] ^ eight[base[same - 1] + 8 * w]
        prefix[same] += 8
        unequal = differ != 0
        at, differ = same[unequal], differ[unequal]
        for b in range(8):   # bytes of this word from the first difference on
            prefix[at] -= differ >= np.uint64(1 << 8 * b)
        same = same[~unequal]
    prefix[1:] = np.minimum(prefix[1:], np.minimum(rest[1:], rest[:-1]))
    return segment, offset, rest, prefix


BORDER, MANY = -1, -2  # what is left of a suffix, besides a byte: the start of its segment, or different bytes


def repeat_intervals(segments: list[bytes], low: np.ndarray, high: np.ndarray, length: int) -> np.ndarray:
    """Rows of (segment, start, end, smallest id) for the occurrences of all maximal repeats that have a smaller id on one of their
    occurrences. ``low`` and ``high``: the smallest and largest id of the texts that hold a segment.

    The stack holds the open intervals of the common-prefix tree: depth, first member, smallest and largest id, left byte,
    and the parts that were closed below, each with its smallest id. An interval of which all members have the same byte on
    their left is part of a longer repeat that starts there, and is passed over. A member is told of an interval only if
    it brings a smaller id than the deeper one it was told of.
    """
    segment, offset, rest, prefix = suffix_array(segments, length)
    out = array("q")   # four numbers for each told member
    if not len(segment):
        return np.empty((0, 4), dtype=np.int64)
    run = np.cumsum(prefix < length)
    heads = np.flatnonzero(np.append(True, run[1:] != run[:-1]))
    sizes = np.diff(np.append(heads, len(run)))
    lows, highs = low[segment], high[segment]
    flat = np.frombuffer(b"".join(segments), dtype=np.uint8)
    firsts = np.cumsum([0] + [len(s) for s in segments[:-1]])
    left = np.where(offset == 0, BORDER, flat[np.maximum(firsts[segment] + offset - 1, 0)].astype(np.int64))
    shared = np.minimum.reduceat(lows, heads) != np.maximum.reduceat(highs, heads)
    diverse = (np.minimum.reduceat(left, heads) == BORDER) | (np.minimum.reduceat(left, heads) != np.maximum.reduceat(left, heads))
    for head, size in zip(heads[shared & diverse].tolist(), sizes[shared & diverse].tolist()):
        part = slice(head, head + size)
        _scan(segment[part].tolist(), offset[part].tolist(), rest[part].tolist(), prefix[part].tolist(), left[part].tolist(),
              lows[part].tolist(), highs[part].tolist(), length, out)
    return np.array(out, dtype=np.int64).reshape(-1, 4)


def _scan(segment, offset, rest, prefix, left, low, high, length, out) -> None:
    def close(depth, least, most, side, parts):
        """Tells the members of an interval that is complete, and returns what its parent has to know."""
        if (side in (BORDER, MANY)) and least < most:
            for a, b, told in parts:
                if told is None or told > least:
                    for i in range(a, b):
                        if high[i] > least:
                            out.extend((segment[i], offset[i], offset[i] + depth, least))
            return [(parts[0][0], parts[-1][1], least)]
        return parts

    def meet(x, y):
        return BORDER if BORDER in (x, y) else x if x == y else MANY

    stack: list[list] = []   # depth, least, most, side, parts
    n = len(segment)
    for i in range(n):
        shared = prefix[i] if i else 0
        done = None
        while stack and stack[-1][0] > shared:
            depth, least, most, side, parts = stack.pop()
            if done:
                least, most, side = min(least, done[0]), max(most, done[1]), meet(side, done[2])
                parts += done[3]
            done = [least, most, side, close(depth, least, most, side, parts)]
        if done:
            if stack and stack[-1][0] == shared:
                top = stack[-1]
                top[1], top[2], top[3] = min(top[1], done[0]), max(top[2], done[1]), meet(top[3], done[2])
                top[4] += done[3]
            elif shared >= length:
                stack.append([shared, *done])
        # a suffix is an interval of its own, as its segment may stand in several texts
        stack.append([rest[i], low[i], high[i], left[i], [(i, i + 1, None)]])
        if len(stack) > 1 and stack[-2][0] == rest[i] and shared == rest[i]:
            leaf, top = stack.pop(), stack[-1]
            top[1], top[2], top[3] = min(top[1], leaf[1]), max(top[2], leaf[2]), meet(top[3], leaf[3])
            top[4] += leaf[4]
    done = None
    while stack:
        depth, least, most, side, parts = stack.pop()
        if done:
            least, most, side = min(least, done[0]), max(most, done[1]), meet(side, done[2])
            parts += done[3]
        done = [least, most, side, close(depth, least, most, side, parts)]


_TOLD = (np.uint32, np.uint8, np.uint8, np.int64)   # place, start, end, smallest id


def _tell(bucket: np.ndarray, place: np.ndarray, start: np.ndarray, end: np.ndarray, least: np.ndarray) -> pa.Table:
    """What was found, by the bucket that holds the occurrences."""
    values = (place.astype(np.uint32), start.astype(np.uint8), end.astype(np.uint8), least.astype(np.int64))
    return pa.Table.from_batches([_rows([(b, 1, _pack(*(v[p] for v in values))) for b, p in _split(bucket)])])


def _sort_suffixes(config: RepeatConfig, hot: np.ndarray):
    def run(table: pa.Table) -> pa.Table:
        bucket, key, place, low, high, segments = _unpack_segments(table.column("_blob").to_pylist())
        # The same segment can come from several buckets: one stands for all of them.
        spans = np.array([len(x) for x in segments], dtype=np.int64)
        marks = _segment_hashes(np.frombuffer(b"".join(segments), dtype=np.uint8), np.cumsum(spans) - spans, spans)
        order = np.lexsort((spans, marks, key))
        new = np.ones(len(order), dtype=bool)
        for column in (key, marks, spans):
            new[1:] &= column[order][1:] == column[order][:-1]
        new[1:] = ~new[1:]
        owner = np.empty(len(order), dtype=np.int64)
        owner[order] = np.cumsum(new) - 1
        heads = np.flatnonzero(new)
        n = len(heads)
        least = np.minimum.reduceat(low[order], heads) if n else low
        most = np.maximum.reduceat(high[order], heads) if n else high
        distinct, keys = [segments[i] for i in order[heads]], key[order[heads]]
        del segments
        by_owner = np.argsort(owner, kind="stable")
        edges = np.searchsorted(owner[by_owner], np.arange(n + 1))
        order = np.argsort(keys, kind="stable")
        order = order[~np.isin(keys[order], hot)]
        found = []
        at = 0
        # Whole anchors at a time, about bucket_windows suffixes together.
        sizes = np.cumsum(np.array([len(distinct[i]) - config.length + 1 for i in order], dtype=np.int64))
        while at < len(order):
            to = max(int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + config.bucket_windows, side="right")), at + 1)
            while to < len(order) and keys[order[to]] == keys[order[to - 1]]:
                to += 1
            part = order[at:to]
            told = repeat_intervals([distinct[i] for i in part], least[part], most[part], config.length)
            if len(told):
                segment, start, end, small = told.T
                segment = part[segment]
                count = edges[segment + 1] - edges[segment]
                item = np.repeat(np.arange(len(segment)), count)
                row = by_owner[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(edges[segment], count)]
                use = high[row] > small[item]
                row, item = row[use], item[use]
                found.append((bucket[row], place[row], start[item], end[item], small[item]))
            at = to
        return _tell(*(np.concatenate(c) for c in zip(*found))) if found else pa.Table.from_batches([_rows([])])
    return run


def _tell_windows(table: pa.Table) -> pa.Table:
    return _tell(*(table.column(c).to_numpy() for c in ("_bucket", "_place", "_start", "_end", "_least")))


def _remove(config: RepeatConfig, whole: bool):
    """The digest of each text of a bucket, and with ``whole`` what is left of it."""
    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return pa.table({n: pa.array([], t) for n, t in _result_types(whole)})
        ids, digests, bodies = _texts(texts.column("_blob").to_pylist())
        kinds, blobs = (told.column(c).to_pylist() for c in ("_kind", "_blob"))
        text, at, place = _unpack([b for b, k in zip(blobs, kinds) if k == 0], np.uint32, np.uint32, np.uint32)
        told_place, start, end, least = _unpack([b for b, k in zip(blobs, kinds) if k == 1], *_TOLD)
        order = np.argsort(told_place, kind="stable")
        told_place, start, end, least = told_place[order], start[order], end[order], least[order]
        a, b = np.searchsorted(told_place, place), np.searchsorted(told_place, place, side="right")
        count = b - a
        row = np.repeat(np.arange(len(place)), count)
        item = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(a, count)
        smaller = least[item] < ids[text[row]]
        row, item = row[smaller], item[smaller]
        owner, begin = text[row], at[row].astype(np.int64) + start[item]
        stop = at[row].astype(np.int64) + end[item]
        order = np.lexsort((begin, owner))
        owner, begin, stop = owner[order], begin[order], stop[order]
        edges = np.searchsorted(owner, np.arange(len(bodies) + 1))
        out = []
        for i, body in enumerate(bodies):
            spans = merged(begin[edges[i]:edges[i + 1]], stop[edges[i]:edges[i + 1]])
            kept = body if not len(spans) else b"".join(body[p:q] for p, q in zip([0, *spans[:, 1]], [*spans[:, 0], len(body)]))
            row = (digests[i].hex(), len(body), int((spans[:, 1] - spans[:, 0]).sum()) if len(spans) else 0, len(spans), hashlib.sha256(kept).hexdigest())
            out.append((*row, kept.decode("utf-8", "ignore"), spans.ravel().tolist() if len(spans) else []) if whole else row)
        columns = list(zip(*out))
        return pa.table({n: pa.array(c, t) for (n, t), c in zip(_result_types(whole), columns)})
    return run


def merged(begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Spans sorted by their begin as maximal runs, rows of (begin, stop). Spans that touch are one run."""
    if not len(begin):
        return np.empty((0, 2), dtype=np.int64)
    reach = np.maximum.accumulate(stop)
    new = np.append(True, begin[1:] > reach[:-1])
    heads = np.flatnonzero(new)
    return np.stack([begin[heads], reach[np.append(heads[1:] - 1, len(begin) - 1)]], axis=1)


def _result_types(whole: bool):
    types = [("_md5", pa.string()), ("_bytes", pa.int64()), ("_removed", pa.int64()), ("_spans", pa.int64()), ("_sha", pa.string())]
    return types + ([("_kept_text", pa.string()), ("_edges", pa.list_(pa.int64()))] if whole else [])


def _hot_windows(hot: DataFrame, config: RepeatConfig) -> DataFrame:
    """The windows of anchors with very many distinct segments, matched one by one with partial aggregation: a window is a
    repeat of its own, so no group has to meet."""
    length = config.length
    each = hot.withColumn("_start", F.explode(F.expr(f"sequence(0, length(_blob) - {length})")))
    window = each.withColumn("_window", F.expr(f"substring(_blob, _start + 1, {length})"))
    least = window.groupBy("_key", "_window").agg(F.min("_low").alias("_least"), F.max("_high").alias("_most")).filter("_least < _most")
    return (window.join(least, ["_key", "_window"]).filter("_high > _least")
            .select("_bucket", "_place", "_start", (F.col("_start") + length).alias("_end"), "_least"))


def remove_repeats(docs: DataFrame, workspace: Workspace, config: RepeatConfig = RepeatConfig(), id_col: str = "doc_id",
                   text_col: str = "text", whole: bool = False) -> DataFrame:
    """One row (id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``; with ``whole`` also kept_text, spans (the
    removed (begin, end) byte ranges as one flat array), and row, a struct of the other columns of ``docs``.

    A byte is removed if a string of ``length`` bytes over it also starts in a document with a smaller id. Texts are UTF-8
    bytes, a null text is empty, strings do not cross documents and are judged on the input. kept_text leaves out bytes of
    characters that were cut in half. Rows with equal ids do not remove each other's bytes. Rows with a null id stay whole
    and remove nothing. Only the id and text columns are read; an empty table gives an empty table.
    """
    textkit.small_batches(docs.sparkSession)
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in (id_col, text_col)], F.lit(None).cast("int").alias("_"))
    source = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"), others.alias("_row"))
    size = F.octet_length("_text").cast("long")
    short = F.col("_id").isNull() | (size < config.length)
    content = F.encode("_text", "UTF-8")
    facts = source.select("_id", F.md5(content).alias("_md5"), size.alias("_size"), F.when(short, F.sha2(content, 256)).alias("_own_sha"),
                          *([F.when(short, F.col("_text")).alias("_own_text"), "_row"] if whole else []))
    facts = workspace.stage(facts, "repeat-facts")
    copies = facts.groupBy("_md5").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
    rows, total = facts.agg(F.count(F.lit(1)), F.sum("_size")).first()
    # At most hot_texts entries, as each stands for more than rows / hot_texts rows.
    often = max(64, math.ceil(rows / config.hot_texts))
    hot = {bytes.fromhex(r["_md5"]): r["_first"] for r in copies.filter((F.col("_copies") > often) & F.col("_first").isNotNull()).select("_md5", "_first").toLocalIterator()}
    buckets = max(partitions(docs), math.ceil((total or 0) / config.bucket_bytes))

    packed = "_bucket long, _kind int, _blob binary"
    entries = (source.select("_id", "_text").mapInArrow(_send_anchors(config, buckets, hot), packed)
               .groupBy("_bucket").applyInArrow(_match_anchors(buckets), packed))
    texts = source.select("_id", "_text").mapInArrow(_send_texts(config, buckets, hot), packed)
    cut = texts.groupBy("_bucket").cogroup(entries.groupBy("_bucket")).applyInArrow(_cut_segments(config, buckets), packed)
    cut = workspace.stage(cut, "repeat-segments")
    segments = cut.filter("_kind = 1")
    counts = segments.select("_blob").mapInArrow(_key_counts, "_key long, _n long").groupBy("_key").agg(F.sum("_n").alias("_n"))
    counts = workspace.stage(counts.filter(F.col("_n") > min(config.hot_segments, 1000)), "repeat-anchors")
    # At most hot_keys entries, as each stands for more than all / hot_keys segments.
    total = segments.select(F.sum(F.octet_length("_blob"))).first()[0] or 0
    crowd = max(config.hot_segments, math.ceil(total / config.hot_keys))
    hot = np.sort(np.array([r["_key"] for r in counts.filter(F.col("_n") > crowd).select("_key").toLocalIterator()], dtype=np.int64))
    told = segments.groupBy("_bucket").applyInArrow(_sort_suffixes(config, hot), packed)
    if len(hot):
        rows = segments.select("_blob").mapInArrow(_crowded_rows(hot), "_bucket long, _key long, _place long, _low long, _high long, _blob binary")
        windows = _hot_windows(rows, config).withColumn("_part", F.pmod(F.xxhash64("_place"), F.lit(16)))
        told = told.unionByName(windows.groupBy("_bucket", "_part").applyInArrow(_tell_windows, packed))
    told = told.unionByName(cut.filter("_kind = 0").select("_bucket", "_kind", "_blob"))
    schema = "_md5 string, _bytes long, _removed long, _spans long, _sha string" + (", _kept_text string, _edges array<long>" if whole else "")
    results = texts.groupBy("_bucket").cogroup(told.groupBy("_bucket")).applyInArrow(_remove(config, whole), schema)

    # A copy of a text with a smaller id loses all its bytes.
    firsts = copies.select("_md5", "_first")
    found = results.join(firsts, "_md5")
    out = facts.join(found, "_md5", "left")
    plain = untouched(config)
    copy = ~plain & (F.col("_id") > F.col("_first"))
    picked = {
        "n_bytes": F.col("_size"),
        "n_removed": F.when(copy, F.col("_size")).when(plain, F.lit(0)).otherwise(F.col("_removed")),
        "n_spans": F.when(copy, F.lit(1)).when(plain, F.lit(0)).otherwise(F.col("_spans")),
        "kept_sha256": F.when(copy, F.sha2(F.lit(b""), 256)).when(plain, F.col("_own_sha")).otherwise(F.col("_sha")),
    }
    if whole:
        picked["kept_text"] = F.when(copy, F.lit("")).otherwise(F.coalesce("_own_text", "_kept_text"))
        picked["spans"] = F.when(copy, F.array(F.lit(0).cast("long"), F.col("_size"))).when(plain, F.array().cast("array<long>")).otherwise(F.col("_edges"))
        picked["row"] = F.col("_row")
    return out.select(F.col("_id").alias(id_col), *[c.cast("long").alias(n) if n.startswith("n_") else c.alias(n) for n, c in picked.items()])


def untouched(config: RepeatConfig):
    """Rows that are never touched: without an id, or shorter than a passage."""
    return F.col("_id").isNull() | (F.col("_size") < config.length)
