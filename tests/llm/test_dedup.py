import hashlib
import random

import numpy as np
import pytest

from coldspring.llm import near_dedup, suffix_dedup, textkit
from coldspring.llm.components import components
from coldspring.workspace import Workspace

SCHEMA = "doc_id long, text string, _id string, _text int, source string"


def table(spark, rows):
    """Documents with extra columns whose names clash with those used inside."""
    return spark.createDataFrame([(i, t, f"x{i}", 7, "s") for i, t in rows], SCHEMA)


def words(draw, n, vocabulary=400):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def family(draw, size, length, edits):
    base = words(draw, length, 5000)
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(draw.randrange(edits + 1)):
            copy[draw.randrange(length)] = f"e{draw.randrange(10 ** 6)}"
        out.append(" ".join(copy))
    return out


def brute_groups(rows, width, percent):
    def shingles(text):
        tokens = "".join(c.lower() if "A" <= c <= "Z" else c for c in (text or "")).split()
        if not tokens:
            return frozenset()
        if len(tokens) < width:
            return frozenset([tuple(tokens)])
        return frozenset(tuple(tokens[i:i + width]) for i in range(len(tokens) - width + 1))
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            same_id = rows[a][0] is not None and rows[a][0] == rows[b][0] and sets[a] and sets[b]
            if (both and 100 * both >= percent * len(sets[a] | sets[b])) or same_id:
                parent[top(a)] = top(b)
    least = {}
    for i, (number, _) in enumerate(rows):
        if number is not None:
            least[top(i)] = min(least.get(top(i), number), number)
    return [(number, len(sets[i]), least.get(top(i))) for i, (number, _) in enumerate(rows)]


@pytest.mark.parametrize("block", [2048, 3])
def test_near_groups_equal_brute_force(spark, workspace, block):
    draw = random.Random(block)
    texts = family(draw, 14, 60, 4) + family(draw, 10, 30, 6) + family(draw, 6, 200, 3) + [" ".join(words(draw, 40)) for _ in range(20)]
    texts += [texts[0], texts[0].upper(), texts[3], None, "", " \n\t ", "one", "ONE", "one two", "one two", "wörter ß ä ö", "a\x0bb c d e f"]
    texts.append(" ".join(words(draw, 3000)))
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    rows += [rows[0], rows[5], (None, texts[0]), (None, None), (2, texts[-1] + " tail")]
    config = near_dedup.NearConfig(width=4, block=block)
    found = near_dedup.near_groups(table(spark, rows), workspace, config).collect()
    expected = [r for r in brute_groups(rows, 4, 80) if r[0] is not None]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found if r.doc_id is not None) == sorted(expected)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)
    nulls = sorted(((r.n_shingles > 0, r.component_id, r.kept) for r in found if r.doc_id is None), key=str)
    component = next(r.component_id for r in found if r.doc_id == 0)
    assert nulls == [(False, None, True), (True, component, False)]


def test_near_groups_of_an_empty_table(spark, workspace):
    found = near_dedup.near_groups(table(spark, []), workspace)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"] and found.count() == 0


def test_shared_counts_are_intersections():
    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 9000, n, dtype=np.uint64)) for n in (5, 300, 6000, 6500, 1)]
    counts = near_dedup.shared_counts(sets, sets[::-1])
    assert counts.tolist() == [[len(np.intersect1d(a, b)) for b in sets[::-1]] for a in sets]


def test_components(spark, workspace):
    edges = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7), (200, 201), (201, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long"), workspace).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 90, 95: 90, 90: 90, 200: 200, 201: 200}


def brute_repeats(rows, length):
    bodies = [(t or "").encode() for _, t in rows]
    least = {}
    for (number, _), body in zip(rows, bodies):
        if number is not None:
            for p in range(len(body) - length + 1):
                window = body[p:p + length]
                least[window] = min(least.get(window, number), number)
    out = []
    for (number, _), body in zip(rows, bodies):
        gone = bytearray(len(body))
        if number is not None:
            for p in range(len(body) - length + 1):
                if least[body[p:p + length]] < number:
                    gone[p:p + length] = b"\1" * length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(body, gone) if not g)
        out.append((number, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "ignore")))
    return out


def passages(seed):
    draw = random.Random(seed)
    shared = [" ".join(words(draw, 20)) for _ in range(5)]
    texts = []
    for _ in range(40):
        parts = [" ".join(words(draw, draw.randrange(1, 30))) for _ in range(3)]
        parts.insert(draw.randrange(3), draw.choice(shared)[draw.randrange(20):])
        texts.append(draw.choice([" ", "\n", ""]).join(parts))
    texts += [texts[0], texts[0], texts[1] + "x", "ab" * 200, "ab" * 130, "é" * 120, "xé" * 70 + "é" * 60, None, "", "short", "\0" * 70, "\0" * 64 + "z", "\0" * 90]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    return rows + [rows[3], (None, texts[0]), (None, "new " + texts[2]), (11, texts[20])]


SMALL = dict(bucket_bytes=500, flush_bytes=700, bucket_windows=300)


@pytest.mark.parametrize("settings", [{}, SMALL, SMALL | dict(hot_segments=2, hot_keys=10 ** 9), dict(length=23, gram=8, hot_texts=1)])
def test_removed_bytes_equal_brute_force(spark, workspace, settings):
    rows = passages(len(settings))
    config = suffix_dedup.RepeatConfig(**settings)
    found = suffix_dedup.remove_repeats(table(spark, rows), workspace, config, whole=True).collect()
    assert sorted((tuple(r)[:6] for r in found), key=str) == sorted(brute_repeats(rows, config.length), key=str)
    for r in found:
        assert r.row["_text"] == 7 and r.row["source"] == "s"
        assert r.n_removed == sum(b - a for a, b in zip(r.spans[::2], r.spans[1::2])) and len(r.spans) == 2 * r.n_spans


def test_removed_bytes_of_an_empty_table(spark, workspace):
    assert suffix_dedup.remove_repeats(table(spark, []), workspace).count() == 0


def test_a_text_longer_than_a_piece(spark, workspace, monkeypatch):
    monkeypatch.setattr(textkit, "PIECE", 100)
    text = " ".join(words(random.Random(3), 200))
    whole = suffix_dedup.anchors([text.encode()], 50, 16)
    monkeypatch.setattr(textkit, "PIECE", 1 << 20)
    once = suffix_dedup.anchors([text.encode()], 50, 16)
    spread = [{(k, int(a) + j) for k, a, n in zip(x[0].tolist(), x[2], x[3]) for j in range(n)} for x in (whole, once)]
    assert spread[0] == spread[1] and len(spread[0]) == len(text) - 49


def test_suffix_array_is_sorted_with_its_prefixes():
    draw = random.Random(5)
    segments = ["".join(draw.choice("ab\0") for _ in range(draw.randrange(20, 66))).encode() for _ in range(40)]
    segment, offset, rest, prefix = suffix_dedup.suffix_array(segments, 20)
    suffixes = [segments[s][o:] for s, o in zip(segment, offset)]
    assert suffixes == sorted(suffixes) and [len(s) for s in suffixes] == rest.tolist()
    for a, b, n in zip(suffixes, suffixes[1:], prefix[1:]):
        assert a[:n] == b[:n] and (len(a) == n or len(b) == n or a[n] != b[n])


def test_workspace_is_shared_folder(spark):
    assert Workspace(spark).root
