"""Periodic runs, byte-pair encoding and whitening against brute force and the public library."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pytest

from coldspring.llm import bpe, registry, run_detection, whitening

tokenizers = pytest.importorskip("tokenizers")
vocabularies = pytest.importorskip("public_tokenizers")
PATH = vocabularies.path("word_bpe_49k.json")
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_runs(words):
    best = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(6, 4 * q):
                best.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((start, q, length) for (start, length), q in best.items())


def collapse(words, runs):
    gone = {i for start, q, length in runs for i in range(start + q, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def repeating_words(draw, n, letters):
    words = [draw.randrange(letters) for _ in range(n)]
    for _ in range(draw.randrange(3)):
        if n > 8:
            p = draw.randrange(1, n // 4 + 1)
            start = draw.randrange(n - p)
            for i in range(start + p, min(n, start + draw.randrange(p, 8 * p))):
                words[i] = words[i - p]
    return words


def test_runs_of_many_texts_equal_brute_force():
    draw = random.Random(3)
    for _ in range(250):
        texts = [repeating_words(draw, draw.randrange(130), draw.choice([1, 2, 2, 3, 6])) for _ in range(draw.randrange(1, 6))]
        counts, runs, collapsed = run_detection.text_runs([" ".join(f"w{w}" for w in t).encode() for t in texts])
        for words, count, found, rest in zip(texts, counts, runs.to_pylist(), collapsed.to_pylist()):
            expected = brute_runs(words)
            assert count == len(words)
            assert [(r["start"], r["period"], r["length"]) for r in found] == expected
            assert rest.decode() == " ".join(f"w{w}" for w in collapse(words, expected))


def test_runs_of_every_short_word_sequence():
    for n in range(1, 13):
        texts = list(itertools.product("ab", repeat=n))
        _, runs, _ = run_detection.text_runs([" ".join(t).encode() for t in texts])
        for words, found in zip(texts, runs.to_pylist()):
            assert [(r["start"], r["period"], r["length"]) for r in found] == brute_runs(words)


def test_range_successor_equals_search():
    draw = np.random.default_rng(4)
    for n in (1, 2, 63, 64, 65, 500):
        values = draw.permutation(n)
        tree = run_detection.RangeSuccessor(values)
        lo = draw.integers(0, n, 300)
        hi = draw.integers(lo, n) + 1
        x = draw.integers(0, n + 1, 300)
        expected = [min((v for v in values[a:b] if v >= c), default=n) for a, b, c in zip(lo, hi, x)]
        assert tree.successor(lo, hi, x).tolist() == expected


def test_runs_of_very_long_texts():
    n = 400_000
    counts, runs, collapsed = run_detection.text_runs([b"la " * n, b"", b"a b c d " * (n // 4)])
    assert counts.tolist() == [n, 0, n]
    assert runs.to_pylist() == [[{"start": 0, "length": n, "period": 1}], [], [{"start": 0, "length": n, "period": 4}]]
    assert collapsed.to_pylist() == [b"la", b"", b"a b c d"]


def test_runs_query_rules(spark, tmp_path):
    draw = random.Random(8)
    rows = [(i, " ".join(f"w{draw.randrange(40)}" for _ in range(draw.randrange(90)))) for i in range(300)]
    rows += [(None, "a b " * 6), (5, None), (10 ** 9, ""), (7, " \t\n"), rows[0], rows[0], (-3, "x " * 50), (8, "ä ä \x0b" * 9)]
    docs = spark.createDataFrame([(i, t, "s", "s") for i, t in rows], "doc_id long, text string, runs string, collapsed string")
    docs.coalesce(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(map(tuple, registry.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    expected = []
    for i, text in rows:
        words = WORD.findall((text or "").encode())
        n, h = len(words), None if i is None else zlib.crc32(str(i).encode())
        if n and h is not None and h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[w] if w < a else words[a + (w - a) % p] for w in range(n)]
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[2], r[0], r[1]), default=None)
        lines = "".join(f"{s},{length},{q}\n" for s, q, length in runs)
        expected.append((i, len(runs), *((best[0], best[2], best[1], 1000 * best[2] // best[1]) if best else (None,) * 4),
                         hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(collapse(words, runs))).hexdigest()))
    assert sum(e[1] for e in expected) > 10
    assert got == sorted(expected, key=str)


def test_no_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, ids string")
    assert run_detection.periodic_runs(empty).count() == 0
    assert bpe.encode(empty, bpe.read_merges(PATH)).count() == 0


@pytest.fixture(scope="module")
def merges():
    return bpe.read_merges(PATH)


PARTS = ["'s", "'LL", "’s", " ", "\n", "a", "b", "E", "é", "é", "Σ", "ß", "İ", "1", "²", "!", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "日本",
         "\x1c", "\x85", "　", "ing", "the", "aaaa", "ͅ", "ǅ", "한", "‍", "😀", "ﬁ", "꟎", "Ᲊ", "\U00010d50"]


def test_encoder_equals_library(merges):
    library, encoder, ids = tokenizers.Tokenizer.from_file(PATH), bpe.Encoder(merges), bpe.table_ids(merges)
    draw = random.Random(6)
    texts = ["".join(draw.choices(PARTS, k=draw.randrange(25))) for _ in range(4000)]
    texts += ["".join(draw.choices("aeinorstlhg", k=draw.randrange(1, 70))) for _ in range(4000)]
    texts += ["".join(draw.choices("aab", k=draw.randrange(1, 70))) for _ in range(2000)]
    texts += ["".join(chr(c) for c in draw.choices([*range(0xD800), *range(0xE000, 0x30000)], k=12)) for _ in range(2000)]
    for text in texts:
        assert [ids[s] for s in encoder.encode(text)] == library.encode(text, add_special_tokens=False).ids, text


def test_a_token_never_merged_whole_is_not_used():
    """abc is made of ab and c, but a takes part in xa first only after x; bc comes before ab, so abc is never reached."""
    names = ["a", "b", "c", "bc", "ab", "abc"]
    symbols = {n: i for i, n in enumerate(names)}
    left, right = list(range(512)), list(range(512))
    byte = {"a": 97, "b": 98, "c": 99}
    left += [byte["b"], byte["a"], 513]
    right += [byte["c"], byte["b"], byte["c"]]
    table = bpe.Merges(".+", {}, list(range(515)), [str(i) for i in range(515)], left, right, [True] * 515)
    pairs = bpe._pairs(table)
    assert bpe.compatible(table, pairs, 97, 512) and not bpe.compatible(table, pairs, 513, 99)
    assert not bpe.compatible(table, pairs, 513, 99, 514)
    assert len(symbols) == 6


def test_codec_rules(spark, merges):
    library = tokenizers.Tokenizer.from_file(PATH)
    texts = [None, "", "  \n", "Hello, world", "hello, WORLD", "x" * 100_000, "ab" * 50_000 + " tail", "word " * 60_000, "<|endoftext|>", "it's 3rd", "it's 3rd"]
    rows = [(i if i != 4 else None, t, "c", [1]) for i, t in enumerate(texts)] + [(3, texts[3], "c", [1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>")
    found = bpe.encode(docs, merges)
    got = sorted(((r.doc_id, list(r.ids), r.decoded) for r in found.collect()), key=str)
    expected = []
    for i, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert got == sorted(expected, key=str)
    back = sorted(((r.doc_id, r.decoded) for r in bpe.decode(found, merges).collect()), key=str)
    assert back == sorted(((i, d) for i, _, d in expected), key=str)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.read_merges(vocabularies.path("byte_bpe_50k.json"))


def test_inertia_and_leading_pairs():
    draw = np.random.default_rng(1)
    turn = lambda d: np.linalg.qr(draw.standard_normal((d, d)))[0]
    q, r = turn(20), turn(24)
    cases = [draw.standard_normal((9, 9)), np.diag([3.0, 3, 3, 2, 2, 0, 0]), np.eye(5), np.zeros((4, 4)), np.ones((6, 6)),
             q @ np.diag(10.0 ** -np.arange(20)) @ q.T, r @ np.diag(1 + 1e-9 * np.arange(24)) @ r.T, np.array([[4.0]])]
    for m in cases:
        m = m @ m.T if not np.allclose(m, m.T) else (m + m.T) / 2
        exact = np.linalg.eigvalsh(m)[::-1]
        values, axes = whitening.leading_pairs(m, 16)
        size = np.abs(m).sum(axis=1).max()
        assert len(values) == (min(16, len(m)) if size else 0)
        assert np.abs(values - exact[:len(values)]).max(initial=0) <= 1e-14 * max(size, 1e-300) * 20
        assert np.abs(axes.T @ axes - np.eye(len(values))).max(initial=0) < 1e-12
        assert np.abs(m @ axes - axes * values).max(initial=0) <= 1e-12 * max(size, 1)
    m = draw.standard_normal((12, 12))
    m = m + m.T
    for shift in draw.uniform(-8, 8, 60):
        exact = np.linalg.eigvalsh(m)
        assert whitening.inertia(m, shift) == ((exact < shift).sum(), (exact > shift).sum())


def brute_whitening(rows, top=16):
    kept = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    fit = np.array(sorted({tuple(x) for _, x in kept}), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (n * fit - sums) / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:top], axes[:, ::-1][:, :top]
    out = {}
    for i, x in kept:
        d = n * np.array(x) - sums
        out.setdefault(i, []).append((n, int((d * d).sum()), (d / n) @ axes / np.sqrt(values), values / np.trace(v)))
    return out


def test_whitening_equals_eigh(spark, workspace):
    draw = np.random.default_rng(2)
    hot = draw.standard_normal(20).astype(np.float32)
    rows = [(i, (draw.standard_normal(20) * np.linspace(1, 4, 20)).astype(np.float32).tolist()) for i in range(200)]
    rows += [(1000 + i, hot.tolist()) for i in range(90)]
    rows += [(2000, None), (2001, [None] + hot.tolist()[1:]), (2002, [float("nan")] + hot.tolist()[1:]), (2003, [float("inf")] + hot.tolist()[1:]),
             (2004, [1e30] + hot.tolist()[1:]), (2005, [1.0, 2.0]), (2006, []), rows[0]]
    table = spark.createDataFrame([(i, v, 7, "c") for i, v in rows], "vec_id long, embedding array<float>, n int, component string")
    model = whitening.fit(table.repartition(5), workspace)
    got = {}
    for r in whitening.whiten(table, model).collect():
        got.setdefault(r.vec_id, []).append(r)
    expected = brute_whitening([(i, v) for i, v in rows if i not in (2004, 2005, 2006)])
    assert set(got) == set(expected)
    sign = None
    for i, found in got.items():
        cases = expected[i]
        assert len(found) == 16 * len(cases)
        first = sorted(found, key=lambda r: r.component)[::len(cases)]
        n, deviation, whitened, explained = cases[0]
        assert {(r.n, r.deviation) for r in found} == {(n, deviation)}
        w = np.array([r.whitened for r in first])
        sign = np.sign(w * whitened) if sign is None else sign
        assert np.allclose(w, whitened * sign, atol=1e-8)
        assert np.allclose([r.explained for r in first], explained, rtol=1e-9)
        assert max(r.identity_error for r in found) < 1e-8


def test_whitening_without_variance(spark, workspace):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, []), (2, [])], [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (None, [1.0, 2.001])]):
        table = spark.createDataFrame(rows, schema)
        assert whitening.whiten(table, whitening.fit(table, workspace)).count() == 0
    flat = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 5.0]), (None, [3.0, 5.0])], schema)
    found = whitening.whiten(flat, whitening.fit(flat, workspace)).collect()
    assert sorted((str(r.vec_id), r.component, round(abs(r.whitened), 9), r.n, r.deviation) for r in found) == [
        ("1", 1, 1.0, 2, 16384), ("2", 1, 1.0, 2, 16384), ("None", 1, 1.0, 2, 16384)]


def test_squares_beyond_longs_are_null():
    assert whitening._squares(np.array([[3, 4], [1 << 31, 1 << 31]], dtype=np.int64)) == [25, None]
    big = whitening._deviations(np.array([[10 ** 15], [0]], dtype=np.int64), 10 ** 6, [10 ** 15])
    assert [int(v) for v in big.ravel()] == [10 ** 21 - 10 ** 15, -10 ** 15]
