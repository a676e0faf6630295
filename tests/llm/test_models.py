import itertools
import os
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from coldspring.llm import boosting, chat_format, decontaminate, dom, html_extract, language_id, line_quality, pairwise_quality, textkit

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, _id string, score int")


# text kit

def test_words_and_shingles():
    texts = ["One two  one\ttwo\x0bTHREE".encode(), b"", b"a", "é ß x y z".encode()]
    words = textkit.Words(texts)
    assert [words.bytes[a:b].tobytes() for a, b in zip(words.starts, words.ends)] == [w for t in texts for w in WORD.findall(t)]
    sets = textkit.shingle_sets([b"A b c", b"a B c d", b"a b c", b"", b"c a b"], 3)
    assert [len(s) for s in sets] == [1, 2, 1, 0, 1] and sets[0].tolist() == sets[2].tolist() != sets[4].tolist()


# benchmark leaks

def distance(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best


def test_myers_is_edit_distance():
    draw = random.Random(1)
    for _ in range(200):
        pattern = "".join(draw.choice("abc") for _ in range(draw.randrange(1, 90)))
        text = "".join(draw.choice("abc") for _ in range(draw.randrange(0, 60)))
        masks = {}
        for i, c in enumerate(pattern):
            masks[c] = masks.get(c, 0) | 1 << i
        assert decontaminate.myers(masks, len(pattern), text)[0] == distance(pattern, text)


def leak_rows():
    draw = random.Random(6)
    items = [(i, " ".join("".join(draw.choice("abcdef") for _ in range(draw.randrange(1, 8))) for _ in range(14))) for i in range(8)]
    items += [(8, items[0][1]), (9, None), (10, ""), (11, "short one"), (None, items[1][1])]
    rows = []
    for n in range(60):
        text = "".join(draw.choice("abcdef  ") for _ in range(draw.randrange(0, 200)))
        if n % 2:
            leak = list(items[draw.randrange(8)][1])
            for _ in range(draw.randrange(9)):
                at = draw.randrange(len(leak))
                leak[at:at + draw.randrange(2)] = draw.choice(["", "x", "qq"])
            text += draw.choice([" ", "\n"]) + "".join(leak).upper().replace(" ", draw.choice([" ", "  \n"])) + text[:50]
        rows.append((n, text))
    return rows + [(60, None), (61, ""), rows[1], (None, rows[1][1])], items


@pytest.mark.parametrize("block_bytes", [16 << 20, 500])
def test_leaks_equal_brute_force(spark, block_bytes):
    rows, items = leak_rows()
    config = decontaminate.LeakConfig(share=0.08, block_bytes=block_bytes)
    table, bench = docs(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    want = []
    for (number, text), (item, wanted) in itertools.product(rows, items):
        wanted, text = decontaminate.normal(wanted or ""), decontaminate.normal(text or "")
        if item is not None and len(wanted) >= 32 and text:
            d = distance(wanted, text)
            if d <= int(0.08 * len(wanted)):
                want.append((number, item, d))
    found = [tuple(r) for r in decontaminate.find_leaks(table, bench, config).collect()]
    assert sorted(found, key=str) == sorted(want, key=str) and len({d for _, _, d in want}) > 3
    clean = decontaminate.drop_leaks(table, bench, config)
    gone = {text for number, text in rows for w in want if w[0] == number}
    assert clean.columns == table.columns
    assert sorted(str((r.doc_id, r.text)) for r in clean.collect()) == sorted(str(r) for r in rows if r[1] not in gone)


def test_anchored_is_edit_distance_to_beginnings():
    draw = random.Random(11)
    for _ in range(100):
        pattern, text = ("".join(draw.choice("abc") for _ in range(draw.randrange(1, 32))) for _ in range(2))
        row, want = list(range(len(pattern) + 1)), []
        for at, c in enumerate(text, 1):
            new = [at]
            for i, p in enumerate(pattern, 1):
                new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p != c)))
            row = new
            want.append(row[-1])
        masks = {c: sum(1 << i for i, p in enumerate(pattern) if p == c) for c in set(pattern)}
        assert list(decontaminate.anchored(masks, len(pattern), text)) == want


def test_short_items_are_matched_between_word_boundaries(spark):
    items = [(1, "Who wrote Hamlet?"), (2, "日本の首都はどこですか"), (3, "art"), (4, "2+2"), (5, "largest inland sea is caspian"), (6, " \n"), (7, "東")]
    texts = {1: "Q: who  wrote\nHamlet? A: Shakespeare", 2: "問題。日本の首都はどこですか東京です", 3: "party cart artful", 4: "modern ART.", 5: "is 2+2 = 4", 6: "is 12+25",
             7: "the largest inlnd sea is caspain, he said", 8: "who wrote hamlt? none", 9: "nothing", 10: None, 11: "xwho wrote hamlet?", 12: "yxwho wrote hamlet?", 13: "art"}
    bench = spark.createDataFrame(items, "item_id long, text string")
    table = docs(spark, list(texts.items()))
    found = sorted(tuple(r) for r in decontaminate.find_leaks(table, bench).collect())
    assert found == [(1, 1, 0), (2, 2, 0), (2, 7, 0), (4, 3, 0), (5, 4, 0), (8, 1, 1), (11, 1, 1), (13, 3, 0)]
    assert {r.doc_id for r in decontaminate.drop_leaks(table, bench).collect()} == {3, 6, 7, 9, 10, 12}


def test_leaks_of_nothing(spark):
    rows, items = leak_rows()
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_leaks(docs(spark, []), bench).count() == 0
    assert decontaminate.find_leaks(docs(spark, rows), bench.limit(0)).count() == 0


def test_leak_at_the_end_of_a_very_long_text(spark):
    item = "which river runs through the largest city of the northern plain"
    body = "plain words of no meaning, " * 60_000
    rows = [(1, body + item), (2, body), (3, item + " " + body), (4, body + item.replace("largest", "largst"))]
    bench = spark.createDataFrame([(9, item)], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.find_leaks(docs(spark, rows), bench).collect()) == [(1, 9, 0), (3, 9, 0), (4, 9, 1)]
    assert [r.doc_id for r in decontaminate.drop_leaks(docs(spark, rows), bench).collect()] == [2]


# line labels

def base_counts(text):
    body = (text or "").encode()
    found = [w.decode("utf-8", "replace") for w in WORD.findall(body)]
    lines, seen, dup = body.split(b"\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
    return len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_base_counts_equal_brute_force(spark):
    draw = random.Random(9)
    rows = [(i, "".join(draw.choice(["a ", "b ", "a b a ", "é# ", "\n", "\n\n", "|x| ", "\t", "a b a b "]) for _ in range(draw.randrange(0, 60)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \n "), (103, "x"), (104, "a b c\r\na b c\r\n"), (None, "a"), (5, "again"), (105, "w " * 40 + " ".join(map(str, range(300))))]
    found = line_quality.judge_documents(docs(spark, rows), line_quality.fit_field([], line_quality.LineConfig())).collect()
    got = sorted(((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found), key=str)
    assert got == sorted(((i, *base_counts(t)) for i, t in rows), key=str)
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed)
    kept = line_quality.keep_documents(docs(spark, rows), line_quality.fit_field([], line_quality.LineConfig()))
    assert kept.columns == ["doc_id", "text", "_id", "score"] and {r.doc_id for r in kept.collect()} == {r.doc_id for r in found if r.kept}


def test_decoding_finds_the_best_path():
    draw = np.random.default_rng(2)
    for _ in range(30):
        field = line_quality.Field(draw.normal(size=3), draw.normal(size=(2, 2)))
        x = draw.normal(size=(draw.integers(1, 9), 3))

        def score(path):
            return sum(x[i] @ field.line * s for i, s in enumerate(path)) + sum(field.step[a, b] for a, b in zip(path, path[1:]))
        best = max(itertools.product((0, 1), repeat=len(x)), key=score)
        assert field.decode(x).tolist() == list(best)


def test_field_tells_junk_lines():
    draw = random.Random(3)

    def prose():
        return " ".join("".join(draw.choice("abcdefgh") for _ in range(draw.randrange(2, 9))) for _ in range(draw.randrange(8, 30))) + "."

    def junk():
        return draw.choice([" | ".join("abc" for _ in range(9)) + " |", "BUY!! NOW!! THIS!! ONE!!", "a### b$$$ c%%% d&&&"])
    texts = [("\n".join(prose() for _ in range(6)).encode(), 1) for _ in range(60)] + [("\n".join([prose()] + [junk() for _ in range(6)]).encode(), 0) for _ in range(30)]
    field = line_quality.fit_field(texts, line_quality.LineConfig())
    lines = [prose(), prose(), junk(), junk(), junk(), prose(), prose(), prose()]
    x = line_quality.Lines(["\n".join(lines).encode()]).features()
    assert field.decode(x).tolist() == [0, 0, 1, 1, 1, 0, 0, 0]


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_line_labels_keep_good_documents(spark):
    table, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    found = line_quality.judge_documents(table, line_quality.fit_lines(table, labels)).filter("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.35 * len(bad)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_line_labels_of_documents_not_fitted_on(spark):
    table, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    field = line_quality.fit_lines(table, labels.filter("doc_id % 2 = 0"))
    found = line_quality.judge_documents(table.filter("doc_id % 2 = 1"), field).filter("not base_failed").join(labels, "doc_id").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert len(good) > 20 and bad and sum(good) >= 0.95 * len(good) and sum(bad) <= 0.4 * len(bad)


def test_fitting_takes_one_text_of_an_id_and_stands_odd_rows(spark):
    rows = [(1, "a b c\n| x | y |"), (1, "zz\nyy"), (2, None), (None, "t"), (3, ""), (4, "w " * 30000), (5, "good line of words.")]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (None, 0), (6, None)], "doc_id long, quality int")
    one, two = (line_quality.fit_lines(t, labels) for t in (table, table.orderBy(table.text.desc())))
    want = line_quality.fit_field([(b"a b c\n| x | y |", 0), (b"", 1), (b"w " * 30000, 1), (b"good line of words.", 1)], line_quality.LineConfig())
    for field in (one, two):
        assert (field.line == want.line).all() and (field.step == want.step).all()
    empty = line_quality.fit_lines(table.limit(0), labels)
    assert empty.decode(np.ones((3, len(line_quality.FEATURES)))).tolist() == [0, 0, 0]
    assert line_quality.judge_documents(table.limit(0), empty).count() == 0


# pairwise quality

def test_ranking_separates_and_is_scaled():
    draw = np.random.default_rng(4)
    x = draw.normal(size=(400, 5))
    good = x[:, 0] - 0.5 * x[:, 3] + 0.1 * draw.normal(size=400) > -0.8
    model = pairwise_quality.fit_ranking(x, good, pairwise_quality.PairConfig(pairs=4000))
    score = model.score(x)
    assert ((score >= pairwise_quality.CUT) == good).mean() > 0.93 and 0 <= score.min() and score.max() <= 1
    one_sided = pairwise_quality.fit_ranking(x, np.ones(400, dtype=bool), pairwise_quality.PairConfig())
    assert np.allclose(one_sided.score(x), one_sided.score(x)[0])


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_quality_scores(spark):
    folder = FOLDER.replace("0.001", "0.01")
    table, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    ranking = pairwise_quality.learn_ranking(table, labels.filter("doc_id % 5 != 0"))
    found = pairwise_quality.score_documents(table, ranking).join(labels.filter("doc_id % 5 = 0"), "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in found]) > 0.95
    odd = pairwise_quality.score_documents(docs(spark, [(1, None), (1, ""), (None, " \n"), (2, "x " * 9000)]), ranking).collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in odd) and len(odd) == 4
    empty = pairwise_quality.learn_ranking(table.limit(0), labels)
    assert pairwise_quality.score_documents(docs(spark, []), empty).count() == 0


# languages

@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_held_out_language(spark):
    table = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    profiles = language_id.learn_profiles(table.filter("doc_id % 4 != 2"))
    found = language_id.identify(table, profiles).join(table.filter("doc_id % 4 = 2 and length(text) > 100").select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) > 0.99
    odd = [(r.lang_pred, r.score) for r in language_id.identify(docs(spark, [(1, None), (1, ""), (None, "123 ...")]), profiles).collect()]
    assert odd == [("und", 0.0)] * 3


def test_languages_of_nothing_and_of_very_long_texts(spark):
    rows = [("en", "the cat and the dog and the bird"), ("de", "der hund und die katze und der vogel")]
    profiles = language_id.learn_profiles(spark.createDataFrame(rows, "lang string, text string"))
    assert language_id.identify(docs(spark, []), profiles).count() == 0
    none = language_id.learn_profiles(spark.createDataFrame([], "lang string, text string"))
    assert [(r.lang_pred, r.score) for r in language_id.identify(docs(spark, [(1, "text")]), none).collect()] == [("und", 0.0)]
    # the whole text counts, not how it begins
    long = docs(spark, [(1, "der hund " * 50 + "the dog and the cat " * 40_000), (1, "the dog and " * 50 + "und die katze " * 40_000)])
    assert [r.lang_pred for r in language_id.identify(long, profiles).collect()] == ["en", "de"]


def test_profiles_by_hand():
    config = language_id.LanguageConfig(grams=4, longest=2)
    codes = language_id.gram_codes("Aa, b!", 2)
    a, b = ord("a"), ord("b")
    assert sorted(codes.tolist()) == sorted([a, a, b, a, (a << 21) | a, a << 21, b, b << 21])   # " a", "aa", "a ", " b", "b "
    assert language_id.ranked(np.array([5, 5, 3, 3, 9], dtype=np.uint64), 2).tolist() == [3, 5]
    profiles = language_id.Profiles.of({"x": [a, b, 7, 8], "y": [b, a, 9, 10]}, 4)
    own = language_id.ranked(language_id.gram_codes("aab", 1), 4)
    assert own.tolist() == [a, b]
    lang, score = profiles.predict("aab", language_id.LanguageConfig(grams=4, longest=1))
    assert (lang, score) == ("x", 1.0)   # distances 0 and 2
    assert language_id.Profiles.of({}, 4).predict("aab", config) == ("und", 0.0)


def test_gram_counts_do_not_depend_on_the_cut(spark):
    rows = [(i, "de" if i % 2 else "en", "abc bca cab " * (i + 1)) for i in range(20)] + [(30, None, "zzz"), (31, "en", None)]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    one, many = (language_id.learn_profiles(table.repartition(n)) for n in (1, 5))
    assert one.languages == many.languages == ["de", "en"] and (one.ranks == many.ranks).all()
    with pytest.raises(ValueError):
        language_id.learn_profiles(table, language_id.LanguageConfig(grams=2, most_languages=1))


def test_languages_of_empty_texts(spark):
    rows = [(1, "en", "abc bca"), (2, "xx", ""), (3, "xx", ""), (4, "yy", "12 !"), (5, "de", ""), (6, "de", "cab")]
    table = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    for n in (1, 6):
        assert language_id.learn_profiles(table.repartition(n)).languages == ["de", "en"]
    assert language_id.learn_profiles(table.filter("lang = 'xx'")).languages == []


def test_long_texts_are_counted_whole():
    config = language_id.LanguageConfig()
    for text in ("abcdefg " * 200_000, "x" * textkit.PIECE + "yz, ab" * 9, "ab1ΑΣ.Α" * 150_000, "q" * (2 * textkit.PIECE + 5)):
        batch = pa.RecordBatch.from_pydict({"_lang": ["en"], "_text": [text]})
        found = next(language_id._count(config)(iter([batch])))
        value, count = np.unique(language_id.gram_codes(text, config.longest), return_counts=True)
        assert dict(zip(found.column("_gram").to_pylist(), found.column("_n").to_pylist())) == dict(zip(value.view(np.int64).tolist(), count.tolist()))


# html

class Plain:
    """Keeps everything but hidden elements, text directly in the page and elements whose class has the word ad."""
    evidence = np.where(np.arange(dom.TOKEN_BUCKETS) == dom.bucket("ad"), -1.0, 0.0)

    def score(self, x):
        return 1.0 - 5 * np.maximum(x[:, len(dom.TAGS):dom.N_OWN].max(axis=1), -x[:, dom.AT_TOKENS])


def simple(page):
    """Text of elements without a class, by the tree alone."""
    return html_extract.extract(page, Plain())


def test_tree_of_odd_html():
    assert simple("<p>a &amp; b&lt;<br>c<p>d<b>e</p><p>f") == "a & b< c\nde\nf"
    assert simple("x <div>y<p>z</div> w") == "y\nz"
    assert simple("<ul><li>a<li>b<ul><li>c</ul></ul><table><tr><td>d<td>e<tr><td>f</table>") == "a\nb\nc\nd\ne\nf"
    assert simple("<script>var t='</p><p>no';</script><style>p{}</style><!-- <p>no --><p>yes<!-- no") == "yes"
    assert simple("<head><title>no</title></head><body><p>yes</p><textarea><p>no</textarea><p>cut <a href='x") == "yes\ncut"
    assert simple("<div class=ad><p>no</p></div><p>yes") == "yes"
    assert simple("plain &copy; text") == "plain © text"
    assert [simple(p) for p in (None, "", "<", "<>", "</p>", "<p></p>")] == ["", "", "<", "<>", "", ""]
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert simple(deep) == "x" and len(simple("<p>" + "word " * 50000)) == 249999


def test_decoding_is_consistent():
    draw = random.Random(8)
    for _ in range(40):
        page = "".join(draw.choice(["<div>", "</div>", "<p>t</p>", "s"]) for _ in range(14))
        nodes = dom.parse(page)
        if not 2 <= len(nodes) <= 12:
            continue
        dom.features(nodes)
        score = np.array([draw.uniform(-2, 2) for _ in nodes])
        weight = [s * (1 + np.log1p(sum(len(t) for _, t, _ in n.units))) for n, s in zip(nodes, score)]

        def value(choice):
            if any(c and n.parent is not None and not choice[n.parent.order] for c, n in zip(choice, nodes)):
                return -1e9
            return sum(w if c else -w for w, c in list(zip(weight, choice))[1:])
        best = max(value((True, *c)) for c in itertools.product((False, True), repeat=len(nodes) - 1))
        assert value(tuple(dom.decode(nodes, score))) == pytest.approx(best)


def test_siblings_count_in_any_number():
    draw = random.Random(5)
    for n in (3, 64, 65, 300):
        parts = [(draw.choice(["p", "p", "h2"]), "x" * draw.randrange(1, 90)) for _ in range(n)]
        nodes = dom.parse("<div>" + "".join(f"<{t}>{body}</{t}>" for t, body in parts) + "</div>")
        x = dom.features(nodes)[:, dom.AT_TREE:]
        sizes, tags = [len(body) for _, body in parts], [t for t, _ in parts]
        assert x[1, 19] == tags.count("p")
        for i, row in enumerate(x[2:]):
            assert row[10:15].tolist() == pytest.approx([n, i / n, np.log1p(sum(sizes) / n), sizes[i] / max(sizes), tags.count(tags[i]) / n])


@pytest.fixture(scope="module")
def extractor():
    pool = ["the quick brown fox", "jumps over, it is.", "Lazy dogs sleep all day.", "und der Hund schläft", "una frase corta"] * 20
    config = html_extract.ExtractConfig(layouts=500)
    return pool, html_extract.fit_written(html_extract.written_pages(pool, config), trees=40)


def test_held_out_layouts(extractor):
    pool, model = extractor
    pages = html_extract.written_pages(pool, html_extract.ExtractConfig(layouts=120), seed=99)
    x, y = html_extract.node_rows(html_extract.labelled_pages(pages), model.evidence)
    assert ((model.score(x) > 0) == (y > 0)).mean() > 0.96    # some ads and boxes have made-up names, which no layout tells apart


TITLE, PARTS = "Title here", ["the quick brown fox jumps over, it is. Lazy dogs sleep all day.", "und der Hund schläft una frase corta, it is.", "Lazy dogs sleep. the quick brown fox"]
MENU, END = "<nav><ul><li><a href=/a>A</a><li><a href=/b>B b</a></ul></nav>", "<footer><p>&copy; Us</p></footer>"


def written(*parts):
    return "".join(f"<p>{p}</p>" for p in parts)


def test_no_pages_give_no_rows(spark, extractor):
    assert html_extract.extract_pages(spark.createDataFrame([], "page_id long, url string, html string"), extractor[1]).count() == 0


@pytest.mark.parametrize("before, after", [
    ('<main class="review">', "</main>"), ('<div class="post tag-social more-news">', "</div>"), ('<div class="site"><div class="site-content">', "</div></div>"),
    ('<article class="discussion">', "</article>"), ('<div id="css-1x9k">', "</div>")])
def test_names_of_articles_do_not_decide(extractor, before, after):
    page = f"<body>{MENU}{before}<h1>{TITLE}</h1>{written(*PARTS)}{after}{END}</body>"
    assert html_extract.extract(page, extractor[1]) == "\n".join([TITLE, *PARTS])


def test_boxes_of_an_article_stay(extractor):
    for name in ("warning", "note", "info"):
        page = f'<body>{MENU}<article><h1>{TITLE}</h1>{written(PARTS[0])}<div class="{name}">{written(PARTS[1])}</div>{written(PARTS[2])}</article>{END}</body>'
        assert html_extract.extract(page, extractor[1]) == "\n".join([TITLE, *PARTS])


@pytest.mark.parametrize("name", ["ad", "werbung", "publicidad", "anzeige", "dfp-unit", "css-1x9k", "qqz"])
def test_adverts_outside_the_article_go_whatever_their_name(extractor, name):
    advert = f'<div class="{name}">Buy this now, great price.</div>'
    for page in (f"{MENU}{advert}<article><h1>{TITLE}</h1>{written(*PARTS)}</article>{END}", f"{MENU}<article><h1>{TITLE}</h1>{written(*PARTS)}</article>{advert}{END}"):
        assert html_extract.extract(f"<body>{page}</body>", extractor[1]) == "\n".join([TITLE, *PARTS])


@pytest.mark.parametrize("name", ["ad", "advert", "sponsored", "werbung"])
def test_known_adverts_inside_the_article_go(extractor, name):
    page = f'{MENU}<article><h1>{TITLE}</h1>{written(PARTS[0])}<div class="{name}">Buy this now, great price.</div>{written(*PARTS[1:])}</article>{END}'
    assert html_extract.extract(f"<body>{page}</body>", extractor[1]) == "\n".join([TITLE, *PARTS])


@pytest.mark.parametrize("name", ["comments", "kommentare", "discourse", "css-77a"])
def test_reader_comments_go_whatever_their_name(extractor, name):
    talk = f'<section class="{name}">' + "".join(f'<div class="{name}-item"><p>{t}</p></div>' for t in ("Nice one", "Thanks for it, good.", "No, it is not.")) + "</section>"
    page = f"<body>{MENU}<article><h1>{TITLE}</h1>{written(*PARTS)}</article>{talk}{END}</body>"
    assert html_extract.extract(page, extractor[1]) == "\n".join([TITLE, *PARTS])


def test_words_never_seen_have_no_evidence(extractor):
    evidence = extractor[1].evidence
    assert evidence[dom.bucket("advert")] < -1 and evidence[dom.bucket("content")] > 0
    assert (html_extract.token_evidence([]) == 0).all() and (html_extract.token_evidence([dom.parse("<p>x")]) == 0).all()


def test_repeated_ids_give_one_text_for_training(spark):
    rows = [(1, "<p>b</p>"), (1, "<p>a</p>"), (None, "<p>no</p>"), (2, None), (3, "<p>" + "z" * 900 + "</p>")]
    table = spark.createDataFrame(rows, "page_id long, html string")
    config = html_extract.ExtractConfig(layouts=30)
    one, two = (html_extract.fit_extractor(t, config) for t in (table, table.orderBy(table.html.desc())))
    x = np.random.default_rng(1).normal(size=(50, dom.FEATURES))
    assert (one.score(x) == two.score(x)).all() and (one.evidence == two.evidence).all()


def test_long_articles_are_read_as_short_ones(extractor):
    pool, model = extractor
    for n in (5, 63, 70, 250):
        blocks = [f"{pool[i % 5]} {pool[(i + 2) % 5]} {i}" for i in range(n)]
        page = ("<body><nav class=menu><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></nav><article><h1>Title</h1>" + "".join(f"<p>{b}</p>" for b in blocks)
                + "</article><div class=comments>" + "<div class=comment><p>Nice text, thanks.</p></div>" * n + "</div></body>")
        assert html_extract.extract(page, model) == "\n".join(["Title", *blocks])


def test_text_directly_in_the_page(extractor):
    pool, model = extractor
    long, more = " ".join(pool[:5] * 3), " ".join(pool[2:5] * 4)
    rest = "<div class='sidebar'><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></div><footer class='site-footer'><p>&copy; Us</p></footer></body>"
    assert html_extract.extract(f"<body><h1>Title</h1>{long}<br>{more}{rest}", model) == f"Title\n{long} {more}"
    early = f"<body><article><h1>Title</h1><p>{long}</p></article>{more}<p>{long}</p>{more}{rest}"
    assert html_extract.extract(early, model) == "\n".join(["Title", long, more, long, more])
    stray = f"<body><a href=#c>Skip</a><hr><article><h1>Title</h1><p>{long}</p><p>{more}</p></article>{rest}"
    assert html_extract.extract(stray, model) == "\n".join(["Title", long, more])


def test_extracted_pages(spark, extractor):
    page = ("<html><head><title>t</title></head><body><header class='site-header'><h1>Site</h1></header><nav><ul><li><a href=/a>A</a></li><li><a href=/b>B</a></li></ul></nav>"
            "<div class='cookie-notice'>We use cookies.</div><article><h1>Title</h1><p>First  line,\nof &eacute;.</p><div class='ad'>Buy it.</div><p>Second line of text.</p>"
            "<section class='comments'><div class='comment'><p>Nice text, thanks.</p></div></section></article><aside class='sidebar'><p>Other.</p></aside>"
            "<form><label>Name</label></form><footer>&copy; Us</footer></body></html>")
    rows = [(1, "u", page), (2, None, None), (None, "v", ""), (1, "u", page), (3, "w", "<nav><a href=x>only a menu</a></nav>")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    found = sorted((tuple(r) for r in html_extract.extract_pages(table, extractor[1]).collect()), key=str)
    text = "Title\nFirst line, of é.\nSecond line of text."
    assert found == sorted([(1, "u", text, len(text))] * 2 + [(2, None, "", 0), (None, "v", "", 0), (3, "w", "", 0)], key=str)
    assert html_extract.fit_extractor(table.limit(0), html_extract.ExtractConfig(layouts=20)).score(np.zeros((1, dom.FEATURES))).shape == (1,)


def test_trees_learn_an_interaction():
    x = np.random.default_rng(1).normal(size=(2000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.3)).astype(float)
    trees = boosting.fit(x, y, trees=30)
    assert ((trees.score(x) > 0) == (y > 0)).mean() > 0.97


# chat

def turns(spark, draw, sizes):
    rows = [(c, t, ["user", "assistant"][t % 2] if t or c % 4 else "system", "\n".join(
        " ".join("word" for _ in range(draw.randrange(1, 12))) + draw.choice([".", "?" if t % 2 == 0 else "."]) for _ in range(1 + 2 * (t % 2))))
        for c, n in enumerate(sizes) for t in range(n)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_ranges_give_the_same_path(spark, workspace):
    draw = random.Random(7)
    table = turns(spark, draw, [4, 120, 3, 6, 1, 2])
    chain = chat_format.learn_chain(table)
    lines = chat_format.written_transcripts(table).cache()
    found = {(r.conv_id, r.place): (r.role, r.rendered) for r in chat_format.parse_transcripts(lines, chain, workspace).collect()}
    by_conv = {}
    for r in lines.collect():
        by_conv.setdefault(r.conv_id, []).append(r)
    right = total = 0
    for conv, rows in by_conv.items():
        rows.sort(key=lambda r: (r.turn, r.line))
        state = chain.decode(chain.scores(chat_format.line_features([r.text for r in rows], chain.roles)), None, None)
        assert [found[conv, i][0] for i in range(len(rows))] == [chain.roles[s // 3] for s in state]
        right += sum(found[conv, i][0] == r.role for i, r in enumerate(rows) if not (r.bare and r.line == 0))
        total += sum(not (r.bare and r.line == 0) for r in rows)
        text = "\n".join(found[conv, i][1] for i in range(len(rows)) if found[conv, i][1] is not None)
        assert text.startswith("<|") and text.endswith("<|end|>") and text.count("<|end|>") == sum(s % 3 == 0 for s in state)
    assert right > 0.95 * total


def test_a_very_long_turn_and_no_lines(spark, workspace):
    chain = chat_format.learn_chain(turns(spark, random.Random(3), [6] * 12))
    said = "\n".join(["many words of one line " * 2000] + [f"line {i} of a long answer" for i in range(4000)])
    table = spark.createDataFrame([(1, 0, "user", "Tell me all."), (1, 1, "assistant", said), (1, 2, "user", "Thanks.")],
                                  "conv_id long, turn long, role string, text string")
    lines = chat_format.written_transcripts(table, chat_format.ChatConfig(unmarked=1 << 30))
    found = sorted(chat_format.parse_transcripts(lines, chain, workspace).collect(), key=lambda r: r.place)
    assert [r.place for r in found] == list(range(4003)) and [found[i].role for i in (0, 1, 2000, 4001, 4002)] == ["user"] + ["assistant"] * 3 + ["user"]
    assert "\n".join(r.rendered for r in found) == f"<|user|>\nTell me all.\n<|end|>\n<|assistant|>\n{said}\n<|end|>\n<|user|>\nThanks.\n<|end|>"
    assert chat_format.parse_transcripts(lines.limit(0), chain, workspace).count() == 0


def test_chat_transcripts_come_back_as_the_turns(spark, workspace):
    """Fitted on some conversations, scored on others; blank lines before unmarked turns are no part of any turn."""
    draw = random.Random(17)
    table = turns(spark, draw, [draw.randrange(2, 12) for _ in range(160)])
    chain = chat_format.learn_chain(table.filter("conv_id < 80"))
    others = table.filter("conv_id >= 80")
    want, got = {}, {}
    for r in others.orderBy("conv_id", "turn").collect():
        want.setdefault(r.conv_id, []).append(f"<|{r.role}|>\n{r.text}\n<|end|>")
    for r in chat_format.parse_transcripts(chat_format.written_transcripts(others), chain, workspace).orderBy("conv_id", "place").collect():
        if r.rendered is not None:
            got.setdefault(r.conv_id, []).append(r.rendered)
    same = sum("\n".join(got[c]) == "\n".join(t) for c, t in want.items())
    assert len(want) == 80 and same >= 72


def test_chat_keeps_words_that_name_no_role(spark, workspace):
    chain = chat_format.learn_chain(turns(spark, random.Random(1), [6] * 12))
    starts = ["Note: see below", "Error: no file", "[Draft] a text", "**Important:** read it", "### Title: x"]
    rows = [(c, t, text) for c, start in enumerate(starts) for t, text in enumerate([start, "Bot: it is.", "", start, "Human: thanks, is it?"])]
    lines = spark.createDataFrame(rows, "conv_id long, turn long, text string").withColumn("line", F.lit(0))
    found = {(r.conv_id, r.place): (r.rendered or "").split("\n") for r in chat_format.parse_transcripts(lines, chain, workspace).collect()}
    for c, start in enumerate(starts):
        assert found[c, 0][0].startswith("<|") and found[c, 0][1] == start and start in found[c, 3]
        assert found[c, 1][-1] == "it is." and found[c, 4][-2] == "thanks, is it?"


def test_chat_of_odd_rows(spark, workspace):
    table = turns(spark, random.Random(1), [6] * 12)
    chain = chat_format.learn_chain(table)
    odd = spark.createDataFrame([(None, 0, 0, "User: hi", 1), (5, None, None, None, 1), (5, 0, 0, "", 1), (5, 0, 0, "", 1), (6, 1, 0, "Bot: x", 1)],
                                "conv_id long, turn long, line long, text string, place int")
    found = chat_format.parse_transcripts(odd, chain, workspace).collect()
    assert sorted((str(r.conv_id), r.place) for r in found) == [("5", 0), ("5", 1), ("5", 2), ("6", 0), ("None", 0)]
    assert {r.rendered for r in found if r.conv_id is None} == {"<|user|>\nhi\n<|end|>"}
    assert chat_format.parse_transcripts(odd.limit(0), chain, workspace).count() == 0
    assert chat_format.learn_chain(table.limit(0)).roles == ["user"]
