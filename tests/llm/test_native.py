import hashlib
import os
import random
import re

import pytest

from coldspring.checks import parity
from coldspring.llm import mixing, registry, url_filter

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
def test_registered_sql(spark):
    sql = registry.oracle_sql()
    wrong = {n: v for n, v in parity.compare(spark, FOLDER, registry.queries(), sql, sorted(sql)).items() if v}
    assert not wrong


def brute_mix(rows, weights=(5.0, 2.0, 1.0), share=1.5, repeats=2):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    words = {s: sum(size(t) for _, t, x in rows if x == s) for s in names}
    budget, free, target = share * sum(words.values()), set(names), {}
    while free:
        level = budget / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > repeats * words[s]}
        if not over:
            target |= {s: level * weight[s] for s in free}
            break
        for s in over:
            target[s] = float(repeats * words[s])
            budget -= target[s]
        free -= over
    out = []
    for s in names:
        own = sorted(((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), size(t), i) for i, t, x in rows if x == s), key=lambda r: r[:2])
        axis = 0
        taken = {}
        for place, (_, n, i) in enumerate(own):
            cut = int(target[s] + 1e-9)
            taken[place] = sum(max(0, min(n, cut - e * words[s] - axis)) for e in range(repeats))
            out.append((i, s, n, words[s], round(target[s], 6), taken[place]))
            axis += n
    return sorted(out, key=str)


def test_mix_equals_brute_force(spark, workspace):
    draw = random.Random(2)
    rows = [(i, " ".join("w" * draw.randrange(1, 5) for _ in range(draw.randrange(0, 40))), draw.choice(["b", "a", "ä", "Z", "", None, "hot", "hot", "hot"])) for i in range(150)]
    rows += [(200, None, "a"), (None, "x y z", "a"), (201, "", "lonely"), rows[0], rows[0], (202, "word\x0bword\u00a0word " * 500, "long")]
    docs = spark.createDataFrame([(i, t, s, 1) for i, t, s in rows], "doc_id long, text string, source string, _size int")
    found = mixing.mix_sources(docs, workspace)
    got = sorted(((r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.taken) for r in found.collect()), key=str)
    assert got == brute_mix(rows)
    again = sorted(map(str, mixing.mix_sources(docs.repartition(7), workspace).collect()))
    assert again == sorted(map(str, found.collect()))


def test_mix_of_nothing(spark, workspace):
    schema = "doc_id long, text string, source string"
    assert mixing.mix_sources(spark.createDataFrame([], schema), workspace).count() == 0
    empty = mixing.mix_sources(spark.createDataFrame([(1, "", "a"), (2, None, None)], schema), workspace).collect()
    assert [(r["size"], r.taken) for r in empty] == [(0, 0), (0, 0)]


def brute_judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group(0)
    path = re.match(r"[^?#]*", rest[len(host):]).group(0)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if host and ("." + host).endswith("." + h) and path.startswith(p)]
    return (host, path, *(max(fits)[2:] if fits else (None, "allow")))


def test_urls_equal_brute_force(spark, workspace):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.net", "/en/x", "block"), ("a.example.net", "/", "allow"), ("com", "", "block"),
             ("b.com", "/q", "allow"), ("b.com", "/qq/r", "block"), ("xample.net", "/", "block"), ("net", "/en/xy/long/path", "allow"), ("org", "/é", "block"), ("c.d.org", "/", "allow")]
    draw = random.Random(4)
    hosts = ["net", "example.net", "a.example.net", "z.a.example.net", "xexample.net", "b.com", "B.COM", "a.b.com", "org", "c.d.org", "d.org", "host:80", "", "..net", "a..b.com", "sp ace.net", "\u0001.net"]
    paths = ["", "/", "/en", "/en/", "/en/x", "/en/xy/long/path/z", "/q", "/qq", "/qq/r", "/é/x", "/e", "?q=/en/", "#/", "/a?b#c", "//"]
    urls = [f"{draw.choice(['http', 'https', ''])}://{draw.choice(hosts)}{draw.choice(paths)}" for _ in range(400)] + [None, "", "no scheme/net/", "http://", "a://b://net/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)] + [(0, urls[0], "x"), (None, urls[1], "x")], "page_id long, url string, host string")
    found = url_filter.judge_urls(pages, spark.createDataFrame(rules, "host string, path string, verdict string"), workspace)
    got = sorted((tuple(r) for r in found.collect()), key=str)
    want = [(i, *brute_judge(u, rules)) for i, u in [*enumerate(urls), (0, urls[0]), (None, urls[1])]]
    assert got == sorted(want, key=str)


def test_urls_without_rules_or_rows(spark, workspace):
    schema = "host string, path string, verdict string"
    pages = spark.createDataFrame([(1, "http://a.net/x")], "page_id long, url string")
    none = url_filter.judge_urls(pages, spark.createDataFrame([], schema), workspace).collect()
    assert [tuple(r) for r in none] == [(1, "a.net", "/x", None, "allow")]
    odd = spark.createDataFrame([("a.net", None, "allow"), ("a.net", "", "block"), (None, "/", "block"), ("", "/", "block")], schema)
    assert [tuple(r)[3:] for r in url_filter.judge_urls(pages, odd, workspace).collect()] == [("a.net", "block")]
    assert url_filter.judge_urls(pages.limit(0), odd, workspace).count() == 0
