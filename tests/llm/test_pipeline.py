import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from coldspring.llm import decontaminate, line_quality
from tests.llm.test_dedup import brute_groups, brute_repeats

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_registered():
    names = entry.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "near duplicates", "repeated passages", "benchmark decontamination", "mix sources"]


def test_stages_equal_brute_force(spark, workspace):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    field = line_quality.fit_lines(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = {r.doc_id for r in line_quality.judge_documents(docs, field).collect() if r.kept}
    rows = {r.doc_id: r.text for r in docs.collect() if r.doc_id in kept}

    one = workspace.stage(corpus_pipeline.quality_rules(spark, docs, FOLDER), "t1")
    assert one.columns == columns and {r.doc_id: r.text for r in one.collect()} == rows

    groups = brute_groups(sorted(rows.items()), 5, 80)
    rows = {i: rows[i] for i, _, component in groups if component in (i, None)}
    two = workspace.stage(corpus_pipeline.near_duplicates(spark, one, FOLDER), "t2")
    assert two.columns == columns and {r.doc_id: r.text for r in two.collect()} == rows

    rows = {r[0]: r[5] for r in brute_repeats(sorted(rows.items()), 50)}
    three = workspace.stage(corpus_pipeline.repeated_passages(spark, two, FOLDER), "t3")
    assert three.columns == columns
    assert {r.doc_id: (r.text, r.n_chars) for r in three.collect()} == {i: (t, len(t)) for i, t in rows.items()}

    items = [(r.item_id, decontaminate.normal(r.text)) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    four = workspace.stage(corpus_pipeline.benchmark_leaks(spark, three, FOLDER), "t4")
    left = {r.doc_id for r in four.collect()}
    assert four.columns == columns and left <= set(rows)
    for i, text in rows.items():
        text = decontaminate.normal(text)
        assert (i in left) or any(decontaminate.Matcher([item], decontaminate.LeakConfig()).leaks(text) for item in items)
        assert i not in left or not any(item in text for _, item in items)

    mixed = corpus_pipeline.mix(spark, four, FOLDER).collect()
    assert {r.doc_id for r in mixed} == left
    assert sum(r.taken for r in mixed) == pytest.approx(1.5 * sum(r["size"] for r in mixed), abs=100)


def test_null_rows_go_through(spark, workspace):
    schema = spark.read.parquet(f"{FOLDER}/documents.parquet").schema
    prose = "\n".join(" ".join(f"word{w * 12 + k}" for k in range(12)) + "." for w in range(20))
    odd = [(None, None, None, None, None), (1, None, "en", "a", 0), (10 ** 9, prose, None, None, None), (None, prose, "en", "b", 5), (10 ** 9 + 1, prose, "de", "a", 9), (4, "", "", "", 0)]
    docs = spark.createDataFrame(odd, schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = workspace.stage(stage(spark, docs, FOLDER), "odd")
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1000000000", "None"]
    docs = spark.createDataFrame([], schema)
    for name, stage in corpus_pipeline.STAGES:
        docs = workspace.stage(stage(spark, docs, FOLDER), "none")
    assert docs.count() == 0
