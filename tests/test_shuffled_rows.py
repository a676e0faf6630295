"""What travels through the shuffles of the wide joins, and how much of it one task takes."""

import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.config import AlsConfig, ScaleConfig, SplitConfig
from coldspring.operators import als, gather
from coldspring.operators import split as splitting
from coldspring.plans import evaluate, serving
from coldspring.sources.tables import rating_rows


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanged(df) -> list[str]:
    """The columns of each shuffle in the plan."""
    mode = df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    found = re.findall(r"\) Exchange\s*\nInput \[\d+\]: \[(.*)\]", df._jdf.queryExecution().explainString(mode))
    assert found
    return found


@pytest.mark.parametrize("limit", [100, 1_000_000])
def test_lines_meet_orders_in_tasks_of_bounded_size(spark, tmp_path, no_broadcast, limit):
    lines = [(n % 40 if n < 300 else 7, n % 11, float(n % 50 + 1)) for n in range(900)] + [(None, 1, 1.0), (99, 1, 1.0)]
    orders = [(n, n * 3, dt.datetime(2020, 1, 1 + n % 9)) for n in range(40)] + [(None, 5, dt.datetime(2020, 1, 1))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    items = spark.createDataFrame([(n,) for n in range(8)], "item_id long")
    when = {n: (dt.datetime(2020, 1, 1 + n % 9) - dt.datetime(1970, 1, 1)).total_seconds() for n in range(40)}
    for kept, wanted in ((None, range(11)), (items, range(8))):
        rows = rating_rows(spark, str(tmp_path), kept, ScaleConfig(rows_per_task=limit, broadcast_ids=1))
        expected = [(o * 3, p, 1.0 + (q - 1) // 10, when[o]) for o, p, q in lines if o in when and p in wanted]
        assert sorted(map(tuple, rows.collect())) == sorted(expected)
        most = rows.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count")).first()[0]
        assert limit > 900 or most < 450         # the long order alone has 608 lines


def test_joins_of_requests_carry_no_ratings(spark, experiment, no_broadcast):
    rating = "ratings array<struct<item_id:bigint,rating:double>>"
    requests = spark.createDataFrame([(1, "cf", 5, None, [(1, 4.0)], "M", 25), (2, "cf", 5, "1", [], None, None),
                                      (3, "cf", 5, None, [(1, 4.0)] * 201, "M", 25)],
                                     f"request_id long, model string, k int, user_id string, {rating}, gender string, age int")
    checked = serving.validate_requests(experiment, requests)
    assert {r.request_id: r.errors for r in checked.collect()} == {1: [], 2: [], 3: ["too_many_ratings"]}
    assert not [c for c in exchanged(checked) if re.search(r"\bratings#", c)]


def test_packed_rows_keep_every_entry():
    draws = np.random.default_rng(3)
    matrix = draws.normal(size=(60, 12)) * (draws.random((60, 12)) < draws.random((60, 1)))
    matrix[4], matrix[5] = 0.0, 1.5
    (of_places, places), (of_values, values) = kernels.pack_rows(matrix)
    assert np.array_equal(kernels.unpack_rows(np.diff(of_places), places, np.diff(of_values), values, 12), matrix)
    assert 12 * len(places) + 8 * (len(values) - len(places)) < matrix.size * 8


def test_shipped_vectors_are_packed(spark, workspace, monkeypatch):
    wide = np.zeros((30, 40))
    wide[np.arange(30), np.arange(30)] = np.arange(30) + 1.0
    rows = spark.createDataFrame([(n, wide[n].tolist()) for n in range(30)], "id long, vec array<double>")
    edges = spark.createDataFrame([(n % 5, n, float(n)) for n in range(30)], "target long, src long, w double")
    scale = ScaleConfig(broadcast_bytes=1, shipped_edges_per_block=8)
    blocks = gather.build_blocks(edges, 30, scale, workspace, "packed", shipped=True)
    summed = gather.gather_sum(blocks, gather.Vectors(rows, 30, 40, scale))
    assert {r.id: r.vec for r in summed.collect()} == {t: sum(n * wide[n] for n in range(t, 30, 5)).tolist() for t in range(5)}
    assert not [c for c in exchanged(summed) if "block#" in c and "vec#" in c]


def test_pairs_carry_no_profile(experiment, no_broadcast):
    rows = evaluate.pair_signals(experiment, experiment.dataset.ratings.select("user_id", "item_id"))
    assert rows.count() == experiment.dataset.ratings.count()
    assert not [c for c in exchanged(rows) if "user_id#" in c and "item_id#" in c and re.search(r"\b(profile|features|seg_no)#", c)]


def test_ratings_meet_short_cold_lists_where_they_are(spark, workspace, frames, no_broadcast):
    cfg = SplitConfig(cold_user_share=0.25, cold_item_share=0.12, min_item_ratings=6)
    rows = [splitting.make_split(frames[0], cfg, scale, workspace).ratings for scale in (ScaleConfig(), ScaleConfig(broadcast_ids=0, rows_per_task=400))]
    short, long = ([c for c in exchanged(r) if "rating#" in c] for r in rows)
    assert len(short) == 1      # the window of the split
    assert len(long) > 1 and rows[1].rdd.getNumPartitions() == 2      # 720 ratings, dealt
    assert sorted(map(tuple, rows[0].collect())) == sorted(map(tuple, rows[1].collect()))


def test_factors_above_their_limit_never_reach_the_driver(everything, workspace, monkeypatch):
    e, cfg, frame = everything, AlsConfig(factors=3, regularization=0.1, iterations=2), type(everything.train_pairs)
    found, sent, collect = [], [], frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda df: sent.append(rows := collect(df)) or rows)
    for scale in (ScaleConfig(), ScaleConfig(renewed_bytes=100, shipped_edges_per_block=50)):
        sent.clear()
        blocks = [als.rating_blocks(e.train_pairs, e.sizes["n_pairs"], scale, workspace, *side, src_bytes=4 * 8 * 40)
                  for side in (("user_id", "item_id", e.user_stats, "n_user"), ("item_id", "user_id", e.item_stats, "n_item"))]
        made = als.fit(*blocks, e.item_stats, e.user_stats, cfg, scale, workspace)
        most = max(t.num_rows for t in sent)
        found.append([{r.id: r.vec for r in df.collect()} for df in (made.users, made.items)])
    assert most == 1 and blocks[0].n_blocks == 15       # sums of outer products
    for plain, shipped in zip(*found):
        assert plain.keys() == shipped.keys()
        np.testing.assert_allclose([shipped[i] for i in plain], list(plain.values()), atol=1e-10)


def test_vectors_for_one_block_travel_as_lists(spark):
    rows = spark.range(3000, numPartitions=2).select("id", (F.col("id") % 3).cast("int").alias("block"), F.transform(
        F.sequence(F.lit(0), F.lit(11)), lambda d: F.when((d + F.col("id")) % 5 == 0, F.col("id") + d * 0.5).otherwise(0.0)).alias("vec"))
    packed = rows.select(F.col("id").alias("src"), "block").join(gather.packed(rows.select(F.col("id").alias("src"), "vec"), 12), "src")
    sent = gather.bundled(packed)
    assert sent.count() <= 3 * packed.rdd.getNumPartitions()
    ids, matrix = gather.unbundled(sent.toArrow(), 12)
    at, d = np.arange(3000)[:, None], np.arange(12)
    assert np.array_equal(matrix[np.argsort(ids)], np.where((at + d) % 5 == 0, at + d * 0.5, 0.0))
    assert gather.unbundled(sent.limit(0).toArrow(), 12)[1].shape == (0, 12)
