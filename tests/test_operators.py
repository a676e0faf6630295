import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.config import ScaleConfig, SplitConfig
from coldspring.functions import buckets, text, vectors
from coldspring.operators import gather, metrics, popularity, skew, split, weights
from coldspring.config import BlendConfig
from tests import data


# --- skew-safe building blocks ---------------------------------------------------

def skewed(spark, n=6000):
    """A third of the rows share key 0."""
    return spark.range(n).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
                                 F.pmod(F.xxhash64("id"), F.lit(97)).alias("t"), "id")


@pytest.mark.parametrize("limit", [10 ** 6, 200, 37])
def test_positions_of_hot_groups_are_exact(spark, limit):
    df = skewed(spark)
    got = skew.with_position(df, ["k"], ["t", "id"], limit, sums={"upto": "t"}).toPandas()
    want = df.toPandas().sort_values(["k", "t", "id"])
    want["_pos"] = want.groupby("k").cumcount()
    want["_size"] = want.groupby("k")["id"].transform("size")
    want["upto"] = want.groupby("k")["t"].cumsum()
    merged = got.merge(want, on=["k", "t", "id"], suffixes=("", "_want"))
    assert len(merged) == len(df.toPandas())
    for name in ("_pos", "_size", "upto"):
        assert (merged[name] == merged[f"{name}_want"]).all()


def test_positions_count_rows_without_a_key(spark):
    df = spark.createDataFrame([(None if i % 3 else i % 2, i % 7, i) for i in range(200)], "k int, t int, id int")
    got = skew.with_position(df, ["k"], ["t", "id"], 20).toPandas()
    want = df.toPandas().sort_values(["t", "id"])
    want["_pos"] = want.groupby("k", dropna=False).cumcount()
    merged = got.merge(want, on="id", suffixes=("", "_want"))
    assert len(merged) == 200 and (merged["_pos"] == merged["_pos_want"]).all()


def test_no_task_holds_a_hot_group(spark):
    """The window of a group of 5,000 rows runs over ranges of some hundred."""
    df = skew.with_position(spark.range(5000).select((F.col("id") % 1).alias("k"), "id"), ["k"], ["id"], 500)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_range" in plan and "_cuts" not in plan
    ranges = df.sparkSession.read.parquet(df.inputFiles()[0].rsplit("/", 1)[0])
    assert ranges.groupBy("_range").count().agg(F.max("count")).first()[0] < 2000


def test_global_positions_do_not_need_one_task(spark):
    df = skewed(spark)
    got = skew.with_position(df, [], ["t", "id"], 100).toPandas().sort_values(["t", "id"])
    assert list(got["_pos"]) == list(range(len(got)))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_spread_join_equals_plain_join(spark, how):
    left = skewed(spark)
    right = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 7).alias("v"))
    hot = skew.hot_keys(left.groupBy("k").agg(F.count("*").alias("n")), "k", "n", 100)
    got = skew.spread_join(left, right, "k", hot, "id", how).select("k", "id", "v").toPandas()
    want = left.join(right, "k", how).select("k", "id", "v").toPandas()
    order = ["id"]
    pd.testing.assert_frame_equal(got.sort_values(order).reset_index(drop=True),
                                  want.sort_values(order).reset_index(drop=True))


def test_first_per_group_limits_before_the_shuffle(spark):
    df = skew.first_per_group(skewed(spark), ["k"], [F.col("t"), F.col("id")], 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert df.groupBy("k").count().agg(F.max("count")).first()[0] == 3


# --- split ------------------------------------------------------------------------

CFG = SplitConfig(cold_user_share=0.2, cold_item_share=0.2, min_item_ratings=5)


@pytest.fixture(scope="module")
def made(frames, workspace):
    out = split.make_split(frames[0], CFG, ScaleConfig(), workspace)
    return out.ratings.toPandas(), set(out.cold_users.toPandas().user_id), set(out.cold_items.toPandas().item_id)


def test_split_keeps_every_row_and_cold_limits(frames, made):
    rows, cold_users, cold_items = made
    assert len(rows) == data.RATINGS and not rows.duplicated(["user_id", "item_id"]).any()
    assert len(cold_users) == 12 and len(cold_items) == 8
    train = rows[rows.in_train]
    assert all(train.user_id.value_counts().get(u, 0) < CFG.cold_below for u in cold_users)
    assert all(train.item_id.value_counts().get(i, 0) < CFG.cold_below for i in cold_items)


def test_split_does_not_leak_the_future(made):
    rows, cold_users, cold_items = made
    warm = rows[~rows.user_id.isin(cold_users) & ~rows.item_id.isin(cold_items)]
    for _, mine in warm.groupby("user_id"):
        train, test = mine[mine.in_train], mine[~mine.in_train]
        assert len(test) == math.floor(len(mine) * 0.2)
        if len(test):
            assert train.ts.max() <= test.ts.min()


def test_split_is_the_same_on_any_partitioning_and_with_hot_groups(frames, made, workspace):
    for partitions, scale in ((1, ScaleConfig()), (13, ScaleConfig(rows_per_task=5))):
        again = split.make_split(frames[0].repartition(partitions), CFG, scale, workspace).ratings.toPandas()
        order = ["user_id", "item_id"]
        pd.testing.assert_frame_equal(again.sort_values(order).reset_index(drop=True),
                                      made[0].sort_values(order).reset_index(drop=True))


def test_other_seed_gives_other_split(frames, made, workspace):
    other = split.make_split(frames[0], SplitConfig(seed=3, cold_user_share=0.2, cold_item_share=0.2, min_item_ratings=5),
                             ScaleConfig(), workspace)
    assert set(other.cold_users.toPandas().user_id) != made[1]


# --- gathers ------------------------------------------------------------------------

def edges(spark, seed=0, n=3000):
    rng = np.random.default_rng(seed)
    target = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 60, n))      # one hot target
    rows = pd.DataFrame({"target": target, "src": rng.integers(0, 80, n), "w": rng.integers(1, 6, n).astype(float)})
    rows = rows.drop_duplicates(["target", "src"])
    vecs = rng.normal(size=(80, 6))
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vec array<double>")
    return rows, vecs, spark.createDataFrame(rows), table


PLANS = [ScaleConfig(), ScaleConfig(edges_per_block=20), ScaleConfig(edges_per_block=20, broadcast_bytes=0),
         ScaleConfig(edges_per_block=20, broadcast_bytes=0, rows_per_task=30, max_hot_rows=100)]


@pytest.mark.parametrize("scale", PLANS)
def test_gather_sum_matches_numpy(spark, workspace, scale):
    rows, vecs, df, table = edges(spark)
    blocks = gather.build_blocks(df, len(rows), scale, workspace, "t")
    assert blocks.has_split == (scale.edges_per_block == 20)
    got = {r.id: r.vec for r in gather.gather_sum(blocks, gather.Vectors(table, 80, 6, scale)).collect()}
    for target, mine in rows.groupby("target"):
        want = (vecs[mine.src] * mine.w.to_numpy()[:, None]).sum(axis=0)
        np.testing.assert_allclose(got[target], want, atol=1e-9)


@pytest.mark.parametrize("scale", PLANS)
def test_gather_ridge_matches_numpy(spark, workspace, scale):
    rows, vecs, df, table = edges(spark, 1)
    source = gather.Vectors(table, 80, 6, scale)
    gram = source.gram() + 0.3 * np.eye(6)
    np.testing.assert_allclose(gram, vecs.T @ vecs + 0.3 * np.eye(6), atol=1e-9)
    blocks = gather.build_blocks(df, len(rows), scale, workspace, "t")
    got = {r.id: r.vec for r in gather.gather_ridge(blocks, source, gram).collect()}
    assert len(got) == rows.target.nunique()
    for target, mine in rows.groupby("target"):
        y, w = vecs[mine.src], mine.w.to_numpy()
        want = np.linalg.solve(gram + (y.T * w) @ y, y.T @ (1 + w))
        np.testing.assert_allclose(got[target], want, atol=1e-8)


@pytest.mark.parametrize("scale", PLANS)
def test_ridge_of_weights_of_any_sign(spark, workspace, scale):
    """More dimensions than edges for most targets (the small system), negative weights and weights of 0."""
    rows, _, _, _ = edges(spark, 2)
    rng = np.random.default_rng(9)
    rows["w"] = np.where(rng.random(len(rows)) < 0.3, 0.0, rng.uniform(-0.02, 0.3, len(rows)))
    vecs = rng.normal(size=(80, 24))
    table = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vecs)], "id long, vec array<double>")
    source = gather.Vectors(table, 80, 24, scale)
    gram = source.gram() + 3.0 * np.eye(24)
    blocks = gather.build_blocks(spark.createDataFrame(rows), len(rows), scale, workspace, "t")
    got = {r.id: r.vec for r in gather.gather_ridge(blocks, source, gram).collect()}
    for target, mine in rows.groupby("target"):
        y, w = vecs[mine.src], mine.w.to_numpy()
        np.testing.assert_allclose(got[target], np.linalg.solve(gram + (y.T * w) @ y, y.T @ (1 + w)), atol=1e-8)


def test_edges_are_not_shuffled_again(spark, workspace):
    rows, _, df, table = edges(spark)
    scale = ScaleConfig(edges_per_block=100)
    blocks = gather.build_blocks(df, len(rows), scale, workspace, "t")
    plan = gather.gather_sum(blocks, gather.Vectors(table, 80, 6, scale))._jdf.queryExecution().executedPlan().toString()
    # Exchanges belong to the summing of split targets, above the per-block step.
    assert "Exchange" not in plan[plan.rindex("FlatMapGroupsInArrow"):]


def test_weighted_sums_in_chunks():
    rng = np.random.default_rng(0)
    t, s, w, v = rng.integers(0, 9, 200), rng.integers(0, 20, 200), rng.random(200), rng.normal(size=(20, 3))
    ids, sums = kernels.weighted_sums(t, s, w, np.arange(20), v, chunk=7)
    for i, row in zip(ids, sums):
        np.testing.assert_allclose(row, (v[s[t == i]] * w[t == i][:, None]).sum(axis=0))


# --- metrics, weights, text -----------------------------------------------------------

def lists_of(spark, rows):
    return spark.createDataFrame(rows, "model string, user_id long, rank int, item_id long, n_item long, sim_before double")


def test_metrics_of_known_lists(spark):
    """Relevant: 20 and 40 for user 7, five items for user 8, one item for user 9, who has no list."""
    shown = {7: [10, 20, 30, 40, 50, 60], 8: [1, 2, 3, 4, 5, 6]}
    lists = lists_of(spark, [("a", u, r, i, 0, 0.0) for u, items in shown.items() for r, i in enumerate(items, 1)])
    relevant = {7: {20, 40}, 8: {1, 2, 3, 4, 90}, 9: {5}}
    truth = spark.createDataFrame([(u, i) for u, items in relevant.items() for i in items], "user_id long, item_id long")
    users = spark.createDataFrame([(u, len(items), 3) for u, items in relevant.items()], "user_id long, n_relevant long, n_train long")
    out = metrics.per_user(metrics.flag_hits(lists, truth), users, ["a"], [1, 2, 6], 6, 10).toPandas().set_index("user_id")
    for user, items in relevant.items():
        for k in (1, 2, 6):
            hits = [i in items for i in shown.get(user, [])[:k]]
            gain = sum(1 / math.log2(place + 2) for place, hit in enumerate(hits) if hit)
            most = sum(1 / math.log2(place + 2) for place in range(min(k, len(items))))
            got = out.loc[user]
            assert got[f"precision@{k}"] == pytest.approx(sum(hits) / k) and got[f"recall@{k}"] == pytest.approx(sum(hits) / len(items))
            assert got[f"hit@{k}"] == float(any(hits)) and got[f"ndcg@{k}"] == pytest.approx(gain / most)


def test_catalog_share_and_list_spread(spark):
    rows = [("a", u, r, 3 * u + r, 2, 0.25 * (r - 1)) for u in (1, 2, 3) for r in (1, 2, 3)]     # items 4..12, none twice
    lists = lists_of(spark, rows)
    assert metrics.coverage(lists, 2, 30, F.array(F.lit("all"))).first().coverage == pytest.approx(6 / 30)
    users = spark.createDataFrame([(u, 1, 9) for u in (1, 2, 3)], "user_id long, n_relevant long, n_train long")
    frame = metrics.per_user(lists.withColumn("hit", F.lit(False)), users, ["a"], [3], 3, 14).toPandas()
    # the cosines of a list of three add up to 0 + 0.25 + 0.5 over 3 pairs
    assert np.allclose(frame["diversity"], 1 - 0.75 / 3)


def test_slices_without_users_are_listed(spark):
    lists = lists_of(spark, [("a", u, r, u + r, 2, 0.0) for u in (1, 2) for r in (1, 2)]).withColumn("hit", F.lit(True))
    users = spark.createDataFrame([(1, 1, 9), (2, 2, 3)], "user_id long, n_relevant long, n_train long")
    frame = metrics.per_user(lists, users, ["a", "b"], [2], 2, 14)
    slices = metrics.slices_of(F.col("n_train"), 5)
    lists = lists.join(users, "user_id")
    out = {(r.slice, r.model): r for r in metrics.summarise(frame, lists, [2], 2, 10, slices, metrics.slice_names(5), ["a", "b"]).collect()}
    assert len(out) == 16
    assert (out[metrics.ALL, "a"].users, out[metrics.ALL, "a"].coverage) == (2, 0.3) and out[metrics.warm_slice(5), "a"].coverage == 0.2
    nobody = out[metrics.exact_slice(0), "a"]
    assert (nobody.users, nobody["ndcg@2"], nobody.coverage, nobody.novelty, nobody.diversity) == (0, None, 0.0, 0.0, 0.0)
    assert out[metrics.ALL, "b"].users == 2 and out[metrics.ALL, "b"]["ndcg@2"] == 0.0


def test_title_parsing(spark):
    cases = {"Harbour at Dusk, The (2003)": ("The Harbour at Dusk", 2003), "Lanterns": ("Lanterns", None), "Lanterns, An": ("An Lanterns", None),
             "  Orchard Keeper, The (Le Verger) (1971) ": ("The Orchard Keeper (Le Verger)", 1971), "Orchard Keeper, The (19712)": ("The Orchard Keeper (19712)", None),
             "Glacier, A (1964)": ("A Glacier", 1964), "2010 (1984) b": ("2010 (1984) b", None)}
    df = spark.createDataFrame([(k,) for k in cases], "raw string")
    for row in df.select("raw", text.clean_title(F.col("raw")).alias("t"), text.title_year(F.col("raw")).alias("y")).collect():
        assert (row.t, row.y) == cases[row.raw]


def test_tokens(spark):
    df = spark.createDataFrame([("The Matrix's 2nd Édition x a1 don't",)], "t string")
    got = df.select(text.tokens(F.col("t"), ("the",))).first()[0]
    import re
    want = [w for w in re.findall(r"(?u)\b[a-z][a-z0-9']+\b", "The Matrix's 2nd Édition x a1 don't".lower()) if w != "the"]
    assert got == want


def test_buckets(spark):
    df = spark.createDataFrame([(n,) for n in (0, 4, 5, 19, 20, 199, 200, 5000)], "n long")
    got = [r[0] for r in df.select(buckets.history_bucket(F.col("n"))).collect()]
    assert got == ["0", "4", "5-19", "5-19", "20-49", "100-199", "200+", "200+"]
    df = spark.createDataFrame([(2.99,), (3.0,), (3.99,), (4.0,)], "m double")
    assert [r[0] for r in df.select(buckets.rating_band(F.col("m"))).collect()] == [
        "mostly dislikes (<3)", "lukewarm (3-4)", "lukewarm (3-4)", "mostly likes (>=4)"]
    df = spark.createDataFrame([(1.2, 1.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(buckets.lift_percent(F.col("a"), F.col("b"))).collect()] == [20, None]


def test_trust_moves_with_both_histories(spark):
    grid = [(u, i) for u in (0, 1, 4, 5, 60, 900) for i in (0, 3, 5, 250)]
    df = spark.createDataFrame(grid, "u long, i long")
    cfg = BlendConfig(k_user=20, k_item=40, k_content=8)
    for mode in ("adaptive", "fixed", "switch"):
        w = weights.pair_weights(F.col("u"), F.col("i"), cfg, mode, 5)
        got = {(r.u, r.i): r for r in df.select("u", "i", *[w[s].alias(s) for s in weights.SIGNALS]).collect()}
        for (u, i), row in got.items():
            cf, text_share = u / (u + 20) * i / (i + 40), u / (u + 8)
            both = u >= 5 and i >= 5
            want = {"adaptive": (cf, (1 - cf) * text_share, (1 - cf) * (1 - text_share)), "fixed": (0.5, 0.5, 0.0),
                    "switch": (float(both), float(not both and u > 0), float(not both and u == 0))}[mode]
            assert (row.cf, row.content, row.popularity) == pytest.approx(want)


def test_standard_scores_use_the_given_moments():
    raw = np.array([[4.0, 8.0, 6.0, 2.0], [7.0, 7.0, 7.0, 7.0], [0.0, 1.0, 2.0, 9.0]])
    z = kernels.standardise(raw, raw.mean(axis=1), raw.std(axis=1), np.array([True, True, False]))
    assert np.allclose(z[0] * raw[0].std() + raw[0].mean(), raw[0]) and not z[1].any() and not z[2].any()


def test_vector_expressions(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "v array<double>")
    assert [r[0] for r in df.select(vectors.unit("v")).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_best_rows_break_ties_by_position():
    scores = np.array([[1.0, 3.0, 3.0 + 1e-13, 2.0, -np.inf], [-np.inf] * 5, [0.0] * 5])
    rows, ranks, places, values = kernels.best_rows(scores, 3, 12)
    assert list(places[rows == 0]) == [1, 2, 3] and not (rows == 1).any() and list(places[rows == 2]) == [0, 1, 2]


def test_reranking_of_many_lists_at_once():
    rng = np.random.default_rng(3)
    sizes, cells, picks = [30, 5, 1, 17], 30, 8
    scores, pct, vecs = rng.random((4, cells)), rng.random((4, cells)), rng.normal(size=(4, cells, 5))
    vecs /= np.linalg.norm(vecs, axis=2)[:, :, None]
    used = np.arange(cells)[None, :] < np.array(sizes)[:, None]
    got, counts = kernels.diversified(scores, pct, vecs, used, picks, 0.7, 0.1, 12)
    for row, size in enumerate(sizes):
        s = scores[row, :size]
        worth = ((s - s.min()) / (s.max() - s.min()) if size > 1 else np.ones(1)) - 0.1 * pct[row, :size]
        mine = got[row][counts[row]].tolist()
        assert len(mine) == min(size, picks) and len(set(mine)) == len(mine)
        for at, pick in enumerate(mine):     # no other free cell is worth more
            value = [0.7 * worth[c] - 0.3 * max([0.0, *(float(vecs[row, c] @ vecs[row, m]) for m in mine[:at])]) for c in range(size)]
            assert value[pick] == pytest.approx(max(v for c, v in enumerate(value) if c not in mine[:at]))


def test_similarity_before_adds_up_to_all_pairs():
    v = np.random.default_rng(4).normal(size=(3, 6, 4))
    got = kernels.similarity_before(v)
    for row in range(3):
        assert got[row, 0] == 0 and np.allclose(got[row], [sum(v[row, c] @ v[row, d] for d in range(c)) for c in range(6)])


def test_padding_of_flat_lists():
    cells, used = kernels.padded(np.array([0, 3, 4]), np.array([3, 1, 2]))
    assert cells[used].tolist() == [0, 1, 2, 3, 4, 5] and used.sum(axis=1).tolist() == [3, 1, 2]


def test_many_segments_are_kept_as_deltas(spark, workspace):
    """3,000 segments of one or two users each: an item stores only the segments that have rated it."""
    scale = ScaleConfig()
    pairs = spark.createDataFrame([(u, (u * 7 + j) % 50) for u in range(4000) for j in range(3)], "user_id long, item_id long")
    segments_of = spark.createDataFrame([(u, f"s{u % 3000:04d}") for u in range(4000) if u % 5], "user_id long, segment string")
    stats = workspace.stage(spark.range(60).withColumnRenamed("id", "item_id").join(pairs.groupBy("item_id").count(), "item_id", "left")
                            .select("item_id", F.coalesce("count", F.lit(0)).alias("n_item")), "stats")
    counts = workspace.stage(popularity.segment_counts(pairs, segments_of, None), "counts")
    found = popularity.number_segments(segments_of, counts, 10.0, scale, workspace)
    vectors = workspace.stage(popularity.segment_vectors(stats, counts, found, 12_000, 60, 10.0), "vectors")
    assert found.n == segments_of.select("segment").distinct().count() and len(found.base) == found.n + 1
    assert vectors.agg(F.sum(F.size("seg_no"))).first()[0] == counts.count()
    n_item, n, total = {r.item_id: r.n_item for r in stats.collect()}, {}, {}
    for r in counts.collect():
        n[r.segment, r.item_id] = r.n
        total[r.segment] = total.get(r.segment, 0) + r.n
    scores = popularity.segment_table(vectors, found)
    assert scores.count() == 60 * found.n
    for r in scores.filter(F.col("segment") < "s0020").collect():
        g = (n_item[r.item_id] + 1) / 12_060
        assert r.score == pytest.approx(math.log((n.get((r.segment, r.item_id), 0) + 10 * g) / (total.get(r.segment, 0) + 10)), abs=1e-12)
    with pytest.raises(ValueError, match="smoothing"):
        popularity.number_segments(segments_of, counts, 0.0, scale, workspace)
