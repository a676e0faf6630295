from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from coldspring.config import AlsConfig, ContentConfig, ScaleConfig
from coldspring.operators import als, content, gather, metrics, protocol, scorer
from coldspring.plans import analysis, evaluate, serving, tune
from coldspring.plans.experiment import Experiment, eval_users
from coldspring.sources.tables import Dataset
from tests import data
from tests.conftest import SMALL


def matrix(df, n, key="id", value="vec"):
    rows = {r[key]: r[value] for r in df.collect()}
    width = len(next(iter(rows.values())))
    return np.array([rows.get(i, [0.0] * width) for i in range(1, n + 1)])


def train_matrix(experiment, n_users=60, n_items=40):
    out = np.zeros((n_users, n_items))
    for r in experiment.train_pairs.collect():
        out[r.user_id - 1, r.item_id - 1] = r.rating
    return out


def dense_als(ratings, start, cfg):
    """The same alternating solves, written densely."""
    items = start
    for _ in range(cfg.iterations):
        sides = []
        for r in (ratings, ratings.T):
            fixed = items if r is ratings else sides[0]
            gram = fixed.T @ fixed + cfg.regularization * np.eye(cfg.factors)
            out = np.zeros((len(r), cfg.factors))
            for i, row in enumerate(r):
                at = np.flatnonzero(row)
                if len(at):
                    y, w = fixed[at], cfg.alpha * row[at]
                    out[i] = np.linalg.solve(gram + (y.T * w) @ y, y.T @ (1 + w))
            sides.append(out)
        users, items = sides
    return users, items


@pytest.mark.parametrize("scale", [ScaleConfig(), ScaleConfig(edges_per_block=7), ScaleConfig(edges_per_block=50, broadcast_bytes=0)])
def test_als_matches_dense_solution(everything, workspace, scale):
    cfg = AlsConfig(factors=4, regularization=0.1, iterations=3)
    e = everything
    start = matrix(als.initial_items(e.item_stats, cfg), 40)
    blocks = [als.rating_blocks(e.train_pairs, e.sizes["n_pairs"], scale, workspace, *side)
              for side in (("user_id", "item_id", e.user_stats, "n_user"), ("item_id", "user_id", e.item_stats, "n_item"))]
    got = als.fit(*blocks, e.item_stats, e.user_stats, cfg, scale, workspace)
    users, items = dense_als(train_matrix(e), start, cfg)
    np.testing.assert_allclose(matrix(got.users, 60), users, atol=1e-7)
    np.testing.assert_allclose(matrix(got.items, 40), items, atol=1e-7)


@pytest.mark.parametrize("scale", [ScaleConfig(), ScaleConfig(edges_per_block=9, broadcast_bytes=0)])
def test_als_of_rank_128_matches_dense_solution(everything, workspace, scale):
    """More factors than ratings of any user or item; small blocks send the equations of split targets as triangles."""
    cfg = AlsConfig(factors=128, regularization=2.0, iterations=1)
    e = everything
    start = matrix(als.initial_items(e.item_stats, cfg), 40)
    blocks = [als.rating_blocks(e.train_pairs, e.sizes["n_pairs"], scale, workspace, *side)
              for side in (("user_id", "item_id", e.user_stats, "n_user"), ("item_id", "user_id", e.item_stats, "n_item"))]
    got = als.fit(*blocks, e.item_stats, e.user_stats, cfg, scale, workspace)
    users, items = dense_als(train_matrix(e), start, cfg)
    np.testing.assert_allclose(matrix(got.users, 60), users, atol=1e-7)
    np.testing.assert_allclose(matrix(got.items, 40), items, atol=1e-7)
    np.testing.assert_allclose(gather.gram(got.items, "vec", 128), items.T @ items, atol=1e-9)


def test_factors_rank_what_lies_near_higher(everything):
    scores = matrix(everything.factors.users, 60) @ matrix(everything.factors.items, 40).T
    far = np.array([[data.away(u, i) for i in range(1, 41)] for u in range(1, 61)])
    near, opposite = scores[far <= 2].mean(), scores[far >= 14].mean()
    assert near > 0.5 > opposite


def test_new_user_is_placed_by_a_few_ratings(spark, everything, workspace):
    pairs = spark.createDataFrame([(9, 33, 5.0), (9, 34, 4.0), (9, 36, 5.0), (9, 999, 5.0)], "target long, src long, w double")
    vec = als.fold_in(gather.build_blocks(pairs, 4, SMALL.scale, workspace, "fold"), everything.factors, SMALL.als).first().vec
    y = matrix(everything.factors.items, 40)
    w = SMALL.als.alpha * np.array([5.0, 4.0, 5.0])
    some = y[[32, 33, 35]]
    want = np.linalg.solve(y.T @ y + SMALL.als.regularization * np.eye(SMALL.als.factors) + (some.T * w) @ some, some.T @ (1 + w))
    np.testing.assert_allclose(vec, want, atol=1e-8)
    nobody = gather.build_blocks(pairs.filter("target < 0"), 0, SMALL.scale, workspace, "fold")
    assert als.fold_in(nobody, everything.factors, SMALL.als).isEmpty()      # the zero vector has no row


def random_titles(spark, n=300, words=60):
    rng = np.random.default_rng(5)
    names = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(words)]
    rows = [(i + 1, " ".join(rng.choice(names, size=rng.integers(1, 6), p=np.arange(1, words + 1) / sum(range(1, words + 1)))),
             None, []) for i in range(n)]
    return rows, spark.createDataFrame(rows, "item_id long, title string, year int, genres array<string>")


@pytest.mark.parametrize("scale", [ScaleConfig(edges_per_block=100), ScaleConfig(edges_per_block=100, broadcast_bytes=0)])
def test_text_embedding_is_the_truncated_svd(spark, workspace, scale):
    rows, items = random_titles(spark)
    cfg = ContentConfig(text_dims=8, stop_words=())
    weights = content.tfidf_table(items, None, len(rows), cfg, ScaleConfig(), workspace)
    vecs, dims = content.text_embedding(weights, len(rows), cfg, scale, workspace)
    cells = weights.toPandas()
    dense = cells.pivot_table(index="item_id", columns="term", values="w", fill_value=0.0)
    assert np.allclose((dense ** 2).sum(axis=1), 1.0)
    u, s, _ = np.linalg.svd(dense.to_numpy(), full_matrices=False)
    want = u[:, :8] * s[:8]
    got = {r.id: r.vec for r in vecs.collect()}
    got = np.array([got[i] for i in dense.index])
    assert dims == 8
    np.testing.assert_allclose(got @ got.T, want @ want.T, atol=1e-6)


def test_text_embedding_sends_no_vector_of_an_item_to_the_driver(spark, workspace, monkeypatch):
    rows, items = random_titles(spark)
    cfg = ContentConfig(text_dims=2, stop_words=())
    weights = workspace.stage(content.tfidf_table(items, None, len(rows), cfg, ScaleConfig(), workspace), "sent-words")
    sent, collect = [], type(items).toArrow
    monkeypatch.setattr(type(items), "toArrow", lambda df: sent.append(found := collect(df)) or found)
    vecs, _ = content.text_embedding(weights, len(rows), cfg, ScaleConfig(edges_per_block=100), workspace)
    assert 0 < max(t.num_rows for t in sent) <= 60      # words
    monkeypatch.undo()
    assert vecs.count() == weights.select("item_id").distinct().count() > 200


def test_text_embedding_of_many_words_settles_in_ten_passes(spark, workspace):
    """5,000 words by Zipf's law: the basis needs at most ten passes (blocks of 128 directions)."""
    rng = np.random.default_rng(1)
    share = 1 / np.arange(1, 5001)
    rows = [(i + 1, " ".join(f"w{chr(97 + k // 676)}{chr(97 + k // 26 % 26)}{chr(97 + k % 26)}" for k in rng.choice(5000, size=rng.integers(2, 7), p=share / share.sum())))
            for i in range(3000)]
    items = spark.createDataFrame(rows, "item_id long, title string")
    cfg = ContentConfig(stop_words=(), svd_passes=10)
    weights = workspace.stage(content.tfidf_table(items, None, len(rows), cfg, ScaleConfig(), workspace), "many-words")
    vecs, dims = content.text_embedding(weights, len(rows), cfg, ScaleConfig(), workspace)
    cells = weights.toPandas()
    dense = cells.pivot_table(index="item_id", columns="term", values="w", fill_value=0.0)
    _, s, _ = np.linalg.svd(dense.to_numpy(), full_matrices=False)
    got = {r.id: r.vec for r in vecs.collect()}
    gram = np.array([got[i] for i in dense.index])
    gram = gram.T @ gram
    np.testing.assert_allclose(np.diag(gram), s[:64] ** 2, rtol=1e-9)
    np.testing.assert_allclose(gram, np.diag(np.diag(gram)), atol=1e-6)


def test_text_embedding_restarts_from_its_leading_directions(spark, workspace):
    rows, items = random_titles(spark)
    cfg = ContentConfig(text_dims=3, svd_oversample=2, svd_basis=3, stop_words=())
    weights = content.tfidf_table(items, None, len(rows), cfg, ScaleConfig(), workspace)
    vecs, _ = content.text_embedding(weights, len(rows), cfg, ScaleConfig(), workspace)
    dense = weights.toPandas().pivot_table(index="item_id", columns="term", values="w", fill_value=0.0)
    _, s, _ = np.linalg.svd(dense.to_numpy(), full_matrices=False)
    got = np.array([r.vec for r in vecs.collect()])
    np.testing.assert_allclose((got ** 2).sum(axis=0), s[:3] ** 2, rtol=1e-9)


def test_text_embedding_says_when_it_does_not_settle(spark, workspace):
    rows, items = random_titles(spark)
    cfg = ContentConfig(text_dims=8, svd_passes=1, svd_oversample=1, svd_tolerance=1e-12, stop_words=())
    weights = content.tfidf_table(items, None, len(rows), cfg, ScaleConfig(), workspace)
    with pytest.raises(RuntimeError, match="svd_passes"):
        content.text_embedding(weights, len(rows), cfg, ScaleConfig(), workspace)


def test_tags_count_like_joined_text(spark, workspace):
    items = spark.createDataFrame([(1, "alpha beta", None, []), (2, "beta", None, [])],
                                  "item_id long, title string, year int, genres array<string>")
    tags = spark.createDataFrame([(1, "Alpha gamma"), (2, "gamma"), (1, "gamma")], "item_id long, tag string")
    cfg = ContentConfig(stop_words=())
    counts = {(r.item_id, r.term): r.tf for r in content.term_counts(content.text_rows(items, tags), cfg).collect()}
    assert counts == {(1, "alpha"): 2, (1, "beta"): 1, (1, "gamma"): 2, (2, "beta"): 1, (2, "gamma"): 1}


# --- the scorer against brute force --------------------------------------------------

def brute_signals(e):
    x, y = matrix(e.factors.users, 60), matrix(e.factors.items, 40)
    f = matrix(e.features.table, 40, "item_id", "features")
    train = train_matrix(e)
    n_item = (train > 0).sum(axis=0)
    profile = np.where(train > 0, train - 2.5, 0) @ f
    length = np.linalg.norm(profile, axis=1, keepdims=True)
    profile = np.divide(profile, length, out=np.zeros_like(profile), where=length > 0)
    has = profile.any(axis=1)[:, None]
    pop = np.log((n_item + 1) / (n_item.sum() + 40))
    m = 1000.0
    demo = np.log((n_item + m * np.exp(pop)) / (n_item.sum() + m))       # everybody is in one segment
    return {"cf": x @ y.T, "content": profile @ f.T + has * 1e-6 * np.log1p(n_item), "popularity": np.tile(pop, (60, 1)),
            "demographic": np.tile(demo, (60, 1)), "features": f, "train": train, "n_item": n_item}


def z(scores):
    sd = scores.std(axis=1, keepdims=True)
    return np.divide(scores - scores.mean(axis=1, keepdims=True), sd, out=np.zeros_like(scores), where=sd > 1e-12)


def brute_scores(e):
    s = brute_signals(e)
    nu, ni = (s["train"] > 0).sum(axis=1)[:, None], s["n_item"][None, :]
    zc, zb, zp = z(s["cf"]), z(s["content"]), z(s["demographic"])
    cf, t = nu / (nu + 30) * (ni / (ni + 300)), nu / (nu + 30)
    warm = (nu >= 5) & (ni >= 5)
    return s, {scorer.POPULARITY: s["popularity"], scorer.DEMOGRAPHIC: s["demographic"], scorer.CF: s["cf"],
               scorer.CONTENT: s["content"], scorer.FIXED: 0.5 * zc + 0.5 * zb,
               scorer.SWITCH: np.where(warm, zc, np.where(nu > 0, zb, zp)),
               scorer.ADAPTIVE: cf * zc + (1 - cf) * t * zb + (1 - cf) * (1 - t) * zp}


def lists_by_key(df):
    out = {}
    for r in df.orderBy("model", "user_id", "rank").collect():
        out.setdefault((r.model, r.user_id), []).append(r.item_id)
    return out


@pytest.fixture(scope="module")
def results(experiment):
    return evaluate.evaluate(experiment)


def test_lists_match_brute_force(experiment, results):
    s, scores = brute_scores(experiment)
    got = lists_by_key(results.lists)
    users = [r.user_id for r in results.users.collect()]
    assert users
    for model, values in scores.items():
        for u in users:
            row = np.where(s["train"][u - 1] > 0, -np.inf, np.round(values[u - 1], 9))
            want = [i + 1 for i in sorted(range(40), key=lambda i: (-row[i], i)) if np.isfinite(row[i])][:5]
            mine = got[(model, u)]
            assert len(mine) == 5 and not set(mine) & set(np.flatnonzero(s["train"][u - 1]) + 1)
            # Near-equal scores may come in either order; the scores at each rank must agree.
            np.testing.assert_allclose([values[u - 1, i - 1] for i in mine], [values[u - 1, i - 1] for i in want], atol=1e-8)


def test_sharded_plan_gives_the_same_lists(experiment, results):
    tiny = replace(experiment.cfg, scale=ScaleConfig(broadcast_bytes=0, shard_bytes=12 * experiment.catalog.row_bytes,
                                                     cells_per_batch=100))
    lists = scorer.rank_users(experiment.user_state.join(results.users.select("user_id"), "user_id", "left_semi"),
                              results.users.count(), experiment.catalog, experiment.moments, experiment.models(), 5, tiny,
                              experiment.workspace, experiment.marks)
    cut = results.lists.filter("rank <= 5")
    # Re-ranking picks from the same 100 candidates in both plans.
    assert lists_by_key(lists) == lists_by_key(cut)
    a = {(r.model, r.user_id, r.rank): r for r in lists.collect()}
    for r in cut.collect():
        mine = a[(r.model, r.user_id, r.rank)]
        assert (mine.hit, mine.n_item, mine.n_train) == (r.hit, r.n_item, r.n_train)
        assert mine.score == pytest.approx(r.score, abs=1e-9) and mine.sim_before == pytest.approx(r.sim_before, abs=1e-9)


def own_models(experiment):
    """Shared ratings (how many users rated both) as a model from outside, with list columns, a bound and a re-ranker."""
    def together(users, items, shared):
        starts, history = users["history"]
        mates, fans = items["mates"]
        out = np.zeros((len(starts) - 1, len(mates) - 1))
        for i in range(out.shape[1]):
            counts = dict(zip(fans[mates[i]:mates[i + 1]], items["times"][1][mates[i]:mates[i + 1]]))
            for u in range(out.shape[0]):
                out[u, i] = sum(counts.get(j, 0) for j in history[starts[u]:starts[u + 1]]) * shared["scale"]
        return out

    def most(users, items, shared):
        starts, _ = users["history"]
        return np.diff(starts) * (items["times"][1].max() if len(items["times"][1]) else 0) * shared["scale"]

    def backwards(lists, k):
        cells = lists["used"].sum(axis=1)[:, None] - 1 - np.arange(min(k, lists["used"].shape[1]))[None, :]
        return np.maximum(cells, 0), cells >= 0

    pairs = experiment.train_pairs.select("user_id", "item_id")
    both = pairs.join(pairs.withColumnRenamed("item_id", "other"), "user_id").filter("item_id <> other").groupBy("item_id", "other").count()
    mates = both.groupBy("item_id").agg(F.collect_list(F.struct("other", "count")).alias("x")).select(
        "item_id", F.col("x.other").alias("mates"), F.col("x.count").alias("times"))
    own = protocol.OwnModel(together, pairs.groupBy("user_id").agg(F.collect_list("item_id").alias("history")), mates, {"scale": 0.5}, most)
    return {"Together": {"own": own}, "Together, backwards": {"own": own, "rerank": protocol.Reranker(backwards, 6)}, scorer.ADAPTIVE: experiment.models()[scorer.ADAPTIVE]}


@pytest.mark.parametrize("scale", [ScaleConfig(), ScaleConfig(broadcast_bytes=0, shard_bytes=6000, cells_per_batch=70)])
def test_models_from_outside(experiment, results, scale):
    notes = {}
    lists = scorer.rank_users(experiment.user_state.join(results.users.select("user_id"), "user_id", "left_semi"), results.users.count(),
                              experiment.catalog, experiment.moments, own_models(experiment), 4, replace(experiment.cfg, scale=scale),
                              experiment.workspace, experiment.marks, notes=notes)
    got = lists_by_key(lists)
    train = {}
    for r in experiment.train_pairs.collect():
        train.setdefault(r.user_id, set()).add(r.item_id)
    times = np.zeros((41, 41))
    for items in train.values():
        for a in items:
            for b in items - {a}:
                times[a, b] += 0.5
    for u in (r.user_id for r in results.users.collect()):
        seen = train.get(u, set())
        score = {i: sum(times[i, j] for j in seen) for i in range(1, 41) if i not in seen}
        want = sorted(score, key=lambda i: (-score[i], i))
        assert got[("Together", u)] == want[:4]
        assert got[("Together, backwards", u)] == want[:6][::-1][:4]
        assert got[(scorer.ADAPTIVE, u)] == lists_by_key(results.lists)[(scorer.ADAPTIVE, u)][:4] if u == 1 else True
    assert bool(notes) == (scale.broadcast_bytes == 0)


def test_shards_that_cannot_help_are_not_scored(experiment, results):
    users = experiment.user_state.join(results.users.select("user_id"), "user_id", "left_semi")
    models = {scorer.POPULARITY: {"signal": "popularity"}, scorer.DEMOGRAPHIC: {"signal": "demographic"}}
    lists, notes = [], {}
    for scale in (ScaleConfig(), ScaleConfig(broadcast_bytes=0, shard_bytes=8 * experiment.catalog.row_bytes)):
        out = scorer.rank_users(users, results.users.count(), experiment.catalog, experiment.moments, models, 3,
                                replace(experiment.cfg, scale=scale), experiment.workspace, experiment.marks, notes=notes)
        lists.append(lists_by_key(out))
    assert lists[0] == lists[1]
    assert notes["skipped"] > notes["scored"] > 0


def test_large_shared_state_is_refused(experiment):
    own = protocol.OwnModel(lambda users, items, shared: None, shared=b"x" * (2 << 20))
    with pytest.raises(ValueError, match="bytes are shared"):
        protocol.attach({"m": {"own": own}}, experiment.user_state, experiment.catalog.table, ScaleConfig(broadcast_bytes=0))


def test_no_limit_changes_a_result(experiment, results, workspace, frames):
    """Every size limit set so low that each hot-key, split and sharded path is taken."""
    scale = ScaleConfig(rows_per_task=4, max_hot_rows=10 ** 6, edges_per_block=6, shipped_edges_per_block=6, broadcast_ids=0,
                        broadcast_bytes=0, shard_bytes=9 * experiment.catalog.row_bytes, cells_per_batch=50)
    tight = Experiment(Dataset("fixture", *frames, None), replace(experiment.cfg, scale=scale, score_digits=7), workspace)
    loose = Experiment(Dataset("fixture", *frames, None), replace(experiment.cfg, score_digits=7), workspace)
    a, b = (sorted(map(tuple, e.split.ratings.select("user_id", "item_id", "case_id", "in_train").collect())) for e in (tight, loose))
    assert a == b
    frames_ = [evaluate.evaluate(e).summary.toPandas().sort_values(["slice", "model"]).reset_index(drop=True)
               for e in (tight, loose)]
    assert list(frames_[0].model) == list(frames_[1].model)
    for name in ("users", "ndcg@5", "coverage", "novelty", "diversity"):
        np.testing.assert_allclose(frames_[0][name].astype(float), frames_[1][name].astype(float), atol=1e-6, err_msg=name)


def test_metrics_match_brute_force(experiment, results):
    liked = {}
    for r in experiment.liked.collect():
        liked.setdefault(r.user_id, set()).add(r.item_id)
    got = lists_by_key(results.lists)
    f = brute_signals(experiment)["features"]
    frame = results.per_user.toPandas().set_index(["model", "user_id"])
    for (model, u), items in got.items():
        want = sum(1 / np.log2(i + 2) for i, item in enumerate(items[:5]) if item in liked[u])
        want /= sum(1 / np.log2(i + 2) for i in range(min(len(liked[u]), 5)))
        assert frame.loc[(model, u), "ndcg@5"] == pytest.approx(want)
        v = f[np.array(items[:5]) - 1]
        sims = v @ v.T
        assert frame.loc[(model, u), "diversity"] == pytest.approx(1 - (sims.sum() - np.trace(sims)) / 20)
    all_users = results.summary.filter(F.col("slice") == metrics.ALL).toPandas().set_index("model")
    assert all_users.loc[scorer.CF, "ndcg@5"] == pytest.approx(frame.loc[scorer.CF]["ndcg@5"].mean())


def test_cold_lists_hold_cold_items_only(experiment, results):
    cold = {r.item_id for r in evaluate.cold_items(experiment).collect()}
    shown = {r.item_id for r in results.cold_lists.collect()}
    assert shown and shown <= cold
    facts = evaluate.dataset_facts(experiment, results).first()
    assert facts.train_ratings + facts.test_ratings == data.RATINGS and facts.cold_items == len(cold)


def test_similar_items_share_the_genre(experiment):
    near = analysis.similar_items(experiment, 3).toPandas()
    assert len(near) == 120 and (near.item_id != near.neighbour_id).all()
    assert ((near.item_id - 1) // 10 == (near.neighbour_id - 1) // 10).all()


def test_analysis_tables(experiment, results):
    tables = {name: df.toPandas() for name, df in analysis.run_analysis(experiment, results).items()}
    assert len(tables["by_history"]) == 10 and tables["by_history"].users.sum() == results.users.count()
    w = tables["weights"]
    assert np.allclose(w.cf_weight + w.content_weight + w.popularity_weight, 1.0)
    assert tables["mainstreamness"].users.sum() == results.users.filter("n_train >= 5").count()
    assert ((tables["popularity_bias"].share_of_recs_from_head >= 0) & (tables["popularity_bias"].share_of_recs_from_head <= 1)).all()
    assert len(tables["content_ablation"]) == 4 and tables["content_ablation"].ndcg.between(0, 1).all()
    assert 0 < len(tables["case_studies"]) <= 3 and len(tables["hardest_cold_items"]) <= 6
    assert tables["hardest_cold_items"].nearest_by_content.map(len).eq(3).all()


def test_quintile_edges_are_linear_quantiles(spark, workspace):
    rng = np.random.default_rng(2)
    x = rng.random(203)
    df = workspace.stage(spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "user_id long, v double"), "q")
    for limit in (10 ** 6, 25):
        np.testing.assert_allclose(analysis.quintile_edges(df, "v", "user_id", limit, 203),
                                   np.quantile(x, [0.2, 0.4, 0.6, 0.8]))


def test_eval_user_cap_is_a_repeatable_sample(experiment):
    capped = Experiment.__new__(Experiment)
    capped.__dict__.update(experiment.__dict__)
    capped.cfg = replace(experiment.cfg, max_eval_users=7)
    first = sorted(r.user_id for r in eval_users(capped, experiment.liked).collect())
    again = sorted(r.user_id for r in eval_users(capped, experiment.liked.repartition(3)).collect())
    assert len(first) == 7 and first == again


# --- tuning ---------------------------------------------------------------------------

def test_blend_grid_equals_one_fit_per_point(experiment, workspace, frames):
    made = tune.validation_experiment(Dataset("fixture", *frames, None), SMALL, workspace)
    grid = {"k_user": [3.0, 100.0], "k_item": [10.0], "k_content": [3.0, 300.0]}
    table = tune.blend_grid(made, grid).toPandas()
    assert len(table) == 4
    point = table.iloc[0]
    users = eval_users(made, made.liked)
    model = {"mode": "adaptive", "k_user": point.k_user, "k_item": point.k_item, "k_content": point.k_content}
    lists = evaluate.ranked(made, users, {"m": model}, 5, "one-point")
    frame = metrics.per_user(lists, users, ["m"], [5], 5, 60).toPandas()
    assert point.warm_users == pytest.approx(frame[frame.n_train >= 5]["ndcg@5"].mean())
    assert point.cold_users == pytest.approx(frame[frame.n_train < 5]["ndcg@5"].mean())
    values = np.maximum([point.warm_users, point.cold_users, point.cold_items], 1e-9)
    assert point.objective == pytest.approx(np.exp(np.log(values).mean()))


def test_run_tuning_with_factor_grid(workspace, frames):
    out = tune.run_tuning(Dataset("fixture", *frames, None), SMALL, workspace, include_als=True,
                          als_points={"factors": [2, 3], "regularization": [1.0], "alpha": [1.0]},
                          blend_points={"k_user": [10.0], "k_item": [10.0], "k_content": [10.0]})
    assert out["als"]["factors"] in (2, 3) and out["blend"] == {"k_user": 10.0, "k_item": 10.0, "k_content": 10.0}
    assert out["als_grid"].count() == 2


# --- serving ------------------------------------------------------------------------------

def test_recommend_known_users(spark, experiment):
    out = serving.recommend_users(experiment, spark.createDataFrame([(1,), (31,)], "user_id long"), 2, ["adaptive", "cf"], 5)
    rows = out.toPandas()
    assert rows.groupby(["model", "user_id"]).size().eq(5).all()
    ours = rows[rows.model == "adaptive"]
    np.testing.assert_allclose(ours.cf + ours.content + ours.popularity, ours.score, atol=1e-8)
    np.testing.assert_allclose(ours.w_cf + ours.w_content + ours.w_popularity, 1.0)
    assert rows[rows.model == "cf"].cf.isna().all()
    train = train_matrix(experiment)
    assert all(train[r.user_id - 1, r.item_id - 1] == 0 for r in rows.itertuples())


@pytest.mark.parametrize("diversify", [False, True])
def test_recommend_new_users(spark, experiment, diversify):
    requests = spark.createDataFrame([(1, "F", 25), (2, None, None)], "request_id long, gender string, age int")
    ratings = spark.createDataFrame([(1, 25, 5.0)], "request_id long, item_id long, rating double")
    out = serving.recommend_new_users(experiment, requests, ratings, list(serving.MODEL_KEYS), 5, diversify).toPandas()
    assert (out.groupby(["model", "request_id"]).size() == 5).all() and out.model.nunique() == 6
    assert not ((out.request_id == 1) & (out.item_id == 25)).any()
    assert set(out[out.request_id == 1].history_size) == {1} and set(out[out.request_id == 2].history_size) == {0}
    nobody = out[(out.request_id == 2) & (out.model == "adaptive")]
    assert (nobody.w_cf == 0).all() and (nobody.w_popularity == 1).all()
    best = brute_signals(experiment)["popularity"][0]
    if not diversify:
        assert best[nobody.sort_values("rank").item_id.iloc[0] - 1] == pytest.approx(best.max())


def test_mean_weights_match_the_average_over_items(experiment):
    shares = {r.user_id: r for r in serving.mean_weights(experiment).collect()}
    switch = {r.user_id: r for r in serving.mean_weights(experiment, "switch").collect()}
    s = brute_signals(experiment)
    watched, ni = s["n_item"] / s["n_item"].sum(), s["n_item"]
    for u in (1, 17, 45):
        n = (s["train"][u - 1] > 0).sum()
        assert shares[u].cf_weight == pytest.approx((n / (n + 30) * ni / (ni + 300)) @ watched)
        assert switch[u].cf_weight == pytest.approx(((n >= 5) & (ni >= 5)).astype(float) @ watched)
        assert switch[u].cf_weight + switch[u].content_weight + switch[u].popularity_weight == pytest.approx(1.0)


def test_search_history_and_examples(spark, experiment):
    queries = spark.createDataFrame([("glacier",), ("t",), (" MARKET upper ",), ("zzz",), ("r li",), ("OU",)], "query string")
    found = serving.search(experiment, queries).toPandas()
    assert set(found["query"]) == {"glacier", " MARKET upper ", "r li", "OU"}
    assert found[found["query"] == "glacier"].title.str.contains("Glacier").all() and (found.groupby("query").size() <= 8).all()
    for _, rows in found.sort_values("rank").groupby("query"):
        assert rows.n_item.is_monotonic_decreasing
    history = serving.user_history(experiment, 3).toPandas()
    assert history.groupby("user_id").size().max() == 3
    examples = {r.label: r for r in serving.example_users(experiment).collect()}
    assert all(r.ratings == {"new sign-up": 0, "1 rating": 1, "3 ratings": 3}.get(label, r.ratings) for label, r in examples.items())
    assert serving.meta(experiment).first().items == 40
    assert serving.user_summary(experiment).filter("user_id = 1").first().age == "35-44"


def test_request_validation(spark, experiment):
    schema = ("request_id long, model string, k int, user_id string, "
              "ratings array<struct<item_id:bigint,rating:double>>, gender string, age int")
    rows = [(1, "adaptive", 5, "1", [], None, None), (2, "adaptive", 5, "99999", [], None, None),
            (3, "adaptive", 5, "abc", [], None, None), (4, "adaptive", 0, "1", [], None, None),
            (5, "adaptive", 10, None, [(99999, 4.0)], None, None), (6, "adaptive", 10, None, [(1, 9.0)], None, None),
            (7, "adaptive", 10, None, [], "X", None), (8, "nope", 10, None, [], None, None),
            (9, "cf", 50, None, [(1, 5.0)] * 201, "F", 26), (10, "cf", 50, None, [(1, 0.5)], "M", 18),
            (11, "cf", 51, None, [(None, 4.0)], "M", 18)]
    got = {r.request_id: list(r.errors) for r in serving.validate_requests(
        experiment, spark.createDataFrame(rows, schema)).collect()}
    assert got == {1: [], 2: ["unknown_user"], 3: ["bad_user_id"], 4: ["bad_k"], 5: ["unknown_item"], 6: ["rating_range"],
                   7: ["bad_gender"], 8: ["unknown_model"], 9: ["too_many_ratings", "bad_age"], 10: [], 11: ["bad_k", "bad_entry"]}
