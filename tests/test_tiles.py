"""Tiles of the scorer against whole rows of scores."""

from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest

from coldspring import kernels
from coldspring.config import ScaleConfig
from coldspring.operators import protocol, scorer
from coldspring.plans import evaluate
from coldspring.plans.experiment import Experiment
from coldspring.sources.tables import Dataset
from tests.conftest import SMALL


class Count:
    def __init__(self):
        self.value = 0

    def add(self, n):
        self.value += n


def lists(draw, of, n):
    return pa.array([draw.choice(of, n, replace=False).tolist() for _ in range(40)], pa.list_(pa.int64()))


@pytest.mark.parametrize("tile_rows", [16, 50, 3000])
def test_tiles_that_cannot_enter_a_list_are_not_scored(tile_rows):
    draw = np.random.default_rng(3)
    n, kinds = 3000, np.eye(12)
    n_item = draw.integers(0, 60, n)
    factors = np.log1p(n_item)[:, None] * draw.uniform(0.8, 1.2, (n, 1))
    features = kinds[draw.integers(0, 12, n)]
    popularity = np.log1p(n_item) / 10
    ids = draw.permutation(10 * n)[:n]
    table = pa.table({"item_id": ids, "n_item": n_item, "pct": n_item / 60, "factors": kernels.to_list_column(factors), "features": kernels.to_list_column(features),
                      "popularity": popularity, "seg_no": pa.array([[1]] * n, pa.list_(pa.int32())), "seg_delta": pa.array([[0.01 * (i % 3)] for i in range(n)]),
                      "tie_break": 1e-6 * np.log1p(n_item)})
    profile = draw.uniform(-1, 1, (40, 12)) * (np.arange(40) % 7 > 0)[:, None]
    users = pa.table({"user_id": np.arange(40), "n_user": np.arange(40) % 7 * 6, "segment_no": (np.arange(40) % 2).astype(np.int32),
                      "factors": kernels.to_list_column(draw.uniform(0, 1, (40, 1)) * (np.arange(40) % 7 > 0)[:, None]),
                      "profile": kernels.to_list_column(profile), "seen": lists(draw, ids, 30), "liked": lists(draw, ids, 30)})
    models = {"pop": {"signal": "popularity"}, "seg": {"signal": "demographic"}, "cf": {"signal": "cf"}, "content": {"signal": "content"}, "fixed": {"mode": "fixed"},
              "switch": {"mode": "switch"}, "adaptive": {"mode": "adaptive", "k_user": 30.0, "k_item": 300.0, "k_content": 30.0}}
    tie = 1e-6 * np.log1p(n_item)
    moments = {"factors_mean": factors.mean(axis=0), "factors_cov": np.cov(factors.T, bias=True).reshape(1, 1), "features_mean": features.mean(axis=0),
               "features_cov": np.cov(features.T, bias=True), "features_tie_cov": ((features - features.mean(axis=0)) * (tie - tie.mean())[:, None]).mean(axis=0),
               "tie_mean": tie.mean(), "tie_var": tie.var(), "popularity_mean": np.array([0.3, 0.4]), "popularity_std": np.array([0.1, 0.1])}
    spec = {"models": models, "k": 10, "digits": 9, "cold_below": 5, "cells": 400_000, "factor_dims": 1, "feature_dims": 12, "parts": False, "only_hits": False,
            "blended": {"cf", "content", "demographic"}, "wanted": {"cf", "content", "demographic", "popularity"}}
    base = np.array([0.0, 0.05])
    items = scorer.item_arrays(table, 1, 12, base, models, tile_rows)
    scored, skipped = Count(), Count()
    best = scorer._best_entries(users, items, moments, spec, counters=(scored, skipped))

    order = np.argsort(ids)
    u = scorer.user_arrays(users, 1, 12)
    delta = np.zeros((2, n))
    delta[1] = 0.01 * (np.arange(n) % 3)
    raw = {"popularity": np.broadcast_to(popularity, (40, n)), "demographic": popularity + base[u["segment"]][:, None] + delta[u["segment"]],
           "cf": u["factors"] @ factors.T, "content": profile @ features.T + profile.any(axis=1)[:, None] * tie}
    z = {s: kernels.standardise(raw[s], *kernels.row_moments(u, moments, {s})[s]) for s in ("cf", "content", "demographic")}
    for name, model in models.items():
        if "signal" in model:
            scores = raw[model["signal"]].copy()
        else:
            shares = kernels.trust(model, u["n_user"], n_item, 5)
            scores = sum(np.broadcast_to(w, (40, n)) * z[s] for w, s in zip(shares, ("cf", "content", "demographic")))
        for row, seen in enumerate(users.column("seen").to_pylist()):
            scores[row, np.isin(ids, seen)] = -np.inf
        rows, ranks, places, values = kernels.best_rows(scores[:, order], 10, 9)
        held = best[name]
        assert held.rows.tolist() == rows.tolist() and held.rank.tolist() == ranks.tolist()
        assert held.entries["l_item"].tolist() == ids[order][places].tolist()
        np.testing.assert_allclose(held.entries["l_score"], values, atol=1e-8)
        liked = [set(x) for x in users.column("liked").to_pylist()]
        assert held.entries["l_hit"].tolist() == [int(i) in liked[r] for r, i in zip(rows, held.entries["l_item"])]
    assert scored.value + skipped.value == 40 * n * len(models)
    if tile_rows == 16:
        assert skipped.value > scored.value


def plain_items(n, models, factors, kinds):
    """Items whose history falls with the id, all popular alike in their segment."""
    table = pa.table({"item_id": np.arange(n), "n_item": np.arange(n)[::-1], "pct": np.zeros(n), "factors": kernels.to_list_column(factors),
                      "features": kernels.to_list_column(kinds), "popularity": np.linspace(1, 0, n), "seg_no": pa.array([[0]] * n, pa.list_(pa.int32())),
                      "seg_delta": pa.array([[0.01 * (i % 5)] for i in range(n)]), "tie_break": np.zeros(n)})
    return scorer.item_arrays(table, factors.shape[1], kinds.shape[1], np.array([0.5]), models, 16)


def plain_users(factors, profile):
    n = len(factors)
    nothing = pa.array([[]] * n, pa.list_(pa.int64()))
    return pa.table({"user_id": np.arange(n), "n_user": np.zeros(n, dtype=np.int64), "segment_no": np.zeros(n, dtype=np.int32),
                     "factors": kernels.to_list_column(factors), "profile": kernels.to_list_column(profile), "seen": nothing, "liked": nothing})


SPEC = {"k": 10, "digits": 9, "cold_below": 5, "cells": 400_000, "factor_dims": 1, "feature_dims": 2, "parts": False, "only_hits": False, "blended": set()}


def test_users_of_whom_nothing_is_known_do_not_score_every_tile():
    """All their scores are 0: the lowest ids win, and tiles of higher ids are left out."""
    models = {"cf": {"signal": "cf"}, "content": {"signal": "content"}}
    draw, n = np.random.default_rng(5), 4800
    items = plain_items(n, models, draw.uniform(0.5, 1, (n, 1)), np.tile([[1.0, 0.0]], (n, 1)))
    scored, skipped = Count(), Count()
    best = scorer._best_entries(plain_users(np.zeros((30, 1)), np.zeros((30, 2))), items, {}, SPEC | {"models": models, "wanted": {"cf", "content"}},
                                counters=(scored, skipped))
    for held in best.values():
        assert held.entries["l_item"].tolist() == list(range(10)) * 30
    assert scored.value + skipped.value == 30 * n * 2
    assert scored.value < 0.2 * skipped.value


@pytest.mark.parametrize("cells", [20, 400_000])
def test_groups_and_tiles_give_the_same_lists(cells):
    """Few cells: groups are scored tile by tile; many: at once. Equal scores are in order of the id either way."""
    models = {"cf": {"signal": "cf"}, "seg": {"signal": "demographic"}}
    n = 700
    factors = (np.arange(n)[:, None] * 7 % 12).astype(float)
    items = plain_items(n, models, factors, np.eye(2)[np.arange(n) % 2])
    x = np.concatenate([np.linspace(0, 1, 9), -np.linspace(0, 1, 2), np.zeros(21)])[:, None]
    best = scorer._best_entries(plain_users(x, np.zeros((32, 2))), items, {}, SPEC | {"models": models, "wanted": {"cf", "demographic"}, "cells": cells})
    for name, scores in (("cf", x @ factors.T), ("seg", np.tile(np.linspace(1, 0, n) + 0.5 + 0.01 * (np.arange(n) % 5), (32, 1)))):
        rows, _, places, values = kernels.best_rows(scores, 10, 9)
        assert best[name].rows.tolist() == rows.tolist() and best[name].entries["l_item"].tolist() == places.tolist()
        np.testing.assert_allclose(best[name].entries["l_score"], values, atol=1e-9)


def many_of_few_kinds(models, n=12_000, kinds=24, items_of=None):
    """Items of few kinds of features whose histories and deltas differ, and users with tastes."""
    draw = np.random.default_rng(8)
    n_item = draw.integers(0, 60, n)
    table = pa.table({"item_id": draw.permutation(n), "n_item": n_item, "pct": n_item / 60, "factors": kernels.to_list_column(np.log1p(n_item)[:, None] * draw.uniform(0.9, 1.1, (n, 1))),
                      "features": kernels.to_list_column(np.eye(kinds)[draw.integers(0, kinds, n)]), "popularity": np.log1p(n_item),
                      "seg_no": pa.array([[0]] * n, pa.list_(pa.int32())), "seg_delta": pa.array(draw.uniform(0, 0.1, (n, 1)).tolist()), "tie_break": 1e-6 * np.log1p(n_item)})
    if items_of is not None:
        table = items_of(table)
    users = plain_users(draw.uniform(0, 1, (60, 1)), draw.uniform(0, 1, (60, kinds)))
    spec = SPEC | {"models": models, "wanted": {"cf", "content", "demographic"}, "blended": {"cf", "content", "demographic"}, "feature_dims": kinds}
    moments = {"factors_mean": np.array([3.0]), "factors_cov": np.eye(1), "features_mean": np.full(kinds, 1 / kinds), "features_cov": np.eye(kinds) / kinds,
               "features_tie_cov": np.zeros(kinds), "tie_mean": 0.0, "tie_var": 0.0, "popularity_mean": np.array([3.0]), "popularity_std": np.ones(1)}
    return users, scorer.item_arrays(table, 1, kinds, np.array([0.5]), models, 128), moments, spec


def test_items_of_few_kinds_are_hardly_scored():
    """Tiles end where the features change, so the content of a tile is that of its items."""
    models = {"content": {"signal": "content"}, "fixed": {"mode": "fixed"}, "switch": {"mode": "switch"},
              "adaptive": {"mode": "adaptive", "k_user": 30.0, "k_item": 300.0, "k_content": 30.0}}
    users, items, moments, spec = many_of_few_kinds(models)
    scored, skipped = Count(), Count()
    scorer._best_entries(users, items, moments, spec, counters=(scored, skipped))
    assert scored.value + skipped.value == 60 * 12_000 * len(models)
    assert scored.value < 0.08 * skipped.value


def test_equal_bounds_are_taken_by_the_lowest_ids():
    """All items of two of the kinds score alike for everyone: only tiles with low ids are looked at."""
    models = {"content": {"signal": "content"}}
    users, items, moments, spec = many_of_few_kinds(models, items_of=lambda t: t.set_column(t.schema.get_field_index("tie_break"), "tie_break", pa.array(np.zeros(t.num_rows))))
    users = users.set_column(users.schema.get_field_index("profile"), "profile", kernels.to_list_column(np.tile(np.eye(24)[3] + np.eye(24)[7], (60, 1))))
    scored, skipped = Count(), Count()
    best = scorer._best_entries(users, items, moments, spec, counters=(scored, skipped))["content"]
    alike = np.sort(items["item_id"][items["distinct"][items["kind"]][:, [3, 7]].any(axis=1)])
    assert best.entries["l_item"].tolist() == alike[:10].tolist() * 60


def test_blocks_are_cut_along_the_order_of_a_model():
    near = protocol.Kernel(lambda users, items, shared: -np.abs(users["factors"][:, :1] * 60 - items["price"][None, :]),
                           lambda users, items, shared: -np.maximum(np.maximum(items["price"].min() - users["factors"][:, 0] * 60, users["factors"][:, 0] * 60 - items["price"].max()), 0),
                           None, {}, {"price": "price"}, lambda items, shared: items["price"])
    prices = np.random.default_rng(9).uniform(0, 60, 12_000)
    models = {"near": {"kernel": near}}
    users, items, moments, spec = many_of_few_kinds(models, items_of=lambda t: t.append_column("price", pa.array(prices)))
    scored, skipped = Count(), Count()
    best = scorer._best_entries(users, items, moments, spec, counters=(scored, skipped))["near"]
    by_id = np.empty(12_000)
    by_id[items["item_id"]] = items["own"]["near"]["price"]
    want = np.argsort(np.abs(scorer.user_arrays(users, 1, 24)["factors"] * 60 - by_id[None, :]), axis=1, kind="stable")[:, :10]
    assert best.entries["l_item"].reshape(60, 10).tolist() == want.tolist()
    assert scored.value + skipped.value == 60 * 12_000
    assert scored.value < 0.5 * skipped.value


def test_equal_features_travel_once_and_lists_are_finished_where_they_are(workspace, frames, monkeypatch):
    plain = replace(SMALL, content=replace(SMALL.content, text_weight=0.0), score_digits=7)
    made = Experiment(Dataset("fixture", *frames, None), plain, workspace)
    users = made.user_state.join(made.liked.select("user_id").distinct(), "user_id", "left_semi")
    size = made.catalog.row_bytes - 8 * made.catalog.feature_dims
    lists = []
    for scale in (ScaleConfig(), ScaleConfig(broadcast_bytes=20 * size, shard_bytes=12 * size)):
        notes = {}
        if scale.broadcast_bytes < 10 ** 6:
            monkeypatch.setattr(scorer, "finish_lists", lambda *args: pytest.fail("lists meet the features in a shuffle"))
        out = scorer.rank_users(users, users.count(), made.catalog, made.moments, made.models(), 4, replace(plain, scale=scale), workspace, made.marks, notes=notes)
        lists.append({(r.model, r.user_id, r.rank): r for r in out.collect()})
    assert notes["scored"] > 0 and lists[0].keys() == lists[1].keys()
    for key, a in lists[0].items():
        b = lists[1][key]
        assert (a.item_id, a.hit, a.n_item, a.n_train) == (b.item_id, b.hit, b.n_item, b.n_train)
        assert a.score == pytest.approx(b.score, abs=1e-9) and a.sim_before == pytest.approx(b.sim_before, abs=1e-9)


def test_nobody_is_ranked_for_tables_that_need_no_lists(experiment, monkeypatch):
    monkeypatch.setattr(scorer, "rank_users", lambda *args, **options: pytest.fail("ranked"))
    results = evaluate.evaluate(experiment)
    facts = evaluate.dataset_facts(experiment, results).first()
    assert facts.eval_users == results.users.count() and facts.cold_item_eval_users == results.cold_users.count()


def test_an_evaluation_refuses_items_that_come_twice(workspace, frames):
    ratings, items, users = frames
    made = Experiment(Dataset("fixture", ratings, items.unionByName(items.limit(1)), users, None), SMALL, workspace)
    with pytest.raises(ValueError, match="catalog has 41 rows for 40 items"):
        evaluate.evaluate(made)
