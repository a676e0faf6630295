"""Score users against the catalog and keep the best k items of each user and model.

The user x item matrix never leaves a task: a batch of users is scored against the catalog
with NumPy, seen items are masked, and only k rows per (model, user) come out.

Two plans, chosen by the measured size of the catalog:
* it fits ``broadcast_bytes``: one map over the users;
* else the catalog is cut into shards of ``shard_bytes``, most rated items first. One shard at a time is
  broadcast, merged into the lists that travel with the users, and destroyed. A list that is full carries the score
  of its last row; a shard whose bound for this user and model (from the largest norms of its items) is below it is
  not scored. Neither users nor catalog are copied or shuffled again.
Users and their seen items meet in one shuffle by user, in both plans.
Z-scores need each user's mean and spread over the whole catalog; both plans take them
from the mean and covariance of the item vectors, so they agree.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring import kernels
from coldspring.config import EngineConfig
from coldspring.operators import gather, protocol
from coldspring.operators.skew import lookup, with_position
from coldspring.workspace import Workspace

# The display names of the compared models.
POPULARITY = "Popularity"
DEMOGRAPHIC = "Popularity (demographic)"
CF = "CF only (ALS)"
CONTENT = "Content only"
FIXED = "Hybrid 50/50 fixed"
SWITCH = "Hybrid switch at 5"
ADAPTIVE = "Hybrid adaptive"
MMR = "Hybrid adaptive + MMR re-rank"

GROUP = 16     # tiles that are bounded together before each of them is (twice as many of one kind of features)
FEW = 16       # items that a tile has at least before it ends where the features change
HELD = 16      # bounds held at once, in batches of cells

PARTS = ["cf", "content", "popularity", "w_cf", "w_content", "w_popularity"]


def registry(cfg: EngineConfig, demographics: bool = True) -> dict[str, dict]:
    """Model name -> how it is scored. A ``signal`` ranks by its raw score, a ``mode`` by the
    weighted z-scores, ``own`` (see ``protocol``) by a model from outside; ``rerank`` (or ``mmr`` for the built-in
    one) picks from the best candidates of any of them."""
    adaptive = {"mode": "adaptive", "k_user": cfg.blend.k_user, "k_item": cfg.blend.k_item,
                "k_content": cfg.blend.k_content}
    models = {POPULARITY: {"signal": "popularity"}, DEMOGRAPHIC: {"signal": "demographic"},
              CF: {"signal": "cf"}, CONTENT: {"signal": "content"},
              FIXED: {"mode": "fixed"}, SWITCH: {"mode": "switch"}, ADAPTIVE: adaptive,
              MMR: {**adaptive, "mmr": True}}
    if not demographics:
        del models[DEMOGRAPHIC]
    return models


def _with_rerankers(models: dict[str, dict], cfg: EngineConfig) -> dict[str, dict]:
    built_in = protocol.Reranker(protocol.Diversifier(cfg.rerank.mmr_lambda, cfg.rerank.popularity_penalty, cfg.score_digits),
                                 cfg.rerank.candidates)
    return {name: {**model, "rerank": built_in} if model.get("mmr") else model for name, model in models.items()}


@dataclass
class Catalog:
    """One row per item: item_id, n_item, pct, factors, features, popularity, seg_no, seg_delta, tie_break.
    ``segment_base``: see ``popularity.Segments``; ``n_deltas``: entries of all seg_delta lists together."""
    table: DataFrame
    n_items: int
    factor_dims: int
    feature_dims: int
    segment_base: np.ndarray
    n_deltas: int

    @property
    def row_bytes(self) -> int:
        return 8 * (self.factor_dims + self.feature_dims + 7) + 16 * math.ceil(self.n_deltas / max(self.n_items, 1))


def catalog_moments(catalog: Catalog) -> dict:
    """Mean and covariance of the item vectors over the whole catalog."""
    n, r, d = catalog.n_items, catalog.factor_dims, catalog.feature_dims
    joint = catalog.table.select(F.concat("factors", "features", F.array("tie_break")).alias("v"))
    mean = gather.tree_sum(joint, "v", r + d + 1) / n
    cov = gather.gram(joint, "v", r + d + 1, centre=mean) / n
    # A segment's scores are those of all users, its base, and the deltas of some items.
    whole = catalog.table.agg(F.avg("popularity").alias("m"), F.var_pop("popularity").alias("v")).first()
    deltas = (catalog.table.select("popularity", F.explode(F.arrays_zip("seg_no", "seg_delta")).alias("d"))
              .select(F.col("d.seg_no").alias("s"), F.col("d.seg_delta").alias("x"), (F.col("popularity") - F.lit(whole.m)).alias("g"))
              .groupBy("s").agg(F.sum("x").alias("x"), F.sum(F.col("x") * F.col("x") + 2 * F.col("x") * F.col("g")).alias("xx")).toArrow())
    first, second = np.zeros(len(catalog.segment_base)), np.zeros(len(catalog.segment_base))
    first[deltas.column("s").to_numpy()] = deltas.column("x").to_numpy() / n
    second[deltas.column("s").to_numpy()] = deltas.column("xx").to_numpy() / n
    return {"factors_mean": mean[:r], "factors_cov": cov[:r, :r],
            "features_mean": mean[r:r + d], "features_cov": cov[r:r + d, r:r + d],
            "features_tie_cov": cov[r:r + d, r + d], "tie_mean": mean[r + d], "tie_var": cov[r + d, r + d],
            "popularity_mean": whole.m + catalog.segment_base + first,
            "popularity_std": np.sqrt(np.maximum(whole.v + second - first * first, 0.0))}


def item_arrays(table: pa.Table, factor_dims: int, feature_dims: int, segment_base: np.ndarray, models: dict | None = None,
                tile_rows: int | None = None, features: np.ndarray | None = None) -> dict:
    """The items, those with equal features beside each other, cut into tiles of at most ``tile_rows``. Equal rows of features are held once:
    ``features`` has them by the column ``kind`` where the table does not hold them itself."""
    if features is None:
        distinct, kind = kernels.distinct_rows(kernels.to_matrix(table.column("features"), feature_dims))
    else:
        used, kind = np.unique(table.column("kind").to_numpy(), return_inverse=True)
        distinct = features[used]
    tile_rows = max(1, table.num_rows if tile_rows is None else tile_rows)
    order = np.lexsort((table.column("item_id").to_numpy(), -table.column("n_item").to_numpy(), kind))
    table, kind = table.drop_columns(["features" if features is None else "kind"]).take(pa.array(order)), kind[order]
    numbers, deltas = (table.column(c).combine_chunks() for c in ("seg_no", "seg_delta"))
    numbers, deltas = (pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c for c in (numbers, deltas))
    places = np.repeat(np.arange(table.num_rows), np.diff(numbers.offsets.to_numpy()))
    starts = _cuts(kind, tile_rows, FEW)
    n_segments, n_tiles = len(segment_base), len(starts) - 1
    # the deltas of segment s in tile t: entries cells[t * n_segments + s] .. cells[t * n_segments + s + 1] - 1
    tile = np.searchsorted(starts, places, side="right") - 1
    cell = tile * n_segments + numbers.flatten().to_numpy(zero_copy_only=False)
    by_cell = np.argsort(cell, kind="stable")
    items = {"item_id": table.column("item_id").to_numpy(), "n_item": table.column("n_item").to_numpy(),
             "pct": table.column("pct").to_numpy(), "tie_break": table.column("tie_break").to_numpy(),
             "factors": kernels.to_matrix(table.column("factors"), factor_dims), "distinct": distinct, "kind": kind,
             "popularity": table.column("popularity").to_numpy(), "segment_base": segment_base, "tile_rows": tile_rows,
             "tile_starts": starts, "cells": np.searchsorted(cell[by_cell], np.arange(n_segments * n_tiles + 1)),
             "segment_places": (places - starts[tile])[by_cell].astype(np.int32),     # from the first item of the tile
             "segment_deltas": deltas.flatten().to_numpy(zero_copy_only=False)[by_cell],
             "own": {name: protocol.own_arrays(table, m["kernel"].item_columns) for name, m in (models or {}).items() if "kernel" in m}}
    items["place_by_id"] = np.argsort(items["item_id"], kind="stable")
    items["tops"] = kernels.tile_tops(items)
    items["group_tops"] = kernels.joined_tops(items["tops"], _cuts(kind[starts[:-1]], 2 * GROUP, 4))
    for name, m in (models or {}).items():
        if "kernel" in m and m["kernel"].order is not None:
            key = np.asarray(m["kernel"].order(_Columns(items, items["own"][name], np.arange(table.num_rows)), m["kernel"].shared), dtype=float)
            items["own"][name]["_order"] = np.lexsort((items["item_id"], key))
    return items


def _cuts(kind: np.ndarray, most: int, few: int) -> np.ndarray:
    """Where runs of at most ``most`` neighbours start, and the end: a run ends where the kind changes; while kinds are small, only once
    it has ``few``."""
    starts, first = [0], np.flatnonzero(np.diff(kind)) + 1
    least = min(few, most) if len(kind) < 4 * few * (len(first) + 1) else 1
    for lo, hi in zip([0, *first.tolist()], [*first.tolist(), len(kind)]):
        if lo - starts[-1] >= least:
            starts.append(lo)
        starts += range(starts[-1] + most, hi, most)
    return np.array([*starts, len(kind)] if len(kind) else [0])


class _Columns(dict):
    """The columns of some items for a model from outside. Dense features are made when they are asked for."""

    def __init__(self, items: dict, own: dict, places: np.ndarray):
        super().__init__({name: items[name][places] for name in ("item_id", "n_item", "pct", "tie_break", "factors", "popularity")})
        self.update({name: _taken_rows(v, places) for name, v in own.items() if name != "_order"})
        self._features = lambda: items["distinct"][items["kind"][places]]

    def __missing__(self, name: str):
        if name != "features":
            raise KeyError(name)
        self[name] = self._features()
        return self[name]


def _taken_rows(column, places: np.ndarray):
    if not isinstance(column, tuple):
        return column[places]
    offsets, values = column
    sizes = offsets[places + 1] - offsets[places]
    return np.append(0, np.cumsum(sizes)), values[kernels.ranges(offsets[places], sizes)]


def user_arrays(table: pa.Table, factor_dims: int, feature_dims: int) -> dict:
    return {"user_id": table.column("user_id").to_numpy(), "n_user": table.column("n_user").to_numpy(),
            "segment": table.column("segment_no").to_numpy(),
            "factors": kernels.to_matrix(table.column("factors"), factor_dims),
            "profile": kernels.to_matrix(table.column("profile"), feature_dims)}


def _marks(column, items: dict, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, positions) of a list-of-item-ids column, by position; ids outside the shard are dropped."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    rows = np.repeat(np.arange(n_rows), lengths)
    place = items["place_by_id"]
    ids = items["item_id"][place]
    at = np.minimum(np.searchsorted(ids, values), len(ids) - 1)
    ok = ids[at] == values
    rows, places = rows[ok], place[at[ok]]
    order = np.argsort(places, kind="stable")
    return rows[order], places[order]


def _tile_rows(cells: int) -> int:
    """Items of a tile: few, so that their bounds are near their scores."""
    return max(16, cells // 12500)


def _slices(table: pa.Table, n_items: int, cells: int):
    step = max(1, cells // max(min(n_items, 4 * _tile_rows(cells)), 1))
    for start in range(0, table.num_rows, step):
        yield table.slice(start, step)


class _Best:
    """The best ``depth`` entries of each user so far. New entries wait until they are half as many as the lists."""

    def __init__(self, n: int, depth: int, digits: int, rows: np.ndarray, entries: dict[str, np.ndarray]):
        self.n, self.depth, self.digits = n, depth, digits
        self.slack = max(2.0 * 10.0 ** -digits, 1e-9)      # scores and bounds are summed in different order
        self.same = 0.4 * 10.0 ** -digits                  # above the floor by less than this is equal to it when rounded
        self.waiting, self.found = 0, [(rows, entries)]
        self.merge()

    def merge(self) -> None:
        rows = np.concatenate([r for r, _ in self.found])
        entries = {name: np.concatenate([e[name] for _, e in self.found]) for name in self.found[0][1]}
        order = np.lexsort((entries["l_item"], -entries["l_score"], rows))
        rows = rows[order]
        self.rank = np.arange(1, len(rows) + 1) - np.searchsorted(rows, rows)
        kept = self.rank <= self.depth
        self.rows, self.rank = rows[kept], self.rank[kept]
        self.entries = {name: values[order[kept]] for name, values in entries.items()}
        self.floor, self.last_item = np.full(self.n, -np.inf), np.zeros(self.n, dtype=np.int64)
        last = self.rank == self.depth
        self.floor[self.rows[last]], self.last_item[self.rows[last]] = self.entries["l_score"][last], self.entries["l_item"][last]
        self.waiting, self.found = 0, [(self.rows, self.entries)]

    def add(self, rows: np.ndarray, entries: dict[str, np.ndarray]) -> None:
        self.found.append((rows, entries))
        self.waiting += len(rows)
        if 2 * self.waiting >= self.n * self.depth:
            self.merge()

    def part(self, first: int, end: int) -> "_Best":
        """The lists of neighbouring users, numbered from 0."""
        lo, hi = np.searchsorted(self.rows, [first, end])
        return _Best(end - first, self.depth, self.digits, self.rows[lo:hi] - first, {name: values[lo:hi] for name, values in self.entries.items()})

    def reached(self, rows: np.ndarray, bound: np.ndarray, least_id) -> np.ndarray:
        """Whether items up to ``bound`` may enter the lists of ``rows``. Those that can only be equal to the last entry need a lower id."""
        floor = self.floor[rows]
        lost = (bound <= floor + self.same) & (self.last_item[rows] < least_id)
        return ~np.isfinite(floor) | ((bound >= floor - self.slack) & ~lost)

    def pick(self, some: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(rows, places, rounded scores) of the cells that may enter the lists of the users ``some``."""
        floor = self.floor[some]
        if not np.isfinite(floor).all():
            by_id = np.argsort(ids, kind="stable")      # of equal scores the lowest id
            rows, _, places, values = kernels.best_rows(scores[:, by_id], self.depth, self.digits)
            return rows, by_id[places], values
        rows, places = np.nonzero(scores >= (floor - self.slack)[:, None])
        values = np.round(scores[rows, places], self.digits) + 0.0
        least = floor[rows]
        kept = (values > least) | ((values == least) & (ids[places] < self.last_item[some][rows]))
        return rows[kept], places[kept], values[kept]


def _best_entries(table: pa.Table, items: dict, moments: dict, spec: dict, carried: tuple | None = None, counters=None) -> dict[str, _Best]:
    """The lists of a batch of users by model, after all ``items``. ``carried``: (rows, entries) of lists from other items."""
    n, models = table.num_rows, spec["models"]
    names = {name: kind for name, kind in (_carried(spec) | {"l_place": "bigint"}).items() if name not in ("l_model", "l_rank")}
    users = user_arrays(table, spec["factor_dims"], spec["feature_dims"])
    n_items = len(items["item_id"])
    seen, liked = (np.sort(rows * n_items + places) for rows, places in (_marks(table.column(c), items, n) for c in ("seen", "liked")))
    shared, best = {}, {}       # models that differ only in re-ranking share the scores, and the longer list
    for number, (name, model) in enumerate(models.items()):
        key = ("kernel", id(model["kernel"])) if "kernel" in model else tuple((k, v) for k, v in model.items() if k not in ("rerank", "mmr"))
        depth = _depth(model, spec["k"])
        if key in shared and best[shared[key]].depth >= depth:
            best[name] = best[shared[key]]
            continue
        rows, entries = np.zeros(0, dtype=np.int64), {c: np.zeros(0, dtype=_NUMPY[kind]) for c, kind in names.items()}
        if carried is not None:
            mine = carried[1]["l_model"] == number
            rows, entries = carried[0][mine], {c: carried[1][c][mine] if c != "l_place" else np.full(mine.sum(), -1) for c in names}
        best[name] = _Best(n, depth, spec["digits"], rows, entries)
        if key in shared:
            best |= {other: best[name] for other, held in best.items() if held is best[shared[key]]}
        shared[key] = name
    count = (lambda scored, skipped: None) if counters is None else (lambda scored, skipped: (counters[0].add(int(scored)), counters[1].add(int(skipped))))
    batch = _Batch(table, users, items, moments, spec, seen, liked, count)
    tiled = {}
    for name, held in {id(b): (name, b) for name, b in best.items()}.values():
        model = models[name]
        if "kernel" in model:
            _own_list(batch, name, model["kernel"], held)
        elif model.get("signal") in ("popularity", "demographic"):
            _segment_list(batch, model["signal"] == "demographic", held)
        else:
            tiled[name] = held
    if tiled:
        _tiled_lists(batch, tiled)
    return best


class _Batch:
    """Some users, the items, and what every list needs of them. ``seen``, ``liked``: sorted row * n_items + place."""

    def __init__(self, table: pa.Table, users: dict, items: dict, moments: dict, spec: dict, seen: np.ndarray, liked: np.ndarray, count):
        self.table, self.users, self.items, self.moments, self.spec, self.seen, self.liked, self.count = table, users, items, moments, spec, seen, liked, count
        self.n, self.n_items = len(users["user_id"]), len(items["item_id"])
        self.n_seen = np.bincount(seen // max(self.n_items, 1), minlength=self.n)

    def entries(self, rows: np.ndarray, places: np.ndarray, values: np.ndarray, shares: np.ndarray | None = None) -> dict[str, np.ndarray]:
        out = {"l_item": self.items["item_id"][places], "l_score": values, "l_n": self.items["n_item"][places], "l_place": places,
               "l_hit": kernels.contains(self.liked, rows * self.n_items + places)}
        if self.spec["parts"]:
            shares = np.full((len(rows), len(PARTS)), np.nan) if shares is None else shares
            out |= {f"l_{p}": shares[:, i] for i, p in enumerate(PARTS)}
        return out


def _segment_list(batch: _Batch, by_segment: bool, held: _Best) -> None:
    """Lists by popularity, of all users or of the segment: one order of the items for each segment, of which a user takes the first ones
    that are not seen."""
    segments = batch.users["segment"] if by_segment else np.full(batch.n, -1)
    most = held.depth + batch.n_seen
    for segment in np.unique(segments):
        mine = np.flatnonzero(segments == segment)
        places, values = _segment_order(batch.items, int(segment), min(int(most[mine].max()), batch.n_items), held.digits)
        sizes = np.minimum(most[mine], np.searchsorted(-values, -held.floor[mine], side="right"))    # none below the last entry
        rows, at = np.repeat(mine, sizes), kernels.ranges(np.zeros(len(mine), dtype=np.int64), sizes)
        new = ~kernels.contains(batch.seen, rows * batch.n_items + places[at])
        rows, at = rows[new], at[new]
        held.add(rows, batch.entries(rows, places[at], values[at]))
        batch.count(sizes.sum(), len(mine) * batch.n_items - sizes.sum())
    held.merge()


def _segment_order(items: dict, segment: int, length: int, digits: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, rounded scores) of the first ``length`` items or more for a segment (-1: all users), kept beside the items for later batches."""
    kept = items.setdefault("orders", {})
    if segment in kept and len(kept[segment][0]) >= length:
        return kept[segment]
    length = min(len(items["item_id"]), max(2 * length, 256))
    scores = items["popularity"]
    if segment >= 0:
        n_segments, starts = len(items["segment_base"]), items["tile_starts"]
        cells = np.arange(len(starts) - 1) * n_segments + segment
        lo, sizes = items["cells"][cells], items["cells"][cells + 1] - items["cells"][cells]
        entries = kernels.ranges(lo, sizes)
        scores = items["segment_base"][segment] + scores
        scores[np.repeat(starts[:-1], sizes) + items["segment_places"][entries]] += items["segment_deltas"][entries]
    scores = np.round(scores, digits) + 0.0
    some = np.arange(len(scores)) if length >= len(scores) else np.flatnonzero(scores >= np.partition(scores, len(scores) - length)[len(scores) - length])
    some = some[np.lexsort((items["item_id"][some], -scores[some]))[:length]]
    kept[segment] = some, scores[some]
    return kept[segment]


def _own_list(batch: _Batch, name: str, kernel: protocol.Kernel, held: _Best) -> None:
    """The lists of a model from outside: groups of tiles in the order of the model, each scored for the users whose list its bound reaches."""
    items, tile = batch.items, 4 * batch.items["tile_rows"]
    own = items["own"][name]
    order = own.get("_order")
    mine = protocol.own_arrays(batch.table, kernel.user_columns)
    size = GROUP * tile
    groups = [(at, min(at + size, batch.n_items)) for at in range(0, batch.n_items, size)]
    places_of = lambda lo, hi: np.arange(lo, hi) if order is None else order[lo:hi]
    users_of = lambda rows: {**{c: v[rows] for c, v in batch.users.items()}, **{c: _taken_rows(v, rows) for c, v in mine.items()}}

    def bound(rows: np.ndarray, columns: dict) -> np.ndarray:
        if kernel.bound is None:
            return np.full(len(rows), np.inf)
        return np.nan_to_num(np.asarray(kernel.bound(users_of(rows), columns, kernel.shared), dtype=float), nan=np.inf, posinf=np.inf, neginf=-np.inf)

    def score(rows: np.ndarray, lo: int, hi: int, columns: dict) -> None:
        places = places_of(lo, hi)
        step = max(1, batch.spec["cells"] // max(len(places), 1))
        for at in range(0, len(rows), step):
            some = rows[at:at + step]
            scores = np.array(kernel.score(users_of(some), columns, kernel.shared), dtype=float)
            scores[np.isnan(scores)] = -np.inf
            number = np.full(batch.n, -1)
            number[some] = np.arange(len(some))
            first, end = np.searchsorted(seen_at, [lo, hi])
            there = number[seen_rows[first:end]]
            scores[there[there >= 0], seen_at[first:end][there >= 0] - lo] = -np.inf
            found, at_, values = held.pick(some, scores, columns["item_id"])
            if len(found):
                held.add(some[found], batch.entries(some[found], places[at_], values))
        batch.count(len(rows) * len(places), 0)

    where = np.arange(batch.n_items)
    if order is not None:
        where = np.empty(batch.n_items, dtype=np.int64)
        where[order] = np.arange(batch.n_items)
    seen_at = where[batch.seen % max(batch.n_items, 1)]
    by_place = np.argsort(seen_at, kind="stable")
    seen_rows, seen_at = batch.seen[by_place] // max(batch.n_items, 1), seen_at[by_place]
    every = np.arange(batch.n)
    bounds = np.full((len(groups), batch.n), np.inf)
    for number, (lo, hi) in enumerate(groups):
        if kernel.bound is not None:
            bounds[number] = bound(every, _Columns(items, own, places_of(lo, hi)))
    # First each user takes the group with the highest bound, so that the lists are nearly final before the others are held against them.
    lead = bounds.argmax(axis=0) if groups else np.zeros(batch.n, dtype=int)
    for leading in (True, False):
        for number in np.argsort(-bounds.max(axis=1, initial=-np.inf), kind="stable") if groups else []:
            lo, hi = groups[number]
            columns = _Columns(items, own, places_of(lo, hi))
            apart = (lead == number) == leading
            rows = np.flatnonzero(apart & held.reached(every, bounds[number], columns["item_id"].min()))
            batch.count(0, (apart.sum() - len(rows)) * (hi - lo))
            if kernel.bound is None or len(rows) <= max(batch.n // 8, 1):
                if len(rows):
                    score(rows, lo, hi, columns)
                continue
            for first in range(lo, hi, tile):
                last = min(first + tile, hi)
                part = _Columns(items, own, places_of(first, last))
                some = rows[held.reached(rows, bound(rows, part), part["item_id"].min())]
                batch.count(0, (len(rows) - len(some)) * (last - first))
                if len(some):
                    score(some, first, last, part)
        held.merge()


def _tiled_lists(batch: _Batch, lists: dict[str, _Best]) -> None:
    """The lists by signals and blends. Some users at a time are held against all groups of tiles, and against the tiles of a group that
    reaches a list; a tile is scored for a user and list only if its bound reaches the last entry."""
    items, spec = batch.items, batch.spec
    n_groups = len(items["group_tops"]["least_id"])
    step = max(1, HELD * spec["cells"] // max((n_groups + len(items["distinct"])) * (len(lists) + 4), 1))
    pieces = {name: [] for name in lists}
    for at in range(0, batch.n, step):
        part = _Part(batch, at, min(at + step, batch.n), {name: held.part(at, min(at + step, batch.n)) for name, held in lists.items()})
        if n_groups:
            part.run()
        for name, held in part.lists.items():
            held.merge()
            pieces[name].append((held.rows + at, held.entries))
    for name, held in lists.items():
        held.found = pieces[name]
        held.merge()


class _Asked:
    """The tiles that a list has been held against, and which of them are scored. ``levels``: by stage and row, the bound from which on
    tiles are scored."""

    def __init__(self, group_bound: np.ndarray):
        self.group_bound, self.open = group_bound, np.ones(group_bound.shape, dtype=bool)
        self.rows, self.tiles = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.bound, self.done = np.zeros(0), np.zeros(0, dtype=bool)
        self.levels, self.lowest = [], None

    def add(self, rows: np.ndarray, tiles: np.ndarray, bound: np.ndarray) -> None:
        self.rows, self.tiles, self.bound = (np.concatenate(pair) for pair in ((self.rows, rows), (self.tiles, tiles), (self.bound, bound)))
        self.done = np.append(self.done, np.zeros(len(rows), dtype=bool))

    def take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        self.done[which] = True
        return self.rows[which], self.tiles[which]


class _Part:
    """A few users of a batch against all items."""

    def __init__(self, batch: _Batch, first: int, end: int, lists: dict[str, _Best]):
        self.batch, self.first, self.n, self.lists, self.items, self.spec = batch, first, end - first, lists, batch.items, batch.spec
        self.users = {c: v[first:end] for c, v in batch.users.items()}
        self.models = {name: batch.spec["models"][name] for name in lists}
        self.wanted = set().union(*map(_signals_of, self.models.values()))
        self.blended = set().union(*(_signals_of(m) for m in self.models.values() if "mode" in m))
        self.stats = kernels.row_moments(self.users, batch.moments, self.blended) if self.blended else {}
        self.content = self.users["profile"] @ self.items["distinct"].T if "content" in self.wanted else None
        self.n_tiles = len(self.items["tile_starts"]) - 1
        lo, hi = np.searchsorted(batch.seen, [first * batch.n_items, end * batch.n_items])
        self.seen = batch.seen[lo:hi] - first * batch.n_items

    def run(self) -> None:
        sizes = np.diff(self.items["tile_starts"])
        bounds = self._group_bounds()
        asked = {name: _Asked(bounds[name]) for name in self.lists}
        # First the tiles that fill a list, then more and more, at last all that still reach it.
        few = max(1, int(np.median(sizes)))
        for name, held in self.lists.items():
            start = min(1 + 2 * held.depth // few, held.depth)
            self._open(name, held, asked[name], sorted({start, max(start, held.depth // 4), held.depth}))
        for stage in range(4):
            keys = {}
            for name, held in self.lists.items():
                mine = asked[name]
                if stage == 3:
                    self._open(name, held, mine)
                elif stage >= len(mine.levels):
                    continue
                left = np.flatnonzero(~mine.done if stage == 3 else ~mine.done & (mine.bound >= mine.levels[stage][mine.rows]))
                left = left[held.reached(mine.rows[left], mine.bound[left], self.items["tops"]["least_id"][mine.tiles[left]])]
                rows, tiles = mine.take(left)
                keys[name] = np.sort(rows * self.n_tiles + tiles)
            if keys:
                self._score(keys)
            for held in self.lists.values():
                held.merge()
        for mine in asked.values():
            scored = int(sizes[mine.tiles[mine.done]].sum())
            self.batch.count(scored, self.n * self.batch.n_items - scored)

    def _open(self, name: str, held: _Best, asked: _Asked, counts: list[int] | None = None) -> None:
        """Hold the list against the tiles of more groups: of all that reach it, or first of about ``counts[-1]``, with the levels that
        so many of these groups reach."""
        bound, tops = asked.group_bound, self.items["group_tops"]
        least, even = held.floor - held.slack, np.zeros(self.n, dtype=bool)
        if counts:
            if counts[-1] < bound.shape[1]:
                least = np.maximum(least, np.partition(bound, bound.shape[1] - counts[-1], axis=1)[:, bound.shape[1] - counts[-1]])
            even = bound[:, 0] == bound[:, -1]      # where nothing is known of a user, all bounds are equal, and the lowest ids win
            even[even] = (bound[even] == bound[even, :1]).all(axis=1)
        mask = bound >= least[:, None]
        mask &= asked.open
        mask[even] = False
        rows, numbers = np.divmod(np.flatnonzero(mask), bound.shape[1])
        reached = bound[rows, numbers]
        kept = held.reached(rows, reached, tops["least_id"][numbers])
        if counts:      # of groups with equal bounds those with the lowest ids, which stand first
            equal = np.cumsum(reached == least[rows])
            first = np.searchsorted(rows, rows)
            kept &= (reached > least[rows]) | (equal - equal[first] < counts[-1])
        rows, numbers = rows[kept], numbers[kept]
        asked.open[rows, numbers] = False
        sizes = tops["end"][numbers] - tops["first"][numbers]
        of_group, tiles = np.repeat(rows, sizes), kernels.ranges(tops["first"][numbers], sizes)
        bounds = self._tile_bounds(name, of_group, tiles)
        if counts:
            highest = np.maximum.reduceat(bounds, np.cumsum(sizes) - sizes) if len(rows) else np.zeros(0)
            order = np.lexsort((-highest, rows))
            first, end = np.searchsorted(rows, np.arange(self.n)), np.searchsorted(rows, np.arange(self.n), side="right")
            for n in counts:
                level = np.full(self.n, -np.inf)
                there = end > first
                level[there] = highest[order[np.minimum(first + n, end)[there] - 1]]
                asked.levels.append(level)
        if even.any():
            low = np.flatnonzero(even)
            sizes = np.minimum(held.depth + self.batch.n_seen[self.first:self.first + self.n][low], self.n_tiles)
            rows, by_id = np.repeat(low, sizes), self.items["tops"]["by_id"][kernels.ranges(np.zeros(len(low), dtype=np.int64), sizes)]
            asked.add(rows, by_id, self._tile_bounds(name, rows, by_id))
            asked.lowest = np.sort(rows * self.n_tiles + by_id)
        if asked.lowest is not None:        # these have some tiles of groups that are still open
            new = ~kernels.contains(asked.lowest, of_group * self.n_tiles + tiles)
            of_group, tiles, bounds = of_group[new], tiles[new], bounds[new]
        asked.add(of_group, tiles, bounds)

    def _group_bounds(self) -> dict[str, np.ndarray]:
        """By list, (users x groups) numbers that no score exceeds."""
        tops = self.items["group_tops"]
        most = kernels.signal_bounds(self.users, tops, self.wanted, self.content)
        z = {s: kernels.standardise(most[s], *self.stats[s]) for s in self.blended}
        nu = self.users["n_user"][:, None]
        return {name: most[m["signal"]] if "signal" in m else kernels.blend_bounds(m, z, nu, *tops["n_item"], self.spec["cold_below"])
                for name, m in self.models.items()}

    def _tile_bounds(self, name: str, rows: np.ndarray, tiles: np.ndarray) -> np.ndarray:
        """The same for pairs of a user and a tile, of one list."""
        tops, model = self.items["tops"], self.models[name]
        most = kernels.pair_bounds(self.users, tops, rows, tiles, _signals_of(model), self.content)
        if "signal" in model:
            return most[model["signal"]]
        z = {s: kernels.standardise_pairs(v, rows, *self.stats[s]) for s, v in most.items()}
        return kernels.blend_bounds(model, z, self.users["n_user"][rows], *(n[tiles] for n in tops["n_item"]), self.spec["cold_below"])

    def _score(self, asked: dict[str, np.ndarray]) -> None:
        """Score the asked (row, tile) pairs; the signals of a pair are computed once for all lists."""
        every = np.unique(np.concatenate(list(asked.values())))
        starts = self.items["tile_starts"]
        sizes = np.diff(starts)[every % self.n_tiles]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(every):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 2 * self.spec["cells"], side="right")))
            pairs, size = every[at:to], sizes[at:to]
            rows, tiles = pairs // self.n_tiles, pairs % self.n_tiles
            row, place = np.repeat(rows, size), kernels.ranges(starts[tiles], size)
            raw = kernels.pair_signals(self.users, self.items, row, place, rows, tiles, self.wanted, self.content)
            z = {s: kernels.standardise_pairs(raw[s], row, *self.stats[s]) for s in self.blended}
            first = np.cumsum(size) - size
            for name, keys in asked.items():
                lo, hi = np.searchsorted(keys, [pairs[0], pairs[-1] + 1])
                if lo < hi:
                    mine = np.searchsorted(pairs, keys[lo:hi])
                    self._keep(name, row, place, raw, z, None if hi - lo == len(pairs) else kernels.ranges(first[mine], size[mine]))
            at = to

    def _keep(self, name: str, row: np.ndarray, place: np.ndarray, raw: dict, z: dict, cells: np.ndarray | None) -> None:
        """Add what enters a list of the pairs ``cells`` (None: all)."""
        held, model = self.lists[name], self.spec["models"][name]
        cut = (lambda v: v) if cells is None else (lambda v: v[cells])
        row, place = cut(row), cut(place)
        mine = {s: cut(z[s]) for s in _signals_of(model)} if "mode" in model else {}
        nu, ni = (self.users["n_user"][row], self.items["n_item"][place]) if mine else (None, None)
        scores = kernels.blend_pairs(model, mine, nu, ni, self.spec["cold_below"]) if mine else cut(raw[model["signal"]])
        some = np.flatnonzero(scores >= (held.floor - held.slack)[row])
        row, place = row[some], place[some]
        values = np.round(scores[some], held.digits) + 0.0
        floor = held.floor[row]
        new = (values > floor) | ((values == floor) & (self.items["item_id"][place] < held.last_item[row]))
        new &= ~kernels.contains(self.seen, row * self.batch.n_items + place)
        some, row, place, values = some[new], row[new], place[new], values[new]
        new = kernels.among_highest(row, values, held.depth)
        if new is not None:
            some, row, place, values = some[new], row[new], place[new], values[new]
        if len(row):
            shares = None
            if self.spec["parts"]:
                shares = _contributions(model, {s: v[some] for s, v in mine.items()}, None if nu is None else nu[some], None if ni is None else ni[some],
                                        len(row), self.spec["cold_below"])
            held.add(row, self.batch.entries(row + self.first, place, values, shares))


def _signals_of(model: dict) -> set:
    if "signal" in model:
        return {model["signal"]}
    return {"cf", "content"} | (set() if model["mode"] == "fixed" else {"demographic"})


def _depth(model: dict, k: int) -> int:
    return model["rerank"].candidates if "rerank" in model else k


def _score_slice(table: pa.Table, items: dict, moments: dict, spec: dict) -> pa.Table:
    """Finished lists of one batch of users against the whole catalog."""
    models = spec["models"]
    users = {c: table.column(c).to_numpy() for c in ("user_id", "n_user")}
    ids = items["item_id"]
    pieces = {name: [] for name in ("model", "row", "rank", "at", "score", "sim", "hit", "parts")}
    best = _best_entries(table, items, moments, spec)
    for number, (name, model) in enumerate(models.items()):
        held = best[name]
        kept = np.flatnonzero(held.rank <= _depth(model, spec["k"]))
        ranks = held.rank[kept]
        kinds = items["kind"][held.entries["l_place"][kept]]
        if "rerank" in model:
            rows, values, places = held.rows[kept], held.entries["l_score"][kept], held.entries["l_place"][kept]
            own = {c: v[places] for c, v in items["own"].get(name, {}).items() if isinstance(v, np.ndarray)}
            cells = {**own, "score": values, "item_id": ids[places], "pct": items["pct"][places], "n_item": items["n_item"][places]}
            picks, ranks = _picks(rows, cells, items["distinct"], kinds, model["rerank"], spec)
            kept, kinds = kept[picks], kinds[picks]
        if spec["only_hits"]:
            hits = held.entries["l_hit"][kept]
            kept, ranks = kept[hits], ranks[hits]
            sim = np.zeros(len(kept))
        else:
            sim = _similarities(held.rows[kept], items["distinct"], kinds, spec)
        pieces["model"].append(np.full(len(kept), number, dtype=np.int32))
        for key, value in (("row", held.rows[kept]), ("rank", ranks), ("at", held.entries["l_place"][kept]), ("score", held.entries["l_score"][kept]),
                           ("sim", sim), ("hit", held.entries["l_hit"][kept])):
            pieces[key].append(value)
        if spec["parts"]:
            pieces["parts"].append(np.column_stack([held.entries[f"l_{p}"][kept] for p in PARTS]))

    rows, places = np.concatenate(pieces["row"]).astype(int), np.concatenate(pieces["at"]).astype(int)
    return _list_rows(spec, np.concatenate(pieces["model"]), users["user_id"][rows], users["n_user"][rows],
                      np.concatenate(pieces["rank"]), ids[places], np.concatenate(pieces["score"]), np.concatenate(pieces["hit"]),
                      items["n_item"][places], np.concatenate(pieces["sim"]), np.concatenate(pieces["parts"]) if spec["parts"] else None)


def _list_rows(spec, model, user_id, n_train, rank, item_id, score, hit, n_item, sim, parts) -> pa.Table:
    names = pa.array(list(spec["models"]), pa.string())
    columns = {
        "model": pa.DictionaryArray.from_arrays(pa.array(model.astype(np.int32)), names).cast(pa.string()),
        "user_id": pa.array(user_id, pa.int64()), "n_train": pa.array(n_train, pa.int64()),
        "rank": pa.array(rank.astype(np.int32)), "item_id": pa.array(item_id, pa.int64()), "score": pa.array(score.astype(float)),
        "hit": pa.array(hit.astype(bool)), "n_item": pa.array(n_item, pa.int64()), "sim_before": pa.array(sim.astype(float))}
    for at, name in enumerate(PARTS if spec["parts"] else []):
        columns[name] = pa.array(parts[:, at], mask=np.isnan(parts[:, at]))
    return pa.table(columns)


# --- lists that travel with the users from shard to shard ----------------------------------------

# Aligned arrays per user, by model, then rank.
_CARRIED = {"l_model": "int", "l_rank": "int", "l_item": "bigint", "l_score": "double", "l_hit": "boolean", "l_n": "bigint"}
_NUMPY = {"int": np.int32, "bigint": np.int64, "double": np.float64, "boolean": bool}


def _carried(spec: dict) -> dict[str, str]:
    return _CARRIED | {f"l_{name}": "double" for name in PARTS if spec["parts"]}


def _flat_lists(table: pa.Table, names: dict[str, str]) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """(row of each entry, entries by column)."""
    out, rows = {}, None
    for name, kind in names.items():
        column = table.column(name).combine_chunks()
        column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
        if rows is None:
            rows = np.repeat(np.arange(table.num_rows), np.diff(column.offsets.to_numpy()))
        out[name] = column.flatten().to_numpy(zero_copy_only=False).astype(_NUMPY[kind])
    return rows, out


def _merge_shard(table: pa.Table, items: dict, moments: dict, spec: dict, counters) -> pa.Table:
    """The users of ``table`` with the lists after this shard."""
    models, names, n = spec["models"], _carried(spec), table.num_rows
    best = _best_entries(table, items, moments, spec, _flat_lists(table, names), counters)
    pieces = {name: [] for name in ("row", *names)}
    for number, (name, model) in enumerate(models.items()):
        held = best[name]
        kept = held.rank <= _depth(model, spec["k"])
        rank = held.rank[kept]
        for column, values in {**{c: v[kept] for c, v in held.entries.items() if c in names}, "row": held.rows[kept], "l_rank": rank,
                               "l_model": np.full(len(rank), number)}.items():
            pieces[column].append(values)
    rows = np.concatenate(pieces.pop("row"))
    order = np.argsort(rows, kind="stable")
    offsets = pa.array(np.searchsorted(rows[order], np.arange(n + 1)).astype(np.int32))
    for name, kind in names.items():
        values = np.concatenate(pieces[name])[order].astype(_NUMPY[kind])
        table = table.set_column(table.schema.get_field_index(name), name, pa.ListArray.from_arrays(offsets, pa.array(values)))
    return table


def _grid(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat rows that are sorted by list, as a padded grid of lists."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1)) if len(rows) else np.zeros(0, dtype=int)
    return kernels.padded(starts, np.diff(np.append(starts, len(rows))))


def _similarities(rows: np.ndarray, vectors: np.ndarray, kinds: np.ndarray, spec: dict) -> np.ndarray:
    """For each of the flat rows the sum of its cosines to those before it in its list. ``kinds``: which of the vectors each row has."""
    cells, used = _grid(rows)
    out = np.zeros(len(rows))
    step = max(1, spec["cells"] * 8 // max(cells.shape[1] * max(vectors.shape[1], 1), 1))
    for at in range(0, len(cells), step):
        c, u = cells[at:at + step], used[at:at + step]
        out[c[u]] = kernels.similarity_before(vectors[kinds[c]] * u[:, :, None])[u]
    return out


def _picks(rows: np.ndarray, cells: dict, vectors: np.ndarray, kinds: np.ndarray, reranker: protocol.Reranker, spec: dict) -> tuple[np.ndarray, np.ndarray]:
    """Which of the flat rows a re-ranker keeps, list by list in its order, and their new ranks."""
    if not len(rows):
        return np.zeros(0, dtype=int), np.zeros(0, dtype=int)
    grid, used = _grid(rows)
    step = max(1, spec["cells"] * 8 // max(grid.shape[1] * max(vectors.shape[1], 1), 1))
    kept, ranks = [], []
    for at in range(0, len(grid), step):
        c, u = grid[at:at + step], used[at:at + step]
        picks, counts = reranker.pick({**{name: values[c] for name, values in cells.items()}, "features": vectors[kinds[c]], "used": u}, spec["k"])
        kept.append(np.take_along_axis(c, picks, axis=1)[counts])
        ranks.append(np.broadcast_to(np.arange(1, picks.shape[1] + 1), picks.shape)[counts])
    return np.concatenate(kept), np.concatenate(ranks)


def _contributions(model: dict, z: dict, nu: np.ndarray, ni: np.ndarray, n: int, cold_below: int) -> np.ndarray:
    out = np.full((n, len(PARTS)), np.nan)
    if "mode" not in model:
        return out
    weights = kernels.shares(model, nu.astype(float), ni.astype(float), cold_below)
    for at, (weight, signal) in enumerate(zip(weights, ("cf", "content", "demographic"))):
        out[:, 3 + at] = weight
        out[:, at] = weight * z[signal] if signal in z else 0.0
    return out


def rank_users(users: DataFrame, n_users: int, catalog: Catalog, moments: dict, models: dict[str, dict],
               k: int, cfg: EngineConfig, workspace: Workspace, marks: DataFrame,
               candidates: DataFrame | None = None, n_candidates: int | None = None,
               parts: bool = False, only_hits: bool = False, notes: dict | None = None) -> DataFrame:
    """(model, user_id, n_train, rank, item_id, score, hit, n_item, sim_before [, parts]).

    ``users``: user_id, n_user, segment_no, factors, profile (one row per user).
    ``marks``: user_id, item_id, kind ('seen' is never recommended, 'liked' sets ``hit``).
    ``candidates``: (item_id) restricts the lists; z-scores still refer to the whole catalog.
    ``notes`` receives ``scored`` and ``skipped``: (user, model, item) triples of the plan with shards.
    """
    items = catalog.table if candidates is None else catalog.table.join(candidates, "item_id", "left_semi")
    n_items = catalog.n_items if n_candidates is None else n_candidates
    users, items, models, own_bytes = protocol.attach(_with_rerankers(models, cfg), users, items, cfg.scale)
    spec = {"models": models, "k": k, "digits": cfg.score_digits, "cold_below": cfg.split.cold_below,
            "cells": cfg.scale.cells_per_batch, "factor_dims": catalog.factor_dims, "feature_dims": catalog.feature_dims,
            "parts": parts, "only_hits": only_hits}
    modes = [m["mode"] for m in models.values() if "mode" in m]
    spec["blended"] = ({"cf", "content"} | ({"demographic"} if any(m != "fixed" for m in modes) else set())) if modes else set()
    spec["wanted"] = spec["blended"] | {m["signal"] for m in models.values() if "signal" in m}
    if n_users <= cfg.scale.broadcast_ids:
        marks = marks.join(F.broadcast(users.select("user_id")), "user_id", "left_semi")
    schema = ("model string, user_id long, n_train long, rank int, item_id long, score double, "
              "hit boolean, n_item long, sim_before double")
    if parts:
        schema += "".join(f", {name} double" for name in PARTS)
    spark = users.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism,
                math.ceil(n_users * max(n_items, 1) / (5000 * cfg.scale.cells_per_batch)))
    row_bytes = catalog.row_bytes + own_bytes / max(catalog.n_items, 1)
    kinds = None
    if n_items * row_bytes > cfg.scale.broadcast_bytes:     # equal rows of features travel once
        kinds = _kinds(items, n_items, catalog.feature_dims, cfg)
    if kinds is not None:
        items = items.withColumn("kind", F.xxhash64("features"))
        row_bytes -= 8 * (catalog.feature_dims - 1)
    arrays_of = lambda table: item_arrays(
        table if kinds is None else kinds.number(table), catalog.factor_dims, catalog.feature_dims, catalog.segment_base, models,
        _tile_rows(cfg.scale.cells_per_batch), None if kinds is None else kinds.features)

    if n_items * row_bytes + (0 if kinds is None else kinds.features.nbytes) <= cfg.scale.broadcast_bytes:
        shared = spark.sparkContext.broadcast((arrays_of((items if kinds is None else items.drop("features")).toArrow()), moments))

        def run(batches):
            arrays, stats = shared.value
            for batch in batches:
                for table in _slices(pa.Table.from_batches([batch]), len(arrays["item_id"]), spec["cells"]):
                    if len(arrays["item_id"]):
                        yield from _score_slice(table, arrays, stats, spec).combine_chunks().to_batches()

        return with_marks(users, marks, tasks).mapInArrow(run, schema)

    reranked = {name: model["rerank"] for name, model in models.items() if "rerank" in model}
    own = {name: models[name]["kernel"].item_columns for name in reranked if "kernel" in models[name]}
    known = None if kinds is None else _Known(kinds, {c for columns in own.values() for c in columns.values()})
    lists = _rank_by_shards(with_marks(users, marks, tasks), items if kinds is None else items.drop("features"), n_items, row_bytes, moments, spec, cfg, workspace,
                            arrays_of, known, notes)
    if known is not None and known.parts and known.bytes <= cfg.scale.broadcast_bytes:
        return _finished(lists, spark.sparkContext.broadcast((*known.arrays(), kinds.features)), reranked, own, spec, schema)
    merged = _flat_rows(lists, spec, schema)
    if only_hits and not reranked:      # nothing is re-ranked, and the vectors are not asked for
        return merged.filter("hit")
    depth = sum(_depth(model, k) for model in models.values())
    out = finish_lists(merged, items, spec, reranked, schema, cfg, n_users * depth)
    return out.filter("hit") if only_hits else out


@dataclass
class _Kinds:
    """The distinct rows of features, and the numbers of their hashes."""
    features: np.ndarray
    hashes: np.ndarray      # sorted
    numbers: np.ndarray

    def number(self, table: pa.Table) -> pa.Table:
        found = self.numbers[np.searchsorted(self.hashes, table.column("kind").to_numpy())]
        return table.set_column(table.schema.get_field_index("kind"), "kind", pa.array(found))


def _kinds(items: DataFrame, n_items: int, dims: int, cfg: EngineConfig) -> _Kinds | None:
    """None if most items have features of their own, if the distinct ones take half a broadcast, or if two of them have one hash."""
    number = F.xxhash64("features")
    n = items.select(number.alias("h")).distinct().count() if dims else 0
    if not n or 2 * n > n_items or 16 * n * dims > cfg.scale.broadcast_bytes:
        return None
    table = items.select(number.alias("h"), "features").distinct().toArrow()
    hashes = table.column("h").to_numpy()
    order = np.argsort(hashes)
    if (np.diff(hashes[order]) == 0).any():
        return None
    features, numbers = kernels.distinct_rows(kernels.to_matrix(table.column("features"), dims))
    return _Kinds(features, hashes[order], numbers[order])


class _Known:
    """What finished lists need of the items, gathered shard by shard."""

    def __init__(self, kinds: _Kinds, columns: set[str]):
        self.kinds, self.columns, self.parts, self.bytes = kinds, sorted(columns), [], kinds.features.nbytes

    def add(self, table: pa.Table) -> None:
        own = protocol.own_arrays(table, {c: c for c in self.columns if not pa.types.is_list(table.schema.field(c).type)})
        self.parts.append((table.column("item_id").to_numpy(), self.kinds.number(table).column("kind").to_numpy().astype(np.int32),
                           table.column("pct").to_numpy(), own))
        self.bytes += table.num_rows * (20 + 8 * len(own))

    def arrays(self) -> tuple:
        """Sorted ids, kinds, percentiles, own columns."""
        ids, kind, pct = (np.concatenate([p[i] for p in self.parts]) for i in range(3))
        order = np.argsort(ids, kind="stable")
        own = {c: np.concatenate([p[3][c] for p in self.parts])[order] for c in self.parts[0][3]}
        return ids[order], kind[order], pct[order], own


def _finished(lists: DataFrame, shared, rerankers: dict[str, protocol.Reranker], own: dict[str, dict], spec: dict, schema: str) -> DataFrame:
    """Re-rank and measure the lists that stand with the users, in one map."""
    names, models = _carried(spec), list(spec["models"])
    per_user = sum(_depth(model, spec["k"]) for model in spec["models"].values())

    def finish(table: pa.Table) -> pa.Table:
        ids, kind, pct, columns, features = shared.value
        rows, lists_ = _flat_lists(table, names)
        place = np.searchsorted(ids, lists_["l_item"])
        keys = rows * len(models) + lists_["l_model"]
        kept, ranks = [], []
        for number, name in enumerate(models):
            at = np.flatnonzero(lists_["l_model"] == number)
            if name not in rerankers:
                kept.append(at)
                ranks.append(lists_["l_rank"][at])
                continue
            cells = {c: columns[column][place[at]] for c, column in own.get(name, {}).items() if column in columns}
            cells |= {"score": lists_["l_score"][at], "item_id": lists_["l_item"][at], "pct": pct[place[at]], "n_item": lists_["l_n"][at]}
            picks, new = _picks(rows[at], cells, features, kind[place[at]], rerankers[name], spec)
            kept.append(at[picks])
            ranks.append(new)
        kept, ranks = np.concatenate(kept), np.concatenate(ranks)
        if spec["only_hits"]:
            hits = lists_["l_hit"][kept]
            kept, ranks = kept[hits], ranks[hits]
            sim = np.zeros(len(kept))
        else:
            order = np.argsort(keys[kept], kind="stable")
            kept, ranks = kept[order], ranks[order]
            sim = _similarities(keys[kept], features, kind[place[kept]], spec)
        shares = np.column_stack([lists_[f"l_{name}"][kept] for name in PARTS]) if spec["parts"] else None
        return _list_rows(spec, lists_["l_model"][kept], table.column("user_id").to_numpy()[rows[kept]], table.column("n_user").to_numpy()[rows[kept]], ranks,
                          lists_["l_item"][kept], lists_["l_score"][kept], lists_["l_hit"][kept], lists_["l_n"][kept], sim, shares)

    def run(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            step = max(1, 2 * spec["cells"] // per_user)
            for at in range(0, table.num_rows, step):
                yield from finish(table.slice(at, step).combine_chunks()).to_batches()

    return lists.select("user_id", "n_user", *names).mapInArrow(run, schema)


def _rank_by_shards(users: DataFrame, items: DataFrame, n_items: int, row_bytes: float, moments: dict, spec: dict, cfg: EngineConfig,
                    workspace: Workspace, arrays_of, known: _Known | None, notes: dict | None) -> DataFrame:
    """``users`` (with marks) and their lists, before any re-ranking: one pass per shard, each written, so that no pass
    is done twice when an executor is lost; the pass before it is then removed."""
    context = users.sparkSession.sparkContext
    shard_rows = max(1, int(cfg.scale.shard_bytes // row_bytes))
    # Much rated items first: their vectors are the longest, so that lists fill early with high scores.
    placed = with_position(workspace.stage(items.withColumn("_less", -F.col("n_item")), "catalog-by-size"), [], ["_less", "item_id"],
                           cfg.scale.rows_per_task, known_cold=n_items <= cfg.scale.rows_per_task)
    shards = workspace.stage(placed.withColumn("_shard", F.floor(F.col("_pos") / shard_rows).cast("int")).drop("_pos", "_size", "_less")
                             .repartition("_shard").sortWithinPartitions("_shard"), "catalog-shards")
    names = _carried(spec)
    now, path = workspace.stage_at(users.select("*", *[F.array().cast(f"array<{kind}>").alias(name) for name, kind in names.items()]), "lists-0")
    counters = (context.accumulator(0), context.accumulator(0))
    for shard in range(max(1, math.ceil(n_items / shard_rows))):
        table = shards.filter(F.col("_shard") == shard).drop("_shard").toArrow()
        if not table.num_rows:
            continue
        arrays = arrays_of(table)
        if known is not None:
            known.add(table)
        shared = context.broadcast((arrays, moments))

        def run(batches, shared=shared):
            block, stats = shared.value
            for batch in batches:
                for table in _slices(pa.Table.from_batches([batch]), len(block["item_id"]), spec["cells"]):
                    yield from _merge_shard(table, block, stats, spec, counters).combine_chunks().to_batches()

        before = path
        now, path = workspace.stage_at(now.mapInArrow(run, now.schema), f"lists-{shard + 1}")
        workspace.remove(before)
        shared.destroy()
    if notes is not None:
        notes["scored"], notes["skipped"] = counters[0].value, counters[1].value

    return now


def _flat_rows(lists: DataFrame, spec: dict, schema: str) -> DataFrame:
    """A row for each entry of the lists that stand with the users."""
    names = _carried(spec)

    def rows(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            at, flat = _flat_lists(table, names)
            shares = np.column_stack([flat[f"l_{name}"] for name in PARTS]) if spec["parts"] else None
            yield from _list_rows(spec, flat["l_model"], table.column("user_id").to_numpy()[at], table.column("n_user").to_numpy()[at], flat["l_rank"],
                                  flat["l_item"], flat["l_score"], flat["l_hit"], flat["l_n"], np.zeros(len(at)), shares).to_batches()

    return lists.select("user_id", "n_user", *names).mapInArrow(rows, schema)


def with_marks(users: DataFrame, marks: DataFrame, tasks: int) -> DataFrame:
    """Attach the seen and liked item ids of each user as arrays. Both sides are dealt by user into ``tasks``
    partitions, in which they are grouped and joined; the map over the users that follows needs no other shuffle."""
    lists = marks.repartition(tasks, "user_id").groupBy("user_id").agg(
        F.collect_list(F.when(F.col("kind") == "seen", F.col("item_id"))).alias("seen"),
        F.collect_list(F.when(F.col("kind") == "liked", F.col("item_id"))).alias("liked"))
    none = F.array().cast("array<long>")
    return (users.repartition(tasks, "user_id").join(lists, "user_id", "left")
            .withColumn("seen", F.coalesce("seen", none)).withColumn("liked", F.coalesce("liked", none)))


def finish_lists(lists: DataFrame, items: DataFrame, spec: dict, rerankers: dict[str, protocol.Reranker], schema: str,
                 cfg: EngineConfig, n_rows: int) -> DataFrame:
    """Re-rank and measure merged lists: at most ``candidates`` rows per (model, user), ``n_rows`` at most in all."""
    own = {name: spec["models"][name]["kernel"].item_columns for name in rerankers if "kernel" in spec["models"][name]}
    wanted = sorted({c for columns in own.values() for c in columns.values()})
    rows = lookup(lists, items.select("item_id", "pct", "features", *wanted), "item_id", "user_id", cfg.scale)
    names = [field.split()[0] for field in schema.split(", ")]
    # Whole users per part, about a shard's size of vectors together.
    n_parts = max(1, math.ceil(n_rows * 8 * (spec["feature_dims"] + 16) / cfg.scale.shard_bytes))

    def finish(table: pa.Table) -> pa.Table:
        table = table.sort_by([("model", "ascending"), ("user_id", "ascending"), ("rank", "ascending")])
        features = kernels.to_matrix(table.column("features"), spec["feature_dims"])
        model, user = table.column("model").to_numpy(zero_copy_only=False), table.column("user_id").to_numpy()
        new = np.append(True, (model[1:] != model[:-1]) | (user[1:] != user[:-1]))[:len(user)]
        lists = np.cumsum(new) - 1
        rank = np.arange(1, len(lists) + 1) - np.searchsorted(lists, lists)
        kept, new_rank = [np.flatnonzero(~np.isin(model, list(rerankers)))], []
        new_rank.append(rank[kept[0]])
        for name, reranker in rerankers.items():
            at = np.flatnonzero(model == name)
            cells = {c: v for c, v in protocol.own_arrays(table, own.get(name, {})).items() if isinstance(v, np.ndarray)}
            cells |= {c: table.column(c).to_numpy() for c in ("score", "item_id", "pct", "n_item")}
            picks, ranks = _picks(lists[at], {c: v[at] for c, v in cells.items()}, features, at, reranker, spec)
            kept.append(at[picks])
            new_rank.append(ranks)
        kept, rank = np.concatenate(kept), np.concatenate(new_rank)
        order = np.argsort(lists[kept], kind="stable")
        kept, rank = kept[order], rank[order]
        done = {name: table.column(name).take(pa.array(kept)) for name in names}
        done["rank"] = pa.array(rank.astype(np.int32))
        done["sim_before"] = pa.array(_similarities(lists[kept], features, kept, spec))
        return pa.table(done)

    return (rows.withColumn("_part", F.pmod(F.xxhash64("user_id"), F.lit(n_parts)))
            .groupBy("_part").applyInArrow(finish, schema))
