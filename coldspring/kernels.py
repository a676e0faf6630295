"""NumPy helpers that run inside Arrow tasks on one bounded batch at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def to_matrix(column, dims: int) -> np.ndarray:
    """An Arrow list<double> column as a (rows x dims) array."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def to_list_column(matrix: np.ndarray) -> pa.Array:
    rows, dims = matrix.shape
    offsets = np.arange(0, rows * dims + 1, max(dims, 1), dtype=np.int32) if dims else np.zeros(rows + 1, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def pack_rows(matrix: np.ndarray):
    """((offsets, places), (offsets, values)): the entries of each row that are not zero; all entries of a row and no places where
    that is shorter."""
    used = matrix != 0
    n = used.sum(axis=1)
    whole = 12 * n >= 8 * matrix.shape[1]
    places = np.nonzero(used & ~whole[:, None])[1].astype(np.int32)
    offsets = [np.append(0, np.cumsum(size)).astype(np.int32) for size in (np.where(whole, 0, n), np.where(whole, matrix.shape[1], n))]
    return (offsets[0], places), (offsets[1], matrix[used | whole[:, None]])


def unpack_rows(n_places: np.ndarray, places: np.ndarray, n_values: np.ndarray, values: np.ndarray, dims: int) -> np.ndarray:
    """The matrix of ``pack_rows``, by the number of places and values of each row."""
    whole = n_values > n_places
    out = np.zeros((len(n_values), dims))
    of_whole = np.repeat(whole, n_values)
    out[whole] = values[of_whole].reshape(-1, dims)
    out[np.repeat(np.arange(len(n_values)), n_values)[~of_whole], places] = values[~of_whole]
    return out


def outer_sum(matrix: np.ndarray) -> np.ndarray:
    return (matrix.T @ matrix).ravel()


def _grouped(targets, sources, weights, vector_ids):
    """Edges sorted by target: (unique targets, starts, ends, vector rows, weights). An edge
    whose source has no vector is left out, as a zero vector would add nothing."""
    in_order = bool((vector_ids[1:] >= vector_ids[:-1]).all())
    by_id = None if in_order else np.argsort(vector_ids, kind="stable")
    rows = np.minimum(np.searchsorted(vector_ids, sources, sorter=by_id), max(len(vector_ids) - 1, 0))
    rows = rows if in_order or not len(rows) else by_id[rows]
    known = vector_ids[rows] == sources if len(vector_ids) else np.zeros(len(sources), dtype=bool)
    targets, rows, weights = targets[known], rows[known], weights[known]
    order = np.argsort(targets, kind="stable")
    targets, rows, weights = targets[order], rows[order], weights[order]
    unique, starts = np.unique(targets, return_index=True)
    return unique, starts, np.append(starts[1:], len(targets)).astype(int), rows, weights


def weighted_sums(targets, sources, weights, vector_ids, vectors, chunk: int = 8192):
    """(unique targets, sum of weight * vector(source) per target)."""
    unique, starts, ends, found, weights = _grouped(targets, sources, weights, vector_ids)
    out = np.zeros((len(unique), vectors.shape[1]))
    first = 0
    while first < len(unique):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + chunk, side="right")))
        lo, hi = starts[first], ends[last - 1]
        part = vectors[found[lo:hi]] * weights[lo:hi, None]
        out[first:last] = np.add.reduceat(part, starts[first:last] - lo, axis=0)
        first = last
    return unique, out


def ridge_rows(targets, sources, weights, vector_ids, vectors, gram, split_targets):
    """Solve the implicit-feedback normal equations of each target in the block.

    Returns (ids, solutions, split ids, packed partial equations). A target in
    ``split_targets`` has only a part of its rows here, so its equations
    [upper triangle of Y'diag(w)Y | Y'(1+w)] are passed on for summing instead.
    """
    dims = vectors.shape[1]
    unique, starts, ends, found, weights = _grouped(targets, sources, weights, vector_ids)
    is_split = np.isin(unique, split_targets)
    used, found = np.unique(found, return_inverse=True)
    vectors = vectors[used]
    through = vectors @ np.linalg.inv(gram)
    solved = np.zeros((len(unique), dims))
    sizes = ends - starts
    # Targets with the same number of rows are solved together.
    for size in np.unique(sizes[~is_split]):
        same = np.flatnonzero((sizes == size) & ~is_split)
        step = max(1, 1_000_000 // (size * dims))
        for at in range(0, len(same), step):
            some = same[at:at + step]
            cells = starts[some, None] + np.arange(size)
            rows, w = found[cells], weights[cells]
            y = vectors[rows]
            if size < dims:
                solved[some] = _short_ridge(y, through[rows], w)
            else:
                a = gram + (y * w[:, :, None]).transpose(0, 2, 1) @ y
                b = ((1.0 + w)[:, None, :] @ y)[:, 0, :]
                solved[some] = np.linalg.solve(a, b[:, :, None])[:, :, 0]
    parts = np.zeros((int(is_split.sum()), dims * (dims + 1) // 2 + dims))
    for row, at in enumerate(np.flatnonzero(is_split)):
        y, w = vectors[found[starts[at]:ends[at]]], weights[starts[at]:ends[at]]
        parts[row] = np.concatenate([pack_triangle((y.T * w) @ y), y.T @ (1.0 + w)])
    return unique[~is_split], solved[~is_split], unique[is_split], parts


def _short_ridge(y, z, w):
    """(G + Y'WY)^-1 Y'(1+w) for a stack of targets with fewer rows than dims, from a
    rows x rows system (Woodbury identity); ``z`` = Y G^-1, shared by all targets. Weights may be negative or 0."""
    inner = (z @ y.transpose(0, 2, 1)) * w[:, :, None]
    inner += np.eye(y.shape[1])
    base = ((1.0 + w)[:, None, :] @ z)[:, 0, :]
    right = w * (y @ base[:, :, None])[:, :, 0]
    left = np.linalg.solve(inner, right[:, :, None])[:, :, 0]
    return base - (left[:, None, :] @ z)[:, 0, :]


def pack_triangle(matrix: np.ndarray) -> np.ndarray:
    """The upper triangle of a symmetric matrix, row by row."""
    return matrix[np.triu_indices(len(matrix))]


def unpack_triangle(packed: np.ndarray, dims: int) -> np.ndarray:
    """The symmetric matrices (... x dims x dims) of packed upper triangles."""
    out = np.zeros((*packed.shape[:-1], dims, dims))
    i, j = np.triu_indices(dims)
    out[..., i, j] = packed
    out[..., j, i] = packed
    return out


def scatter(lengths, places, values, width: int) -> np.ndarray:
    """Rows of (place, value) lists as a dense matrix."""
    out = np.zeros((len(lengths), width))
    out[np.repeat(np.arange(len(lengths)), lengths), places] = values
    return out


def solve_packed(packed: np.ndarray, gram: np.ndarray, step: int = 256) -> np.ndarray:
    """Solutions of summed equations (rows of [packed triangle | right side]) with ``gram`` added to each."""
    dims = gram.shape[0]
    cells = dims * (dims + 1) // 2
    out = np.zeros((len(packed), dims))
    for at in range(0, len(packed), step):
        rows = packed[at:at + step]
        out[at:at + step] = np.linalg.solve(gram + unpack_triangle(rows[:, :cells], dims), rows[:, cells:, None])[:, :, 0]
    return out


# --- scoring ---------------------------------------------------------------

def standardise(scores, mean, std, known):
    """z-scores from known moments; rows without information or spread become 0."""
    std = np.where(known & (std > 1e-12), std, np.inf)
    return (scores - mean[:, None]) / std[:, None]


def standardise_pairs(scores: np.ndarray, row: np.ndarray, mean, std, known) -> np.ndarray:
    """The same for scores of the users ``row``."""
    std = np.where(known & (std > 1e-12), std, np.inf)
    return (scores - mean[row]) / std[row]


def distinct_rows(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct rows, which of them each row is), rows that start alike beside each other."""
    n, dims = matrix.shape
    if not n or not dims:
        return matrix[:1], np.zeros(n, dtype=np.int64)
    whole = np.ascontiguousarray(matrix).view(np.dtype((np.void, 8 * dims)))[:, 0]
    _, first, kind = np.unique(whole, return_index=True, return_inverse=True)
    return matrix[first], kind


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def contains(ordered: np.ndarray, values: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool)
    return ordered[np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)] == values


def pair_signals(users: dict, items: dict, row: np.ndarray, place: np.ndarray, rows: np.ndarray, tiles: np.ndarray, wanted: set,
                 content: np.ndarray | None) -> dict:
    """Raw signals of the (user, item) pairs ``row``, ``place``: all items of the pairs (user, tile) ``rows``, ``tiles``, one after the other.
    ``content``: the products of the profiles with the distinct features of the items."""
    out = {}
    if "cf" in wanted:
        x, y = users["factors"], items["factors"]
        if x.shape[1] == 1:
            out["cf"] = x[row, 0] * y[place, 0]
        else:
            out["cf"] = np.einsum("ij,ij->i", x[row], y[place])
    if "content" in wanted:
        out["content"] = content[row, items["kind"][place]]
        out["content"] += users["profile"].any(axis=1)[row] * items["tie_break"][place]
    if "demographic" in wanted:
        segment, starts = users["segment"], items["tile_starts"]
        out["demographic"] = items["segment_base"][segment][row] + items["popularity"][place]
        cell = tiles * len(items["segment_base"]) + segment[rows]
        lo = items["cells"][cell]
        sizes = items["cells"][cell + 1] - lo
        entries = ranges(lo, sizes)
        ends = np.cumsum(starts[tiles + 1] - starts[tiles])
        at = np.repeat(ends - (starts[tiles + 1] - starts[tiles]), sizes) + items["segment_places"][entries]
        out["demographic"][at] += items["segment_deltas"][entries]
    return out


def tile_tops(items: dict) -> dict:
    """What bounds the scores of each tile: ends of its factors and history, the largest values, its kinds of features and its least id."""
    starts = items["tile_starts"][:-1]
    if not len(starts):
        return {"least_id": np.zeros(0, dtype=np.int64), "by_id": np.zeros(0, dtype=np.int64)}
    least, most = (lambda v: np.minimum.reduceat(v, starts, axis=0)), (lambda v: np.maximum.reduceat(v, starts, axis=0))
    kind, last = items["kind"], items["tile_starts"][1:] - 1
    sizes = kind[last] - kind[starts] + 1
    ids = least(items["item_id"])
    return {"low": least(items["factors"]), "high": most(items["factors"]), "length": np.sqrt(most((items["factors"] ** 2).sum(axis=1))),
            "tie_break": most(items["tie_break"]), "popularity": most(items["popularity"]), "segments": _segment_tops(items, most(items["popularity"])),
            "n_item": (least(items["n_item"]), most(items["n_item"])), "least_id": ids, "by_id": np.argsort(ids, kind="stable"),
            "kinds": ranges(kind[starts], sizes), "kind_starts": np.cumsum(sizes) - sizes, "n_kinds": sizes}


def joined_tops(tops: dict, starts: np.ndarray) -> dict:
    """The same for groups of neighbouring tiles, those with the lowest ids first, and the tiles of each group (``first``, ``end``)."""
    first, end = starts[:-1], starts[1:]
    if not len(first):
        return tops
    least, most = (lambda v, axis=0: np.minimum.reduceat(v, first, axis=axis)), (lambda v, axis=0: np.maximum.reduceat(v, first, axis=axis))
    low = tops["kinds"][tops["kind_starts"]]
    ids, lowest, sizes = least(tops["least_id"]), least(low), most(low + tops["n_kinds"]) - least(low)
    order = np.argsort(ids, kind="stable")
    sizes = sizes[order]
    return {"low": least(tops["low"])[order], "high": most(tops["high"])[order], "segments": most(tops["segments"], 1)[:, order],
            "n_item": (least(tops["n_item"][0])[order], most(tops["n_item"][1])[order]), "least_id": ids[order], "first": first[order], "end": end[order],
            "kinds": ranges(lowest[order], sizes), "kind_starts": np.cumsum(sizes) - sizes, "n_kinds": sizes,
            **{name: most(tops[name])[order] for name in ("length", "tie_break", "popularity")}}


def _segment_tops(items: dict, popularity: np.ndarray) -> np.ndarray:
    """The highest score of each segment in each tile (an item without a delta may be the highest): segments x tiles."""
    n_segments, cells = len(items["segment_base"]), items["cells"]
    top = np.repeat(popularity, n_segments)
    used = np.flatnonzero(np.diff(cells))
    if len(used):
        sizes = np.diff(cells)[used]
        place = np.repeat(items["tile_starts"][used // n_segments], sizes) + items["segment_places"]
        scores = items["popularity"][place] + items["segment_deltas"]
        top[used] = np.maximum(top[used], np.maximum.reduceat(scores, cells[used]))
    return np.ascontiguousarray(top.reshape(-1, n_segments).T) + items["segment_base"][:, None]


def signal_bounds(users: dict, tops: dict, wanted: set, content: np.ndarray | None) -> dict:
    """(users x tiles) the most a signal can be for any item of a tile; a little more, for rounding. ``content``: the products of the
    profiles with the distinct features."""
    out, more = {}, 1e-9
    if "cf" in wanted:
        x = users["factors"]
        length = np.linalg.norm(x, axis=1)[:, None] * tops["length"]
        box = np.maximum(x, 0) @ tops["high"].T + np.minimum(x, 0) @ tops["low"].T
        out["cf"] = np.minimum(box, length, out=box)
        out["cf"] += np.multiply(length, more, out=length)
    if "content" in wanted:
        kinds = tops["kinds"]
        top = content[:, kinds]
        if len(kinds) > len(tops["kind_starts"]):
            top = np.maximum.reduceat(top, tops["kind_starts"], axis=1)
        has = users["profile"].any(axis=1)
        out["content"] = top + has[:, None] * (tops["tie_break"] + more)
    if "demographic" in wanted:
        out["demographic"] = tops["segments"][users["segment"]]
    return out


def pair_bounds(users: dict, tops: dict, row: np.ndarray, tile: np.ndarray, wanted: set, content: np.ndarray | None) -> dict:
    """``signal_bounds`` of pairs of a user and a tile."""
    out, more = {}, 1e-9
    if "cf" in wanted:
        x = users["factors"]
        length = np.linalg.norm(x, axis=1)[row] * tops["length"][tile]
        x = x[row]
        box = np.einsum("ij,ij->i", x, np.where(x > 0, tops["high"][tile], tops["low"][tile]))
        out["cf"] = np.minimum(box, length) + length * more
    if "content" in wanted:
        sizes = tops["n_kinds"][tile]
        if (sizes == 1).all():
            top = content[row, tops["kinds"][tops["kind_starts"][tile]]]
        else:
            kinds = tops["kinds"][ranges(tops["kind_starts"][tile], sizes)]
            top = np.maximum.reduceat(content[np.repeat(row, sizes), kinds], np.cumsum(sizes) - sizes)
        out["content"] = top + users["profile"].any(axis=1)[row] * (tops["tie_break"][tile] + more)
    if "demographic" in wanted:
        out["demographic"] = tops["segments"][users["segment"][row], tile]
    return out


def blend_bounds(model: dict, z: dict, n_user: np.ndarray, least: np.ndarray, most: np.ndarray, cold_below: int) -> np.ndarray:
    """The most a blend can be, from the most its z-scores can be; ``least``, ``most``: the ends of the history of the items."""
    nu = n_user.astype(float)
    if model["mode"] == "fixed":
        return 0.5 * z["cf"] + 0.5 * z["content"]
    if model["mode"] == "switch":       # an item has the weights of one end, whole
        cold = np.where(nu > 0, z["content"], z["demographic"])
        warm = np.maximum(np.where(most >= cold_below, z["cf"], -np.inf), np.where(least < cold_below, cold, -np.inf))
        return np.where(nu >= cold_below, warm, cold)
    t = nu / (nu + model["k_content"])
    rest = t * z["content"]
    rest += (1 - t) * z["demographic"]
    # between the ends the blend is linear in the weight of cf
    more = z["cf"] - rest
    low, high = (n / (n + model["k_item"]) for n in (least.astype(float), most.astype(float)))
    share = np.where(more > 0, high, low)
    share *= nu / (nu + model["k_user"])
    share *= more
    share += rest
    return share


def row_moments(users: dict, moments: dict, wanted: set) -> dict:
    """Per user (mean, std, known) of each signal over the whole catalog, from the mean and
    covariance of the item vectors; no second pass over the scores is needed."""
    out = {}
    if "cf" in wanted:
        x = users["factors"]
        var = np.einsum("ij,jk,ik->i", x, moments["factors_cov"], x, optimize=True)
        out["cf"] = (x @ moments["factors_mean"], np.sqrt(np.maximum(var, 0)), x.any(axis=1))
    if "content" in wanted:
        p = users["profile"]
        has = p.any(axis=1)
        var = (np.einsum("ij,jk,ik->i", p, moments["features_cov"], p, optimize=True)
               + 2 * p @ moments["features_tie_cov"] + moments["tie_var"])
        out["content"] = (p @ moments["features_mean"] + moments["tie_mean"], np.sqrt(np.maximum(var, 0)), has)
    if "demographic" in wanted:
        s = users["segment"]
        out["demographic"] = (moments["popularity_mean"][s], moments["popularity_std"][s],
                              np.ones(len(s), dtype=bool))
    return out


def trust(model: dict, n_user: np.ndarray, n_item: np.ndarray, cold_below: int):
    """Weights of cf, content and popularity, each broadcastable to (users x items)."""
    return shares(model, n_user[:, None].astype(float), n_item[None, :].astype(float), cold_below)


def shares(model: dict, nu: np.ndarray, ni: np.ndarray, cold_below: int):
    if model["mode"] == "fixed":
        return 0.5, 0.5, 0.0
    if model["mode"] == "switch":
        warm = (nu >= cold_below) & (ni >= cold_below)
        return warm.astype(float), (~warm & (nu > 0)).astype(float), (~warm & (nu == 0)).astype(float)
    cf = (nu / (nu + model["k_user"])) * (ni / (ni + model["k_item"]))
    t = nu / (nu + model["k_content"])
    return cf, (1 - cf) * t, (1 - cf) * (1 - t)


def blend_pairs(model: dict, z: dict, n_user: np.ndarray, n_item: np.ndarray, cold_below: int) -> np.ndarray:
    """The blend of pairs of a user and an item."""
    nu, ni = n_user.astype(float), n_item.astype(float)
    if model["mode"] == "adaptive":     # cf * a + (1 - cf) * (t * b + (1 - t) * c)
        t = nu / (nu + model["k_content"])
        rest = t * z["content"]
        rest += (1 - t) * z["demographic"]
        out = z["cf"] - rest
        out *= nu / (nu + model["k_user"])
        out *= ni / (ni + model["k_item"])
        out += rest
        return out
    cf, content, popularity = shares(model, nu, ni, cold_below)
    out = cf * z["cf"] + content * z["content"]
    if model["mode"] != "fixed":
        out += popularity * z["demographic"]
    return out


def best_rows(scores: np.ndarray, k: int, digits: int):
    """Row-wise top k of finite scores: score (rounded) descending, then lowest position.

    Returns (rows, ranks, positions, rounded scores) as flat arrays.
    """
    n_rows, n_items = scores.shape
    slack = 2.0 * 10.0 ** -digits
    if k < n_items:
        floor = np.partition(scores, n_items - k, axis=1)[:, n_items - k]
    else:
        floor = np.full(n_rows, -np.inf)
    floor = np.where(np.isfinite(floor), floor - slack, -np.finfo(float).max)
    rows, places = np.nonzero(scores >= floor[:, None])
    values = np.round(scores[rows, places], digits) + 0.0
    order = np.lexsort((places, -values, rows))
    rows, places, values = rows[order], places[order], values[order]
    ranks = np.arange(1, len(rows) + 1) - np.searchsorted(rows, rows)
    kept = ranks <= k
    return rows[kept], ranks[kept], places[kept], values[kept]


def among_highest(rows: np.ndarray, values: np.ndarray, k: int) -> np.ndarray | None:
    """Which of the values are among the k highest of their row, equal ones included (None: nearly all). ``rows`` are in order."""
    starts = np.flatnonzero(np.diff(rows, prepend=-1))
    sizes = np.diff(np.append(starts, len(rows)))
    if not len(rows) or sizes.max() <= k or sizes.max() * len(sizes) > 4 * len(rows):
        return None
    cells, used = padded(starts, sizes)
    grid = np.where(used, values[cells], -np.inf)
    floor = np.partition(grid, grid.shape[1] - k, axis=1)[:, grid.shape[1] - k]
    return values >= np.repeat(floor, sizes)


def padded(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Flat lists as a grid: (place of each cell in the flat arrays, whether the cell is used)."""
    width = int(sizes.max()) if len(sizes) else 0
    used = np.arange(width)[None, :] < sizes[:, None]
    return np.where(used, starts[:, None] + np.arange(width)[None, :], 0), used


def diversified(scores: np.ndarray, pct: np.ndarray, vectors: np.ndarray, used: np.ndarray, k: int, share: float, penalty: float,
                digits: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal marginal relevance for many lists at once: (lists x picks) of cell numbers and which of them count.

    ``scores``, ``pct``, ``used``: lists x cells; ``vectors``: lists x cells x dims. Relevance is the score scaled to 0..1 over the
    list, less ``penalty * pct``; the next pick of a list has the largest share * relevance - (1 - share) * (largest
    cosine to its picks, at least 0), equal values in cell order.
    """
    lists, cells = scores.shape
    least = np.where(used, scores, np.inf).min(axis=1, initial=np.inf)[:, None]
    most = np.where(used, scores, -np.inf).max(axis=1, initial=-np.inf)[:, None]
    spread = most > least
    relevance = np.where(spread, (scores - least) / np.where(spread, most - least, 1.0), 1.0) - penalty * pct
    open_cells = used.copy()
    closest = np.zeros((lists, cells))
    picks = np.zeros((lists, min(k, cells)), dtype=int)
    counts = np.zeros(picks.shape, dtype=bool)
    every = np.arange(lists)
    for step in range(picks.shape[1]):
        worth = np.where(open_cells, np.round(share * relevance - (1 - share) * closest, digits), -np.inf)
        picks[:, step] = worth.argmax(axis=1)
        counts[:, step] = open_cells.any(axis=1)
        open_cells[every, picks[:, step]] = False
        np.maximum(closest, np.einsum("lcd,ld->lc", vectors, vectors[every, picks[:, step]]), out=closest)
    return picks, counts


def similarity_before(vectors: np.ndarray) -> np.ndarray:
    """For each cell of each list (lists x cells x dims) the sum of its cosines to the cells before it."""
    return np.tril(vectors @ vectors.transpose(0, 2, 1), -1).sum(axis=2)
