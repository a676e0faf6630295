"""Neighbour search with bounds against all pairs."""

import numpy as np
import pytest

from coldspring.config import ScaleConfig
from coldspring.operators import neighbours


def unit(m):
    length = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(length > 0, length, 1)


def clustered(n, seed, equal=0, zeros=0):
    """Points around a few centres, a group of equal vectors, and zero vectors; ids in no order."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, 6))
    m = unit(centres[rng.integers(0, 8, n)] + 0.1 * rng.normal(size=(n, 6)))
    m[:equal] = m[0]
    m[equal:equal + zeros] = 0.0
    return rng.permutation(5 * n)[:n], m


def table(spark, ids, m):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, m)], "id long, vec array<double>").repartition(3)


def all_pairs(ids, m, k, digits, asked):
    out = set()
    cosine = np.round(m @ m.T, digits) + 0.0
    for a in range(len(ids)):
        if ids[a] in asked:
            order = sorted((b for b in range(len(ids)) if b != a), key=lambda b: (-cosine[a, b], ids[b]))[:k]
            out |= {(int(ids[a]), rank, int(ids[b]), float(cosine[a, b])) for rank, b in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("scale", [ScaleConfig(), ScaleConfig(broadcast_bytes=0, shard_bytes=1, rows_per_task=50)])
def test_neighbours_equal_all_pairs(spark, workspace, scale, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 64)
    for seed, equal, zeros in ((0, 0, 0), (1, 90, 40)):
        ids, m = clustered(300, seed, equal, zeros)
        df = workspace.stage(table(spark, ids, m), "vectors")
        got = {tuple(r) for r in neighbours.nearest(df, 300, 6, 5, 9, scale, workspace).collect()}
        assert got == all_pairs(ids, m, 5, 9, set(ids.tolist()))
        some = {int(i) for i in ids[::7]}
        asked = spark.createDataFrame([(i,) for i in some], "id long")
        got = {tuple(r) for r in neighbours.nearest(df, 300, 6, 3, 9, scale, workspace, asked).collect()}
        assert got == all_pairs(ids, m, 3, 9, some)


def test_most_pairs_are_skipped(spark, workspace):
    """Also in a group of equal vectors that holds half of all rows."""
    ids, m = clustered(4000, 3, equal=2000)
    notes = {}
    df = workspace.stage(table(spark, ids, m), "many-vectors")
    found = neighbours.nearest(df, 4000, 6, 4, 9, ScaleConfig(), workspace, notes=notes)
    assert found.count() == 16000
    assert notes["compared"] + notes["skipped"] == 4000 * 4000
    assert notes["compared"] < notes["skipped"] / 4
    same = sorted(ids[:2000].tolist())
    lists = {r.id: r.near for r in found.filter("id in (%s)" % ",".join(map(str, same[:3]))).groupBy("id").agg({"neighbour_id": "collect_list"}).toDF("id", "near").collect()}
    assert sorted(lists[same[0]]) == same[1:5] and sorted(lists[same[2]]) == [same[i] for i in (0, 1, 3, 4)]


def test_fewer_vectors_than_neighbours(spark, workspace):
    one = spark.createDataFrame([(4, [1.0, 0.0])], "id long, vec array<double>")
    assert neighbours.nearest(one, 1, 2, 3, 9, ScaleConfig(), workspace).count() == 0
    none = one.filter("id < 0")
    assert neighbours.nearest(none, 0, 2, 3, 9, ScaleConfig(), workspace).count() == 0
    zeros = spark.createDataFrame([(4, [0.0, 0.0]), (2, [0.0, 0.0]), (9, [1.0, 0.0])], "id long, vec array<double>")
    got = sorted(map(tuple, neighbours.nearest(zeros, 3, 2, 3, 9, ScaleConfig(), workspace).collect()))
    assert got == [(2, 1, 4, 0.0), (2, 2, 9, 0.0), (4, 1, 2, 0.0), (4, 2, 9, 0.0), (9, 1, 2, 0.0), (9, 2, 4, 0.0)]
