"""What a fold-in at two factors computes, and how its vectors are looked up."""

from types import SimpleNamespace

import numpy as np
import pytest

from coldspring import kernels
from coldspring.checks.queries import RANK2, Borrowed
from coldspring.config import ScaleConfig
from coldspring.operators import gather


class Owner:
    """An experiment whose profiles are not to be asked for."""

    def __init__(self):
        self.dataset = SimpleNamespace(name="none", ratings=None, items=None, users=None, tags=None, stored=True)
        self.workspace = SimpleNamespace(spark=None)
        self.split = object()

    @property
    def profiles(self):
        raise AssertionError("profiles were computed")


def test_what_is_borrowed_is_computed_when_asked_for():
    owner = Owner()
    made = Borrowed(owner, RANK2, ("split", "profiles"))
    assert made.split is owner.split and made.cfg is RANK2
    with pytest.raises(AssertionError, match="profiles were computed"):
        made.profiles


def test_shared_vectors_are_sorted_once(spark, monkeypatch):
    draw = np.random.default_rng(4)
    ids = draw.permutation(400)
    rows = spark.createDataFrame([(int(i), [float(i), 2.0 * float(i)]) for i in ids], "id long, vec array<double>").repartition(5)
    known, matrix = gather.Vectors(rows, 400, 2, ScaleConfig()).local
    assert known.tolist() == list(range(400)) and matrix[:, 1].tolist() == [2.0 * i for i in range(400)]

    targets, sources, weights = draw.integers(0, 9, 60), draw.integers(0, 500, 60), draw.normal(size=60)
    from_any = kernels.weighted_sums(targets, sources, weights, ids, np.column_stack([ids, 2 * ids]).astype(float))
    sort, lengths = np.argsort, []
    monkeypatch.setattr(np, "argsort", lambda values, *a, **k: lengths.append(len(values)) or sort(values, *a, **k))
    from_sorted = kernels.weighted_sums(targets, sources, weights, known, matrix)
    assert max(lengths) <= 60       # the edges of the block, not the vectors
    assert from_sorted[0].tolist() == from_any[0].tolist()
    np.testing.assert_allclose(from_sorted[1], from_any[1])
    assert not len(kernels.weighted_sums(targets, sources, weights, known[:0], matrix[:0])[0])
