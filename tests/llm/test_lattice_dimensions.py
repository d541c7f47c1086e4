"""Lattice hashing of vectors of other lengths and for other thresholds."""

import numpy as np
import pytest

from cohortviews.llm import lattice


def _pairs(dimension, cosine, n, rng):
    a, b = (lattice.normed(rng.normal(size=(n, dimension))) for _ in range(2))
    b = lattice.normed(b - (a * b).sum(1)[:, None] * a)
    return a, cosine * a + np.sqrt(1 - cosine * cosine) * b


def _hashing(dimension, least):
    return lattice.Hashing(dimension) if least == 0.9 else lattice.Hashing(dimension, least=least)


@pytest.mark.parametrize("dimension", [2, 4, 8, 16, 32, 64, 256, 768])
@pytest.mark.parametrize("least", [0.9, 0.8])
def test_pairs_at_the_threshold_meet(dimension, least):
    hashing = _hashing(dimension, least)
    a, b = (hashing.cells(x) for x in _pairs(dimension, least, 2000, np.random.default_rng(7)))
    assert (a[:, :, :, None] == b[:, :, None, :]).any((1, 2, 3)).mean() >= 0.98


@pytest.mark.parametrize("dimension", [8, 16, 64, 256, 768])
def test_cells_divide_the_vectors(dimension):
    x = lattice.normed(np.random.default_rng(8).normal(size=(5000, dimension)))
    cells = lattice.Hashing(dimension).cells(x)
    for table in range(cells.shape[1]):
        assert np.unique(cells[:, table, 0], return_counts=True)[1].max() <= 0.03 * len(x)


def test_links_of_short_vectors(spark):
    rng = np.random.default_rng(9)
    a, b = _pairs(16, 0.95, 100, rng)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([a, b]))]
    got = {r.vec_id: r.n_links for r in lattice.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    unit = np.concatenate([a, b])
    want = (unit @ unit.T >= 0.9).sum(1) - 1
    assert [got[i] for i in range(200)] == want.tolist() and want.min() >= 1
