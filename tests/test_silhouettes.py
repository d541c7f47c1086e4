import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortviews.operators import evaluate as ev
from cohortviews.operators import silhouettes as si


def frame(spark, x, c):
    rows = [(i, [float(v) for v in row], None if k is None else int(k)) for i, (row, k) in enumerate(zip(x, c))]
    return spark.createDataFrame(rows, "id long, vector array<double>, cluster int")


def values(df):
    return {r.id: r.silhouette for r in df.collect()}


@pytest.mark.parametrize("spread, block_rows", [(0.3, 7), (0.3, 1000), (4.0, 16)])
def test_same_values_with_fewer_distances(spark, spread, block_rows):
    """Clusters apart, and clusters inside each other; a third of the rows in one of them."""
    rng = np.random.default_rng(2)
    c = np.array([0] * 60 + [1 + i % 6 for i in range(120)])
    x = rng.normal(size=(7, 3))[c] * 8 + spread * rng.normal(size=(180, 3))
    df = frame(spark, x, c)
    out = si.silhouette_bounded(df, "id", block_rows=block_rows).cache()
    wanted, got = values(ev.silhouette_exact(df, "id")), values(out)
    assert set(got) == set(wanted) and np.allclose([got[i] for i in sorted(got)], [wanted[i] for i in sorted(got)])
    measured = out.agg(F.sum("n_distances")).first()[0]
    if spread < 1:
        assert measured < 0.5 * 180 * 180


def test_alone_repeated_and_without_a_cluster(spark):
    x = [[0.0, 0.0], [0.0, 0.0], [5.0, 5.0], [9.0, 1.0], [9.0, 1.5]]
    df = frame(spark, x, [0, 0, 1, 2, None])
    got = values(si.silhouette_bounded(df, "id"))
    assert got == {0: 1.0, 1: 1.0, 2: 0.0, 3: 0.0}
    assert set(values(si.silhouette_bounded(df.where("cluster = 0"), "id")).values()) == {0.0}
    assert si.silhouette_bounded(df.limit(0), "id").count() == 0
    with pytest.raises(Exception):
        si.silhouette_bounded(df.unionByName(df), "id").count()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("of", [ev.silhouette_exact, si.silhouette_bounded])
def test_blocks_meet_without_copies_in_a_shuffle(spark, of):
    """Blocks pair up where they lie: no row is repeated for each block it must meet."""
    rng = np.random.default_rng(5)
    text = plan(of(frame(spark, rng.normal(size=(60, 3)), [i % 3 for i in range(60)]), "id", block_rows=8))
    assert "CartesianProduct" in text and "Generate explode" not in text and "FlatMapGroupsInPandas" not in text


@pytest.mark.parametrize("of", [ev.silhouette_exact, si.silhouette_bounded])
def test_copies_far_from_the_origin(spark, of):
    """Copies have distance zero, near rows their own distance, wherever the cloud lies; clusters may be text."""
    x = np.array([[0.0, 0.0], [0.0, 0.0], [3e-5, 4e-5], [1.0, 1.0], [1.0, 1.0 + 1e-4]]) + 1e3
    df = frame(spark, x, [0, 0, 0, 1, 1]).withColumn("cluster", F.col("cluster").cast("string"))
    got = values(of(df, "id", block_rows=2))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    own = np.array([d[0, :3].sum() / 2, d[1, :3].sum() / 2, d[2, :3].sum() / 2, d[3, 4], d[4, 3]])
    other = np.concatenate([d[:3, 3:].mean(1), d[3:, :3].mean(1)])
    assert np.allclose([got[i] for i in range(5)], (other - own) / other, rtol=1e-9)
