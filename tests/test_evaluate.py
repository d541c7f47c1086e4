import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortviews.operators import evaluate as ev


@pytest.fixture(scope="module")
def published(spark):
    """The published three-cohort matrix, as rows."""
    cells = {(0, 0): 1094, (1, 0): 2, (1, 1): 513, (2, 2): 495}
    rows = [(a, p) for (a, p), n in cells.items() for _ in range(n)]
    return spark.createDataFrame(rows, "actual_code int, predicted_code int")


def test_published_scores(published):
    s = ev.summary_scores(published).first()
    assert math.isclose(s.accuracy, 2102 / 2104)
    assert math.isclose(s.balanced_accuracy, (1 + 513 / 515 + 1) / 3)
    report = {r.label: r for r in ev.classification_report(published).collect()}
    assert round(report["1"].recall, 5) == 0.99612 and report["0"].support == 1094
    assert math.isclose(report["macro avg"].recall, s.balanced_accuracy)
    matrix = {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(published).collect()}
    assert len(matrix) == 9 and matrix[1, 0] == 2 and matrix[0, 1] == 0


def test_scores_do_not_depend_on_order(spark, published):
    shuffled = published.orderBy(F.rand(3)).repartition(5)
    assert ev.summary_scores(shuffled).first() == ev.summary_scores(published).first()


def test_zero_division_counts_as_zero(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "actual_code int, predicted_code int")
    report = {r.label: r for r in ev.classification_report(df).collect()}
    assert report["1"].precision == 0.0 and report["1"].f1 == 0.0


def test_log_loss_clips(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [0.5, 0.5])], "actual_code int, probabilities array<double>")
    eps = np.finfo(float).eps
    expected = -(math.log(1 - eps) + math.log(eps) + math.log(0.5)) / 3
    assert math.isclose(ev.log_loss(df).first().log_loss, expected, rel_tol=1e-9)


def test_roc_against_pair_counting(spark):
    rng = random.Random(4)
    rows = [(rng.randrange(2), [rng.randrange(8) / 8, rng.randrange(4) / 4]) for _ in range(300)]
    df = spark.createDataFrame(rows, "actual_code int, probabilities array<double>").repartition(6)
    scored = ev.class_score_rows(df, [0, 1])
    auc = {r["class"]: r.auc for r in ev.roc_auc(scored).collect()}
    for c in (0, 1):
        pos = [p[c] for a, p in rows if a == c]
        neg = [p[c] for a, p in rows if a != c]
        wins = sum((x > y) + (x == y) / 2 for x, y in itertools.product(pos, neg))
        assert math.isclose(auc[c], wins / len(pos) / len(neg), rel_tol=1e-12)
    points = ev.roc_points(scored).where("class = 0").orderBy(F.desc_nulls_first("threshold")).collect()
    assert points[0].threshold is None and points[0].tpr == 0.0
    assert points[-1].tpr == 1.0 and points[-1].fpr == 1.0
    assert [p.tp for p in points] == sorted(p.tp for p in points)


def _brute_silhouette(x, c, power=1):
    out = []
    for i in range(len(x)):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1)) ** power
        own = c == c[i]
        if own.sum() == 1:
            out.append(0.0)
            continue
        a = d[own].sum() / (own.sum() - 1)
        b = min(d[c == k].mean() for k in set(c) if k != c[i])
        out.append((b - a) / max(a, b))
    return np.array(out)


@pytest.fixture(scope="module")
def clusters(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(90, 4))
    c = rng.integers(0, 3, size=90)
    c[:40] = 0  # one cluster dominates
    c[89] = 9  # and one has a single row
    rows = [(i, [float(v) for v in x[i]], int(c[i])) for i in range(90)]
    return spark.createDataFrame(rows, "id long, vector array<double>, cluster int"), x, c


@pytest.mark.parametrize("block_rows", [7, 40, 2048])
def test_exact_silhouette_any_block_size(clusters, block_rows):
    df, x, c = clusters
    got = {r.id: r.silhouette for r in ev.silhouette_exact(df, "id", block_rows=block_rows).collect()}
    assert np.allclose([got[i] for i in range(90)], _brute_silhouette(x, c))


def test_squared_silhouette(clusters):
    df, x, c = clusters
    got = {r.id: r.silhouette for r in ev.silhouette_squared(df).collect()}
    assert np.allclose([got[i] for i in range(90)], _brute_silhouette(x, c, 2))


def test_agreement(spark):
    rng = random.Random(2)
    rows = [(f"L{i % 4}", i % 4) for i in range(200)]
    same = spark.createDataFrame([(label, 3 - k) for label, k in rows], "label string, cluster int")
    r = ev.cluster_agreement(same).first()
    assert math.isclose(r.ari, 1.0) and math.isclose(r.nmi, 1.0)
    noise = spark.createDataFrame([(label, rng.randrange(4)) for label, _ in rows] + [(None, 1)], "label string, cluster int")
    r = ev.cluster_agreement(noise).first()
    assert r.n_labeled == 200 and abs(r.ari) < 0.1
    one = spark.createDataFrame([("x", 0), ("x", 0)], "label string, cluster int")
    assert ev.cluster_agreement(one).first().ari == 1.0


def test_purity_and_contingency(spark):
    rows = [(0, "b"), (0, "a"), (0, "a"), (0, "b"), (1, "c"), (1, None)]
    df = spark.createDataFrame(rows, "cluster int, label string")
    got = {r.cluster: (r.majority, r.purity_percent, r.n) for r in ev.cluster_purity(df).collect()}
    assert got == {0: ("a", 50.0, 4), 1: ("c", 100.0, 1)}
    cells = {(r.cluster, r.label): (r.n, r.row_percent) for r in ev.contingency(df, labels=["a", "b", "c"]).collect()}
    assert cells[0, "c"] == (0, 0.0) and cells[1, "c"] == (1, 100.0) and len(cells) == 6
    wide = {r.cluster: (r.a, r.b, r.c) for r in ev.contingency_wide(df, ["a", "b", "c"]).collect()}
    assert wide == {0: (2, 2, 0), 1: (0, 0, 1)}


def test_attribution(spark):
    rows = [("f", "x", 1.0), ("f", "x", -3.0), ("f", "y", 1.0), ("g", "x", 0.5), ("g", "y", 0.5)]
    df = spark.createDataFrame(rows, "feature string, class string, contribution double")
    got = {(r.feature, r["class"]): (r.mean_abs, r.mean_abs_all) for r in ev.attribution_summary(df).collect()}
    assert got["f", "x"] == (2.0, 1.5) and got["g", "y"] == (0.5, 0.5)


def test_loadings(spark):
    rows = [("v", 1, "a", -3.0), ("v", 1, "b", 2.0), ("v", 1, "c", 1.0), ("w", 1, "a", 0.1)]
    df = spark.createDataFrame(rows, "view string, factor int, feature string, loading double")
    got = {(r.view, r["rank"]): r.feature for r in ev.top_loadings(df, 2).collect()}
    assert got == {("v", 1): "a", ("v", 2): "b", ("w", 1): "a"}
