import numpy as np
import pytest

from cohortviews.operators import select as sel


@pytest.fixture(scope="module")
def long(spark):
    """10 patients; g1 wide and complete, g2 widest but sparse, g3 flat, g4 marker."""
    rows = []
    for p in range(10):
        rows.append((f"p{p}", "ENSG1.1", float(p * 10)))
        rows.append((f"p{p}", "ENSG3.2", 1.0))
        rows.append((f"p{p}", "ENSG5.1", float(p)))
        rows.append((f"p{p}", "ENSG2.7", float(p * 1000) if p < 3 else None))
    rows.append(("p0", "ENSG4.9", 0.5))
    return spark.createDataFrame(rows, "patient_id string, feature_id string, value double")


def names(df):
    return {r.feature_id for r in df.collect()}


def test_gate_precedes_ranking(long):
    assert names(sel.top_variance_features(long, 2, 0.8)) == {"ENSG1.1", "ENSG5.1"}
    assert names(sel.top_variance_features(long, 2, 0.3)) == {"ENSG2.7", "ENSG1.1"}


def test_forced_features_bypass_the_gate(spark, long):
    keep = spark.createDataFrame([("ENSG4",), ("ENSG1",), ("ENSG404",)], "base_id string")
    got = {r.feature_id: r.forced for r in sel.top_variance_features(long, 1, 0.8, keep).collect()}
    assert got == {"ENSG1.1": False, "ENSG4.9": True}


def test_forced_feature_with_only_nulls(spark, long):
    more = long.union(spark.createDataFrame([("p1", "ENSG6.1", None)], long.schema))
    keep = spark.createDataFrame([("ENSG6",)], "base_id string")
    assert "ENSG6.1" in names(sel.top_variance_features(more, 1, 0.8, keep))


def test_rows_or_entities(spark, long):
    twice = long.where("feature_id = 'ENSG2.7'").union(long)
    # 3 patients measured twice: 6 rows
    assert "ENSG2.7" in names(sel.top_variance_features(twice, 1, 0.6))
    assert "ENSG2.7" not in names(sel.top_variance_features(twice, 1, 0.6, distinct_entities=True))


def test_nan_is_no_value(spark):
    df = spark.createDataFrame(
        [("a", "f", 1.0), ("b", "f", float("nan")), ("c", "f", 3.0)],
        "patient_id string, feature_id string, value double",
    )
    row = sel.feature_statistics(df).first()
    assert (row.n_obs, row.variance) == (2, 1.0)
    assert sel.feature_statistics(df, ddof=1).first().variance == 2.0


def test_ties_go_to_the_smaller_name(spark):
    rows = [(p, f, float(v)) for f in ("c", "b", "a") for p, v in (("x", 0), ("y", 1))]
    df = spark.createDataFrame(rows, "patient_id string, feature_id string, value double")
    assert names(sel.top_variance_features(df, 2, 1.0)) == {"a", "b"}


def test_recurrence(spark):
    rows = [(f"p{p}", "common") for p in range(50)] + [("p1", "rare"), ("p1", "pair"), ("p2", "pair"), ("p1", "pair")]
    df = spark.createDataFrame(rows, "patient_id string, feature_id string")
    got = {r.feature_id: r.n_entities for r in sel.recurrent_features(df, 0.03).collect()}
    assert got == {"common": 50, "pair": 2}  # half-even: 1.5 -> 2


def test_keep_features(spark, long):
    chosen = sel.top_variance_features(long, 1, 0.8)
    assert names(sel.keep_features(long, chosen)) == {"ENSG1.1"}


def test_fold_variance_equals_numpy(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6)) * np.arange(1, 7) + 1e4
    fold = np.arange(60) % 4
    rows = [(int(fold[i]), f"f{j}", float(x[i, j])) for i in range(60) for j in range(6)]
    rows.append((0, "empty", None))
    df = spark.createDataFrame(rows, "fold int, feature_id string, value double")
    got = {(r.fold, r.feature_id): r.variance for r in sel.fold_feature_variance(df, 4).collect()}
    for k in range(4):
        for j in range(6):
            assert np.isclose(got[k, f"f{j}"], x[fold != k, j].var(ddof=1), rtol=1e-9)
    assert got[1, "empty"] is None


def test_fold_top_and_panel(spark):
    rows = [(i % 3, f"f{j}", float(i * (j + 1))) for i in range(30) for j in range(5)]
    df = spark.createDataFrame(rows, "fold int, feature_id string, value double")
    panel = spark.createDataFrame([("f0",)], "feature_id string")
    chosen = sel.fold_top_features(df, 3, 2, panel).collect()
    for k in range(3):
        assert {r.feature_id for r in chosen if r.fold == k} == {"f4", "f3", "f0"}
    assert sel.fold_top_features(df, 3, None).count() == 15
    assert sel.fold_top_features(df, 3, 0).count() == 15
    assert sel.fold_top_features(df, 3, 99).count() == 15


def test_forbidden_columns():
    sel.forbid_columns(["a", "b"], ["patient_id", "cohort"])
    with pytest.raises(ValueError):
        sel.forbid_columns(["a", "cohort"], ["patient_id", "cohort"])
