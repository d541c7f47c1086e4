import pytest
from pyspark.sql import functions as F

from cohortviews.operators import select as sel
from cohortviews.operators import states as st
from cohortviews.sources import folders


@pytest.fixture(scope="module")
def rows(spark):
    """Three cohorts; values far from zero; feature f3 in one cohort only, f4 never with a value, some repeated entities."""
    i = F.col("id")
    return spark.range(3000).select(
        F.concat(F.lit("c"), (i % 3).cast("string")).alias("cohort"),
        F.concat(F.lit("p"), F.floor(i / 7).cast("string")).alias("patient_id"),
        F.concat(F.lit("f"), F.when((i % 4 == 3) & (i % 3 != 0), 0).otherwise(i % 5).cast("string")).alias("feature_id"),
        F.when(i % 5 != 4, 1e9 + F.sin(i.cast("double")) * (1 + i % 5)).when(i % 2 == 0, F.lit(float("nan"))).alias("value"),
    )


def picked(df):
    return {r.feature_id: (r.n_obs, None if r.variance is None else round(r.variance, 4), r.forced) for r in df.collect()}


def test_states_select_as_rows_do(spark, rows, tmp_path):
    root = str(tmp_path / "states")
    loads = ["c0", "c1", "c2"]
    for load in loads:
        assert st.add_load(rows.where(F.col("cohort") == load), root, load)
    panel = spark.createDataFrame([("f4",), ("none",)], "base_id string")
    for n, coverage, ddof in ((2, 0.8, 0), (9, 0.0, 1), (3, 0.2, 0)):
        wanted = picked(sel.top_variance_features(rows, n, coverage, panel, ddof=ddof))
        assert picked(st.top_variance_of_loads(spark, root, loads, n, coverage, panel, ddof=ddof)) == wanted
    part = rows.where("cohort <> 'c1'")
    assert picked(st.top_variance_of_loads(spark, root, ["c0", "c2"], 9, 0.1)) == picked(sel.top_variance_features(part, 9, 0.1))


def test_a_stored_load_is_not_read_again(spark, rows, tmp_path):
    root, calls = str(tmp_path / "states"), spark.sparkContext.accumulator(0)

    @F.udf("double")
    def seen(x):
        calls.add(1)
        return x

    counted = rows.where("cohort = 'c0'").withColumn("value", seen("value"))
    assert st.add_load(counted, root, "c0")
    first = calls.value
    assert first > 0 and not st.add_load(counted, root, "c0") and calls.value == first
    # one of its two tables lost its mark: the load is incomplete and written again
    folders.remove(spark, f"{root}/c0/{st.ENTITIES}/{folders.MARKER}")
    with pytest.raises(RuntimeError):
        st.top_variance_of_loads(spark, root, ["c0"], 3, 0.1)
    assert st.add_load(counted, root, "c0") and calls.value > first
    assert st.drop_load(spark, root, "c0") and not st.drop_load(spark, root, "c0")


def test_sketches_of_many_entities(spark):
    """More distinct entities than a sketch holds, so that the estimates are estimates."""
    pairs = spark.range(200_000).select(
        F.col("id").alias("patient_id"), F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("modality")
    ).where("modality = 'a' OR (modality = 'b' AND patient_id % 2 = 0) OR (modality = 'c' AND patient_id % 3 = 0)")
    parts = st.entity_sketches(pairs.withColumn("part", F.col("patient_id") % 4), ["modality", "part"])
    found = {r.step: r for r in st.sketched_funnel(parts).collect()}
    wanted = {"a": 200_000, "b": 100_000, "c": 66_667, "in_1_views": 200_000, "in_3_views": 33_334}
    assert set(found) == set(wanted)
    for step, n in wanted.items():
        assert 0 < found[step].error < 0.07 * 200_000 and abs(found[step].n_entities - n) <= found[step].error


def test_small_sketches_are_exact(spark):
    pairs = spark.createDataFrame([("x", "a"), ("y", "a"), ("y", "b"), (None, "b")], "patient_id string, modality string")
    found = {r.step: (r.n_entities, r.error) for r in st.sketched_funnel(st.entity_sketches(pairs, ["modality"])).collect()}
    assert found == {"a": (2, 0.0), "b": (1, 0.0), "in_1_views": (2, 0.0), "in_2_views": (1, 0.0)}
    assert st.sketched_funnel(st.entity_sketches(pairs.limit(0), ["modality"])).count() == 0


def test_quantile_sketches_merge(spark):
    n = 100_000
    rows = spark.range(n).select((F.col("id") % 7).alias("k"), F.when(F.col("id") % 10 == 0, None).otherwise(F.col("id")).alias("x"))
    whole = st.merged_quantiles(st.quantile_sketches(rows, ["k"], "x"), [], [0.0, 0.25, 0.9]).first()
    assert whole.n == 90_000
    for share, q in zip((0.0, 0.25, 0.9), whole.quantiles):
        assert abs(q / n - share) <= st.KLL_RANK_ERROR + 1e-3


def test_loads_are_read_from_rows_joined_once(spark, monkeypatch):
    """A load of the query scans its own folder: the joins behind the rows are not run again for each load."""
    from cohortviews.plans import queries_states as qs

    plans, add_load = [], st.add_load

    def watched(rows, root, load):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return add_load(rows, root, load)

    monkeypatch.setattr(st, "add_load", watched)
    qs.incremental_selection(spark, "/root/testdata/sf0.001").collect()
    assert len(plans) > 1 and not any("Join" in p for p in plans)
    assert all("PartitionFilters: [isnotnull(cohort" in p for p in plans)
