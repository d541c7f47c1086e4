"""Shapes of physical plans that matter at scale."""

import re

import pytest
from pyspark.sql import functions as F

from cohortviews import dims, session
from cohortviews.operators import panels as pn
from cohortviews.operators import quality as ql
from cohortviews.operators import ranking as rk
from cohortviews.operators import reshape as rs
from cohortviews.operators import select as sel
from cohortviews.plans import cohort as co


@pytest.fixture(scope="module")
def long(spark):
    rows = spark.range(5000).select(
        (F.col("id") % 50).alias("patient_id"),
        F.format_string("ENSG%d.1", F.col("id") % 37).alias("feature_id"),
        (F.col("id") % 11).cast("double").alias("value"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("cohort"),
        F.lit("unused").alias("other"),
    )
    return session.stage(rows, "plan-test")


def plan(df, final=True):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0] if final else text


def test_selection_reads_the_table_once_per_statistic(spark, long):
    ids = dims.panel_ids(dims.panels(spark))
    text = plan(sel.top_variance_features(long, 5, 0.1, ids), final=False)
    assert "ReusedExchange" in text
    assert "TakeOrderedAndProject" in text and "other" not in re.sub(r"Location.*", "", text)


def test_chosen_features_are_broadcast_to_the_scan(long):
    chosen = sel.top_variance_features(long, 5, 0.1)
    text = plan(sel.keep_features(long, chosen))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text
    assert text.count("Exchange hashpartitioning") == 0


def test_large_sides_are_not_hinted(spark):
    side = spark.range(20)
    assert "broadcast" in session.small_side(side, 20)._jdf.queryExecution().toString().lower()
    assert "broadcast" not in session.small_side(side, 19)._jdf.queryExecution().logical().toString().lower()


def test_aggregates_combine_before_they_move(long):
    for df in (
        sel.feature_statistics(long),
        rs.mean_cells(long),
        ql.gate_features(long, long.select("patient_id", "cohort").distinct(), None, 0.5),
    ):
        assert "partial_" in plan(df)


def test_top_per_key_limits_before_the_shuffle(long):
    scores = long.select("cohort", "patient_id", "value")
    text = plan(rk.top_per_key(scores, [F.desc("value"), F.asc("patient_id")], 3, ["cohort"]))
    assert text.count("WindowGroupLimit") == 2


def test_no_cartesian_product(spark, long):
    view = co.ranked_view("RNA", long, 5, 0.1)
    ranked = pn.rank_features(sel.feature_statistics(long).select(F.col("feature_id").alias("feature"), F.col("variance").alias("s")), "s")
    for df in (view.arrays, ranked, pn.panel_hits(ranked, dims.panels(spark))):
        text = plan(df, final=False)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_merge_keeps_one_row_per_entity(long):
    views = [co.View(n, co.ranked_view(n, long, 5, 0.1).arrays, None) for n in ("a", "b")]
    merged = co.merge(views)
    assert merged.columns == ["patient_id", "a", "b"] and merged.count() == 50


def test_ordinals_agree_on_both_paths(spark, monkeypatch):
    names = spark.createDataFrame([(f"f{i:03d}",) for i in range(300)], "feature_id string").repartition(5)
    small = {r.feature_id: r.at for r in rk.ordinals(names, [F.asc("feature_id")], "at").collect()}
    monkeypatch.setattr(rk, "BROADCAST_ROWS", 10)
    large = {r.feature_id: r.at for r in rk.ordinals(names, [F.asc("feature_id")], "at").collect()}
    assert small == large == {f"f{i:03d}": i for i in range(300)}


def test_inline_table_keeps_odd_names(spark):
    rows = [("a'b", 1, 0.5), ("c\\d", 2, 1e-3), ("e`f.g", 3, -2.0)]
    assert [tuple(r) for r in dims.inline_table(spark, rows, "n string, i bigint, x double").collect()] == rows
    assert dims.inline_table(spark, [], "n string, i bigint").count() == 0


def test_builders_run_in_order_and_raise():
    assert session.together(lambda: 1, lambda: 2) == [1, 2]

    def fails():
        raise ValueError("no")

    with pytest.raises(ValueError):
        session.together(fails, lambda: 1)
