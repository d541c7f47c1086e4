import json
import glob

import pytest
from pyspark.sql import functions as F

from cohortviews.plans import adapters as ad
from cohortviews.plans import queries_matrix as qm
from cohortviews import dims
from cohortviews.operators import merge as mg
from cohortviews.operators import quality as ql
from cohortviews.operators import reshape as rs
from cohortviews.plans import cohort as co
from cohortviews.sources import sinks

COHORTS = ("BRCA", "LUAD", "PRAD")
GENES = [f"ENSG{i:011d}.1" for i in range(10)]
PROBES = [f"cg{i:08d}" for i in range(10)]


@pytest.fixture(scope="module")
def study(spark):
    """Three cohorts, three patients each; one patient has no segments."""
    rna, cnv, meth = [], [], []
    for cohort in COHORTS:
        for i in range(3):
            p = f"TCGA-{cohort[:2]}-P{i:03d}"
            rna += [(cohort, p, g, float(10 * i + j)) for j, g in enumerate(GENES)]
            meth += [(cohort, p, c, 0.1 * (i + j % 5)) for j, c in enumerate(PROBES)]
            if (cohort, i) != ("LUAD", 2):
                cnv += [
                    (cohort, p, "1", 1_000_000, 5_000_000, 0.1 * i),
                    (cohort, p, "chr1", 130_000_000, 200_000_000, -0.1 * i),
                    (cohort, p, "M", 1, 5, 9.0),
                ]
    keys = "cohort string, patient_id string, "
    return (
        spark.createDataFrame(rna, keys + "feature_id string, value double"),
        spark.createDataFrame(cnv, keys + "chromosome string, start long, `end` long, copy_number double"),
        spark.createDataFrame(meth, keys + "feature_id string, value double"),
    )


def test_pivot_keeps_the_list_only(study):
    wide = rs.pivot_mean(study[0].where("cohort = 'BRCA'"), GENES[:5])
    assert wide.columns == ["patient_id", *GENES[:5]]
    assert wide.count() == 3


def test_pivot_null_and_duplicates(spark):
    rows = [("a", "x.1", 1.0), ("a", "x.1", 3.0), ("a", "y", None), ("b", "y", 2.0), ("c", "z", 1.0)]
    df = spark.createDataFrame(rows, "patient_id string, feature_id string, value double")
    got = {r[0]: tuple(r)[1:] for r in rs.pivot_mean(df, ["x.1", "y"]).collect()}
    assert got == {"a": (2.0, None), "b": (None, 2.0)}
    filled = {r[0]: tuple(r)[1:] for r in rs.pivot_mean(df, ["x.1", "y"], fill=0.0).collect()}
    assert filled == {"a": (2.0, 0.0), "b": (0.0, 2.0)}


def test_arrays_agree_with_columns(spark, study):
    rna = study[0].drop("cohort")
    dictionary = rs.feature_dictionary(rna.where(F.col("feature_id") != GENES[4]))
    arrays = rs.dense_arrays(rna, dictionary)
    names = [g for g in GENES if g != GENES[4]]
    by_array = {r[0]: tuple(r)[1:] for r in rs.array_columns(arrays, "values", names).collect()}
    by_pivot = {r[0]: tuple(r)[1:] for r in rs.pivot_mean(rna, names).collect()}
    assert by_array == by_pivot


def test_arrays_pad_every_gap(spark):
    rows = [("a", "f2", 2.0), ("a", "f5", 5.0), ("b", "f0", 0.5), ("b", "f6", 6.0), ("c", "f3", None)]
    df = spark.createDataFrame(rows, "patient_id string, feature_id string, value double")
    dictionary = rs.feature_dictionary(spark.createDataFrame([(f"f{i}",) for i in range(7)], "feature_id string"))
    got = {r[0]: r[1] for r in rs.dense_arrays(df, dictionary).collect()}
    n = None
    assert got == {"a": [n, n, 2.0, n, n, 5.0, n], "b": [0.5, n, n, n, n, n, 6.0], "c": [n] * 7}
    zero = {r[0]: r[1] for r in rs.dense_arrays(df, dictionary, fill=0.0).collect()}
    assert zero["c"] == [0.0] * 7 and zero["a"][5] == 5.0


def test_arm_columns(study):
    view = co.arm_view(study[1], ("cohort", "patient_id"))
    assert view.names() == ["1p", "1q"]
    assert view.arrays.count() == 8


def test_three_view_merge(study):
    merged, views = co.three_views(*study, n_rna=5, n_methylation=4, min_coverage=0.8)
    wide = co.wide_table(merged, views, ("cohort", "patient_id"))
    assert len(wide.columns) == 2 + 5 + 2 + 4
    rows = wide.collect()
    assert {r.cohort for r in rows} == set(COHORTS)
    assert len(rows) == 8 and "TCGA-LU-P002" not in {r.patient_id for r in rows}
    ql.require_unique(wide, ["patient_id"], "merge")


def test_older_merge_is_a_parameter_set(study):
    merged, views = co.three_views(*study, n_rna=3, n_methylation=3, min_coverage=0, ddof=1)
    assert [len(v.names()) for v in views] == [3, 2, 3]
    assert merged.count() == 8


def test_mutation_roster(spark):
    pairs = rs.distinct_indicators(
        spark.createDataFrame(
            [("a", "TP53"), ("a", "TP53"), ("b", "TP53"), ("c", "RARE"), ("b", "PTEN"), ("a", "PTEN")],
            "patient_id string, hugo_symbol string",
        )
    )
    view = co.indicator_view(pairs, 0.5)
    assert {r[0]: r[1] for r in view.arrays.collect()} == {"a": [1.0, 1.0], "b": [1.0, 1.0]}
    assert view.names() == ["MUT_PTEN", "MUT_TP53"]
    kept = co.indicator_view(pairs, 0.5, keep_unmutated=True)
    assert {r[0]: r[1] for r in kept.arrays.collect()}["c"] == [0.0, 0.0]


def test_merged_cells_hold_every_cell(study):
    merged, views = co.three_views(*study, n_rna=5, n_methylation=4, min_coverage=0.8)
    keys = ("cohort", "patient_id")
    cells = co.merged_cells(merged, views, keys)
    assert cells.count() == 8 * 11
    wide = co.wide_table(merged, views, keys)
    long = rs.unpivot_features(wide, keys)
    a = {(r.patient_id, r.view, r.feature_id, r.value) for r in cells.collect()}
    b = {(r.patient_id, r.view, r.feature_id, r.value) for r in long.collect()}
    assert a == b


def test_stacking_fills_and_widens(spark):
    a = spark.createDataFrame([(1, 2)], "id int, x int")
    b = spark.createDataFrame([(2, 1.5, "z")], "id long, x double, y string")
    out = mg.stack_cohorts([a, b])
    assert dict(out.dtypes) == {"id": "bigint", "x": "double", "y": "string"}
    assert {tuple(r) for r in out.collect()} == {(1, 2.0, None), (2, 1.5, "z")}


def test_funnel(spark):
    roster = spark.createDataFrame(
        [("a", "x"), ("a", "y"), ("a", "x"), ("b", "x"), ("c", "y")], "patient_id string, modality string"
    )
    got = {r.step: r.n_entities for r in mg.coverage_funnel(roster).collect()}
    assert got == {"x": 2, "y": 2, "in_1_views": 3, "in_2_views": 1}
    assert [r[0] for r in mg.in_every_view(roster, 2).collect()] == ["a"]


@pytest.fixture(scope="module")
def gate_case(spark):
    rows = [
        ("p1", "BRCA", 1.0, 0.1, None, 0.0),
        ("p2", "BRCA", 2.0, 0.2, 0.2, 0.1),
        ("p3", "LUAD", 3.0, None, None, 0.2),
        ("p4", "LUAD", 4.0, None, 0.9, 0.3),
    ]
    wide = spark.createDataFrame(
        rows, "patient_id string, cohort string, ENSG_keep double, cg_structural double, cg_sparse double, `1p` double"
    )
    return rs.unpivot_features(wide, ("patient_id", "cohort")), wide.select("patient_id", "cohort")


def test_cohort_model(gate_case, tmp_path):
    cells, roster = gate_case
    model = co.cohort_model(cells, roster, 0.25)
    wide = model.wide()
    assert set(wide.columns) == {"patient_id", "cohort", "cohort_code", "ENSG_keep", "1p"}
    assert {r.cohort: r.cohort_code for r in wide.collect()} == {"BRCA": 0, "LUAD": 1}
    sinks.write_json(model.manifest(0.25, "no imputation"), str(tmp_path / "m"))
    text = open(glob.glob(str(tmp_path / "m" / "*.json"))[0]).read()
    doc = json.loads(text)
    assert doc["label_map"] == {"BRCA": 0, "LUAD": 1}
    assert sorted(doc["feature_columns"]) == ["1p", "ENSG_keep"]
    assert doc["dropped"]["structural_missing_in_any_cohort"] == ["cg_structural"]
    assert doc["dropped"]["over_missingness_threshold"] == ["cg_sparse"]
    assert doc["feature_family_counts"] == {"cnv": 1, "rna": 1}
    assert doc["dropped"]["counts_by_family"] == {"methylation": 2}


def test_gate_threshold_is_strict(gate_case):
    cells, roster = gate_case
    status = {r.feature_id: r.status for r in ql.gate_features(cells, roster, None, 0.5).collect()}
    assert status["cg_sparse"] == "kept"
    with pytest.raises(ValueError):
        ql.gate_features(cells, roster, cells, 1.0)


def test_structural_gap(gate_case):
    cells, roster = gate_case
    assert [r[0] for r in ql.structurally_missing(cells, roster).collect()] == ["cg_structural"]


def test_subtype_model(spark, gate_case):
    cells, _ = gate_case
    labels = spark.createDataFrame(
        [("p1", "LUAD.1"), ("p2", "LUAD.2"), ("p3", None), ("p4", "BRCA.x"), ("p9", "LUAD.2")],
        "patient_id string, selected string",
    )
    model = co.subtype_model(cells, labels, "selected", "LUAD", dims.RARE_CLASS_REMAP["LUAD"], 0.4)
    got = {(r.patient_id, r.subtype, r.subtype_code) for r in model.rows.collect()}
    assert got == {("p1", "LUAD.other", 1), ("p2", "LUAD.2", 0)}
    kept = {r.feature_id for r in model.dictionary.collect()}
    assert kept == {"ENSG_keep", "cg_structural", "1p"}


def test_missing_rates_with_absent_features(spark, gate_case):
    cells, roster = gate_case
    features = spark.createDataFrame([("cg_sparse",), ("never",)], "feature_id string")
    got = {r.feature_id: r.missing_rate for r in ql.missing_rates(cells, roster, features).collect()}
    assert got == {"cg_sparse": 0.5, "never": 1.0}


def test_view_gate(spark):
    rates = spark.createDataFrame(
        [("RNA", "a", 0.2), ("RNA", "b", 0.21), ("methylation", "c", 0.4), ("methylation", "d", 0.5)],
        "view string, feature_id string, missing_rate double",
    )
    counts = {r.view: (r.n_in, r.n_kept, r.n_dropped) for r in ql.view_gate_counts(ql.view_gate(rates, dims.view_config(spark))).collect()}
    assert counts == {"RNA": (2, 1, 1), "methylation": (2, 1, 1)}
    uniform = ql.view_gate(rates, dims.view_config(spark, 0.1))
    assert uniform.where("kept").count() == 0


def test_reconcile_marks(spark):
    want = spark.createDataFrame([("B", "rna", "a"), ("B", "rna", "b"), ("B", "cnv", "a"), ("L", "rna", "z")], "cohort string, modality string, patient_id string")
    have = spark.createDataFrame([("B", "rna", "a"), ("L", "rna", "z"), ("L", "rna", "y"), ("L", "cnv", "y")], want.schema)
    got = {(r.cohort, r.modality): (r.difference, r.mark) for r in ql.reconcile(want, have).collect()}
    assert got == {("B", "rna"): (-1, " gap"), ("B", "cnv"): (-1, "MISSING"), ("L", "rna"): (1, " +"), ("L", "cnv"): (1, " +")}


def test_guards(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "patient_id string, x int")
    with pytest.raises(RuntimeError):
        ql.require_rows(df.where("x > 5"), "nothing")
    with pytest.raises(RuntimeError):
        ql.require_unique(df, ["patient_id"], "twice")
    with pytest.raises(ValueError):
        ql.require_columns(df, ["cohort"])
    with pytest.raises(ValueError):
        ql.require_numeric(df, ["patient_id"])
    with pytest.raises(RuntimeError):
        sinks.write_table(df.where("x > 5"), str(tmp_path / "e"))
    with pytest.raises(RuntimeError):
        sinks.write_table(df, str(tmp_path / "d"), ["patient_id"])
    assert sinks.write_table(df, str(tmp_path / "f"), ["x"]) == 2


def test_panels_dimension(spark):
    panel = dims.panels(spark)
    assert {r["panel"]: r["count"] for r in panel.groupBy("panel").count().collect()} == {"BRCA": 20, "LUAD": 7, "PRAD": 9}
    assert dims.panel_ids(panel).count() == 34
    assert dims.centromeres(spark).count() == 23 and len(dims.ARM_COLUMNS) == 46


def test_six_views_join_the_lines_once(spark, monkeypatch):
    read = []
    given = ad.table
    monkeypatch.setattr(ad, "table", lambda spark, sf_dir, name: read.append(name) or given(spark, sf_dir, name))
    qm.six(spark, "/root/testdata/sf0.001")
    assert read.count("lineitem") == read.count("orders") == 1


def test_line_facts_keep_every_join(spark, tmp_path):
    """Keys that repeat in customer and part, keys that are in neither, and missing keys: the rows are those of the joins."""
    sf = "/root/testdata/sf0.001"
    for name in ("customer", "part", "orders", "lineitem", "supplier"):
        df = spark.read.parquet(f"{sf}/{name}.parquet")
        if name == "customer":
            df = df.where("c_custkey % 3 > 0").unionByName(df.where("c_custkey % 5 = 0").withColumn("c_mktsegment", F.lit(None).cast("string")))
        if name == "part":
            df = df.where("p_partkey % 4 > 0").unionByName(df.where("p_partkey % 7 = 0").withColumn("p_size", F.col("p_size") + 1))
        if name == "orders":
            df = df.withColumn("o_custkey", F.expr("if(o_orderkey % 11 = 0, null, o_custkey)"))
        if name == "lineitem":
            df = df.withColumn("l_partkey", F.expr("if(l_orderkey % 13 = 0, null, l_partkey)"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    sf = str(tmp_path)
    facts = ad.line_facts(spark, sf)
    for adapter in (ad.expression, ad.segments, ad.protein, ad.variants):
        one, other = adapter(spark, sf), adapter(spark, sf, facts)
        assert one.dtypes == other.dtypes and one.count() > 0
        assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty()


def test_arrays_of_unique_cells(spark):
    rows = [(1, "a", 1.0), (1, "c", None), (2, "b", float("nan")), (2, "c", 4.0), (3, "x", 1.0)]
    df = spark.createDataFrame(rows, "patient_id int, feature_id string, value double")
    dictionary = rs.feature_dictionary(df.where("feature_id <> 'x'"))
    for fill in (None, 0.0):
        one, other = (rs.dense_arrays(df, dictionary, fill=fill, unique=unique) for unique in (False, True))
        assert sorted(one.collect()) == sorted(other.collect())
