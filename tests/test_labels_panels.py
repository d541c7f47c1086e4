import json

import pytest
from pyspark.sql import functions as F

from cohortviews import dims
from cohortviews.operators import labels as lb
from cohortviews.operators import panels as pn
from cohortviews.plans import cohort as co
from cohortviews.sources import labels as src


def test_label_table(spark, tmp_path):
    (tmp_path / "t.tsv").write_text(
        "Pan.SamplesID\tcancer.type\tSubtype_mRNA\tSUBTYPE_Selected\n"
        "TCGA-AA-0001-02\tBRCA\tlate\tBRCA.LumB\n"
        "TCGA-AA-0001-01\tBRCA\t[Not Applicable]\tBRCA.LumA\n"
        "TCGA-AA-0002-01\tBRCA\tNA\tNot_Applicable\n"
    )
    got = {r.patient_id: (r.hoadley_subtype_mrna, r.hoadley_subtype_selected) for r in src.read_label_table(spark, str(tmp_path / "t.tsv")).collect()}
    assert got == {"TCGA-AA-0001": (None, "BRCA.LumA"), "TCGA-AA-0002": (None, None)}
    (tmp_path / "bad.tsv").write_text("who\tSubtype\na\tb\n")
    with pytest.raises(ValueError):
        src.read_label_table(spark, str(tmp_path / "bad.tsv"))


def test_label_json(spark, tmp_path):
    full, empty = tmp_path / "a.json", tmp_path / "b.json"
    full.write_text(json.dumps([{"patientId": "p1", "value": "LumA"}, {"patientId": "p2", "value": "Her2"}]))
    empty.write_text("[]")
    assert src.read_label_json(spark, str(full), "brca").count() == 2
    none = src.read_label_json(spark, str(empty), "luad")
    assert none.columns == ["patient_id", "luad"] and none.count() == 0


def test_audit(spark):
    base = spark.createDataFrame([("p1", "BRCA"), ("p2", "LUAD"), ("p3", "PRAD")], "patient_id string, cohort string")
    hoadley = spark.createDataFrame([("p1", "BRCA.LumA"), ("p2", None)], "patient_id string, hoadley_subtype_selected string")
    per = {
        c: spark.createDataFrame([("p1", f"{c}1"), ("p2", f"{c}2")], f"patient_id string, {c.lower()}_marker_subtype string")
        for c in ("BRCA", "LUAD")
    }
    audit = co.label_audit(base, hoadley, per)
    assert {r.patient_id: r.marker_subtype for r in audit.collect()} == {"p1": "BRCA1", "p2": "LUAD2", "p3": None}
    sources = [c for c in audit.columns if "subtype" in c]
    counts = {(r.cohort, r.source, r.label): r.n for r in lb.label_counts(audit, sources).collect()}
    assert counts["PRAD", "marker_subtype", "__null__"] == 1
    totals = {(r.cohort, r.source): (r.n_labeled, r.n_unlabeled) for r in lb.label_totals(audit, sources).collect()}
    assert totals["LUAD", "hoadley_subtype_selected"] == (0, 1)


def test_first_per_entity(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 7, None)]
    df = spark.createDataFrame(rows, "id string, turn int, text string")
    got = {r.id: (r.turn, r.text) for r in lb.first_per_entity(df, "id", ["turn"]).collect()}
    assert got == {"a": (1, "early"), "b": (7, None)}


def test_codes_and_weights(spark):
    df = spark.createDataFrame([("b",), ("a",), ("a",), (None,)], "label string")
    assert {r.label: r.code for r in lb.label_codes(df, "label", "code").collect()} == {"a": 0, "b": 1}
    coded = lb.with_codes(df.where("label is not null"), "label", "code")
    assert coded.count() == 3
    weights = {r.label: r.weight for r in lb.balanced_weights(df.where("label is not null"), "label").collect()}
    assert weights == {"a": 0.75, "b": 1.5}


def test_only_cohort(spark):
    df = spark.createDataFrame([("a", "X"), ("b", "Y")], "id string, cohort string")
    assert lb.only_cohort(df, "X").count() == 1
    assert lb.only_cohort(df.drop("cohort"), "X").count() == 2


@pytest.fixture(scope="module")
def ranking(spark):
    rows = [("ENSG00000091831.16", 0.5), ("cg0001", 0.9), ("ENSG00000082175.1", 0.2), ("ENSG9.1", 0.4), ("12q", 0.3), ("ENSG00000091831.2", 0.1)]
    return pn.rank_features(spark.createDataFrame(rows, "feature string, score double"), "score")


def test_annotation(spark, ranking):
    panel = dims.panels(spark).where(F.col("panel") == "BRCA")
    got = {r.feature: (r.rank, r.kind, r.label, r.in_panel) for r in pn.annotate(ranking, panel).collect()}
    assert got["ENSG00000091831.16"] == (2, "rna", "ESR1", True)
    assert got["cg0001"] == (1, "methylation", "cg0001", False)
    assert got["12q"] == (4, "cnv", "12q", False)


def test_panel_ranks_and_hits(spark, ranking):
    panel = dims.panels(spark).where(F.col("panel") == "BRCA")
    ranks = {r.symbol: (r["rank"], r.in_features) for r in pn.panel_ranks(ranking, panel, "score").collect()}
    assert ranks["ESR1"] == (2, True) and ranks["PGR"] == (5, True) and ranks["MELK"] == (None, False)
    assert len(ranks) == 20
    hits = {(r.panel, r.k): (r.hits, r.panel_size) for r in pn.panel_hits(ranking, dims.panels(spark), (2, 5, 10)).collect()}
    assert hits["BRCA", 2] == (1, 20) and hits["BRCA", 5] == (2, 20) and hits["BRCA", 10] == (3, 20)
    assert hits["LUAD", 10] == (0, 7)


def test_marker_coverage(spark):
    features = spark.createDataFrame([("ENSG00000169083.3",), ("ENSG00000157554.1",)], "feature_id string")
    row = {r.panel: r for r in pn.marker_coverage(dims.panels(spark), features).collect()}["PRAD"]
    assert (row.panel_size, row.n_present, row.n_missing, row.present) == (9, 2, 7, ["AR", "ERG"])
