"""The jobs end to end on a small generated study."""

import csv
import glob
import json

import numpy as np
import pytest

from cohortviews import dims, jobs
from cohortviews.plans import cohort as co
from cohortviews.operators import reshape as rs

PROJECTS = ("TCGA-BRCA", "TCGA-LUAD")
MARKERS = list(dims.MARKER_PANELS["BRCA"].values())[:6]
TYPES = ["BRCA.LumA", "BRCA.Basal"]


def read_json(path):
    return [json.loads(line) for f in glob.glob(f"{path}/*.json") for line in open(f)]


def read_csv(path):
    return [row for f in glob.glob(f"{path}/*.csv") for row in csv.DictReader(open(f))]


@pytest.fixture(scope="module")
def study(tmp_path_factory):
    """40 patients per project; project and subtype shift expression."""
    root = tmp_path_factory.mktemp("study")
    rng = np.random.default_rng(6)
    genes = [f"{g}.{i}" for i, g in enumerate(MARKERS)] + [f"ENSG{i:011d}.1" for i in range(12)]
    for p, project in enumerate(PROJECTS):
        hits = {k: [] for k in ("rnaseq", "cnv", "methylation", "rppa", "mirna", "mutations")}
        for i in range(40):
            code = f"TCGA-{'AB'[p]}0-{i:04d}"
            kind = i % 2
            x = rng.gamma(2, 2, size=len(genes)) + 5 * p * (np.arange(len(genes)) > 8) + 9 * kind * (np.arange(len(genes)) < 3)
            rna = "# gene-model: GENCODE v36\n" + "\t".join(jobs.files.RNA.columns) + "\nN_unmapped\t\t\t1\tx\t\t\t\t\n"
            rna += "".join(f"{g}\tG\tprotein_coding\t1\t1\t1\t{v}\t{v}\t{v}\n" for g, v in zip(genes, x))
            cnv = "\t".join(jobs.files.SEGMENTS.columns) + "\n" + "".join(
                f"a\t{c}\t{s}\t{s + 1000}\t3\t{rng.normal()}\n" for c in ("1", "2", "X") for s in (10, 140_000_000)
            )
            meth = "".join(f"cg{j:05d}\t{'NA' if j == 3 else rng.random()}\n" for j in range(8))
            rppa = "\t".join(jobs.files.PROTEIN.columns) + "\r\n" + "".join(f"A\t1\tc\ts\tP{j}\t{rng.normal()}\r\n" for j in range(4))
            mirna = "\t".join(jobs.files.MIRNA.columns) + "\n" + "".join(f"hsa-{j}\t1\t{rng.random()}\tN\n" for j in range(4))
            maf = "#v\nHugo_Symbol\tVariant_Classification\nTP53\tMissense_Mutation\n" + ("MYC\tNonsense_Mutation\n" if kind else "")
            for modality, text in zip(hits, (rna, cnv, meth, rppa, mirna, maf)):
                file_id = f"{p:08d}-{list(hits).index(modality):04d}-0000-0000-{i:012d}"
                folder = root / "raw" / project / modality / file_id
                folder.mkdir(parents=True)
                (folder / "f.tsv").write_bytes(text.encode())
                hits[modality].append({"file_id": file_id, "file_name": "f.tsv", "cases": [{"submitter_id": code + "-01A-11R"}]})
        (root / "manifests" / project).mkdir(parents=True)
        for modality, found in hits.items():
            (root / "manifests" / project / f"{modality}.json").write_text(json.dumps({"data": {"hits": found}}))
    samples = ["sampleID\tcancer.type\tSubtype_Selected"]
    samples += [f"TCGA-A0-{i:04d}-01\tBRCA\t{TYPES[i % 2] if i < 36 else 'NA'}" for i in range(40)]
    (root / "labels.tsv").write_text("\n".join(samples) + "\n")
    for cohort in ("BRCA", "LUAD"):
        (root / f"{cohort}.json").write_text(json.dumps([{"patientId": "TCGA-A0-0001", "value": "x"}]))
    return str(root)


@pytest.fixture(scope="module")
def loaded(spark, study):
    patterns = (f"{study}/manifests/{{project}}/{{modality}}.json", f"{study}/raw/{{project}}/{{modality}}", f"{study}/data")
    first = jobs.ingest(spark, *patterns, PROJECTS)
    assert first["TCGA-BRCA", "rna_seq"] == f"{40 * 18} rows" and not any("failed" in v for v in first.values()), first
    again = jobs.ingest(spark, *patterns, (*PROJECTS, "TCGA-NONE"), ("rna_seq", "cnv"))
    assert again["TCGA-LUAD", "cnv"] == "skipped" and again["TCGA-NONE", "cnv"].startswith("failed")
    return study


def test_verify(spark, loaded):
    report = jobs.verify(spark, f"{loaded}/manifests/{{project}}/{{modality}}.json", f"{loaded}/data", f"{loaded}/verify", PROJECTS)
    assert {r.difference for r in report.collect()} == {0} and report.count() == 6


def test_from_merge_to_panels(spark, loaded):
    jobs.merge_cohorts(spark, f"{loaded}/data", f"{loaded}/merged", PROJECTS, n=10)
    wide = spark.read.parquet(f"{loaded}/merged/wide")
    assert wide.count() == 80 and {f"{m}.{i}" for i, m in enumerate(MARKERS)} <= set(wide.columns)
    jobs.cohort_table(spark, f"{loaded}/merged", f"{loaded}/cohort", wide=True)
    manifest = read_json(f"{loaded}/cohort/manifest")[0]
    assert manifest["label_map"] == {"BRCA": 0, "LUAD": 1} and manifest["rows"] == 80
    assert "cg00003" not in manifest["feature_columns"]
    jobs.classify(spark, f"{loaded}/cohort", f"{loaded}/model", top_n=10, trees=10, depth=4, learner="forest")
    scores = {r["metric"]: float(r["mean"]) for r in read_csv(f"{loaded}/model/cv_scores")}
    assert scores["accuracy"] > 0.8
    assert len(read_csv(f"{loaded}/model/oof_predictions")) == 80
    assert read_json(f"{loaded}/model/classification_metrics")[0]["n_classes"] == 2

    jobs.label_audit(spark, f"{loaded}/merged", f"{loaded}/labels.tsv", f"{loaded}/{{cohort}}.json", f"{loaded}/audit", ("BRCA", "LUAD"))
    coverage = {r["panel"]: r["n_present"] for r in read_json(f"{loaded}/audit/subtype_marker_coverage")}
    assert coverage["BRCA"] == 6
    jobs.subtype_table(spark, f"{loaded}/merged", f"{loaded}/audit/subtype_label_audit", f"{loaded}/subtype", "BRCA")
    assert read_json(f"{loaded}/subtype/manifest")[0]["rows"] == 36
    jobs.classify(spark, f"{loaded}/subtype", f"{loaded}/submodel", "BRCA", top_n=8, trees=6, depth=3)
    log = [float(r["log_loss"]) for r in read_csv(f"{loaded}/submodel/training_log")]
    assert len(log) == 6 and log == sorted(log, reverse=True)
    jobs.compare_panels(spark, f"{loaded}/submodel/attribution_summary", f"{loaded}/panels", "BRCA")
    report = read_json(f"{loaded}/panels/panel_comparison")[0]
    assert report["panel_size"] == 20 and report["hits_top10"]["hits"] >= 3
    assert len(read_csv(f"{loaded}/panels/panel_gene_ranks")) == 20


def test_older_merge(spark, loaded):
    jobs.merge_cohorts(spark, f"{loaded}/data", f"{loaded}/older", PROJECTS, older=True, wide=False)
    assert spark.read.parquet(f"{loaded}/older/arrays").count() == 80


def test_factors_and_clusters(spark, loaded):
    jobs.merge_project(spark, f"{loaded}/data", f"{loaded}/six", n=10)
    arrays = spark.read.parquet(f"{loaded}/six/arrays")
    assert set(arrays.columns) == {"patient_id", *dims.VIEW_CONFIG} and arrays.count() == 40
    jobs.factor_analysis(spark, f"{loaded}/six", f"{loaded}/factors", factors=3, max_iter=5)
    assert len(read_csv(f"{loaded}/factors/factor_scores")) == 40
    jobs.cluster_analysis(
        spark, f"{loaded}/factors", f"{loaded}/clusters", f"{loaded}/audit/subtype_label_audit", cancer_type="BRCA", k_max=3, restarts=2
    )
    summary = read_json(f"{loaded}/clusters/cluster_vs_subtype")[0]
    assert summary["n_labeled"] == 36 and summary["best_k"] in (2, 3)


def test_wide_back_to_arrays(spark, loaded):
    wide = spark.read.parquet(f"{loaded}/six/wide")
    arrays, dictionary = co.arrays_of_wide(wide)
    cells = co.array_cells(arrays, dictionary)
    long = rs.unpivot_features(wide)
    assert sorted(map(tuple, cells.collect()), key=repr) == sorted(map(tuple, long.collect()), key=repr)


def test_command_line(capsys):
    known = jobs.parser().parse_args(["merge-cohorts", "--data", "d", "--out", "o", "--older", "--no-wide", "--projects", "A", "B"])
    assert vars(known) == {"job": "merge-cohorts", "data": "d", "out": "o", "older": True, "wide": False, "projects": ["A", "B"]}
    with pytest.raises(SystemExit):
        jobs.parser().parse_args(["merge-cohorts", "--data", "d"])
