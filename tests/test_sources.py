import dataclasses
import gzip
import json

import pytest
from pyspark.sql import functions as F

from cohortviews.plans import raw_files
from cohortviews import schemas
from cohortviews.sources import artefacts, files, manifest as mf, sinks
from cohortviews.streaming.ingest import listed_parts, load_new_files, loaded_rows, stream_lines

IDS = [f"{i:08d}-aaaa-bbbb-cccc-{i:012d}" for i in range(6)]
RNA_HEAD = "gene_id\tgene_name\tgene_type\tunstranded\tstranded_first\tstranded_second\ttpm_unstranded\tfpkm_unstranded\tfpkm_uq_unstranded"
RNA = "# gene-model: GENCODE v36\n" + RNA_HEAD + "\n" + "".join(
    f"{n}\t\t\t1\tx\t\t\t\t\n" for n in ("N_unmapped", "N_multimapping", "N_noFeature", "N_ambiguous")
) + "".join(f"ENSG{i}.1\tG{i}\tprotein_coding\t{i}\t1\t1\t{i}.5\t{i}.25\t{i}.125\n" for i in range(5))
SEGMENTS = (
    "GDC_Aliquot\tChromosome\tStart\tEnd\tNum_Probes\tSegment_Mean\n"
    "a\tchr1\t10\t20\t3\t0.5\na\tchr2\t30\t40\t3\t-0.25\na\tchrX\t50\t60\t3\t0.0\n"
)
METH = "cg1\t0.1\ncg2\tNA\ncg3\t0.3\ncg4\t1.0\n"


def put(root, texts, suffix=".tsv"):
    for file_id, text in texts.items():
        folder = root / file_id
        folder.mkdir()
        if isinstance(text, bytes):
            (folder / ("f" + suffix)).write_bytes(text)
        else:
            (folder / ("f" + suffix)).write_bytes(text.encode())


def listing(spark, n):
    return spark.createDataFrame([(IDS[i], "f.tsv", f"TCGA-AA-{i:04d}") for i in range(n)], schemas.MANIFEST)


def test_rna(spark, tmp_path):
    put(tmp_path, {IDS[0]: RNA, IDS[1]: RNA})
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 2), files.RNA)
    assert rows.schema.simpleString() == spark.createDataFrame([], schemas.RNA_LONG).schema.simpleString()
    assert rows.count() == 10 and errors.count() == 0
    assert not any(r.gene_id.startswith("N_") for r in rows.collect())
    assert {r.patient_id for r in rows.collect()} == {"TCGA-AA-0000", "TCGA-AA-0001"}
    narrow, _ = files.ingest(spark, str(tmp_path), listing(spark, 2), files.RNA, ("gene_id", "fpkm_unstranded"))
    assert narrow.columns == ["patient_id", "gene_id", "fpkm_unstranded"]


def test_a_bad_file_is_skipped_whole(spark, tmp_path):
    broken = RNA.replace("3.25", "many")
    put(tmp_path, {IDS[0]: RNA, IDS[1]: "not\ta\tvalid\theader\n1\t2\t3\t4\n", IDS[2]: broken, IDS[3]: RNA})
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 3), files.RNA)
    assert rows.count() == 5  # the fourth file is not in the manifest
    got = {r.file_id: (r.patient_id, r.error) for r in errors.collect()}
    assert got == {
        IDS[1]: ("TCGA-AA-0001", "unexpected header"),
        IDS[2]: ("TCGA-AA-0002", "1 unreadable rows"),
    }
    _, errors5 = files.ingest(spark, str(tmp_path), listing(spark, 5), files.RNA)
    assert {r.file_id: r.error for r in errors5.collect()}[IDS[4]] == "no such file, or empty"
    assert sinks.write_ledger(errors, str(tmp_path / "ledger"))
    assert not sinks.write_ledger(errors.where("file_id = 'x'"), str(tmp_path / "none"))


def test_segments(spark, tmp_path):
    put(tmp_path, {IDS[0]: SEGMENTS, IDS[1]: SEGMENTS})
    rows, _ = files.ingest(spark, str(tmp_path), listing(spark, 2), files.SEGMENTS)
    assert rows.count() == 6
    assert dict(rows.dtypes) == {"patient_id": "string", "chromosome": "string", "start": "bigint", "end": "bigint", "copy_number": "double"}


def test_missing_field_spoils_the_file(spark, tmp_path):
    put(tmp_path, {IDS[0]: SEGMENTS, IDS[1]: SEGMENTS + "a\tchr3\t1\n"})
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 2), files.SEGMENTS)
    assert rows.count() == 3 and [r.file_id for r in errors.collect()] == [IDS[1]]


def test_empty_result_keeps_its_schema(spark, tmp_path):
    put(tmp_path, {IDS[0]: SEGMENTS.splitlines()[0] + "\n"})
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 1), files.SEGMENTS)
    target = str(tmp_path / "out")
    rows.write.parquet(target)
    assert spark.read.schema(schemas.SEGMENT_LONG).parquet(target).count() == 0 and errors.count() == 0


def test_methylation(spark, tmp_path):
    put(tmp_path, {IDS[0]: METH, IDS[1]: METH, IDS[2]: "cg001\tNOT_A_NUMBER\ncg002\tALSO_BAD\n"}, ".txt")
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 3), files.METHYLATION)
    assert rows.count() == 8  # the first row of a headerless file is data
    assert rows.where("beta_value is null").count() == 2
    assert [r.file_id for r in errors.collect()] == [IDS[2]]
    strict = dataclasses.replace(files.METHYLATION, nulls=())
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 3), strict)
    assert rows.count() == 0 and errors.count() == 3


def test_protein_with_windows_line_ends(spark, tmp_path):
    text = "AGID\tlab_id\tcatalog_number\tset_id\tpeptide_target\tprotein_expression\r\nA\t1\tc\ts\tTP53\t0.5\r\nA\t1\tc\ts\tAKT\tNA\r\n"
    put(tmp_path, {IDS[0]: text})
    rows, errors = files.ingest(spark, str(tmp_path), listing(spark, 1), files.PROTEIN)
    assert {r.peptide_target: r.protein_expression for r in rows.collect()} == {"TP53": 0.5, "AKT": None}
    assert errors.count() == 0


def test_mirna_zero_is_a_value(spark, tmp_path):
    text = "miRNA_ID\tread_count\treads_per_million_miRNA_mapped\tcross-mapped\nhsa-1\t0\t0.000000\tN\nhsa-2\t5\t1.5\tY\n"
    put(tmp_path, {IDS[0]: text})
    rows, _ = files.ingest(spark, str(tmp_path), listing(spark, 1), files.MIRNA)
    assert {r.mirna_id: r.reads_per_million_mirna_mapped for r in rows.collect()} == {"hsa-1": 0.0, "hsa-2": 1.5}


def test_mutations_by_column_name(spark, tmp_path):
    one = "#version 1\nHugo_Symbol\tChromosome\tVariant_Classification\nTP53\t17\tMissense_Mutation\nTP53\t17\tNonsense_Mutation\nMYC\t8\tSilent\n\t1\tSplice_Site\nUnknown\t1\tSplice_Site\n"
    two = "#version 1\nVariant_Classification\tHugo_Symbol\nSplice_Region\tEGFR\nIntron\tALK\n"
    put(tmp_path, {IDS[0]: gzip.compress(one.encode()), IDS[1]: gzip.compress(two.encode()), IDS[2]: gzip.compress(b"no\theader\n")}, ".maf.gz")
    rows, errors = files.ingest_mutations(spark, str(tmp_path), listing(spark, 3))
    assert {tuple(r) for r in rows.collect()} == {("TCGA-AA-0000", "TP53", 1.0), ("TCGA-AA-0001", "EGFR", 1.0)}
    assert [r.file_id for r in errors.collect()] == [IDS[2]]


def test_manifest(spark, tmp_path):
    hits = [
        {"file_id": "f1", "file_name": "a.tsv", "cases": [{"submitter_id": "TCGA-BH-A18H-01A-11R"}, {"submitter_id": "TCGA-ZZ-ZZZZ"}]},
        {"file_id": "f2", "file_name": "b.tsv", "cases": []},
    ]
    (tmp_path / "a.json").write_text(json.dumps({"data": {"hits": hits}}))
    got = {r.file_id: r.patient_id for r in mf.read_manifest(spark, str(tmp_path / "a.json")).collect()}
    assert got == {"f1": "TCGA-BH-A18H", "f2": None}
    (tmp_path / "b.json").write_text(json.dumps({"data": {"hits": []}}))
    assert mf.read_manifest(spark, str(tmp_path / "b.json")).count() == 0


def test_sync_plan(spark):
    rows = [("P", "rna", "f1", "a"), ("P", "rna", "f2", "b"), ("Q", "cnv", "f3", "c")]
    want = spark.createDataFrame(rows, "project_id string, modality string, file_id string, file_name string")
    have = spark.createDataFrame([("tcga/rna/f1/a",)], "key string")
    plan = mf.sync_plan(want, have)
    assert {r.file_id: r.action for r in plan.collect()} == {"f1": "skipped", "f2": "to_copy", "f3": "to_copy"}
    totals = {(r.project_id, r.modality): (r.n_files, r.n_skipped, r.n_to_copy) for r in mf.sync_totals(plan).collect()}
    assert totals["P", "rna"] == (2, 1, 1) and totals["P", "__all__"] == (2, 1, 1) and totals["__all__", "__all__"] == (3, 1, 2)


def test_training_log(spark, tmp_path):
    (tmp_path / "log").write_text(
        "start\nIteration 1: time=0.10, ELBO=-100.5, deltaELBO=3.2 (0.5%), Factors=15\n"
        "Iteration 2: time=0.10, ELBO=-90.25, deltaELBO=1.0 (0.001%), Factors=14\nIteration x: bad\n"
    )
    got = [tuple(r) for r in artefacts.read_training_log(spark, str(tmp_path / "log")).orderBy("iteration").collect()]
    assert got == [(1, -100.5, 0.5, 15), (2, -90.25, 0.001, 14)]


def test_metrics_and_reports(spark, tmp_path):
    score = {"mean": 0.9, "std": 0.1}
    (tmp_path / "m.json").write_text(json.dumps({"task": "t", "n_classes": 3, "cv_scores": {"accuracy": score, "balanced_accuracy": score, "macro_f1": score, "log_loss": score}}))
    row = artefacts.read_metrics(spark, str(tmp_path / "m.json")).first()
    assert (row.accuracy, row.macro_f1_std) == (0.9, 0.1)
    hits = {"panel_size": 20, "hits": 9, "rate": 0.45}
    (tmp_path / "p.json").write_text(json.dumps({"cancer": "BRCA", "panel_size": 20, "n_features_ranked": 500, "hits_top10": hits, "hits_top25": hits, "hits_top50": {**hits, "hits": 17}}))
    row = artefacts.read_panel_reports(spark, str(tmp_path / "p.json")).first()
    assert (row.top10, row.top50) == (9, 17)


def test_streaming_loads_once(spark, tmp_path):
    source, target, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    source.mkdir()
    people = listing(spark, 4)

    def run():
        load_new_files(spark, str(source), people, files.SEGMENTS, target, mark, files_per_batch=1).awaitTermination()
        return loaded_rows(spark, target, schemas.SEGMENT_LONG).count()

    put(source, {IDS[0]: SEGMENTS, IDS[1]: SEGMENTS.replace("0.5", "half")})
    assert run() == 3
    assert run() == 3  # nothing new, nothing added
    put(source, {IDS[2]: SEGMENTS})
    assert run() == 6
    assert spark.read.schema(schemas.LEDGER).parquet(f"{target}/errors").count() == 1


def test_streamed_lines_are_kept_on_disk(spark, tmp_path):
    """What came is a table of the checkpoint, not state in memory; a batch that is run again does not meet its own lines."""
    source, target, mark = tmp_path / "in", str(tmp_path / "out"), tmp_path / "mark"
    source.mkdir()

    def deliver(name, texts):
        (source / name).mkdir()
        put(source / name, texts)

    people, keys = listing(spark, 4), ("chromosome", "start", "end", "copy_number")

    def run():
        query = load_new_files(spark, str(source), people, files.SEGMENTS, target, str(mark), files_per_batch=1, keys=keys)
        query.awaitTermination()
        assert not any(p["stateOperators"] for p in query.recentProgress)
        return sorted(r.file_id for r in spark.read.schema("file_id string").parquet(f"{target}/rows").collect())

    head, *lines = SEGMENTS.splitlines(keepends=True)
    deliver("first", {IDS[0]: SEGMENTS, IDS[1]: SEGMENTS})
    assert run() == [IDS[0]] * 3 + [IDS[1]] * 3  # equal lines of two files are two lines
    again = lines[0].replace("0.5", "0.75")
    deliver("second", {IDS[0]: head + "".join(lines) + again + again, IDS[1]: head + "a\tchr1\tno number\n"})
    assert run() == [IDS[0]] * 4 + [IDS[1]] * 3
    last = max(int(f.name) for f in (mark / "commits").iterdir() if f.name.isdigit())
    for f in (mark / "commits").glob(f"*{last}*"):
        f.unlink()  # a driver lost before the last batch was committed
    assert run() == [IDS[0]] * 4 + [IDS[1]] * 3
    assert loaded_rows(spark, target, schemas.SEGMENT_LONG).count() == 4
    deliver("third", {IDS[0]: SEGMENTS, IDS[1]: SEGMENTS})
    assert run() == [IDS[0]] * 4 + [IDS[1]] * 3


@pytest.mark.parametrize("layout", [files.RNA, files.SEGMENTS, files.METHYLATION, files.PROTEIN])
def test_split_lines_are_those_of_the_reader(spark, tmp_path, layout):
    """Lines split by the stream have the fields that the reader of single loads finds, whatever they look like."""
    n = len(layout.columns)
    odd = ["", "   ", "\t" * (n - 1), "\t" * n, " \t ", "#", "# x\ty", " #\ty", "x", "\t".join(layout.columns)]
    odd += ["\t".join(cell for _ in range(k)) for k in (n - 1, n, n + 1) for cell in ("a", '"', '"a"', "'b", "a b ", " c", "\\", "\\t", "a,b;c", "\u00e9\u4e2d", "NA", "0.5", "1e3", "\u00a0", "#")]
    odd += ["a" + "\t" * (n - 1), "\t" * (n - 1) + "z", '"' + "\t".join("a" * n) + '"', '"a\tb"' + "\tc" * (n - 1), "a\rb\tc"]
    data = "\n".join(odd).encode() + b"\r\n" + "\t".join("w" * n).encode() + b"\r\n\r\n" + b"\t".join([b"\xe9x"] * n) + b"\n" + b"\xff" + b"\tlast" * (n - 1)
    put(tmp_path, {IDS[0]: data})
    text = spark.read.option("recursiveFileLookup", True).text(str(tmp_path))
    columns = [*(f"`{c}`" for c in layout.columns), files.CORRUPT]
    found = [tuple(r) for r in files.split_lines(text, layout).select(*columns).collect()]
    want = [tuple(r) for r in files.scan(spark, str(tmp_path), layout, whole=True).select(*columns).collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr) and len(found) > 40


def test_parts_that_come_later_are_searched(spark, tmp_path):
    """Parts that were not yet there when the folder was listed have their file id all the same."""
    put(tmp_path, {IDS[0]: SEGMENTS})
    parts = listed_parts(spark, str(tmp_path))
    assert [r.listed for r in parts.collect()] == [IDS[0]]
    assert listed_parts(spark, str(tmp_path / "nothing")) is None
    stream = stream_lines(spark, str(tmp_path), files.SEGMENTS, 10)
    put(tmp_path, {IDS[1]: SEGMENTS})
    query = stream.writeStream.format("memory").queryName("parts").trigger(availableNow=True).start()
    query.awaitTermination()
    assert {r.file_id: r.n for r in spark.sql("SELECT file_id, count(*) AS n FROM parts GROUP BY 1").collect()} == {IDS[0]: 4, IDS[1]: 4}


def test_long_table_prunes_partitions(spark, tmp_path):
    rows = spark.createDataFrame([("B", "rna", "p", "f", 1.0), ("L", "rna", "q", "f", 2.0)], schemas.MEASUREMENT)
    path = sinks.write_long(rows, str(tmp_path / "long"))
    read = spark.read.parquet(path).where(F.col("cohort") == "L")
    assert read.count() == 1
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cohort" in plan


@pytest.mark.parametrize("layout", [files.RNA, files.SEGMENTS, files.METHYLATION, files.MIRNA, files.PROTEIN])
def test_layouts_name_their_columns(layout):
    assert {raw for raw, _ in layout.output.values()} <= set(layout.columns)


def test_lines_of_files_move_once(spark):
    """Their place needs no shuffle by subject, whatever Spark believes of the sizes."""
    rows = spark.range(1000).select((F.col("id") % 3).alias("nation"), F.col("id").alias("salt"), F.col("id").cast("string").alias("line"))
    described = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "nation long, file_id string").withColumn("preamble", raw_files.lines("head"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        placed = raw_files.placed_lines(rows, described)
        plan = placed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning" not in plan and "BroadcastHashJoin" in plan
    found = {(r.file_id, r.at): r.n for r in placed.groupBy("file_id", "at").count().withColumnRenamed("count", "n").collect()}
    assert found == {("a", 0): 1, ("b", 0): 1, ("c", 0): 1, ("a", 1000): 334, ("b", 1000): 333, ("c", 1000): 333}
