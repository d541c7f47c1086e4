"""Queries that go through files: ingest, streaming ingest, labels, artefacts."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews.dims import MODALITY_SPECS, inline_table
from cohortviews.operators import evaluate as ev
from cohortviews.operators import merge as mg
from cohortviews.plans import adapters as ad
from cohortviews.plans import raw_files as raw
from cohortviews.plans.catalogue import query
from cohortviews.plans.queries_evaluation import SQL_SCORES, SQL_SUMMARY, sql_class_scores
from cohortviews.plans.queries_matrix import _rounded_views, mutations
from cohortviews.plans import cohort as co
from cohortviews import schemas
from cohortviews.session import stage, staging_path
from cohortviews.sources import artefacts, files, folders, labels, sinks, tables
from cohortviews.sources.manifest import read_manifest, with_modality
from cohortviews.streaming.ingest import load_new_files, loaded_rows

SALES = "lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey"
VISITS = """(SELECT e.*, c.c_nationkey AS nation, CAST(regexp_extract(e.props, '"k": *([0-9]+)', 1) AS INTEGER) AS k
  FROM events e JOIN customer c ON e.user_id = c.c_custkey) v"""
SELLER = raw.SQL_BARCODE.format(key="s.s_nationkey")
VISITOR = raw.SQL_BARCODE.format(key="v.nation")

SQL_RNA = f"""SELECT {SELLER} AS patient_id,
  'ENSG' || lpad(CAST(l_partkey AS VARCHAR), 11, '0') || '.' || l_linenumber AS gene_id,
  'G' || l_partkey AS gene_name, l_returnflag AS gene_type, l_extendedprice / 2 AS fpkm_unstranded,
  l_discount AS tpm_unstranded, l_extendedprice AS fpkm_uq_unstranded FROM {SALES}"""
SQL_SEGMENTS = f"""SELECT {SELLER} AS patient_id, CAST(l_suppkey % 22 + 1 AS VARCHAR) AS chromosome, l_partkey * 1000 AS start,
  l_partkey * 1000 + CAST(l_quantity * 1000 AS BIGINT) AS "end", l_discount - l_tax AS copy_number FROM {SALES}"""


# --- measurement files ---------------------------------------------------------------


@query("ingest_expression_files", SQL_RNA)
def ingest_expression_files(spark, sf_dir):
    path = raw.rna_files(spark, sf_dir)
    return files.ingest(spark, path, raw.manifest(spark, sf_dir, "rna"), files.RNA)[0]


@query(
    "ingest_expression_narrow",
    f"WITH r AS ({SQL_RNA}) SELECT patient_id, gene_id, fpkm_unstranded FROM r",
)
def ingest_expression_narrow(spark, sf_dir):
    path = raw.rna_files(spark, sf_dir)
    manifest = raw.manifest(spark, sf_dir, "rna")
    return files.ingest(spark, path, manifest, files.RNA, ("gene_id", "fpkm_unstranded"))[0]


@query(
    "ingest_skips_damaged_files",
    f"WITH r AS ({SQL_RNA} WHERE s_nationkey % 5 < 3) "
    "SELECT patient_id, count(*) AS n, count(DISTINCT gene_id) AS n_genes FROM r GROUP BY patient_id",
)
def ingest_skips_damaged_files(spark, sf_dir):
    path = raw.rna_files(spark, sf_dir, damaged=True)
    rows, _ = files.ingest(spark, path, raw.manifest(spark, sf_dir, "rna"), files.RNA)
    sizes = rows.groupBy("patient_id").agg(F.count("*").alias("n"))
    genes = rows.groupBy("patient_id").agg(F.count_distinct("gene_id").alias("n_genes"))
    return sizes.join(genes, "patient_id")


@query(
    "ingest_error_ledger",
    f"""SELECT {raw.SQL_BARCODE.format(key='k')} AS patient_id, {raw.sql_uuid('rna', 'k')} AS file_id,
  CASE WHEN k % 5 = 3 THEN 'unexpected header' ELSE '1 unreadable rows' END AS error
FROM (SELECT DISTINCT s_nationkey AS k FROM {SALES}) t WHERE k % 5 >= 3
UNION ALL SELECT {raw.SQL_BARCODE.format(key='n_nationkey')}, {raw.sql_uuid('rna', 'n_nationkey')}, 'no such file, or empty'
FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM {SALES})""",
)
def ingest_error_ledger(spark, sf_dir):
    path = raw.rna_files(spark, sf_dir, damaged=True)
    _, errors = files.ingest(spark, path, raw.manifest(spark, sf_dir, "rna"), files.RNA)
    target = staging_path(spark, "ledger")
    sinks.write_ledger(errors, target)
    return artefacts.read_csv_table(spark, target, schemas.LEDGER)


@query("ingest_segment_files", SQL_SEGMENTS)
def ingest_segment_files(spark, sf_dir):
    path = raw.segment_files(spark, sf_dir)
    return files.ingest(spark, path, raw.manifest(spark, sf_dir, "cnv"), files.SEGMENTS)[0]


@query(
    "ingest_methylation_files",
    f"""SELECT {VISITOR} AS patient_id, 'cg' || event_type || k AS probe_id,
  CASE WHEN event_type <> 'error' THEN value / (1 + value) END AS beta_value FROM {VISITS}""",
)
def ingest_methylation_files(spark, sf_dir):
    path = raw.methylation_files(spark, sf_dir)
    return files.ingest(spark, path, raw.manifest(spark, sf_dir, "meth"), files.METHYLATION)[0]


@query(
    "ingest_methylation_damaged",
    f"""WITH v AS (SELECT nation AS k, event_id FROM {VISITS}), files AS (
  SELECT n_nationkey AS k, count(event_id) AS n FROM nation LEFT JOIN v ON v.k = n_nationkey GROUP BY 1)
SELECT {raw.SQL_BARCODE.format(key='k')} AS patient_id, CASE WHEN n > 0 AND k % 5 < 3 THEN n ELSE 0 END AS n_rows,
  CASE WHEN n = 0 THEN 'no such file, or empty' WHEN k % 5 >= 3 THEN '1 unreadable rows' END AS error FROM files""",
)
def ingest_methylation_damaged(spark, sf_dir):
    """Files without a header and one line with a field too few or too many: none of their rows, one ledger entry."""
    path = raw.methylation_files(spark, sf_dir, damaged=True)
    listing = raw.manifest(spark, sf_dir, "meth")
    rows, errors = files.ingest(spark, path, listing, files.METHYLATION)
    counts = rows.groupBy("patient_id").agg(F.count("*").alias("n_rows"))
    joined = listing.select("patient_id").join(counts, "patient_id", "left").join(errors, "patient_id", "left")
    return joined.select("patient_id", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "error")


@query(
    "ingest_methylation_strict",
    f"""WITH v AS (SELECT nation AS k, count(*) AS n, count(*) FILTER (event_type = 'error') AS bad FROM {VISITS} GROUP BY 1)
SELECT {raw.SQL_BARCODE.format(key='k')} AS patient_id, CASE WHEN bad > 0 THEN 'skipped' ELSE 'loaded' END AS outcome FROM v""",
)
def ingest_methylation_strict(spark, sf_dir):
    """The form without a spelling of missing numbers: a file that has one is skipped whole."""
    rows, errors = files.ingest(
        spark, raw.methylation_files(spark, sf_dir), raw.manifest(spark, sf_dir, "meth"), files.METHYLATION_STRICT
    )
    loaded = rows.select("patient_id", F.lit("loaded").alias("outcome")).distinct()
    return loaded.unionByName(
        errors.where(F.col("error").endswith("unreadable rows")).select("patient_id", F.lit("skipped").alias("outcome"))
    )


@query(
    "ingest_absent_files",
    f"""SELECT {raw.SQL_BARCODE.format(key='n_nationkey')} AS patient_id, {raw.sql_uuid('cnv', 'n_nationkey')} AS file_id,
  'no such file, or empty' AS error
FROM nation WHERE n_nationkey % 3 = 1 OR n_nationkey NOT IN (SELECT s_nationkey FROM {SALES})""",
)
def ingest_absent_files(spark, sf_dir):
    """The ledger of a folder that lacks every third subject's file."""
    listing = raw.manifest(spark, sf_dir, "cnv")
    there = F.col("nation") % 3 != 1
    described = listing.withColumn("preamble", raw.lines(raw.SEGMENT_HEADER))
    path = raw.write_files(raw.segment_rows(spark, sf_dir).where(there), described.where(there), staging_path(spark, "cnv"))
    return files.ingest(spark, path, listing, files.SEGMENTS)[1]


@query(
    "ingest_empty_modality",
    "SELECT 'first' AS attempt, 'cnv has no rows' AS outcome UNION ALL SELECT 'again', 'loaded'",
)
def ingest_empty_modality(spark, sf_dir):
    """A modality whose files are all damaged leaves no table, so it is loaded once the files are mended."""
    listing = raw.manifest(spark, sf_dir, "cnv")
    rows = raw.segment_rows(spark, sf_dir)
    target, done = staging_path(spark, "empty-target"), []
    for attempt, header in (("first", "not a header"), ("again", raw.SEGMENT_HEADER)):
        described = listing.withColumn("preamble", raw.lines(header))
        path = raw.write_files(rows, described, staging_path(spark, "cnv"))
        try:
            sinks.write_table(files.ingest(spark, path, listing, files.SEGMENTS)[0], target, what="cnv")
            done.append((attempt, "loaded" if tables.stored(spark, target) else "no table"))
        except RuntimeError as exc:
            done.append((attempt, "a table was left" if tables.stored(spark, target) else str(exc)))
    return inline_table(spark, done, "attempt string, outcome string")


@query(
    "ingest_protein_files",
    f"""SELECT {VISITOR} AS patient_id, upper(event_type) || k AS peptide_target,
  CASE WHEN k <> 7 THEN value END AS protein_expression FROM {VISITS}""",
)
def ingest_protein_files(spark, sf_dir):
    path = raw.protein_files(spark, sf_dir)
    return files.ingest(spark, path, raw.manifest(spark, sf_dir, "rppa"), files.PROTEIN)[0]


@query(
    "ingest_mirna_files",
    f"""SELECT {VISITOR} AS patient_id, 'hsa-mir-' || k AS mirna_id,
  CASE WHEN event_type = 'view' THEN 0.0 ELSE value END AS reads_per_million_mirna_mapped FROM {VISITS}""",
)
def ingest_mirna_files(spark, sf_dir):
    path = raw.mirna_files(spark, sf_dir)
    return files.ingest(spark, path, raw.manifest(spark, sf_dir, "mirna"), files.MIRNA)[0]


@query(
    "ingest_mutation_files",
    f"""SELECT DISTINCT {SELLER} AS patient_id, 'GENE' || l_partkey % 97 AS hugo_symbol, CAST(1.0 AS DOUBLE) AS mutated FROM {SALES}
WHERE l_linenumber <= 5 AND l_partkey % 11 <> 0 AND l_partkey % 13 <> 0""",
)
def ingest_mutation_files(spark, sf_dir):
    path = raw.mutation_files(spark, sf_dir)
    return files.ingest_mutations(spark, path, raw.manifest(spark, sf_dir, "maf"))[0]


@query(
    "ingest_manifest",
    f"""SELECT {raw.sql_uuid('m', 's_suppkey')} AS file_id, s_name || '.tsv' AS file_name,
  'TC-' || s_nationkey || '-' || s_suppkey AS patient_id FROM supplier""",
)
def ingest_manifest(spark, sf_dir):
    s = ad.table(spark, sf_dir, "supplier")
    code = F.concat_ws("-", F.lit("TC"), "s_nationkey", "s_suppkey", F.lit("01A"), F.lit("11R"))
    hit = F.struct(
        raw.uuid_of("m", F.col("s_suppkey")).alias("file_id"),
        F.concat("s_name", F.lit(".tsv")).alias("file_name"),
        F.array(F.struct(code.alias("submitter_id")), F.struct(F.lit("OTHER-1-2").alias("submitter_id"))).alias("cases"),
    )
    page = F.to_json(F.struct(F.struct(F.collect_list(hit).alias("hits")).alias("data")))
    return read_manifest(spark, raw.write_pages(s, "s_suppkey", page, "manifest"))


@query("ingest_stream", SQL_SEGMENTS)
def ingest_stream(spark, sf_dir):
    """Half of the subjects, a run, the other half, two more runs."""
    rows = raw.segment_rows(spark, sf_dir)
    listing = raw.manifest(spark, sf_dir, "cnv")
    described = listing.withColumn("preamble", raw.lines(raw.SEGMENT_HEADER))
    folder, target, mark = (staging_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    for wanted in (F.col("nation") < 12, F.col("nation") >= 12, None):
        if wanted is not None:
            raw.write_files(rows.where(wanted), described.where(wanted), folder, mode="append")
        load_new_files(spark, folder, listing, files.SEGMENTS, target, mark).awaitTermination()
    return loaded_rows(spark, target, schemas.SEGMENT_LONG)


@query(
    "ingest_stream_late_damage",
    f"SELECT patient_id, count(*) AS n FROM ({SQL_SEGMENTS}) WHERE patient_id NOT IN ("
    f"SELECT {raw.SQL_BARCODE.format(key='n_nationkey')} FROM nation WHERE n_nationkey % 4 = 0) GROUP BY patient_id",
)
def ingest_stream_late_damage(spark, sf_dir):
    """Every fourth subject's file gets a damaged second part in a later batch: none of its rows count."""
    rows = raw.segment_rows(spark, sf_dir)
    listing = raw.manifest(spark, sf_dir, "cnv")
    described = listing.withColumn("preamble", raw.lines(raw.SEGMENT_HEADER))
    damaged = rows.where(F.col("nation") % 4 == 0).dropDuplicates(["nation"]).withColumn("line", F.lit("a\tchr1\tno number"))
    folder, target, mark = (staging_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    for part in (rows, damaged):
        raw.write_files(part, described, folder, mode="append")
        load_new_files(spark, folder, listing, files.SEGMENTS, target, mark).awaitTermination()
    return loaded_rows(spark, target, schemas.SEGMENT_LONG).groupBy("patient_id").agg(F.count("*").alias("n"))


@query("ingest_stream_repeated_part", f"SELECT DISTINCT * FROM ({SQL_SEGMENTS})")
def ingest_stream_repeated_part(spark, sf_dir):
    """Half of the subjects; the same parts again, under other names, with the other half; and all once more."""
    rows = stage(raw.segment_rows(spark, sf_dir), "segments")  # written to files three times, joined once
    listing = raw.manifest(spark, sf_dir, "cnv")
    described = listing.withColumn("preamble", raw.lines(raw.SEGMENT_HEADER))
    folder, target, mark = (staging_path(spark, n) for n in ("stream-in", "stream-out", "stream-mark"))
    keys = ("chromosome", "start", "end", "copy_number")
    for wanted in (F.col("nation") < 12, F.lit(True), F.lit(True)):
        raw.write_files(rows.where(wanted), described.where(wanted), folder, mode="append")
        load_new_files(spark, folder, listing, files.SEGMENTS, target, mark, keys=keys).awaitTermination()
    return loaded_rows(spark, target, schemas.SEGMENT_LONG)


@query("ingest_half_committed", SQL_SEGMENTS)
def ingest_half_committed(spark, sf_dir):
    """A table of which a lost driver left half: it does not count as loaded, and the next load replaces it."""
    path = raw.segment_files(spark, sf_dir)
    rows, _ = files.ingest(spark, path, raw.manifest(spark, sf_dir, "cnv"), files.SEGMENTS)
    target = staging_path(spark, "half")
    rows.where(F.col("start") % 2 == 0).write.parquet(target)
    if not tables.stored(spark, target):
        sinks.write_table(rows, target, what="cnv")
    return spark.read.parquet(target)


@query(
    "ingest_clean_rerun",
    f"""SELECT 'damaged' AS attempt, (SELECT count(*) FROM (SELECT DISTINCT s_nationkey AS k FROM {SALES}) t WHERE k % 5 >= 3)
  + (SELECT count(*) FROM nation WHERE n_nationkey NOT IN (SELECT s_nationkey FROM {SALES})) AS n_errors
UNION ALL SELECT 'mended', 0""",
)
def ingest_clean_rerun(spark, sf_dir):
    """The ledger of a load that went wrong is gone after one that did not."""
    listing, target, done = raw.manifest(spark, sf_dir, "rna"), staging_path(spark, "ledger"), []
    for attempt in ("damaged", "mended"):
        path = raw.rna_files(spark, sf_dir, damaged=attempt == "damaged")
        there = listing if attempt == "damaged" else listing.join(files.with_file(spark.read.text(path)), "file_id", "left_semi")
        sinks.write_ledger(files.ingest(spark, path, there, files.RNA)[1], target)
        left = folders.exists(spark, target)
        done.append((attempt, artefacts.read_csv_table(spark, target, schemas.LEDGER).count() if left else 0))
    return inline_table(spark, done, "attempt string, n_errors bigint")


@query(
    "sync_modalities",
    f"""WITH specs AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{c}', '{t}', '{m}')" for i, (c, t, m) in enumerate(MODALITY_SPECS))}) s(i, c, t, modality))
SELECT modality, NOT starts_with(modality, '_excluded/') AS is_primary, count(*) AS n_files
FROM orders JOIN specs ON o_orderkey % 12 = i GROUP BY modality""",
)
def sync_modalities(spark, sf_dir):
    """Files by kind of data: wanted kinds get their folder, others are left out."""
    kinds = [(i, c, t) for i, (c, t, _) in enumerate(MODALITY_SPECS)] + [(9, "Clinical", "Pathology Report"), (10, "Other", "Clinical Supplement")]
    kinds = inline_table(spark, kinds, "kind int, data_category string, data_type string")
    listing = ad.table(spark, sf_dir, "orders").withColumn("kind", (F.col("o_orderkey") % 12).cast("int")).join(kinds, "kind")
    return with_modality(listing).groupBy("modality").agg(F.max("is_primary").alias("is_primary"), F.count("*").alias("n_files"))


# --- label files -----------------------------------------------------------------------


@query(
    "ingest_label_table",
    """SELECT 'TC-' || lpad(CAST(doc_id AS VARCHAR), 9, '0') AS patient_id,
  CASE WHEN toxic = 1 THEN 'T.' || toxic END AS hoadley_subtype_mrna,
  CASE WHEN quality = 1 THEN 'Q.' || quality END AS hoadley_subtype_selected FROM labels""",
)
def ingest_label_table(spark, sf_dir):
    table = ad.table(spark, sf_dir, "labels")
    sample = F.concat(F.lit("TC-"), F.lpad(F.col("doc_id").cast("string"), 9, "0"))
    first = table.select(
        F.concat(sample, F.lit("-01")).alias("sampleID"),
        F.lit("en").alias("cancer.type"),
        F.when(F.col("toxic") == 1, "T.1").otherwise("[Not Applicable]").alias("Subtype_mRNA"),
        F.when(F.col("quality") == 1, "Q.1").otherwise("NA").alias("SUBTYPE_Selected"),
    )
    second = first.select(
        F.regexp_replace("sampleID", "-01$", "-06").alias("sampleID"),
        "`cancer.type`",
        F.lit("later").alias("Subtype_mRNA"),
        F.lit("later").alias("SUBTYPE_Selected"),
    )
    path = staging_path(spark, "labels")
    first.unionByName(second).write.option("header", True).option("sep", "\t").csv(path)
    return labels.read_label_table(spark, path)


@query(
    "ingest_label_json",
    "SELECT CAST(doc_id AS VARCHAR) AS patient_id, 'Q' || quality AS en_marker_subtype FROM labels",
)
def ingest_label_json(spark, sf_dir):
    rows = ad.table(spark, sf_dir, "labels")
    entry = F.struct(F.col("doc_id").cast("string").alias("patientId"), F.concat(F.lit("Q"), "quality").alias("value"))
    path = raw.write_pages(rows, "doc_id", F.to_json(F.collect_list(entry)), "label-json")
    return labels.read_label_json(spark, path, "en_marker_subtype")


# --- artefacts --------------------------------------------------------------------------


@query(
    "log_metrics",
    """SELECT CAST(event_id AS INTEGER) AS iteration, -value AS elbo, value AS delta_percent,
  CAST(user_id AS INTEGER) AS factors FROM events WHERE event_type = 'purchase'""",
)
def log_metrics(spark, sf_dir):
    e = ad.table(spark, sf_dir, "events")
    step = F.concat(
        F.lit("Iteration "), "event_id", F.lit(": time=0.25, ELBO=-"), F.col("value").cast("string"),
        F.lit(", deltaELBO=1.5 ("), F.col("value").cast("string"), F.lit("%), Factors="), "user_id",
    )
    path = staging_path(spark, "log")
    e.select(F.when(F.col("event_type") == "purchase", step).otherwise(F.col("event_type"))).write.text(path)
    return artefacts.read_training_log(spark, path)


@query(
    "artifact_compare",
    f"""WITH {ad.SQL_VECTORS}, {SQL_SCORES.replace('fold,', 'cluster, fold,').replace('1, 2, 3)', '1, 2, 3, 4)').replace('SELECT fold, p, 0', 'SELECT cluster, fold, p, 0')},
{sql_class_scores('cluster, fold, ')}, m AS (SELECT cluster, fold, {SQL_SUMMARY} FROM sc GROUP BY 1, 2)
SELECT 'task' || cluster AS task, CAST(10 AS INTEGER) AS n_classes, round(avg(accuracy), 8) AS accuracy,
  round(avg(balanced_accuracy), 8) AS balanced_accuracy, round(avg(macro_f1), 8) AS macro_f1,
  round(stddev_pop(accuracy), 8) AS accuracy_std, round(stddev_pop(balanced_accuracy), 8) AS balanced_accuracy_std,
  round(stddev_pop(macro_f1), 8) AS macro_f1_std FROM m GROUP BY cluster""",
)
def artifact_compare(spark, sf_dir):
    """Scores per task and fold, written as one JSON document per task, read back."""
    scores = ev.summary_scores(ad.vectors(spark, sf_dir), ["cluster", "fold"])
    names = ["accuracy", "balanced_accuracy", "macro_f1"]
    runs = scores.groupBy(F.concat(F.lit("task"), "cluster").alias("task")).agg(
        F.lit(10).alias("n_classes"),
        F.struct(
            *[F.struct(F.avg(n).alias("mean"), F.stddev_pop(n).alias("std")).alias(n) for n in names]
        ).alias("cv_scores"),
    )
    path = staging_path(spark, "metrics")
    runs.repartition("task").write.partitionBy("task").json(path)
    out = artefacts.read_metrics(spark, path)
    return out.withColumns({c: F.round(c, 8) for c in out.columns if c not in ("task", "n_classes")})


@query(
    "panel_report_compare",
    f"""WITH {ad.SQL_VECTORS} SELECT 'c' || cluster AS cancer, CAST(count(*) AS BIGINT) AS panel_size,
  count(*) FILTER (WHERE label < 1) AS top10, count(*) FILTER (WHERE label < 2) AS top25, count(*) FILTER (WHERE label < 5) AS top50
FROM vectors GROUP BY cluster""",
)
def panel_report_compare(spark, sf_dir):
    v = ad.vectors(spark, sf_dir)
    hits = {f"hits_top{k}": F.struct(F.count_if(F.col("label") < n).alias("hits")) for k, n in ((10, 1), (25, 2), (50, 5))}
    reports = v.groupBy(F.concat(F.lit("c"), "cluster").alias("cancer")).agg(
        F.count("*").alias("panel_size"), *[c.alias(n) for n, c in hits.items()]
    )
    path = staging_path(spark, "reports")
    reports.repartition("cancer").write.partitionBy("cancer").json(path)
    return artefacts.read_panel_reports(spark, path)


@query(
    "predictions_csv_roundtrip",
    f"WITH {ad.SQL_VECTORS} SELECT vec_id AS patient_id, fold, actual_code, predicted_code FROM vectors",
)
def predictions_csv_roundtrip(spark, sf_dir):
    rows = ad.vectors(spark, sf_dir).select(F.col("vec_id").alias("patient_id"), "fold", "actual_code", "predicted_code")
    path = sinks.write_csv(rows, staging_path(spark, "predictions"))
    return artefacts.read_csv_table(spark, path, "patient_id bigint, fold int, actual_code int, predicted_code int")


#: More names than one pushed list takes; one of them does not occur.
CLUSTERED = ["Brand#11.0", "Brand#11.1", "Brand#13.2", *[f"Brand#{m}{n}.3" for m in (2, 3) for n in range(1, 6)], "none"]


@query(
    "long_table_roundtrip",
    f"""WITH {ad.SQL_PROTEIN}, {ad.SQL_MIRNA}
SELECT 'rppa' AS modality, patient_id, feature_id, value FROM protein
UNION ALL SELECT 'mirna', patient_id, feature_id, value FROM mirna""",
)
def long_table_roundtrip(spark, sf_dir):
    rows = mg.stack_cohorts(
        [
            ad.protein(spark, sf_dir).withColumn("modality", F.lit("rppa")),
            ad.mirna(spark, sf_dir).withColumn("modality", F.lit("mirna")),
        ]
    )
    path = sinks.write_long(rows, staging_path(spark, "long"), ["modality"])
    return spark.read.parquet(path)


@query(
    "clustered_features",
    f"""WITH {ad.SQL_EXPRESSION} SELECT cohort, patient_id, feature_id, value FROM expression
WHERE feature_id IN ({", ".join(f"'{f}'" for f in CLUSTERED)})""",
)
def clustered_features(spark, sf_dir):
    """Some features of a table that is clustered by feature inside each cohort."""
    path = sinks.write_long(ad.expression(spark, sf_dir), staging_path(spark, "long"), ["cohort"], ["feature_id", "patient_id"])
    return tables.only_features(spark.read.parquet(path), CLUSTERED).select("cohort", "patient_id", "feature_id", "value")


@query(
    "wide_table_roundtrip",
    f"WITH {ad.SQL_ARMS} SELECT patient_id, "
    + ", ".join(f"round(avg(CASE WHEN arm = '{a}' THEN copy_number END) + 0.0, 6) AS \"{a}\"" for a in ("1p", "1q", "2p", "2q"))
    + " FROM arms GROUP BY patient_id",
)
def wide_table_roundtrip(spark, sf_dir):
    view = co.arm_view(ad.segments(spark, sf_dir))
    wide = co.wide_table(view.arrays.withColumnRenamed("values", "CNV"), [view], declared={"CNV": ["1p", "1q", "2p", "2q"]})
    path = staging_path(spark, "wide")
    sinks.write_table(wide, path, ["patient_id"], "arm matrix")
    return _rounded_views(spark.read.parquet(path), ("patient_id",))


@query(
    "json_manifest_roundtrip",
    f"""WITH {ad.SQL_MUTATION} SELECT count(*) AS rows, count(DISTINCT patient_id) AS n_entities, min(hugo_symbol) AS first_gene FROM mutation""",
)
def json_manifest_roundtrip(spark, sf_dir):
    pairs = mutations(spark, sf_dir)
    people = pairs.agg(F.count_distinct("patient_id").alias("n")).scalar()
    row = sinks.manifest_row(pairs, {"rows": F.count("*"), "first_gene": F.min("hugo_symbol")})
    path = sinks.write_json(row.withColumn("n_entities", people), staging_path(spark, "manifest-json"))
    return spark.read.schema("rows bigint, n_entities bigint, first_gene string").json(path)
