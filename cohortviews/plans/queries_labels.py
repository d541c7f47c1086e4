"""Queries on labels, panels, reconciliation and the sync plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews import dims
from cohortviews.functions.ids import (
    base_id,
    object_key,
    patient_of_barcode,
    patient_of_sample,
    short_cohort,
)
from cohortviews.operators import labels as lb
from cohortviews.operators import panels as pn
from cohortviews.operators import quality as ql
from cohortviews.operators import reshape as rs
from cohortviews.operators import select as sel
from cohortviews.plans import adapters as ad
from cohortviews.plans import cohort as co
from cohortviews.plans.catalogue import query
from cohortviews.plans.queries_matrix import _digest
from cohortviews.sources.manifest import pending_files, select_files, sync_plan, sync_totals

# --- labels --------------------------------------------------------------------------


def _audit(spark, sf_dir):
    """Documents as patients, language as cohort, one label source per cohort."""
    docs = ad.labelled_documents(spark, sf_dir)
    base = docs.select("patient_id", "cohort")
    published = docs.select("patient_id", F.col("quality").alias("hoadley_subtype_selected"))
    english = docs.select("patient_id", F.col("quality").alias("en_marker_subtype"))
    german = docs.select("patient_id", F.col("toxic").alias("de_marker_subtype"))
    return co.label_audit(base, published, {"en": english, "de": german})


SQL_AUDIT = f"""{ad.SQL_DOCUMENTS}, audit AS (
  SELECT patient_id, cohort, quality AS hoadley_subtype_selected, quality AS en_marker_subtype,
         toxic AS de_marker_subtype,
         CASE WHEN cohort = 'en' THEN quality WHEN cohort = 'de' THEN toxic END AS marker_subtype FROM labelled),
long_ AS (SELECT cohort, 'hoadley_subtype_selected' AS source, hoadley_subtype_selected AS label FROM audit
  UNION ALL SELECT cohort, 'en_marker_subtype', en_marker_subtype FROM audit
  UNION ALL SELECT cohort, 'de_marker_subtype', de_marker_subtype FROM audit
  UNION ALL SELECT cohort, 'marker_subtype', marker_subtype FROM audit)"""


@query("label_audit", f"WITH {SQL_AUDIT} SELECT * FROM audit")
def label_audit(spark, sf_dir):
    return _audit(spark, sf_dir)


@query("label_coalesce", f"WITH {SQL_AUDIT} SELECT patient_id, cohort, marker_subtype FROM audit")
def label_coalesce(spark, sf_dir):
    return _audit(spark, sf_dir).select("patient_id", "cohort", "marker_subtype")


def _sources(audit):
    return [c for c in audit.columns if "subtype" in c.lower()]


@query(
    "label_audit_counts",
    f"""WITH {SQL_AUDIT} SELECT cohort, source, coalesce(label, '__null__') AS label, count(*) AS n
FROM long_ GROUP BY 1, 2, 3""",
)
def label_audit_counts(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    return lb.label_counts(audit, _sources(audit))


@query(
    "label_audit_totals",
    f"""WITH {SQL_AUDIT} SELECT cohort, source, count(*) AS n_entities, count(label) AS n_labeled,
count(*) - count(label) AS n_unlabeled FROM long_ GROUP BY 1, 2""",
)
def label_audit_totals(spark, sf_dir):
    audit = _audit(spark, sf_dir)
    return lb.label_totals(audit, _sources(audit))


@query(
    "label_remap",
    f"""WITH {ad.SQL_DOCUMENTS} SELECT patient_id, CASE WHEN lang_label = 'de.0' THEN 'de.other' ELSE lang_label END AS subtype
FROM (SELECT patient_id, cohort || '.' || quality AS lang_label FROM labelled) t WHERE lang_label LIKE 'de%'""",
)
def label_remap(spark, sf_dir):
    docs = ad.labelled_documents(spark, sf_dir)
    named = docs.select("patient_id", F.concat("cohort", F.lit("."), "quality").alias("subtype"))
    return lb.labels_of_type(named, "subtype", "de", {"de.0": "de.other"})


@query(
    "label_codes",
    f"""WITH {ad.SQL_DOCUMENTS} SELECT source, row_number() OVER (ORDER BY source) - 1 AS source_code
FROM (SELECT DISTINCT source FROM labelled) t""",
)
def label_codes(spark, sf_dir):
    return lb.label_codes(ad.labelled_documents(spark, sf_dir), "source", "source_code")


SUBTYPE_MISSING = 0.6


@query(
    "model_ready_subtype",
    f"""WITH {ad.SQL_METHYLATION}, {ad.SQL_MIRNA}, {ad.SQL_DOCUMENTS},
cells AS (SELECT patient_id, feature_id, avg(value) AS value FROM methylation GROUP BY 1, 2),
lab AS (SELECT patient_id, CASE WHEN l = 'en.0' THEN 'en.other' ELSE l END AS subtype
        FROM (SELECT patient_id, cohort || '.' || quality AS l FROM labelled) t WHERE l LIKE 'en%'),
roster AS (SELECT * FROM lab WHERE patient_id IN (SELECT patient_id FROM cells)),
codes AS (SELECT subtype, row_number() OVER (ORDER BY subtype) - 1 AS subtype_code FROM (SELECT DISTINCT subtype FROM roster) d),
own AS (SELECT c.* FROM cells c JOIN roster r ON c.patient_id = r.patient_id),
kept AS (SELECT f.feature_id FROM (SELECT DISTINCT feature_id FROM cells) f LEFT JOIN own o ON f.feature_id = o.feature_id
  GROUP BY f.feature_id HAVING 1 - count(o.value) / CAST((SELECT count(*) FROM roster) AS DOUBLE) <= {SUBTYPE_MISSING})
SELECT r.patient_id, r.subtype, any_value(k.subtype_code) AS subtype_code, (SELECT count(*) FROM kept) AS n_features,
  count(CASE WHEN d.feature_id IS NOT NULL THEN c.value END) AS n_observed,
  CAST(coalesce(sum(CASE WHEN d.feature_id IS NOT NULL THEN CAST(round(c.value * 10000) AS BIGINT) END), 0) AS BIGINT) AS value_units
FROM roster r JOIN codes k ON r.subtype = k.subtype LEFT JOIN own c ON r.patient_id = c.patient_id
LEFT JOIN kept d ON c.feature_id = d.feature_id GROUP BY r.patient_id, r.subtype""",
)
def model_ready_subtype(spark, sf_dir):
    cells = rs.mean_cells(ad.methylation(spark, sf_dir))
    docs = ad.labelled_documents(spark, sf_dir)
    labels = docs.select("patient_id", F.concat("cohort", F.lit("."), "quality").alias("selected"))
    model = co.subtype_model(
        cells, labels, "selected", "en", {"en.0": "en.other"}, SUBTYPE_MISSING
    )
    return _digest(model.rows, ["patient_id", "subtype", "subtype_code"])


@query(
    "dedupe_first_per_entity",
    """SELECT conv_id, turn, role, text FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS r FROM conversations) t WHERE r = 1""",
)
def dedupe_first_per_entity(spark, sf_dir):
    return lb.first_per_entity(ad.table(spark, sf_dir, "conversations"), "conv_id", ["turn"])


@query(
    "barcode_keys",
    """SELECT c_custkey, array_to_string(list_slice(string_split(code, '-'), 1, 3), '-') AS patient_id,
  substr(code, 1, 12) AS sample_patient, split_part(c_name || '.7.1', '.', 1) AS base_id,
  'tcga/' || c_mktsegment || '/' || c_name AS object_key, replace('TCGA-' || c_mktsegment, 'TCGA-', '') AS cohort
FROM (SELECT *, CASE WHEN c_nationkey % 2 = 0 THEN 'TC-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || c_custkey || '-01A-11R'
       ELSE 'TC-' || c_custkey END AS code FROM customer) t""",
)
def barcode_keys(spark, sf_dir):
    customers = ad.table(spark, sf_dir, "customer")
    key = F.col("c_custkey").cast("string")
    code = F.when(
        F.col("c_nationkey") % 2 == 0,
        F.concat_ws("-", F.lit("TC"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), key, F.lit("01A"), F.lit("11R")),
    ).otherwise(F.concat_ws("-", F.lit("TC"), key))
    return customers.withColumn("code", code).select(
        "c_custkey",
        patient_of_barcode("code").alias("patient_id"),
        patient_of_sample("code").alias("sample_patient"),
        base_id(F.concat("c_name", F.lit(".7.1"))).alias("base_id"),
        object_key(F.lit("tcga"), "c_mktsegment", "c_name").alias("object_key"),
        short_cohort(F.concat(F.lit("TCGA-"), "c_mktsegment")).alias("cohort"),
    )


@query("class_counts", "SELECT label, count(*) AS n FROM embeddings GROUP BY label")
def class_counts(spark, sf_dir):
    return lb.class_counts(ad.table(spark, sf_dir, "embeddings"), "label")


@query(
    "class_weights",
    """SELECT label, count(*) AS n, round((SELECT count(*) FROM embeddings) /
  CAST((SELECT count(DISTINCT label) FROM embeddings) * count(*) AS DOUBLE), 8) AS weight FROM embeddings GROUP BY label""",
)
def class_weights(spark, sf_dir):
    weights = lb.balanced_weights(ad.table(spark, sf_dir, "embeddings"), "label")
    return weights.withColumn("weight", F.round("weight", 8))


# --- panels --------------------------------------------------------------------------

SQL_RANKED = f"""{ad.SQL_EXPRESSION}, {ad.sql_panel()},
scores AS (SELECT feature_id AS feature, var_pop(value) AS score FROM expression GROUP BY feature_id),
placed AS (SELECT feature, score, row_number() OVER (ORDER BY score DESC NULLS LAST, feature) AS rank FROM scores)"""


def _placed(spark, sf_dir):
    stats = sel.feature_statistics(ad.expression(spark, sf_dir))
    scores = stats.select(F.col("feature_id").alias("feature"), F.col("variance").alias("score"))
    return pn.rank_features(scores, "score")


@query("feature_ranks", f"WITH {SQL_RANKED} SELECT feature, round(score, 2) AS score, rank FROM placed")
def feature_ranks(spark, sf_dir):
    return _placed(spark, sf_dir).withColumn("score", F.round("score", 2))


@query(
    "marker_coverage",
    f"""WITH {ad.SQL_EXPRESSION}, {ad.sql_panel()},
{ad.sql_top('expression', 40, 0.30, 'top')},
base AS (SELECT DISTINCT split_part(feature_id, '.', 1) AS base_id FROM top)
SELECT p.panel, count(*) AS panel_size, count(b.base_id) AS n_present, count(*) - count(b.base_id) AS n_missing,
  coalesce(string_agg(CASE WHEN b.base_id IS NOT NULL THEN p.symbol END, ',' ORDER BY p.symbol), '') AS present,
  coalesce(string_agg(CASE WHEN b.base_id IS NULL THEN p.symbol END, ',' ORDER BY p.symbol), '') AS missing
FROM panel p LEFT JOIN base b ON p.base_id = b.base_id GROUP BY p.panel""",
)
def marker_coverage(spark, sf_dir):
    features = sel.top_variance_features(ad.expression(spark, sf_dir), 40, 0.30)
    covered = pn.marker_coverage(dims.panels(spark, ad.BRAND_PANELS), features)
    return covered.withColumns(
        {c: F.array_join(c, ",") for c in ("present", "missing")}
    )


@query(
    "panel_union",
    f"""WITH {ad.sql_panel()}, ids AS (SELECT DISTINCT base_id FROM panel)
SELECT i.base_id, count(p.p_partkey) AS n_parts FROM ids i LEFT JOIN part p ON p.p_brand = i.base_id GROUP BY i.base_id""",
)
def panel_union(spark, sf_dir):
    ids = dims.panel_ids(dims.panels(spark, ad.BRAND_PANELS))
    parts = ad.table(spark, sf_dir, "part").groupBy(F.col("p_brand").alias("base_id")).agg(
        F.count("*").alias("n_parts")
    )
    return ids.join(parts, "base_id", "left").fillna(0, subset=["n_parts"])


@query(
    "panel_rank",
    f"""WITH {SQL_RANKED},
best AS (SELECT split_part(feature, '.', 1) AS base_id, min(rank) AS rank FROM placed GROUP BY 1)
SELECT p.panel, p.symbol, p.base_id, b.rank, b.rank IS NOT NULL AS in_features, round(s.score, 2) AS score
FROM panel p LEFT JOIN best b ON p.base_id = b.base_id LEFT JOIN placed s ON s.rank = b.rank
ORDER BY p.panel, b.rank NULLS LAST""",
)
def panel_rank(spark, sf_dir):
    ranks = pn.panel_ranks(
        _placed(spark, sf_dir), dims.panels(spark, ad.BRAND_PANELS), "score", rna_prefix="Brand"
    )
    return ranks.withColumn("score", F.round("score", 2)).orderBy("panel", F.asc_nulls_last("rank"))


@query(
    "panel_hits",
    f"""WITH {SQL_RANKED}, sizes AS (SELECT panel, count(DISTINCT base_id) AS panel_size FROM panel GROUP BY panel),
k(k) AS (VALUES (10), (25), (50))
SELECT s.panel, s.panel_size, k.k, count(f.feature) AS hits, round(count(f.feature) / CAST(s.panel_size AS DOUBLE), 8) AS rate
FROM sizes s CROSS JOIN k LEFT JOIN panel p ON p.panel = s.panel
LEFT JOIN placed f ON split_part(f.feature, '.', 1) = p.base_id AND f.rank <= k.k
GROUP BY s.panel, s.panel_size, k.k""",
)
def panel_hits(spark, sf_dir):
    hits = pn.panel_hits(
        _placed(spark, sf_dir), dims.panels(spark, ad.BRAND_PANELS), rna_prefix="Brand"
    )
    return hits.withColumn("rate", F.round("rate", 8))


@query(
    "top_features_annotated",
    f"""WITH {SQL_RANKED}
SELECT f.rank, f.feature, coalesce(p.symbol, f.feature) AS label, 'rna' AS kind, p.symbol IS NOT NULL AS in_panel,
       round(f.score, 2) AS score
FROM placed f LEFT JOIN panel p ON p.panel = 'P1' AND split_part(f.feature, '.', 1) = p.base_id WHERE f.rank <= 25""",
)
def top_features_annotated(spark, sf_dir):
    panel = dims.panels(spark, ad.BRAND_PANELS).where(F.col("panel") == "P1")
    top = pn.top_features(_placed(spark, sf_dir), 25)
    out = pn.annotate(top, panel, rna_prefix="Brand")
    return out.withColumn("score", F.round("score", 2))


@query(
    "per_class_top",
    f"""WITH {ad.SQL_VECTOR_CELLS},
s AS (SELECT feature_id AS feature, CAST(label AS VARCHAR) AS class, avg(abs(value)) AS score FROM cells GROUP BY 1, 2)
SELECT class, feature, round(score, 8) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY class ORDER BY score DESC, feature) AS rank FROM s) t WHERE rank <= 8""",
)
def per_class_top(spark, sf_dir):
    scores = (
        ad.vector_cells(spark, sf_dir)
        .groupBy(F.col("feature_id").alias("feature"), F.col("label").cast("string").alias("class"))
        .agg(F.avg(F.abs("value")).alias("score"))
    )
    # the published table has one column per class; back to rows for ranking
    wide = rs.class_columns(scores, [str(c) for c in range(10)], "feature", "class", "score", "mean_abs_")
    top = pn.per_class_top(rs.unpivot_scores(wide, "mean_abs_"), 8)
    return top.select("class", "feature", F.round("score", 8).alias("score"), F.col("rank").cast("long").alias("rank"))


# --- reconciliation and sync -------------------------------------------------------------


@query(
    "manifest_reconcile",
    """WITH w AS (SELECT lang AS cohort, source AS modality, count(DISTINCT doc_id) AS n_expected FROM documents GROUP BY 1, 2),
h AS (SELECT d.lang AS cohort, d.source AS modality, count(DISTINCT d.doc_id) AS n_stored
      FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1, 2)
SELECT coalesce(w.cohort, h.cohort) AS cohort, coalesce(w.modality, h.modality) AS modality,
  coalesce(n_expected, 0) AS n_expected, coalesce(n_stored, 0) AS n_stored,
  coalesce(n_stored, 0) - coalesce(n_expected, 0) AS difference,
  CASE WHEN n_stored IS NULL THEN 'MISSING' WHEN n_stored < n_expected THEN ' gap' WHEN n_stored > n_expected THEN ' +' ELSE '' END AS mark
FROM w FULL JOIN h ON w.cohort = h.cohort AND w.modality = h.modality""",
)
def manifest_reconcile(spark, sf_dir):
    docs = ad.table(spark, sf_dir, "documents").select(
        F.col("lang").alias("cohort"), F.col("source").alias("modality"), F.col("doc_id").alias("patient_id")
    )
    labels = ad.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("patient_id"))
    return ql.reconcile(docs, docs.join(labels, "patient_id", "left_semi"))


def _plan(spark, sf_dir):
    """Documents as files; what has a label is at the destination already."""
    docs = ad.table(spark, sf_dir, "documents").select(
        F.col("lang").alias("project_id"),
        F.col("source").alias("modality"),
        F.col("doc_id").alias("file_id"),
        F.concat("doc_id", F.lit(".txt")).alias("file_name"),
    )
    there = ad.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id"))
    listing = docs.join(there, "file_id").select(
        object_key(F.lit("tcga"), "modality", "file_id", "file_name").alias("key")
    )
    return sync_plan(docs, listing)


SQL_PLAN = """plan AS (SELECT d.lang AS project_id, d.source AS modality, d.doc_id AS file_id, d.doc_id || '.txt' AS file_name,
  'tcga/' || d.source || '/' || d.doc_id || '/' || d.doc_id || '.txt' AS key,
  CASE WHEN l.doc_id IS NULL THEN 'to_copy' ELSE 'skipped' END AS action
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


@query("sync_plan", f"WITH {SQL_PLAN} SELECT * FROM plan")
def sync_plan_rows(spark, sf_dir):
    return _plan(spark, sf_dir)


@query(
    "sync_totals",
    f"""WITH {SQL_PLAN} SELECT CASE WHEN grouping(project_id) = 1 THEN '__all__' ELSE project_id END AS project_id,
  CASE WHEN grouping(modality) = 1 THEN '__all__' ELSE modality END AS modality, count(*) AS n_files,
  count(*) FILTER (WHERE action = 'skipped') AS n_skipped, count(*) FILTER (WHERE action = 'to_copy') AS n_to_copy
FROM plan GROUP BY ROLLUP (project_id, modality)""",
)
def sync_totals_rows(spark, sf_dir):
    return sync_totals(_plan(spark, sf_dir))


@query(
    "pending_files",
    "SELECT doc_id AS file_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def pending_files_rows(spark, sf_dir):
    docs = ad.table(spark, sf_dir, "documents").select(F.col("doc_id").alias("file_id"), "source")
    loaded = ad.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("file_id"))
    return pending_files(docs, loaded)


@query(
    "manifest_selection",
    "SELECT doc_id AS file_id FROM documents WHERE lang = 'en' AND source = 'src3' AND n_chars > 1000",
)
def manifest_selection(spark, sf_dir):
    listing = ad.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("file_id"),
        F.col("lang").alias("project_id"),
        F.col("source").alias("data_category"),
        F.when(F.col("n_chars") > 1000, "long").otherwise("short").alias("data_type"),
        F.lit("open").alias("access"),
    )
    return select_files(listing, "en", "src3", "long").select("file_id")
