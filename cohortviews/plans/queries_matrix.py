"""Queries on selection, reshaping, merging and missingness."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews import dims
from cohortviews.functions.genome import feature_family
from cohortviews.operators import labels as lb
from cohortviews.operators import merge as mg
from cohortviews.operators import quality as ql
from cohortviews.operators import reshape as rs
from cohortviews.operators import select as sel
from cohortviews.operators.factors import gated_views
from cohortviews.plans import adapters as ad
from cohortviews.plans import cohort as co
from cohortviews.plans.catalogue import query
from cohortviews.session import stage
from cohortviews.sources.files import altering

COVERAGE = 0.30
TOP = 20
PANEL_FEATURES = [f"{b}.{s}" for b in ad.BRAND_IDS if b != "Brand#99" for s in range(4)]


def quoted_sql(name: str) -> str:
    return '"' + name + '"'


def wide_sql(names, source: str, keys: str, value: str = "value", digits: int = 4, fill: str | None = None) -> str:
    cells = []
    for n in names:
        cell = f"avg(CASE WHEN feature_id = '{n}' THEN {value} END)"
        if fill is not None:
            cell = f"coalesce({cell}, {fill})"
        cells.append(f"round({cell} + 0.0, {digits}) AS {quoted_sql(n)}")
    return f"SELECT {keys}, {', '.join(cells)} FROM {source} GROUP BY {keys}"


def rounded(df, names, keep, digits: int = 4):
    return df.selectExpr(
        *keep, *[f"round({rs.quoted(n)} + 0.0D, {digits}) AS {rs.quoted(n)}" for n in names]
    )


def units(value):
    """Ten-thousandths as whole numbers, so that sums compare exactly."""
    return F.round(value * 10000).cast("long")


def brand_ids(spark):
    return dims.panel_ids(dims.panels(spark, ad.BRAND_PANELS))


def mutations(spark, sf_dir, facts=None):
    calls = altering(ad.variants(spark, sf_dir, facts), "hugo_symbol", "variant_class", ("A", "R"))
    return rs.distinct_indicators(calls)


# --- selection -------------------------------------------------------------------


def _shown(df):
    return df.select("feature_id", "n_obs", F.round("variance", 2).alias("variance"), "forced")


SHOWN = "SELECT feature_id, CAST(n_obs AS BIGINT) AS n_obs, round(variance, 2) AS variance, forced FROM top"


@query(
    "top_variance_features",
    f"WITH {ad.SQL_EXPRESSION}, {ad.sql_top('expression', TOP, COVERAGE, 'top')} {SHOWN}",
)
def top_variance_features(spark, sf_dir):
    return _shown(sel.top_variance_features(ad.expression(spark, sf_dir), TOP, COVERAGE))


@query(
    "top_variance_forced_panel",
    f"WITH {ad.SQL_EXPRESSION}, {ad.sql_top('expression', TOP, COVERAGE, 'top', ad.BRAND_IDS)} {SHOWN}",
)
def top_variance_forced_panel(spark, sf_dir):
    return _shown(sel.top_variance_features(ad.expression(spark, sf_dir), TOP, COVERAGE, brand_ids(spark)))


@query(
    "top_sample_variance_ungated",
    f"WITH {ad.SQL_EXPRESSION}, {ad.sql_top('expression', 30, 0.0, 'top', var='var_samp')} {SHOWN}",
)
def top_sample_variance_ungated(spark, sf_dir):
    return _shown(sel.top_variance_features(ad.expression(spark, sf_dir), 30, 0.0, ddof=1))


@query(
    "top_variance_distinct_entities",
    f"""WITH {ad.SQL_METHYLATION},
stats AS (SELECT feature_id, count(DISTINCT patient_id) AS n_obs, var_pop(value) AS v
          FROM methylation GROUP BY feature_id),
floor_ AS (SELECT greatest(1, round_even(count(DISTINCT patient_id) * CAST(0.7 AS DOUBLE), 0)) AS f FROM methylation)
SELECT feature_id, n_obs, round(v, 8) AS variance FROM stats
WHERE n_obs >= (SELECT f FROM floor_) ORDER BY v DESC, feature_id LIMIT {TOP}""",
)
def top_variance_distinct_entities(spark, sf_dir):
    top = sel.top_variance_features(
        ad.methylation(spark, sf_dir), TOP, 0.7, distinct_entities=True
    )
    return top.select("feature_id", "n_obs", F.round("variance", 8).alias("variance"))


@query(
    "recurrent_features",
    f"""WITH {ad.SQL_MUTATION}
SELECT hugo_symbol, count(*) AS n_entities FROM mutation GROUP BY hugo_symbol
HAVING count(*) >= (SELECT greatest(1, round_even(count(DISTINCT patient_id) * CAST(0.2 AS DOUBLE), 0)) FROM mutation)""",
)
def recurrent_features(spark, sf_dir):
    return sel.recurrent_features(mutations(spark, sf_dir), 0.2, "hugo_symbol")


@query(
    "most_recurrent_features",
    f"""WITH {ad.SQL_MUTATION}
SELECT hugo_symbol, count(*) AS n_entities FROM mutation GROUP BY hugo_symbol
HAVING count(*) >= (SELECT greatest(1, round_even(count(DISTINCT patient_id) * CAST(0.02 AS DOUBLE), 0)) FROM mutation)
ORDER BY n_entities DESC, hugo_symbol LIMIT 10""",
)
def most_recurrent_features(spark, sf_dir):
    found = sel.recurrent_features(mutations(spark, sf_dir), dims.MIN_RECURRENCE, "hugo_symbol")
    return found.orderBy(F.desc("n_entities"), "hugo_symbol").limit(10)


# --- reshaping ---------------------------------------------------------------------


@query(
    "pivot_mean_wide",
    f"WITH {ad.SQL_EXPRESSION} "
    + wide_sql(PANEL_FEATURES, "(SELECT * FROM expression WHERE feature_id IN ("
               + ", ".join(f"'{f}'" for f in PANEL_FEATURES) + ")) e", "patient_id"),
)
def pivot_mean_wide(spark, sf_dir):
    wide = rs.pivot_mean(ad.expression(spark, sf_dir), PANEL_FEATURES)
    return rounded(wide, PANEL_FEATURES, ["patient_id"])


@query(
    "selected_cells",
    f"""WITH {ad.SQL_EXPRESSION}, {ad.sql_top('expression', TOP, COVERAGE, 'top', ad.BRAND_IDS)}
SELECT patient_id, feature_id, round(avg(value), 4) AS value FROM expression
WHERE feature_id IN (SELECT feature_id FROM top) GROUP BY patient_id, feature_id""",
)
def selected_cells(spark, sf_dir):
    rows = ad.expression(spark, sf_dir)
    chosen = sel.top_variance_features(rows, TOP, COVERAGE, brand_ids(spark))
    return co.selected_cells(rows, chosen).select("patient_id", "feature_id", F.round("value", 4).alias("value"))


@query(
    "feature_arrays",
    f"""WITH {ad.SQL_EXPRESSION}, {ad.sql_top('expression', TOP, COVERAGE, 'top', ad.BRAND_IDS)},
dict AS (SELECT feature_id, row_number() OVER (ORDER BY feature_id) - 1 AS ordinal FROM top),
c AS (SELECT e.patient_id, d.ordinal, avg(e.value) AS x FROM expression e JOIN dict d ON e.feature_id = d.feature_id
      GROUP BY 1, 2)
SELECT patient_id, (SELECT count(*) FROM dict) AS n_slots, count(x) AS n_values,
       CAST(coalesce(sum(CAST(round(x * 10000) AS BIGINT)), 0) AS BIGINT) AS value_units,
       CAST(coalesce(sum(CAST(round(x * 10000) AS BIGINT) * ordinal), 0) AS BIGINT) AS position_units
FROM c GROUP BY patient_id""",
)
def feature_arrays(spark, sf_dir):
    rows = ad.expression(spark, sf_dir)
    view = co.ranked_view("RNA", rows, TOP, COVERAGE, brand_ids(spark))
    cells = rs.array_rows(view.arrays, "values", ["patient_id"])
    return cells.groupBy("patient_id").agg(
        F.count("*").alias("n_slots"),
        F.count("value").alias("n_values"),
        F.coalesce(F.sum(units(F.col("value"))), F.lit(0)).alias("value_units"),
        F.coalesce(F.sum(units(F.col("value")) * F.col("position")), F.lit(0)).alias("position_units"),
    )


@query(
    "segment_arm_means",
    f"WITH {ad.SQL_ARMS} SELECT patient_id, arm, round(avg(copy_number), 6) AS copy_number FROM arms GROUP BY patient_id, arm",
)
def segment_arm_means(spark, sf_dir):
    means = rs.arm_means(ad.segments(spark, sf_dir))
    return means.select("patient_id", F.col("feature_id").alias("arm"), F.round("value", 6).alias("copy_number"))


@query(
    "segment_arm_wide",
    f"WITH {ad.SQL_ARMS} "
    + wide_sql(dims.ARM_COLUMNS, "(SELECT patient_id, arm AS feature_id, copy_number AS value FROM arms) a", "patient_id", digits=6),
)
def segment_arm_wide(spark, sf_dir):
    view = co.arm_view(ad.segments(spark, sf_dir))
    wide = co.wide_table(
        view.arrays.withColumnRenamed("values", "CNV"), [view], declared={"CNV": dims.ARM_COLUMNS}
    )
    return rounded(wide, dims.ARM_COLUMNS, ["patient_id"], 6)


MUT_COLUMNS = [f"MUT_{f}" for f in ad.BRAND_FEATURES]
SQL_RECURRENT = """rec AS (SELECT hugo_symbol FROM mutation GROUP BY hugo_symbol
  HAVING count(*) >= (SELECT greatest(1, round_even(count(DISTINCT patient_id) * CAST(0.2 AS DOUBLE), 0)) FROM mutation)),
kept AS (SELECT patient_id, 'MUT_' || hugo_symbol AS feature_id FROM mutation
         WHERE hugo_symbol IN (SELECT hugo_symbol FROM rec))"""


def indicator_sql() -> str:
    cells = ", ".join(
        f"CASE WHEN '{n[4:]}' IN (SELECT hugo_symbol FROM rec) "
        f"THEN CAST(max(CASE WHEN feature_id = '{n}' THEN 1 ELSE 0 END) AS DOUBLE) END AS {quoted_sql(n)}"
        for n in MUT_COLUMNS
    )
    return f"SELECT patient_id, {cells} FROM kept GROUP BY patient_id"


@query("indicator_wide", f"WITH {ad.SQL_MUTATION}, {SQL_RECURRENT} {indicator_sql()}")
def indicator_wide(spark, sf_dir):
    view = co.indicator_view(mutations(spark, sf_dir), 0.2)
    return co.wide_table(
        view.arrays.withColumnRenamed("values", "mutations"), [view], declared={"mutations": MUT_COLUMNS}
    )


RPPA_COLUMNS = [f"RPPA_{t}" for t in ad.PART_TYPES]
MIR_COLUMNS = [f"MIR_{t}" for t in ad.EVENT_TYPES]


@query(
    "prefixed_views_wide",
    f"""WITH {ad.SQL_PROTEIN}, {ad.SQL_MIRNA},
a AS ({wide_sql(RPPA_COLUMNS, "(SELECT patient_id, 'RPPA_' || feature_id AS feature_id, value FROM protein) p", "patient_id")}),
b AS ({wide_sql(MIR_COLUMNS, "(SELECT patient_id, 'MIR_' || feature_id AS feature_id, value FROM mirna) m", "patient_id", digits=6)})
SELECT a.*, b.* EXCLUDE (patient_id) FROM a JOIN b ON a.patient_id = b.patient_id""",
)
def prefixed_views_wide(spark, sf_dir):
    a = rs.pivot_mean(rs.prefixed(ad.protein(spark, sf_dir), "RPPA_"), RPPA_COLUMNS)
    b = rs.pivot_mean(rs.prefixed(ad.mirna(spark, sf_dir), "MIR_"), MIR_COLUMNS)
    return _rounded_views(mg.inner_merge_wide([a, b]), ("patient_id",))


# --- merging -------------------------------------------------------------------------


def three(spark, sf_dir):
    return co.three_views(
        ad.expression(spark, sf_dir),
        ad.segments(spark, sf_dir),
        ad.methylation(spark, sf_dir),
        n_rna=TOP,
        n_methylation=TOP,
        min_coverage=COVERAGE,
        must_keep=brand_ids(spark),
    )


def six(spark, sf_dir):
    facts = ad.line_facts(spark, sf_dir)  # four of the six read the line items
    return co.six_views(
        ad.expression(spark, sf_dir, facts).drop("cohort"),
        ad.segments(spark, sf_dir, facts).drop("cohort"),
        ad.methylation(spark, sf_dir).drop("cohort"),
        ad.protein(spark, sf_dir, facts),
        ad.mirna(spark, sf_dir),
        mutations(spark, sf_dir, facts),
        n_rna=TOP,
        n_methylation=TOP,
        min_coverage=COVERAGE,
        min_recurrence=0.2,
        must_keep=brand_ids(spark),
    )


DECLARED = {
    "RNA": ad.BRAND_FEATURES,
    "CNV": dims.ARM_COLUMNS,
    "methylation": ad.PROBES,
    "RPPA": RPPA_COLUMNS,
    "miRNA": MIR_COLUMNS,
    "mutations": MUT_COLUMNS,
}


def _sql_selected_views(keys: str) -> str:
    return f"""{ad.SQL_EXPRESSION}, {ad.SQL_ARMS}, {ad.SQL_METHYLATION},
{ad.sql_top('expression', TOP, COVERAGE, 'toprna', ad.BRAND_IDS)},
{ad.sql_top('methylation', TOP, COVERAGE, 'topmeth')},
w_rna AS ({wide_sql(ad.BRAND_FEATURES, "(SELECT * FROM expression WHERE feature_id IN (SELECT feature_id FROM toprna)) x", keys)}),
w_cnv AS ({wide_sql(dims.ARM_COLUMNS, f"(SELECT {keys}, arm AS feature_id, copy_number AS value FROM arms) x", keys, digits=6)}),
w_meth AS ({wide_sql(ad.PROBES, "(SELECT * FROM methylation WHERE feature_id IN (SELECT feature_id FROM topmeth)) x", keys, digits=8)})"""


@query(
    "merge_three_views",
    f"""WITH {_sql_selected_views("cohort, patient_id")}
SELECT a.*, b.* EXCLUDE (cohort, patient_id), c.* EXCLUDE (cohort, patient_id)
FROM w_rna a JOIN w_cnv b ON a.cohort = b.cohort AND a.patient_id = b.patient_id
JOIN w_meth c ON a.cohort = c.cohort AND a.patient_id = c.patient_id""",
)
def merge_three_views(spark, sf_dir):
    keys = ("cohort", "patient_id")
    merged, views = three(spark, sf_dir)
    return _rounded_views(co.wide_table(merged, views, keys, DECLARED), keys)


@query(
    "merge_older",
    f"""WITH {ad.SQL_EXPRESSION}, {ad.SQL_ARMS}, {ad.SQL_METHYLATION},
{ad.sql_top('expression', 500, 0.0, 'toprna', var='var_samp')}, {ad.sql_top('methylation', 500, 0.0, 'topmeth', var='var_samp')},
names AS (SELECT 'RNA' AS view, feature_id FROM toprna UNION ALL SELECT 'methylation', feature_id FROM topmeth
  UNION ALL SELECT DISTINCT 'CNV', arm FROM arms),
people AS (SELECT count(*) AS n FROM (SELECT DISTINCT patient_id FROM expression INTERSECT SELECT DISTINCT patient_id FROM arms
  INTERSECT SELECT DISTINCT patient_id FROM methylation) t)
SELECT view, feature_id, CAST(row_number() OVER (PARTITION BY view ORDER BY feature_id) - 1 AS INTEGER) AS ordinal,
  (SELECT n FROM people) AS n_rows FROM names""",
)
def merge_older(spark, sf_dir):
    """The first form of the merge: its features in order, and its rows."""
    merged, views = co.three_views(
        ad.expression(spark, sf_dir), ad.segments(spark, sf_dir), ad.methylation(spark, sf_dir), **co.OLDER
    )
    return co.merged_dictionary(views).withColumn("n_rows", merged.agg(F.count("*").alias("n")).scalar())


@query(
    "stack_cohorts_uneven",
    """SELECT c_custkey AS id, CAST(c_nationkey AS DOUBLE) AS amount, c_mktsegment AS segment, NULL AS phone FROM customer
UNION ALL SELECT s_suppkey, CAST(s_acctbal AS DOUBLE), NULL, s_name FROM supplier""",
)
def stack_cohorts_uneven(spark, sf_dir):
    """Two tables with a column each that the other lacks, and one column of two number types."""
    a = ad.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("int").alias("amount"), F.col("c_mktsegment").alias("segment")
    )
    b = ad.table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_acctbal").cast("double").alias("amount"), F.col("s_name").alias("phone")
    )
    return mg.stack_cohorts([a, b])


@query(
    "cohort_filter_optional",
    f"""WITH {ad.SQL_EXPRESSION} SELECT 'cohort column' AS input, count(*) AS n FROM expression WHERE cohort = 'BUILDING'
UNION ALL SELECT 'no cohort column', count(*) FROM expression""",
)
def cohort_filter_optional(spark, sf_dir):
    """One cohort where rows have one, all rows where they have none."""
    rows = ad.expression(spark, sf_dir)
    parts = [("cohort column", rows), ("no cohort column", rows.drop("cohort"))]
    counted = [
        lb.only_cohort(df, "BUILDING").agg(F.lit(name).alias("input"), F.count("*").alias("n")) for name, df in parts
    ]
    return counted[0].unionByName(counted[1])


def _rounded_views(wide, keys):
    digits = {n: 6 for n in dims.ARM_COLUMNS + MIR_COLUMNS} | {n: 8 for n in ad.PROBES}
    return wide.selectExpr(
        *keys,
        *[
            f"round({rs.quoted(c)} + 0.0D, {digits.get(c, 4)}) AS {rs.quoted(c)}"
            for c in wide.columns
            if c not in keys
        ],
    )


@query(
    "merge_six_views",
    f"""WITH {_sql_selected_views("patient_id")}, {ad.SQL_PROTEIN}, {ad.SQL_MIRNA}, {ad.SQL_MUTATION}, {SQL_RECURRENT},
w_rppa AS ({wide_sql(RPPA_COLUMNS, "(SELECT patient_id, 'RPPA_' || feature_id AS feature_id, value FROM protein) p", "patient_id")}),
w_mir AS ({wide_sql(MIR_COLUMNS, "(SELECT patient_id, 'MIR_' || feature_id AS feature_id, value FROM mirna) m", "patient_id", digits=6)}),
w_mut AS ({indicator_sql()})
SELECT a.*, b.* EXCLUDE (patient_id), c.* EXCLUDE (patient_id), d.* EXCLUDE (patient_id),
       e.* EXCLUDE (patient_id), f.* EXCLUDE (patient_id)
FROM w_rna a JOIN w_cnv b ON a.patient_id = b.patient_id JOIN w_meth c ON a.patient_id = c.patient_id
JOIN w_rppa d ON a.patient_id = d.patient_id JOIN w_mir e ON a.patient_id = e.patient_id
JOIN w_mut f ON a.patient_id = f.patient_id""",
)
def merge_six_views(spark, sf_dir):
    merged, views = six(spark, sf_dir)
    return _rounded_views(co.wide_table(merged, views, declared=DECLARED), ("patient_id",))


def roster(spark, sf_dir):
    """Distinct ``(modality, patient_id)`` over the six adapters."""
    views = {
        "rna_seq": ad.expression(spark, sf_dir),
        "cnv": ad.segments(spark, sf_dir),
        "methylation": ad.methylation(spark, sf_dir),
        "rppa": ad.protein(spark, sf_dir),
        "mirna": ad.mirna(spark, sf_dir),
        "mutations": mutations(spark, sf_dir),
    }
    parts = [
        df.select(F.lit(name).alias("modality"), "patient_id").distinct() for name, df in views.items()
    ]
    return mg.stack_cohorts(parts)


SQL_ROSTER = f"""{ad.SQL_EXPRESSION}, {ad.SQL_ARMS}, {ad.SQL_METHYLATION}, {ad.SQL_PROTEIN}, {ad.SQL_MIRNA}, {ad.SQL_MUTATION},
roster AS (SELECT DISTINCT 'rna_seq' AS modality, patient_id FROM expression
  UNION SELECT 'cnv', patient_id FROM segments UNION SELECT 'methylation', patient_id FROM methylation
  UNION SELECT 'rppa', patient_id FROM protein UNION SELECT 'mirna', patient_id FROM mirna
  UNION SELECT 'mutations', patient_id FROM mutation)"""


@query(
    "coverage_funnel",
    f"""WITH {SQL_ROSTER}, depth AS (SELECT patient_id, count(*) AS n FROM roster GROUP BY patient_id)
SELECT modality AS step, count(*) AS n_entities FROM roster GROUP BY modality
UNION ALL SELECT 'in_' || CAST(k AS VARCHAR) || '_views', count(*) FROM depth, range(1, 7) t(k) WHERE n >= k GROUP BY k""",
)
def coverage_funnel(spark, sf_dir):
    return mg.coverage_funnel(roster(spark, sf_dir))


@query(
    "entities_in_every_view",
    f"WITH {SQL_ROSTER} SELECT patient_id FROM roster GROUP BY patient_id HAVING count(*) = 6",
)
def entities_in_every_view(spark, sf_dir):
    return mg.in_every_view(roster(spark, sf_dir), 6)


@query(
    "modality_volume",
    f"""WITH {ad.SQL_PROTEIN}, {ad.SQL_MIRNA}, both_ AS (
  SELECT 'rppa' AS modality, patient_id, feature_id FROM protein UNION ALL SELECT 'mirna', patient_id, feature_id FROM mirna)
SELECT modality, count(*) AS n_rows, count(DISTINCT patient_id) AS n_entities, count(DISTINCT feature_id) AS n_files
FROM both_ GROUP BY modality""",
)
def modality_volume(spark, sf_dir):
    rows = mg.stack_cohorts(
        [
            ad.protein(spark, sf_dir).withColumn("modality", F.lit("rppa")),
            ad.mirna(spark, sf_dir).withColumn("modality", F.lit("mirna")),
        ]
    )
    return mg.modality_volume(rows, file="feature_id")


# --- missingness ---------------------------------------------------------------------

SQL_RATES = f"""{ad.SQL_EXPRESSION},
cells AS (SELECT patient_id, feature_id, avg(value) AS value FROM expression GROUP BY 1, 2),
rates AS (SELECT feature_id, count(value) AS n_observed,
  1 - count(value) / CAST((SELECT count(DISTINCT patient_id) FROM expression) AS DOUBLE) AS missing_rate
  FROM cells GROUP BY feature_id)"""


def _rates(spark, sf_dir):
    rows = ad.expression(spark, sf_dir)
    return ql.missing_rates(rs.mean_cells(rows), rows.select("patient_id").distinct())


@query(
    "missing_rate_by_feature",
    f"WITH {SQL_RATES} SELECT feature_id, n_observed, round(missing_rate, 8) AS missing_rate FROM rates",
)
def missing_rate_by_feature(spark, sf_dir):
    return _rates(spark, sf_dir).select("feature_id", "n_observed", F.round("missing_rate", 8).alias("missing_rate"))


@query(
    "missing_distribution",
    f"""WITH {SQL_RATES} SELECT count(*) AS n_features, round(avg(missing_rate), 8) AS mean_rate,
round(quantile_cont(missing_rate, 0.9), 8) AS p90_rate,
avg(CASE WHEN n_observed = 0 THEN 1.0 ELSE 0.0 END) AS share_all_missing FROM rates""",
)
def missing_distribution(spark, sf_dir):
    return ql.missing_summary(_rates(spark, sf_dir)).select(
        "n_features",
        F.round("mean_rate", 8).alias("mean_rate"),
        F.round("p90_rate", 8).alias("p90_rate"),
        "share_all_missing",
    )


MAX_MISSING = 0.7
SQL_GATE = f"""{ad.SQL_PART_EXPRESSION},
cells AS (SELECT cohort, patient_id, feature_id, avg(value) AS value FROM part_expression GROUP BY 1, 2, 3),
roster AS (SELECT DISTINCT patient_id, cohort FROM part_expression),
feat AS (SELECT feature_id, count(DISTINCT CASE WHEN value IS NOT NULL THEN cohort END) AS n_cohorts,
                count(value) AS n_observed FROM cells GROUP BY feature_id),
status AS (SELECT feature_id, CASE
    WHEN n_cohorts < (SELECT count(DISTINCT cohort) FROM roster) THEN 'structural'
    WHEN 1 - n_observed / CAST((SELECT count(*) FROM roster) AS DOUBLE) > {MAX_MISSING} THEN 'sparse'
    ELSE 'kept' END AS status FROM feat)"""


def _part_model(spark, sf_dir):
    rows = ad.part_expression(spark, sf_dir)
    cells = stage(rs.mean_cells(rows, ("cohort", "patient_id")))
    roster_ = cells.select("patient_id", "cohort").distinct()
    return co.cohort_model(cells, roster_, MAX_MISSING)


@query("structural_missing_features", f"WITH {SQL_GATE} SELECT feature_id FROM status WHERE status = 'structural'")
def structural_missing_features(spark, sf_dir):
    rows = ad.part_expression(spark, sf_dir)
    return ql.structurally_missing(rows, rows.select("cohort").distinct())


@query("gated_feature_status", f"WITH {SQL_GATE} SELECT feature_id, status FROM status")
def gated_feature_status(spark, sf_dir):
    return _part_model(spark, sf_dir).status


@query(
    "model_ready_cohort",
    f"""WITH {SQL_GATE},
kept AS (SELECT feature_id, row_number() OVER (ORDER BY feature_id) - 1 AS ordinal FROM status WHERE status = 'kept'),
codes AS (SELECT cohort, row_number() OVER (ORDER BY cohort) - 1 AS cohort_code FROM (SELECT DISTINCT cohort FROM roster) d)
SELECT r.patient_id, r.cohort, any_value(k.cohort_code) AS cohort_code, (SELECT count(*) FROM kept) AS n_features,
  count(CASE WHEN d.ordinal IS NOT NULL THEN c.value END) AS n_observed,
  CAST(coalesce(sum(CASE WHEN d.ordinal IS NOT NULL THEN CAST(round(c.value * 10000) AS BIGINT) END), 0) AS BIGINT) AS value_units
FROM roster r JOIN codes k ON r.cohort = k.cohort LEFT JOIN cells c ON r.patient_id = c.patient_id
LEFT JOIN kept d ON c.feature_id = d.feature_id GROUP BY r.patient_id, r.cohort""",
)
def model_ready_cohort(spark, sf_dir):
    return _digest(_part_model(spark, sf_dir).rows, ["patient_id", "cohort", "cohort_code"])


def _digest(rows, keep):
    zero = F.lit(0).cast("long")
    return rows.select(
        *keep,
        F.size("values").cast("long").alias("n_features"),
        F.size(F.filter("values", lambda x: x.isNotNull())).cast("long").alias("n_observed"),
        F.aggregate("values", zero, lambda a, x: a + F.coalesce(units(x), zero)).alias("value_units"),
    )


@query(
    "model_manifest",
    f"""WITH {SQL_GATE}
SELECT 'label_map' AS section, cohort AS name, row_number() OVER (ORDER BY cohort) - 1 AS n
FROM (SELECT DISTINCT cohort FROM roster) d
UNION ALL SELECT 'kept', 'other', count(*) FROM status WHERE status = 'kept'
UNION ALL SELECT 'dropped', 'structural', count(*) FROM status WHERE status = 'structural'
UNION ALL SELECT 'dropped', 'sparse', count(*) FROM status WHERE status = 'sparse'
UNION ALL SELECT 'rows', 'all', count(*) FROM roster""",
)
def model_manifest(spark, sf_dir):
    m = _part_model(spark, sf_dir).manifest(MAX_MISSING)
    long = F.lit(0).cast("long")
    pairs = F.concat(
        F.transform(
            F.map_entries("label_map"),
            lambda e: F.struct(F.lit("label_map").alias("section"), e["key"].alias("name"), e["value"].alias("n")),
        ),
        F.transform(
            F.map_entries("feature_family_counts"),
            lambda e: F.struct(F.lit("kept").alias("section"), e["key"].alias("name"), e["value"].alias("n")),
        ),
        F.array(
            F.struct(F.lit("dropped").alias("section"), F.lit("structural").alias("name"),
                     (F.size("dropped.structural_missing_in_any_cohort") + long).alias("n")),
            F.struct(F.lit("dropped").alias("section"), F.lit("sparse").alias("name"),
                     (F.size("dropped.over_missingness_threshold") + long).alias("n")),
            F.struct(F.lit("rows").alias("section"), F.lit("all").alias("name"), F.col("rows").alias("n")),
        ),
    )
    return m.select(F.inline(pairs))


# --- views -------------------------------------------------------------------------------


SQL_SIX_CELLS = f"""{ad.SQL_EXPRESSION}, {ad.SQL_ARMS}, {ad.SQL_METHYLATION}, {ad.SQL_PROTEIN}, {ad.SQL_MIRNA}, {ad.SQL_MUTATION}, {SQL_RECURRENT},
{ad.sql_top('expression', TOP, COVERAGE, 'toprna', ad.BRAND_IDS)},
{ad.sql_top('methylation', TOP, COVERAGE, 'topmeth')},
found AS (
  SELECT 'RNA' AS view, patient_id, feature_id, avg(value) AS value FROM expression
   WHERE feature_id IN (SELECT feature_id FROM toprna) GROUP BY 2, 3
  UNION ALL SELECT 'CNV', patient_id, arm, avg(copy_number) FROM arms GROUP BY 2, 3
  UNION ALL SELECT 'methylation', patient_id, feature_id, avg(value) FROM methylation
   WHERE feature_id IN (SELECT feature_id FROM topmeth) GROUP BY 2, 3
  UNION ALL SELECT 'RPPA', patient_id, 'RPPA_' || feature_id, avg(value) FROM protein GROUP BY 2, 3
  UNION ALL SELECT 'miRNA', patient_id, 'MIR_' || feature_id, avg(value) FROM mirna GROUP BY 2, 3
  UNION ALL SELECT 'mutations', patient_id, feature_id, 1.0 FROM kept),
people AS (SELECT patient_id FROM (SELECT DISTINCT patient_id, view FROM found) d GROUP BY patient_id HAVING count(*) = 6),
feats AS (SELECT DISTINCT view, feature_id FROM found),
cells AS (SELECT f.view, p.patient_id, f.feature_id,
    CASE WHEN f.view = 'mutations' THEN coalesce(x.value, 0.0) ELSE x.value END AS value
  FROM people p CROSS JOIN feats f
  LEFT JOIN found x ON x.view = f.view AND x.patient_id = p.patient_id AND x.feature_id = f.feature_id),
config(view, max_missing, likelihood) AS (VALUES
  {", ".join(f"('{v}', CAST({r} AS DOUBLE), '{k}')" for v, (r, k) in dims.VIEW_CONFIG.items())}),
rates AS (SELECT view, feature_id, count(value) AS n_observed,
  1 - count(value) / CAST((SELECT count(*) FROM people) AS DOUBLE) AS missing_rate FROM cells GROUP BY 1, 2)"""


@query(
    "view_gate_counts",
    f"""WITH {SQL_SIX_CELLS}
SELECT r.view, c.likelihood, c.max_missing, count(*) AS n_in,
  count(*) FILTER (WHERE r.missing_rate <= c.max_missing) AS n_kept,
  count(*) FILTER (WHERE r.missing_rate > c.max_missing) AS n_dropped
FROM rates r JOIN config c ON r.view = c.view GROUP BY 1, 2, 3""",
)
def view_gate_counts(spark, sf_dir):
    cells, people = _six_cells(spark, sf_dir)
    rates = cells.groupBy("view", "feature_id").agg(F.count("value").alias("n_observed")).withColumn(
        "missing_rate", 1 - F.col("n_observed") / people.agg(F.count("*").alias("n")).scalar()
    )
    return ql.view_gate_counts(ql.view_gate(rates, dims.view_config(spark)))


def _six_cells(spark, sf_dir):
    merged, views = six(spark, sf_dir)
    merged = stage(merged)
    return co.merged_cells(merged, views), merged.select("patient_id")


@query(
    "view_transforms",
    f"""WITH {SQL_SIX_CELLS},
gated AS (SELECT r.view, r.feature_id FROM rates r JOIN config c ON r.view = c.view WHERE r.missing_rate <= c.max_missing),
t AS (SELECT x.view, x.feature_id, CASE
    WHEN x.view IN ('RNA', 'miRNA') THEN log2(x.value + 1)
    WHEN x.view = 'methylation' THEN log2(least(greatest(x.value, 1e-6), 1 - 1e-6) / (1 - least(greatest(x.value, 1e-6), 1 - 1e-6)))
    ELSE x.value END AS value
  FROM cells x JOIN gated g ON x.view = g.view AND x.feature_id = g.feature_id WHERE x.value IS NOT NULL)
SELECT view, feature_id, count(value) AS n, round(avg(value) + 0.0, 6) AS mean, round(var_pop(value) + 0.0, 6) AS variance
FROM t GROUP BY view, feature_id""",
)
def view_transforms(spark, sf_dir):
    cells, people = _six_cells(spark, sf_dir)
    out = gated_views(cells, people, dims.view_config(spark))
    return out.groupBy("view", "feature_id").agg(
        F.count("value").alias("n"),
        F.round(F.avg("value") + 0.0, 6).alias("mean"),
        F.round(F.var_pop("value") + 0.0, 6).alias("variance"),
    )


@query(
    "unpivot_views",
    f"""WITH {ad.SQL_PROTEIN}, {ad.SQL_MIRNA},
a AS (SELECT patient_id, 'RPPA_' || feature_id AS feature_id, avg(value) AS value FROM protein GROUP BY 1, 2),
b AS (SELECT patient_id, 'MIR_' || feature_id AS feature_id, avg(value) AS value FROM mirna GROUP BY 1, 2),
p AS (SELECT patient_id FROM a INTERSECT SELECT patient_id FROM b),
f AS (SELECT DISTINCT feature_id FROM a UNION SELECT DISTINCT feature_id FROM b)
SELECT p.patient_id, CASE WHEN f.feature_id LIKE 'RPPA%' THEN 'RPPA' ELSE 'miRNA' END AS view, f.feature_id,
       round(coalesce(a.value, b.value), 6) AS value
FROM p CROSS JOIN f LEFT JOIN a ON a.patient_id = p.patient_id AND a.feature_id = f.feature_id
LEFT JOIN b ON b.patient_id = p.patient_id AND b.feature_id = f.feature_id""",
)
def unpivot_views(spark, sf_dir):
    a = rs.pivot_mean(rs.prefixed(ad.protein(spark, sf_dir), "RPPA_"), RPPA_COLUMNS)
    b = rs.pivot_mean(rs.prefixed(ad.mirna(spark, sf_dir), "MIR_"), MIR_COLUMNS)
    long = rs.unpivot_features(mg.inner_merge_wide([a, b]))
    return long.withColumn("value", F.round("value", 6))


@query(
    "feature_family_counts",
    f"""WITH {SQL_SIX_CELLS}
SELECT CASE WHEN feature_id LIKE 'Brand%' THEN 'rna' WHEN feature_id LIKE 'cg%' THEN 'methylation'
  WHEN regexp_matches(feature_id, '^([0-9]+|X)[pq]$') THEN 'cnv' ELSE 'other' END AS family, count(*) AS n
FROM feats GROUP BY 1""",
)
def feature_family_counts(spark, sf_dir):
    _, views = six(spark, sf_dir)
    names = mg.stack_cohorts([v.dictionary.select("feature_id") for v in views])
    return names.groupBy(feature_family(F.col("feature_id"), "Brand").alias("family")).agg(F.count("*").alias("n"))
