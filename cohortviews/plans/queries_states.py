"""Queries on statistics that are kept as mergeable states, and on digests."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews.operators import digests as dg
from cohortviews.operators import merge as mg
from cohortviews.operators import states as st
from cohortviews.plans import adapters as ad
from cohortviews.plans.catalogue import query
from cohortviews.plans.queries_matrix import COVERAGE, SHOWN, SQL_ROSTER, TOP, _shown, brand_ids, roster
from cohortviews.session import stage, staging_path


@query(
    "incremental_selection",
    f"WITH {ad.SQL_EXPRESSION}, {ad.sql_top('expression', TOP, COVERAGE, 'top', ad.BRAND_IDS)} {SHOWN}",
)
def incremental_selection(spark, sf_dir):
    """Selection over all cohorts from the states that each cohort left; the same as over the rows of all."""
    rows, root = stage(ad.expression(spark, sf_dir), "loads", by=["cohort"]), staging_path(spark, "states")  # joined once
    cohorts = [r.cohort for r in rows.select("cohort").distinct().orderBy("cohort").collect()]  # a row for each cohort
    for cohort in cohorts:
        st.add_load(rows.where(F.col("cohort") == cohort), root, cohort)
    return _shown(st.top_variance_of_loads(spark, root, cohorts, TOP, COVERAGE, brand_ids(spark)))


@query(
    "sketched_funnel",
    f"""WITH {SQL_ROSTER}, depth AS (SELECT patient_id, count(*) AS n FROM roster GROUP BY patient_id)
SELECT modality AS step, count(*) AS n_entities, TRUE AS within_error FROM roster GROUP BY modality
UNION ALL SELECT 'in_1_views', count(*), TRUE FROM depth
UNION ALL SELECT 'in_6_views', count(*) FILTER (WHERE n = 6), TRUE FROM depth""",
)
def sketched_funnel(spark, sf_dir):
    """Exact sizes beside the claim that the sketches' sizes lie within their error."""
    pairs = stage(roster(spark, sf_dir))
    exact = mg.coverage_funnel(pairs).withColumnRenamed("n_entities", "exact")
    found = st.sketched_funnel(st.entity_sketches(pairs, ["modality"]))
    return exact.join(found, "step").select(
        "step", F.col("exact").alias("n_entities"), (F.abs(F.col("n_entities") - F.col("exact")) <= F.col("error") + 0.5).alias("within_error"))


SHARES = (0.1, 0.5, 0.9)


@query(
    "sketched_quantiles",
    f"""WITH {ad.SQL_EXPRESSION} SELECT cohort, share, count(value) AS n, TRUE AS within_error
FROM expression, (VALUES {", ".join(f"(CAST({s} AS DOUBLE))" for s in SHARES)}) q(share) GROUP BY 1, 2""",
)
def sketched_quantiles(spark, sf_dir):
    """Quantiles of each cohort, merged from sketches of its features, hold the ranks they are asked for."""
    rows = stage(ad.expression(spark, sf_dir).select("cohort", "feature_id", F.col("value").cast("double").alias("value")))
    parts = st.quantile_sketches(rows, ["cohort", "feature_id"], "value")
    shares = F.array(*[F.lit(s) for s in SHARES])
    asked = st.merged_quantiles(parts, ["cohort"], SHARES).select(
        "cohort", "n", F.explode(F.arrays_zip(shares.alias("share"), F.col("quantiles").alias("q"))).alias("a"))
    asked = F.broadcast(stage(asked.select("cohort", "n", "a.share", "a.q")))  # a row for each cohort and share
    ranks = rows.where(F.col("value").isNotNull()).join(asked, "cohort").groupBy("cohort", "share", "n").agg(
        F.count("*").alias("seen"), F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto"))
    slack = F.col("n") * st.KLL_RANK_ERROR + 1
    at = F.col("share") * F.col("n")
    return ranks.select(
        "cohort", "share", F.col("seen").alias("n"),
        ((F.col("n") == F.col("seen")) & (F.col("below") - slack <= at) & (at <= F.col("upto") + slack)).alias("within_error"))


SQL_CHANGED = f"""{ad.SQL_EXPRESSION},
cells AS (SELECT cohort, patient_id, feature_id, count(value) AS n_values FROM expression GROUP BY 1, 2, 3)"""


@query(
    "digest_differences",
    f"""WITH {SQL_CHANGED}
SELECT cohort, patient_id, feature_id, CASE WHEN patient_id % 97 = 0 THEN 'MISSING' ELSE 'CHANGED' END AS mark,
  CAST(1 AS BIGINT) AS n_expected, CAST(CASE WHEN patient_id % 97 = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_stored
FROM cells WHERE cohort IN ('BUILDING', 'MACHINERY') AND (patient_id % 97 = 0 OR (patient_id % 89 = 0 AND feature_id LIKE '%.1'))
UNION ALL SELECT cohort, patient_id, 'new', 'EXTRA', 0, 1 FROM (SELECT DISTINCT cohort, patient_id FROM cells) c
WHERE cohort IN ('BUILDING', 'MACHINERY') AND patient_id % 83 = 0""",
)
def digest_differences(spark, sf_dir):
    """Rows that a changed copy lacks, has besides, or has otherwise; two of five cohorts were changed."""
    keys, ids, values = ["cohort"], ["patient_id", "feature_id"], ["n_values"]
    whole = stage(ad.expression(spark, sf_dir).groupBy(*keys, *ids).agg(F.count("value").alias("n_values")))
    touched = F.col("cohort").isin("BUILDING", "MACHINERY")
    lost = touched & (F.col("patient_id") % 97 == 0)
    other = touched & (F.col("patient_id") % 89 == 0) & F.col("feature_id").endswith(".1")
    copy = whole.where(~lost).withColumn("n_values", F.when(other, F.col("n_values") + 1).otherwise(F.col("n_values")))
    new = whole.where(touched & (F.col("patient_id") % 83 == 0)).select(*keys, "patient_id").distinct()
    copy = stage(copy.unionByName(new.select(*keys, "patient_id", F.lit("new").alias("feature_id"), F.lit(1).cast("long").alias("n_values"))))
    trees = [stage(dg.digest_tree(t, keys, ids, values)) for t in (whole, copy)]
    return dg.differences(whole, copy, *trees, keys, ids, values)
