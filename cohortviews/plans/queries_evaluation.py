"""Queries on folds, predictions, clusterings, factors and attributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews.dims import inline_table
from cohortviews.functions.values import argmax_code
from cohortviews.operators import evaluate as ev
from cohortviews.operators import factors as fa
from cohortviews.operators import select as sel
from cohortviews.operators import silhouettes as si
from cohortviews.operators.model import stratified_folds
from cohortviews.plans import adapters as ad
from cohortviews.plans.catalogue import query

CLASSES = list(range(10))


def _round(df, digits: int, *columns: str):
    return df.withColumns({c: F.round(F.col(c) + 0.0, digits) for c in columns})


# --- folds ---------------------------------------------------------------------------


@query(
    "stratified_folds",
    """SELECT label, CAST((r - 1) % 5 AS INTEGER) AS fold, count(*) AS n FROM (
  SELECT label, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS r FROM embeddings) t GROUP BY 1, 2""",
)
def stratified_folds_sizes(spark, sf_dir):
    placed = stratified_folds(ad.table(spark, sf_dir, "embeddings"), "label", "vec_id")
    return placed.groupBy("label", "fold").agg(F.count("*").alias("n"))


FOLD_TOP = 10


@query(
    "fold_feature_selection",
    f"""WITH {ad.SQL_VECTOR_CELLS}, f(fold) AS (SELECT CAST(range AS INTEGER) FROM range(5)),
v AS (SELECT f.fold, c.feature_id, var_samp(c.value) AS variance FROM cells c JOIN f ON c.fold <> f.fold GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY fold ORDER BY variance DESC NULLS LAST, feature_id) AS k FROM v)
SELECT fold, feature_id, round(variance, 8) AS variance FROM r
WHERE k <= {FOLD_TOP} OR feature_id IN ('dim_00', 'dim_63')""",
)
def fold_feature_selection(spark, sf_dir):
    panel = inline_table(spark, [("dim_00",), ("dim_63",)], "feature_id string")
    chosen = sel.fold_top_features(ad.vector_cells(spark, sf_dir), 5, FOLD_TOP, panel)
    return _round(chosen, 8, "variance")


# --- classification ----------------------------------------------------------------------

SQL_SCORES = """pairs AS (SELECT fold, actual_code AS a, predicted_code AS p, count(*) AS n FROM vectors GROUP BY 1, 2, 3),
booked AS (SELECT fold, a AS class, CASE WHEN a = p THEN n ELSE 0 END AS tp, 0 AS fp, CASE WHEN a = p THEN 0 ELSE n END AS fn FROM pairs
  UNION ALL SELECT fold, p, 0, CASE WHEN a = p THEN 0 ELSE n END, 0 FROM pairs)"""


def sql_class_scores(keys: str) -> str:
    return f"""cls AS (SELECT {keys}class, CAST(sum(tp) AS DOUBLE) AS tp, CAST(sum(fp) AS DOUBLE) AS fp, CAST(sum(fn) AS DOUBLE) AS fn
  FROM booked GROUP BY ALL),
sc AS (SELECT *, tp + fn AS support, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1 FROM cls)"""


SQL_SUMMARY = """sum(tp) / sum(support) AS accuracy, avg(CASE WHEN support > 0 THEN recall END) AS balanced_accuracy,
  avg(f1) AS macro_f1, sum(f1 * support) / sum(support) AS weighted_f1"""


@query(
    "classification_metrics",
    f"""WITH {ad.SQL_VECTORS}, {SQL_SCORES}, {sql_class_scores('fold, ')}, m AS (SELECT fold, {SQL_SUMMARY} FROM sc GROUP BY fold)
SELECT fold, round(accuracy, 8) AS accuracy, round(balanced_accuracy, 8) AS balanced_accuracy,
  round(macro_f1, 8) AS macro_f1, round(weighted_f1, 8) AS weighted_f1 FROM m""",
)
def classification_metrics(spark, sf_dir):
    scores = ev.summary_scores(ad.vectors(spark, sf_dir), ["fold"])
    return _round(scores, 8, "accuracy", "balanced_accuracy", "macro_f1", "weighted_f1")


@query(
    "fold_score_summary",
    f"""WITH {ad.SQL_VECTORS}, {SQL_SCORES}, {sql_class_scores('fold, ')}, m AS (SELECT fold, {SQL_SUMMARY} FROM sc GROUP BY fold),
long_ AS (SELECT 'accuracy' AS metric, accuracy AS s FROM m UNION ALL SELECT 'balanced_accuracy', balanced_accuracy FROM m
  UNION ALL SELECT 'macro_f1', macro_f1 FROM m)
SELECT metric, round(avg(s), 8) AS mean, round(stddev_pop(s), 8) AS std FROM long_ GROUP BY metric""",
)
def fold_score_summary(spark, sf_dir):
    scores = ev.summary_scores(ad.vectors(spark, sf_dir), ["fold"])
    return _round(ev.fold_summary(scores, ["accuracy", "balanced_accuracy", "macro_f1"]), 8, "mean", "std")


@query(
    "classification_report",
    f"""WITH {ad.SQL_VECTORS}, {SQL_SCORES}, {sql_class_scores('')}, w AS (SELECT sum(support) AS n FROM sc)
SELECT CAST(class AS VARCHAR) AS label, round(precision, 8) AS precision, round(recall, 8) AS recall, round(f1, 8) AS f1,
  CAST(support AS BIGINT) AS support FROM sc
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 8), round(sum(tp) / sum(support), 8), round(sum(tp) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM sc
UNION ALL SELECT 'macro avg', round(avg(precision), 8), round(avg(recall), 8), round(avg(f1), 8), CAST(sum(support) AS BIGINT) FROM sc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 8), round(sum(recall * support) / sum(support), 8),
  round(sum(f1 * support) / sum(support), 8), CAST(sum(support) AS BIGINT) FROM sc""",
)
def classification_report(spark, sf_dir):
    return _round(ev.classification_report(ad.vectors(spark, sf_dir)), 8, "precision", "recall", "f1")


@query(
    "confusion_matrix",
    f"""WITH {ad.SQL_VECTORS}, c AS (SELECT DISTINCT CAST(label AS INTEGER) AS c FROM vectors),
n AS (SELECT actual_code AS a, predicted_code AS p, count(*) AS n FROM vectors GROUP BY 1, 2)
SELECT x.c AS actual, y.c AS predicted, coalesce(n.n, 0) AS n,
  round(coalesce(n.n, 0) / CAST(sum(coalesce(n.n, 0)) OVER (PARTITION BY x.c) AS DOUBLE), 8) AS row_share
FROM c x CROSS JOIN c y LEFT JOIN n ON n.a = x.c AND n.p = y.c""",
)
def confusion_matrix(spark, sf_dir):
    return _round(ev.confusion_matrix(ad.vectors(spark, sf_dir), CLASSES), 8, "row_share")


@query(
    "log_loss",
    f"""WITH {ad.SQL_VECTORS} SELECT fold, round(-avg(ln(least(greatest(probabilities[actual_code + 1], 2.220446049250313e-16),
  1 - 2.220446049250313e-16))), 8) AS log_loss FROM vectors GROUP BY fold""",
)
def log_loss(spark, sf_dir):
    return _round(ev.log_loss(ad.vectors(spark, sf_dir), ["fold"]), 8, "log_loss")


@query(
    "argmax_predictions",
    f"""WITH {ad.SQL_VECTORS} SELECT vec_id, CAST(list_position(probabilities, list_max(probabilities)) - 1 AS INTEGER) AS predicted_code FROM vectors""",
)
def argmax_predictions(spark, sf_dir):
    return ad.vectors(spark, sf_dir).select("vec_id", argmax_code(F.col("probabilities")).alias("predicted_code"))


SQL_CURVE = f"""{ad.SQL_VECTORS}, k(class) AS (SELECT CAST(range AS INTEGER) FROM range(10)),
long_ AS (SELECT k.class, v.probabilities[k.class + 1] AS score, CASE WHEN v.actual_code = k.class THEN 1 ELSE 0 END AS pos
  FROM vectors v CROSS JOIN k),
th AS (SELECT class, score, sum(pos) AS pos, sum(1 - pos) AS neg FROM long_ GROUP BY 1, 2),
run AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER (PARTITION BY class) AS p,
  sum(neg) OVER (PARTITION BY class) AS q FROM th WINDOW w AS (PARTITION BY class ORDER BY score DESC))"""


@query(
    "roc_points",
    f"""WITH {SQL_CURVE}
SELECT class, round(score, 9) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
  round(tp / CAST(p AS DOUBLE), 8) AS tpr, round(fp / CAST(q AS DOUBLE), 8) AS fpr FROM run
UNION ALL SELECT class, NULL, 0, 0, 0.0, 0.0 FROM k""",
)
def roc_points(spark, sf_dir):
    rows = ev.class_score_rows(ad.vectors(spark, sf_dir), CLASSES)
    points = ev.roc_points(rows).withColumn("threshold", F.round("threshold", 9))
    return _round(points, 8, "tpr", "fpr")


@query(
    "roc_auc",
    f"""WITH {SQL_CURVE}
SELECT class, round(sum(neg * (2 * tp - pos)) / CAST(2 * any_value(p) * any_value(q) AS DOUBLE), 8) AS auc FROM run GROUP BY class""",
)
def roc_auc(spark, sf_dir):
    return _round(ev.roc_auc(ev.class_score_rows(ad.vectors(spark, sf_dir), CLASSES)), 8, "auc")


# --- clustering ------------------------------------------------------------------------------


@query(
    "cluster_contingency",
    f"""WITH {ad.SQL_VECTORS}, c AS (SELECT cluster, label, count(*) AS n FROM vectors GROUP BY 1, 2),
g AS (SELECT x.cluster, CAST(y.range AS INTEGER) AS label FROM (SELECT DISTINCT cluster FROM c) x CROSS JOIN range(10) y)
SELECT g.cluster, g.label, coalesce(c.n, 0) AS n,
  round(100 * coalesce(c.n, 0) / CAST(sum(coalesce(c.n, 0)) OVER (PARTITION BY g.cluster) AS DOUBLE), 8) AS row_percent
FROM g LEFT JOIN c ON g.cluster = c.cluster AND g.label = c.label""",
)
def cluster_contingency(spark, sf_dir):
    return _round(ev.contingency(ad.vectors(spark, sf_dir), labels=CLASSES), 8, "row_percent")


@query(
    "cluster_contingency_wide",
    f"WITH {ad.SQL_VECTORS} SELECT cluster, "
    + ", ".join(f'count(*) FILTER (WHERE label = {c}) AS "{c}"' for c in CLASSES)
    + " FROM vectors GROUP BY cluster",
)
def cluster_contingency_wide(spark, sf_dir):
    return ev.contingency_wide(ad.vectors(spark, sf_dir), CLASSES)


@query(
    "cluster_purity",
    f"""WITH {ad.SQL_VECTORS}, c AS (SELECT cluster, label, count(*) AS n FROM vectors GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS k, sum(n) OVER (PARTITION BY cluster) AS t FROM c)
SELECT cluster, label AS majority, round(100 * n / CAST(t AS DOUBLE), 8) AS purity_percent, CAST(t AS BIGINT) AS n FROM r WHERE k = 1""",
)
def cluster_purity(spark, sf_dir):
    return _round(ev.cluster_purity(ad.vectors(spark, sf_dir)), 8, "purity_percent")


@query("cluster_sizes", f"WITH {ad.SQL_VECTORS} SELECT cluster, count(*) AS n FROM vectors GROUP BY cluster")
def cluster_sizes(spark, sf_dir):
    return ev.cluster_sizes(ad.vectors(spark, sf_dir))


@query(
    "cluster_agreement",
    f"""WITH {ad.SQL_VECTORS}, c AS (SELECT cluster, label, CAST(count(*) AS DOUBLE) AS n FROM vectors GROUP BY 1, 2),
a AS (SELECT sum(n) AS n FROM c GROUP BY cluster), b AS (SELECT sum(n) AS n FROM c GROUP BY label),
s AS (SELECT (SELECT sum(n) FROM c) AS n, (SELECT sum(n * (n - 1) / 2) FROM c) AS ij,
  (SELECT sum(n * (n - 1) / 2) FROM a) AS ai, (SELECT sum(n * (n - 1) / 2) FROM b) AS bi,
  (SELECT sum(n * ln(n)) FROM c) AS lc, (SELECT sum(n * ln(n)) FROM a) AS la, (SELECT sum(n * ln(n)) FROM b) AS lb)
SELECT CAST(n AS BIGINT) AS n_labeled,
  round((ij - ai * bi / (n * (n - 1) / 2)) / ((ai + bi) / 2 - ai * bi / (n * (n - 1) / 2)) + 0.0, 8) AS ari,
  round(((lc - la - lb) / n + ln(n)) / ((ln(n) - la / n + ln(n) - lb / n) / 2), 8) AS nmi FROM s""",
)
def cluster_agreement(spark, sf_dir):
    return _round(ev.cluster_agreement(ad.vectors(spark, sf_dir)), 8, "ari", "nmi")


def sql_silhouette(distance: str, group: str) -> str:
    return f"""WITH {ad.SQL_VECTORS}, size AS (SELECT cluster, count(*) AS n FROM vectors GROUP BY cluster),
d AS (SELECT x.vec_id, x.cluster, y.cluster AS target, sum({distance}) AS t
  FROM (SELECT vec_id, cluster, CAST(embedding AS DOUBLE[]) AS e FROM vectors) x
  CROSS JOIN (SELECT vec_id, cluster, CAST(embedding AS DOUBLE[]) AS e FROM vectors) y GROUP BY 1, 2, 3),
m AS (SELECT d.vec_id, d.cluster, CASE WHEN d.cluster = d.target THEN t / (s.n - 1) END AS a,
  CASE WHEN d.cluster <> d.target THEN t / s.n END AS b FROM d JOIN size s ON d.target = s.cluster),
p AS (SELECT vec_id, cluster, max(a) AS a, min(b) AS b FROM m GROUP BY 1, 2),
sil AS (SELECT vec_id, cluster, (b - a) / greatest(a, b) AS silhouette FROM p)
{group}"""


PER_ROW = "SELECT vec_id, cluster, round(silhouette, 7) AS silhouette FROM sil"
PER_CLUSTER = "SELECT cluster, count(*) AS n, round(avg(silhouette), 7) AS silhouette FROM sil GROUP BY cluster"


@query("silhouette_exact", sql_silhouette("list_distance(x.e, y.e)", PER_ROW))
def silhouette_exact(spark, sf_dir):
    return _round(ev.silhouette_exact(ad.vectors(spark, sf_dir), "vec_id"), 7, "silhouette")


@query("silhouette_bounded", sql_silhouette("list_distance(x.e, y.e)", PER_ROW))
def silhouette_bounded(spark, sf_dir):
    """The exact silhouette again, without the distances that its bounds rule out."""
    rows = si.silhouette_bounded(ad.vectors(spark, sf_dir), "vec_id")
    return _round(rows.drop("n_distances"), 7, "silhouette")


@query(
    "silhouette_squared",
    sql_silhouette("list_distance(x.e, y.e) * list_distance(x.e, y.e)", PER_CLUSTER),
)
def silhouette_squared(spark, sf_dir):
    rows = ev.silhouette_squared(ad.vectors(spark, sf_dir).select("vec_id", "vector", "cluster"))
    out = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.avg("silhouette").alias("silhouette"))
    return _round(out, 7, "silhouette")


# --- factors and attributions -------------------------------------------------------------------

SQL_LOADINGS = f"""{ad.SQL_VECTOR_CELLS},
loadings AS (SELECT 'v' || CAST(dim // 16 AS VARCHAR) AS view, label AS factor, feature_id AS feature, avg(value) AS loading
  FROM cells GROUP BY 1, 2, 3)"""


def _loadings(spark, sf_dir):
    """Class means per dimension as loadings; blocks of 16 dimensions as views."""
    view = F.concat(F.lit("v"), F.floor(F.col("dim") / 16))
    return (
        ad.vector_cells(spark, sf_dir)
        .groupBy(view.alias("view"), F.col("label").alias("factor"), F.col("feature_id").alias("feature"))
        .agg(F.avg("value").alias("loading"))
    )


@query(
    "loading_bars",
    f"""WITH {SQL_LOADINGS} SELECT view, feature, round(loading, 8) AS loading FROM (
  SELECT *, row_number() OVER (PARTITION BY view ORDER BY abs(loading) DESC, feature) AS rank FROM loadings WHERE factor = 1) t
WHERE rank <= 10 ORDER BY view, loading""",
)
def loading_bars(spark, sf_dir):
    bars = ev.loading_bars(_loadings(spark, sf_dir), 1, 10)
    return _round(bars.select("view", "feature", "loading"), 8, "loading")


@query(
    "top_loadings",
    f"""WITH {SQL_LOADINGS} SELECT view, factor, feature, round(loading, 8) AS loading, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY view, factor ORDER BY abs(loading) DESC, feature) AS rank FROM loadings) t WHERE rank <= 5""",
)
def top_loadings(spark, sf_dir):
    top = ev.top_loadings(_loadings(spark, sf_dir), 5)
    return _round(top, 8, "loading").withColumn("rank", F.col("rank").cast("long"))


@query(
    "factor_scatter",
    f"""WITH {ad.SQL_VECTORS} SELECT vec_id AS patient_id, label, round(CAST(embedding[1] AS DOUBLE), 8) AS factor_1,
  round(CAST(embedding[2] AS DOUBLE), 8) AS factor_2, count(*) OVER (PARTITION BY label) AS n_label FROM vectors""",
)
def factor_scatter(spark, sf_dir):
    v = ad.vectors(spark, sf_dir).withColumnRenamed("vec_id", "patient_id")
    scores = fa.score_columns(v.select("patient_id", F.col("vector").alias("scores")), 2)
    return _round(fa.factor_scatter(scores, v, "label"), 8, "factor_1", "factor_2")


FACTORS = 3


@query(
    "variance_explained",
    f"""WITH {ad.SQL_VECTOR_CELLS},
z AS (SELECT vec_id, dim AS k, value AS z FROM cells WHERE dim < {FACTORS}),
w AS (SELECT c.feature_id, z.k, sum(c.value * z.z) / sum(z.z * z.z) AS w FROM cells c JOIN z ON c.vec_id = z.vec_id GROUP BY 1, 2)
SELECT CAST(z.k + 1 AS INTEGER) AS factor, CASE WHEN c.dim < 32 THEN 'low' ELSE 'high' END AS view,
  round(100 * (1 - sum((c.value - z.z * w.w) * (c.value - z.z * w.w)) / sum(c.value * c.value)), 6) AS r2
FROM cells c JOIN z ON c.vec_id = z.vec_id JOIN w ON c.feature_id = w.feature_id AND w.k = z.k GROUP BY 1, 2""",
)
def variance_explained(spark, sf_dir):
    """First dimensions as scores, least-squares loadings, explained share per view."""
    v = ad.vectors(spark, sf_dir).select("vec_id", "vector", F.slice("vector", 1, FACTORS).alias("z"))
    cells = v.select("z", F.posexplode("vector").alias("dim", "value"))
    loading = [
        F.sum(F.col("value") * F.get("z", F.lit(k))) / F.sum(F.get("z", F.lit(k)) * F.get("z", F.lit(k)))
        for k in range(FACTORS)
    ]
    loadings = cells.groupBy("dim").agg(F.array(*loading).alias("w"))
    view = F.when(F.col("dim") < 32, "low").otherwise("high")
    r2 = ev.variance_explained(cells.join(loadings, "dim").withColumn("view", view), FACTORS)
    return _round(r2, 6, "r2")


@query(
    "attribution_summary",
    f"""WITH {ad.SQL_VECTOR_CELLS}, mu AS (SELECT dim, avg(value) AS m FROM cells GROUP BY dim),
w AS (SELECT c.label AS class, c.dim, avg(c.value) - any_value(mu.m) AS w FROM cells c JOIN mu ON c.dim = mu.dim GROUP BY 1, 2),
per AS (SELECT c.feature_id AS feature, w.class, avg(abs(w.w * (c.value - mu.m))) AS s
  FROM cells c JOIN mu ON c.dim = mu.dim JOIN w ON w.dim = c.dim GROUP BY 1, 2)
SELECT feature, class, round(s, 9) AS mean_abs, round(avg(s) OVER (PARTITION BY feature), 9) AS mean_abs_all FROM per""",
)
def attribution_summary(spark, sf_dir):
    """Contributions of a nearest-centroid scorer: (centroid - mean) * (x - mean)."""
    cells = ad.vector_cells(spark, sf_dir)
    means = cells.groupBy("feature_id").agg(F.avg("value").alias("m"))
    centroids = cells.groupBy("feature_id", F.col("label").alias("class")).agg(F.avg("value").alias("c"))
    # a feature's class weights travel as one array, so cells are not multiplied before the join
    weights = (
        centroids.join(means, "feature_id")
        .groupBy("feature_id", "m")
        .agg(F.collect_list(F.struct("class", (F.col("c") - F.col("m")).alias("w"))).alias("ws"))
    )
    parts = cells.join(weights, "feature_id").select(
        F.col("feature_id").alias("feature"), (F.col("value") - F.col("m")).alias("d"), F.inline("ws")
    )
    contributions = parts.withColumn("contribution", F.col("w") * F.col("d"))
    return _round(ev.attribution_summary(contributions), 9, "mean_abs", "mean_abs_all")
