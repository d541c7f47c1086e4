"""Queries that train boosted trees and explain them.

Their examples are the given vectors, one cell in ten of them missing by a rule.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews.operators import attributions as at
from cohortviews.operators import boosting as bo
from cohortviews.operators.ranking import ranked
from cohortviews.plans import adapters as ad
from cohortviews.plans.catalogue import query
from cohortviews.session import stage

#: A cell of vector ``vec_id`` at position i (from 1) is missing where this holds.
GAP = "(vec_id * 7 + {i} * 13) % 10 = 0"
WIDTH = 64


def _holed(spark, sf_dir):
    """Vectors with missing cells, their label, and a label planted on three positions: 3 missing, else 10 or 21 above zero."""
    rows = ad.vectors(spark, sf_dir).withColumn(
        "features", F.expr(f"transform(vector, (x, i) -> CASE WHEN {GAP.format(i='(i + 1)')} THEN NULL ELSE x END)")
    )
    planted = F.expr("CASE WHEN features[3] IS NULL THEN 2 WHEN coalesce(features[10], 1) > 0 THEN 1 ELSE 0 END")
    return stage(rows.select(F.col("vec_id").alias("id"), "label", planted.alias("planted"), "features"))


ONE_ROUND = bo.Settings(rounds=1, depth=2, rate=0.3, rows=1.0, columns=1.0, bins=32)

_SIDES = """SELECT s.*, m.missing_left,
    g_until - CASE WHEN m.missing_left THEN 0 ELSE g_missing END AS gl, h_until - CASE WHEN m.missing_left THEN 0 ELSE h_missing END AS hl
  FROM {level}_sums s JOIN (VALUES (TRUE), (FALSE)) m(missing_left) ON m.missing_left OR s.bin >= 0"""


def _sql_level(level: str, rows: str) -> str:
    """Best splits of the nodes of one level; ``rows`` is (vec_id, class, path, g, h)."""
    return f"""{level}_cells AS (
  SELECT r.class, r.path, b.feature, b.bin, sum(r.g) AS g, sum(r.h) AS h
  FROM {rows} r JOIN bins b ON r.vec_id = b.vec_id GROUP BY 1, 2, 3, 4),
{level}_sums AS (
  SELECT class, path, feature, bin,
    sum(g) OVER (PARTITION BY class, path, feature ORDER BY bin) AS g_until,
    sum(h) OVER (PARTITION BY class, path, feature ORDER BY bin) AS h_until,
    sum(g) OVER (PARTITION BY class, path, feature) AS g_all, sum(h) OVER (PARTITION BY class, path, feature) AS h_all,
    coalesce(sum(CASE WHEN bin = -1 THEN g END) OVER (PARTITION BY class, path, feature), 0) AS g_missing,
    coalesce(sum(CASE WHEN bin = -1 THEN h END) OVER (PARTITION BY class, path, feature), 0) AS h_missing
  FROM {level}_cells),
{level}_sides AS ({_SIDES.format(level=level)}),
{level} AS (
  SELECT class, path, feature, bin, missing_left, gl, hl, g_all - gl AS gr, h_all - hl AS hr,
    round(gl * gl / (hl + 1) + (g_all - gl) * (g_all - gl) / (h_all - hl + 1) - g_all * g_all / (h_all + 1), 9) AS gain
  FROM {level}_sides WHERE hl >= 1 AND h_all - hl >= 1
  QUALIFY row_number() OVER (PARTITION BY class, path ORDER BY gain DESC, feature, bin, missing_left) = 1 AND gain > 1e-6)"""


@query(
    "boosted_first_round",
    f"""WITH cells AS (
  SELECT vec_id, i - 1 AS feature, CASE WHEN {GAP.format(i='i')} THEN NULL ELSE CAST(embedding[i] AS DOUBLE) END AS x
  FROM (SELECT vec_id, embedding, CAST(unnest(range(1, {WIDTH + 1})) AS INTEGER) AS i FROM embeddings)),
ranks AS (
  SELECT feature, x, row_number() OVER (PARTITION BY feature ORDER BY x) AS r, count(*) OVER (PARTITION BY feature) AS n
  FROM cells WHERE x IS NOT NULL),
cuts AS (
  SELECT DISTINCT feature, x AS cut FROM ranks JOIN (SELECT unnest(range(1, 32)) AS j) ON r = (j * n + 31) // 32),
numbered AS (SELECT feature, cut, row_number() OVER (PARTITION BY feature ORDER BY cut) - 1 AS bin FROM cuts),
bins AS (
  SELECT c.vec_id, c.feature, CASE WHEN c.x IS NULL THEN -1 ELSE count(k.cut) END AS bin
  FROM cells c LEFT JOIN cuts k ON c.feature = k.feature AND k.cut < c.x GROUP BY c.vec_id, c.feature, c.x),
sizes AS (SELECT label, count(*) AS n, sum(count(*)) OVER () AS total, count(*) OVER () AS k FROM embeddings GROUP BY label),
rows AS (
  SELECT e.vec_id, c.label AS class, '' AS path, s.total / s.n / s.k AS w, 1.0::DOUBLE / s.k AS p, e.label = c.label AS own
  FROM embeddings e JOIN sizes s ON e.label = s.label CROSS JOIN (SELECT label FROM sizes) c),
root AS (SELECT vec_id, class, path, w * (p - CAST(own AS INTEGER)) AS g, 2 * p * (1 - p) * w AS h FROM rows),
{_sql_level("upper", "root")},
inner_rows AS (
  SELECT r.vec_id, r.class, CASE WHEN b.bin = -1 THEN CASE WHEN u.missing_left THEN 'L' ELSE 'R' END
      WHEN b.bin <= u.bin THEN 'L' ELSE 'R' END AS path, r.g, r.h
  FROM root r JOIN upper u ON r.class = u.class JOIN bins b ON r.vec_id = b.vec_id AND b.feature = u.feature),
{_sql_level("lower_", "inner_rows")},
splits AS (SELECT * FROM upper UNION ALL SELECT * FROM lower_),
nodes AS (
  SELECT class, path || 'L' AS path, gl AS g, hl AS h FROM splits UNION ALL SELECT class, path || 'R', gr, hr FROM splits
  UNION ALL SELECT class, path, sum(g), sum(h) FROM root GROUP BY 1, 2)
SELECT CAST(n.class AS INTEGER) AS class, n.path, CAST(coalesce(s.feature, -1) AS INTEGER) AS feature,
  round(q.cut, 9) AS threshold, s.missing_left, round(s.gain, 6) + 0.0 AS gain, round(-0.3 * n.g / (n.h + 1), 9) + 0.0 AS value, round(n.h, 6) AS cover
FROM nodes n LEFT JOIN splits s ON n.class = s.class AND n.path = s.path
LEFT JOIN numbered q ON s.feature = q.feature AND s.bin = q.bin""",
)
def boosted_first_round(spark, sf_dir):
    """Every node of the first trees: splits, the side of missing cells, gains, leaf values."""
    model, _ = bo.fit(_holed(spark, sf_dir), settings=ONE_ROUND)
    rows = []
    for k, tree in enumerate(model.trees()[0]):
        todo = [(0, "")]
        while todo:
            n, path = todo.pop()
            f, cuts = tree.feature[n], model.cuts[tree.feature[n]]
            cut = float(cuts[tree.bin[n]]) if f >= 0 and 0 <= tree.bin[n] < len(cuts) else None
            rows.append((k, path, f, cut, tree.missing_left[n] if f >= 0 else None, tree.gain[n] if f >= 0 else None, tree.value[n], tree.cover[n]))
            todo += [(tree.left[n], path + "L"), (tree.right[n], path + "R")] if f >= 0 else []
    schema = "class int, path string, feature int, threshold double, missing_left boolean, gain double, value double, cover double"
    table = spark.createDataFrame(rows, schema)
    return table.withColumns(
        {"threshold": F.round("threshold", 9), "gain": F.round("gain", 6) + 0.0, "value": F.round("value", 9) + 0.0, "cover": F.round("cover", 6)}
    )


#: Enough rounds at a higher rate to learn a planted rule.
SHORT = bo.Settings(rounds=12, depth=3, rate=0.4, bins=64)


@query(
    "boosted_classifier",
    f"""WITH planted AS (
  SELECT vec_id, CASE WHEN {GAP.format(i='4')} THEN 2 WHEN {GAP.format(i='11')} OR embedding[11] > 0 THEN 1 ELSE 0 END AS label FROM embeddings),
sizes AS (SELECT label, count(*) AS n FROM planted GROUP BY label)
SELECT CAST(fold AS INTEGER) AS fold, CAST(sum((n + 4 - fold) // 5) AS BIGINT) AS n_predicted,
  CAST(sum((n + 4 - fold) // 5) AS BIGINT) AS n_distinct, TRUE AS sums_to_one, TRUE AS is_argmax, TRUE AS learned
FROM sizes CROSS JOIN range(5) f(fold) GROUP BY fold""",
)
def boosted_classifier(spark, sf_dir):
    """Out-of-fold predictions of a rule that hangs on missing cells: every row once, nearly all of them right."""
    rows = _holed(spark, sf_dir).select("id", F.col("planted").alias("label"), "features")
    found = stage(bo.cross_validate(rows, top_n=40, must_keep=[3, 10], settings=SHORT))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
    return found.groupBy("fold").agg(
        F.count("*").alias("n_predicted"),
        F.count_distinct("id").alias("n_distinct"),
        F.bool_and(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        F.bool_and(F.get("probabilities", F.col("predicted_code")) == F.array_max("probabilities")).alias("is_argmax"),
        (F.avg((F.col("actual_code") == F.col("predicted_code")).cast("double")) >= 0.95).alias("learned"),
    )


def _planted_model(spark, sf_dir):
    rows = _holed(spark, sf_dir).select("id", F.col("planted").alias("label"), "features")
    return rows, *bo.fit(rows, settings=SHORT)


@query(
    "boosted_importances",
    "SELECT CAST(i AS INTEGER) AS ordinal, i IN (3, 10) AS planted_first, TRUE AS sum_is_one, TRUE AS loss_falls FROM range(64) t(i)",
)
def boosted_importances(spark, sf_dir):
    """Gain of every feature: those of the planted rule come first; the training loss falls in every round."""
    _, model, _ = _planted_model(spark, sf_dir)
    shares = [(i, g) for i, g in enumerate(bo.gain_importances(model))]
    losses = [x[0] for x in model.losses]
    table = ranked(spark.createDataFrame(shares, "ordinal int, importance double"), [F.desc("importance"), F.asc("ordinal")])
    one = abs(sum(g for _, g in shares) - 1) < 1e-9
    falls = all(b < a for a, b in zip(losses, losses[1:]))
    return table.select("ordinal", (F.col("rank") <= 2).alias("planted_first"), F.lit(one).alias("sum_is_one"), F.lit(falls).alias("loss_falls"))


@query(
    "tree_attributions",
    "SELECT vec_id AS id, CAST(class AS INTEGER) AS class, TRUE AS adds_up FROM embeddings CROSS JOIN range(3) c(class)",
)
def tree_attributions(spark, sf_dir):
    """For every row and class the contributions add up to the score less the base value."""
    rows, model, scored = _planted_model(spark, sf_dir)
    base = at.base_values(model)
    found = at.attributions(rows, model).join(scored.select(F.col("id").cast("long").alias("id"), "scores"), "id")
    each = found.select("id", "scores", F.posexplode("contributions").alias("class", "values"))
    total = F.aggregate("values", F.lit(0.0), lambda a, x: a + x)
    gap = F.abs(total + F.get(F.lit(base), F.col("class")) - F.get("scores", F.col("class")))
    return each.select("id", "class", (gap < 1e-9).alias("adds_up"))


@query(
    "tree_attribution_summary",
    "SELECT CAST(i AS INTEGER) AS position, i IN (3, 10) AS planted_first, TRUE AS is_mean_of_rows FROM range(64) t(i)",
)
def tree_attribution_summary(spark, sf_dir):
    """Mean size of the contributions: the features of the planted rule come first, and single rows give the same means."""
    rows, model, _ = _planted_model(spark, sf_dir)
    summed = at.summary(rows, model).groupBy("position").agg(F.sum("mean_abs").alias("mean_abs"))
    cells = at.attributions(rows, model).select(F.explode("contributions").alias("values"), "id")
    cells = cells.select(F.posexplode("values").alias("position", "x"), "id")
    plain = cells.groupBy("position").agg((F.sum(F.abs("x")) / F.count_distinct("id")).alias("plain"))
    placed = ranked(summed.join(plain, "position"), [F.desc("mean_abs"), F.asc("position")])
    close = F.abs(F.col("mean_abs") - F.col("plain")) < 1e-9
    return placed.select("position", (F.col("rank") <= 2).alias("planted_first"), close.alias("is_mean_of_rows"))
