"""Queries that train: clusterings, classifiers, attributions, factor models."""

from __future__ import annotations

from pyspark.sql import functions as F

from cohortviews import dims
from cohortviews.operators import factors as fa
from cohortviews.operators import merge as mg
from cohortviews.operators import model as md
from cohortviews.operators import reshape as rs
from cohortviews.operators import variational as va
from cohortviews.operators.ranking import best_row
from cohortviews.plans import adapters as ad
from cohortviews.plans.catalogue import query
from cohortviews.plans.queries_matrix import SQL_SIX_CELLS, _six_cells
from cohortviews.session import stage


def _points(spark, sf_dir):
    return stage(ad.vectors(spark, sf_dir).select("vec_id", "vector", "label"))


def _examples(spark, sf_dir):
    return stage(
        ad.vectors(spark, sf_dir).select(
            F.col("vec_id").alias("id"), "label", F.col("vector").alias("features")
        )
    )


def _view_cells(spark, sf_dir):
    """Protein- and count-like cells, one per (entity, feature)."""
    parts = [
        rs.mean_cells(rs.prefixed(ad.protein(spark, sf_dir), "RPPA_")).withColumn("view", F.lit("RPPA")),
        rs.mean_cells(rs.prefixed(ad.mirna(spark, sf_dir), "MIR_")).withColumn("view", F.lit("miRNA")),
    ]
    return mg.stack_cohorts(parts)


@query(
    "standardised_cells",
    f"""WITH {ad.SQL_PROTEIN}, {ad.SQL_MIRNA},
c AS (SELECT 'RPPA' AS view, patient_id, 'RPPA_' || feature_id AS feature_id, avg(value) AS value FROM protein GROUP BY 2, 3
  UNION ALL SELECT 'miRNA', patient_id, 'MIR_' || feature_id, avg(value) FROM mirna GROUP BY 2, 3),
m AS (SELECT view, feature_id, avg(value) AS mean, count(*) AS n, var_pop(value) * count(*) AS m2 FROM c GROUP BY 1, 2),
s AS (SELECT view, sqrt(sum(m2) / sum(n)) AS scale FROM m GROUP BY view)
SELECT c.view, c.patient_id, c.feature_id, round((c.value - m.mean) / s.scale + 0.0, 8) AS value
FROM c JOIN m ON c.view = m.view AND c.feature_id = m.feature_id JOIN s ON c.view = s.view""",
)
def standardised_cells(spark, sf_dir):
    cells = fa.standardised(_view_cells(spark, sf_dir))
    return cells.select("view", "patient_id", "feature_id", F.round(F.col("value") + 0.0, 8).alias("value"))


SQL_K = "SELECT CAST(k AS INTEGER) AS k FROM range(2, 11) t(k)"


def _cluster_costs(placed, name):
    """Sum of squared distances to the mean of the own cluster, and the number of clusters."""
    cells = placed.select(F.col(name).alias("c"), F.posexplode("vector").alias("i", "x"))
    per = cells.groupBy("c", "i").agg((F.var_pop("x") * F.count("x")).alias("ss"))
    return per.agg(F.sum("ss").alias("cost"), F.count_distinct("c").alias("clusters"))


@query(
    "kmeans_sweep",
    f"""SELECT k, (SELECT count(*) FROM embeddings) AS n_assigned, CAST(k AS BIGINT) AS clusters,
  TRUE AS cost_is_that_of_the_means, TRUE AS silhouette_in_range FROM ({SQL_K})""",
)
def kmeans_sweep(spark, sf_dir):
    """Every k of the default sweep: all rows assigned, no empty cluster, inertia that of the clusters' means."""
    sweep, placed = fa.kmeans_runs(_points(spark, sf_dir), "vec_id")
    costs = None
    for k in range(2, 11):
        part = _cluster_costs(placed, f"cluster_{k}").withColumn("k", F.lit(k))
        costs = part if costs is None else costs.unionByName(part)
    # fitting stops before the last small moves of the means, which can only lower the cost
    near = (F.col("cost") <= F.col("inertia") * 1.000001) & (F.col("inertia") <= 1.02 * F.col("cost"))
    return sweep.join(costs, "k").select(
        "k",
        F.lit(placed.count()).cast("long").alias("n_assigned"),
        "clusters",
        near.alias("cost_is_that_of_the_means"),
        F.col("silhouette").between(-1, 1).alias("silhouette_in_range"),
    )


@query("kmeans_clusters", "SELECT vec_id, TRUE AS best_k, TRUE AS at_nearest_mean FROM embeddings")
def kmeans_clusters(spark, sf_dir):
    """Every row once, at the k of the best exact silhouette, with no other cluster's mean much nearer than its own."""
    sweep, placed = fa.kmeans_runs(_points(spark, sf_dir), "vec_id")
    k = sweep.agg(F.max_by("k", F.struct("silhouette", -F.col("k")))).first()[0]
    wanted = placed.select("vec_id", F.col(f"cluster_{k}").alias("wanted"))
    best = stage(fa.best_clustering(sweep, placed).join(wanted, "vec_id"))
    cells = best.select("cluster", F.posexplode("vector").alias("i", "x"))
    means = cells.groupBy("cluster", "i").agg(F.avg("x").alias("m"))
    far = (
        best.select("vec_id", "cluster", "wanted", F.posexplode("vector").alias("i", "x"))
        .join(F.broadcast(means.withColumnRenamed("cluster", "of")), "i")  # k rows for each dimension
        .groupBy("vec_id", "cluster", "wanted", "of")
        .agg(F.sum((F.col("x") - F.col("m")) * (F.col("x") - F.col("m"))).alias("d"))
        .groupBy("vec_id", "cluster", "wanted")
        .agg(F.min("d").alias("least"), F.max(F.when(F.col("of") == F.col("cluster"), F.col("d"))).alias("own"))
    )
    return far.select(
        "vec_id", (F.col("cluster") == F.col("wanted")).alias("best_k"), (F.col("own") <= 1.05 * F.col("least")).alias("at_nearest_mean")
    )


@query(
    "best_k",
    """WITH sweep AS (SELECT label AS k, round(avg(embedding[1]), 9) AS silhouette, count(*) AS inertia FROM embeddings GROUP BY label)
SELECT k, silhouette, inertia FROM sweep ORDER BY silhouette DESC, k LIMIT 1""",
)
def best_k(spark, sf_dir):
    """The best row of a sweep that is given as a table."""
    points = _points(spark, sf_dir)
    sweep = points.groupBy(F.col("label").alias("k")).agg(
        F.round(F.avg(F.get("vector", F.lit(0))), 9).alias("silhouette"), F.count("*").alias("inertia")
    )
    return best_row(sweep, "silhouette", "k")


@query(
    "cv_classifier",
    """WITH sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label)
SELECT CAST(fold AS INTEGER) AS fold, CAST(sum((n + 4 - fold) // 5) AS BIGINT) AS n_predicted,
  CAST(sum((n + 4 - fold) // 5) AS BIGINT) AS n_distinct, TRUE AS sums_to_one, TRUE AS is_argmax
FROM sizes CROSS JOIN range(5) f(fold) GROUP BY fold""",
)
def cv_classifier(spark, sf_dir):
    """Out-of-fold predictions with per-fold selection: every row predicted once, in its fold."""
    predictions = stage(md.cross_validate(_examples(spark, sf_dir), top_n=40, must_keep=[0, 63]))
    total = F.aggregate("probabilities", F.lit(0.0), lambda a, p: a + p)
    return predictions.groupBy("fold").agg(
        F.count("*").alias("n_predicted"),
        F.count_distinct("id").alias("n_distinct"),
        F.bool_and(F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        F.bool_and(F.get("probabilities", F.col("predicted_code")) == F.array_max("probabilities")).alias("is_argmax"),
    )


@query(
    "feature_importances",
    "SELECT CAST(i AS INTEGER) AS ordinal, TRUE AS in_range, TRUE AS sum_is_one FROM range(64) t(i)",
)
def feature_importances(spark, sf_dir):
    """A share of the whole for every feature of the refitted model."""
    model, positions, _ = md.final_model(_examples(spark, sf_dir))
    table = stage(md.importances(spark, model, positions))
    whole = table.agg(F.sum("importance")).first()[0]
    return table.select("ordinal", F.col("importance").between(0, 1).alias("in_range"), F.lit(abs(whole - 1) < 1e-9).alias("sum_is_one"))


@query(
    "linear_attribution",
    """SELECT CAST(i AS INTEGER) AS position, CAST(label AS INTEGER) AS class, TRUE AS not_negative
FROM range(64) t(i) CROSS JOIN (SELECT DISTINCT label FROM embeddings)""",
)
def linear_attribution(spark, sf_dir):
    """Mean contribution of every feature to every class."""
    return md.linear_attribution(_examples(spark, sf_dir)).select("position", "class", (F.col("mean_abs") >= 0).alias("not_negative"))


@query(
    "permutation_importance",
    "SELECT CAST(i AS INTEGER) AS ordinal, TRUE AS in_range FROM range(64) t(i)",
)
def permutation_importance(spark, sf_dir):
    """Loss of accuracy for every feature of the refitted model."""
    data = _examples(spark, sf_dir)
    model, positions, means = md.final_model(data)
    losses = md.permutation_importance(data, model, positions, means)
    return losses.select("ordinal", F.col("accuracy_loss").between(-1, 1).alias("in_range"))


@query(
    "planted_feature_first",
    """SELECT m AS measure, CAST(64 AS INTEGER) AS ordinal, TRUE AS well_ahead
FROM (VALUES ('forest'), ('linear'), ('permutation')) t(m) WHERE (SELECT count(DISTINCT label) FROM embeddings) > 1""",
)
def planted_feature_first(spark, sf_dir):
    """One more feature that tells the label, up to noise, ranks first by every measure, at least twice ahead of the next."""
    noise = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1000)) / 2500
    data = stage(_examples(spark, sf_dir).withColumn(
        "features", F.concat(F.col("features").cast("array<double>"), F.array((F.col("label") + noise).cast("double")))))
    model, positions, means = md.final_model(data)
    measures = {
        "forest": md.importances(spark, model, positions).select("ordinal", F.col("importance").alias("size")),
        "permutation": md.permutation_importance(data, model, positions, means).select("ordinal", F.col("accuracy_loss").alias("size")),
        "linear": md.linear_attribution(data).groupBy(F.col("position").cast("int").alias("ordinal")).agg(F.sum("mean_abs").alias("size")),
    }
    sizes = mg.stack_cohorts([df.withColumn("measure", F.lit(m)) for m, df in measures.items()])
    top = sizes.groupBy("measure").agg(F.array_sort(F.collect_list(F.struct((-F.col("size")).alias("minus"), "ordinal"))).alias("s"))  # a feature each
    return top.select(
        "measure", F.get("s", F.lit(0))["ordinal"].alias("ordinal"),
        (F.get("s", F.lit(0))["minus"] <= 2 * F.get("s", F.lit(1))["minus"]).alias("well_ahead"))


def _factors(spark, sf_dir):
    cells, people = _six_cells(spark, sf_dir)
    gated = fa.gated_views(cells, people, dims.view_config(spark))
    return fa.fit_factors(fa.standardised(gated))


@query(
    "factor_model",
    "SELECT TRUE AS any_factor, TRUE AS at_most_all, TRUE AS each_explains, TRUE AS largest_first",
)
def factor_model(spark, sf_dir):
    """Variance explained: never above all of it, no factor below the limit, and loadings' lengths descending."""
    model = _factors(spark, sf_dir)
    per_factor = model.r2.groupBy("factor").agg(F.max("r2").alias("top"))
    lengths = fa.loading_rows(model.loadings).groupBy("factor").agg(F.sqrt(F.sum(F.col("loading") * F.col("loading"))).alias("length"))
    listed = per_factor.join(lengths, "factor").agg(F.array_sort(F.collect_list(F.struct("factor", "top", "length"))).alias("fs"))  # a row each
    return listed.select(
        (F.size("fs") > 0).alias("any_factor"),
        F.forall("fs", lambda f: f["top"] <= 100).alias("at_most_all"),
        F.forall("fs", lambda f: f["top"] >= 0.1).alias("each_explains"),
        (F.transform("fs", lambda f: f["length"]) == F.reverse(F.array_sort(F.transform("fs", lambda f: f["length"])))).alias("largest_first"),
    )


def _orthogonal(df, column):
    """Whether different positions of an array column are uncorrelated over all rows."""
    cells = df.select(F.posexplode(column).alias("a", "x"), F.col(column).alias("v"))
    pairs = cells.select("a", "x", F.posexplode("v").alias("b", "y"))
    gram = stage(pairs.groupBy("a", "b").agg(F.sum(F.col("x") * F.col("y")).alias("g")))
    own = gram.filter("a = b").select("a", F.col("g").alias("own"))
    scaled = gram.join(own, "a").join(own.select(F.col("a").alias("b"), F.col("own").alias("other")), "b")
    return scaled.agg(F.bool_and((F.col("a") == F.col("b")) | (F.abs("g") <= 1e-3 * F.sqrt(F.col("own") * F.col("other")))).alias("orthogonal"))


@query("factor_loadings", "SELECT TRUE AS orthogonal")
def factor_loadings(spark, sf_dir):
    """Loadings of different factors are orthogonal."""
    return _orthogonal(_factors(spark, sf_dir).loadings, "loadings")


@query("factor_scores", "SELECT TRUE AS orthogonal")
def factor_scores(spark, sf_dir):
    """Scores of different factors are orthogonal."""
    return _orthogonal(_factors(spark, sf_dir).scores, "scores")


@query(
    "variational_factors",
    f"""WITH {SQL_SIX_CELLS},
gated AS (SELECT r.view, r.feature_id FROM rates r JOIN config c ON r.view = c.view WHERE r.missing_rate <= c.max_missing),
seen AS (SELECT x.view, x.feature_id, x.patient_id FROM cells x JOIN gated g ON x.view = g.view AND x.feature_id = g.feature_id
  WHERE x.value IS NOT NULL)
SELECT count(DISTINCT patient_id) AS n_scores, count(DISTINCT (view, feature_id)) AS n_loadings, TRUE AS never_falls,
  TRUE AS at_most_all, TRUE AS each_explains, TRUE AS strongest_first FROM seen""",
)
def variational_factors(spark, sf_dir):
    """Variational model of the gated views: entities and features it covers, its bound, and what its factors explain."""
    config = dims.view_config(spark)
    cells, people = _six_cells(spark, sf_dir)
    likelihoods = {r.view: r.likelihood for r in config.collect()}  # a row for each view
    model = va.fit_variational(va.prepared(fa.gated_views(cells, people, config), likelihoods), likelihoods, max_iter=40)
    steps = F.array_sort(F.collect_list(F.struct("iteration", "elbo", "factors")))  # a row for each iteration
    pairs = F.arrays_zip(F.slice("steps", F.lit(1), F.size("steps") - 1).alias("a"), F.slice("steps", F.lit(2), F.size("steps") - 1).alias("b"))
    log = model.log.agg(steps.alias("steps")).select(
        F.forall(
            pairs,
            lambda p: (p["a"]["factors"] != p["b"]["factors"]) | (p["b"]["elbo"] >= p["a"]["elbo"] - 1e-7 * F.abs(p["a"]["elbo"])),
        ).alias("never_falls")
    )
    shares = model.r2.groupBy("factor").agg(F.max("r2").alias("top"), F.sum("r2").alias("total"))
    listed = shares.agg(F.array_sort(F.collect_list(F.struct("factor", "top", "total"))).alias("fs"))  # a row for each factor
    totals = F.transform("fs", lambda f: f["total"])
    return listed.select(
        model.scores.agg(F.count("*")).scalar().alias("n_scores"),
        model.loadings.agg(F.count("*")).scalar().alias("n_loadings"),
        log.scalar().alias("never_falls"),
        F.forall("fs", lambda f: f["top"] <= 100).alias("at_most_all"),
        (F.forall("fs", lambda f: f["top"] >= 0.1) | (F.size("fs") == 1)).alias("each_explains"),
        (totals == F.reverse(F.array_sort(totals))).alias("strongest_first"),
    )
