"""Unsupervised jobs: k-means sweep and the multi-view factor model.

The factor model factorises the observed cells only: features are centred,
views scaled to unit variance, alternating least squares fits both sides, and a
k x k rotation (from the two Gram matrices) makes the factors orthogonal and
ordered.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.dims import inline_table
from cohortviews.functions.values import known, view_transform
from cohortviews.operators import kmeans as km
from cohortviews.operators.evaluate import silhouettes_exact, variance_explained
from cohortviews.operators.quality import view_gate
from cohortviews.operators.ranking import best_row, ranked
from cohortviews.session import small_side, stage


def zero_filled(vector: str) -> Column:
    return F.transform(vector, lambda x: F.coalesce(F.nanvl(x.cast("double"), F.lit(0.0)), F.lit(0.0)))


def kmeans_best(df: DataFrame, k: int, vector: str = "vector", restarts: int = 10, seed: int = 42, max_iter: int = 50):
    """The fit with the smallest inertia among the restarts, and the rows with its ``cluster``.

    Missing coordinates count as 0. Restarts run at the same time over one written copy of the vectors.
    """
    ready = stage(df.withColumn("__filled", zero_filled(vector)), "points")
    best = km.best_fits(ready, [k], "__filled", restarts, seed, max_iter)[0]
    return best, km.with_clusters(ready, {"cluster": best.means}, "__filled").drop("__filled")


def kmeans_runs(
    df: DataFrame,
    id_col: str,
    vector: str = "vector",
    k_range: Sequence[int] = range(2, 11),
    restarts: int = 10,
    seed: int = 42,
    exact: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """``(k, silhouette, inertia)`` for every k, and the rows with the clusters of every k in ``cluster_<k>``.

    ``exact`` uses Euclidean distances (quadratic in rows), each computed once for all k; otherwise the linear
    squared-distance form. Both see the zero-filled vectors that the clusters were fitted on.
    """
    filled_rows = stage(df.withColumn("__filled", zero_filled(vector)), "points")
    best = km.best_fits(filled_rows, list(k_range), "__filled", restarts, seed)  # all k and restarts in the same passes
    fits = [(fit.k, fit.cost) for fit in best]
    names = [f"cluster_{k}" for k, _ in fits]
    placed = stage(km.with_clusters(filled_rows, dict(zip(names, (fit.means for fit in best))), "__filled"), "clusters")
    if exact:
        scores = silhouettes_exact(placed, id_col, names, "__filled").groupBy("clustering").agg(F.avg("silhouette").alias("s"))
        score = {r.clustering: r.s for r in scores.collect()}
    else:
        ready = placed.withColumn("__v", array_to_vector("__filled"))
        score = {
            n: ClusteringEvaluator(featuresCol="__v", predictionCol=n).evaluate(ready.withColumn(n, F.col(n).cast("double")))
            for n in names
        }
    rows = [(k, float(score[n]), inertia) for (k, inertia), n in zip(fits, names)]
    return inline_table(df.sparkSession, rows, "k int, silhouette double, inertia double"), placed.drop("__filled")


def kmeans_sweep(df: DataFrame, id_col: str, **how) -> DataFrame:
    """``(k, silhouette, inertia)`` for every k; the arguments are those of :func:`kmeans_runs`."""
    return kmeans_runs(df, id_col, **how)[0]


def best_clustering(sweep: DataFrame, placed: DataFrame) -> DataFrame:
    """Rows with ``cluster`` at the k of the best silhouette, from the runs that were scored."""
    k = best_row(sweep, "silhouette", "k").first()["k"]
    others = [c for c in placed.columns if c.startswith("cluster_")]
    return placed.withColumn("cluster", F.col(f"cluster_{k}")).drop(*others)


def gated_views(cells: DataFrame, entities: DataFrame, config: DataFrame) -> DataFrame:
    """Transformed cells of the features that pass their view's gate."""
    rates = (
        cells.groupBy("view", "feature_id")
        .agg(F.count_if(known(F.col("value"))).alias("n_observed"))
        .withColumn("missing_rate", 1 - F.col("n_observed") / entities.agg(F.count("*").alias("n")).scalar())
    )
    kept = stage(view_gate(rates, config).where("kept").select("view", "feature_id"))
    return cells.join(small_side(kept), ["view", "feature_id"], "left_semi").withColumn(
        "value", view_transform(F.col("view"), F.col("value"))
    )


def standardised(cells: DataFrame) -> DataFrame:
    """Observed cells, centred per feature and scaled per view.

    Both steps are small aggregates joined back: centring changes no variance,
    so the view's scale follows from the features' moments.
    """
    seen = cells.where(known(F.col("value")))
    moments = stage(
        seen.groupBy("view", "feature_id").agg(
            F.avg("value").alias("mean"),
            F.count("*").alias("n"),
            (F.var_pop("value") * F.count("*")).alias("m2"),
        )
    )
    scale = moments.groupBy("view").agg(F.sqrt(F.sum("m2") / F.sum("n")).alias("scale"))
    shift = small_side(stage(moments.join(scale, "view").select("view", "feature_id", "mean", "scale")))
    return seen.join(shift, ["view", "feature_id"]).withColumn(
        "value", F.coalesce(F.try_divide(F.col("value") - F.col("mean"), F.col("scale")), F.lit(0.0))
    ).drop("mean", "scale")


class FactorModel:
    """Scores per entity, loadings per feature, variance explained per view."""

    def __init__(self, scores: DataFrame, loadings: DataFrame, r2: DataFrame, factors: int):
        self.scores = scores
        self.loadings = loadings
        self.r2 = r2
        self.factors = factors


def fit_factors(
    cells: DataFrame,
    entity: str = "patient_id",
    factors: int = 15,
    max_iter: int = 15,
    reg: float = 0.02,
    seed: int = 42,
    min_r2: float = 0.001,
) -> FactorModel:
    """Factor model of standardised cells ``(entity, view, feature_id, value)``.

    Factors that explain less than ``min_r2`` (a share, so 0.001 is 0.1 %) of
    every view are dropped.
    """
    people = ranked(cells.select(entity).distinct(), [F.asc(entity)], name="u")
    items = ranked(cells.select("view", "feature_id").distinct(), [F.asc("view"), F.asc("feature_id")], name="i")
    people = stage(people.withColumn("u", F.col("u").cast("int")))
    items = stage(items.withColumn("i", F.col("i").cast("int")))
    coded = stage(
        cells.join(people, entity)
        .join(small_side(items), ["view", "feature_id"])
        .select("u", "i", "view", F.col("value").cast("float").alias("value"))
    )
    als = ALS(
        rank=factors, maxIter=max_iter, regParam=reg, userCol="u", itemCol="i", ratingCol="value",
        seed=seed, checkpointInterval=5,
    ).fit(coded)
    z = stage(als.userFactors.select(F.col("id").alias("u"), F.col("features").cast("array<double>").alias("z")))
    w = stage(als.itemFactors.select(F.col("id").alias("i"), F.col("features").cast("array<double>").alias("w")))

    to_z, to_w = _rotations(_gram(z, "z", factors), _gram(w, "w", factors))
    z = z.withColumn("z", _rotate("z", to_z))
    w = w.withColumn("w", _rotate("w", to_w))

    fitted = coded.join(z, "u").join(small_side(w), "i")
    r2 = stage(variance_explained(fitted, factors))
    live = [
        r.factor
        for r in r2.groupBy("factor").agg(F.max("r2").alias("top")).where(F.col("top") >= 100 * min_r2)
        .orderBy("factor").collect()
    ]
    renumber = {old: new for new, old in enumerate(live, 1)}
    keep = F.array(*[F.lit(f) for f in live])

    def chosen(column: str) -> Column:
        return F.transform(keep, lambda p: F.element_at(F.col(column), p))

    mapping = F.create_map(*[F.lit(v) for pair in renumber.items() for v in pair])
    return FactorModel(
        scores=people.join(z, "u").select(entity, chosen("z").alias("scores")),
        loadings=items.join(w, "i").select("view", "feature_id", chosen("w").alias("loadings")),
        r2=r2.where(F.col("factor").isin(live)).withColumn("factor", mapping[F.col("factor")]),
        factors=len(live),
    )


def _gram(df: DataFrame, column: str, k: int) -> np.ndarray:
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    sums = df.agg(
        *[F.sum(F.get(column, F.lit(a)) * F.get(column, F.lit(b))).alias(f"s{a}_{b}") for a, b in pairs]
    ).first()
    gram = np.zeros((k, k))
    for (a, b), value in zip(pairs, sums):
        gram[a, b] = gram[b, a] = value or 0.0
    return gram


def _rotations(gz: np.ndarray, gw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """k x k maps that leave Z W' unchanged and make both sides orthogonal."""
    values, vectors = np.linalg.eigh(gz)
    values = np.maximum(values, 1e-12)
    root = vectors * np.sqrt(values) @ vectors.T
    inverse = vectors / np.sqrt(values) @ vectors.T
    _, turn = np.linalg.eigh(root @ gw @ root)
    turn = turn[:, ::-1]  # largest explained part first
    return inverse @ turn, root @ turn


def _rotate(column: str, matrix: np.ndarray) -> Column:
    lines = [
        F.aggregate(
            F.zip_with(F.col(column), F.array(*[F.lit(float(v)) for v in matrix[:, j]]), lambda x, m: x * m),
            F.lit(0.0),
            lambda a, v: a + v,
        )
        for j in range(matrix.shape[1])
    ]
    return F.array(*lines)


def score_columns(scores: DataFrame, factors: int, entity: str = "patient_id") -> DataFrame:
    return scores.select(
        entity, *[F.get("scores", F.lit(i)).alias(f"factor_{i + 1}") for i in range(factors)]
    )


def loading_rows(loadings: DataFrame) -> DataFrame:
    """``(view, factor, feature, loading)``."""
    return loadings.select(
        "view", F.col("feature_id").alias("feature"), F.posexplode("loadings").alias("k", "loading")
    ).select("view", (F.col("k") + 1).alias("factor"), "feature", "loading")


def factor_scatter(scores: DataFrame, labels: DataFrame, label: str, entity: str = "patient_id") -> DataFrame:
    """First two factors with label and the label's number of rows."""
    joined = scores.join(labels.where(F.col(label).isNotNull()).select(entity, label), entity)
    sizes = small_side(stage(joined.groupBy(label).agg(F.count("*").alias("n_label"))))
    return joined.join(sizes, label).select(entity, label, "factor_1", "factor_2", "n_label")
