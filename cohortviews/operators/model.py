"""Supervised jobs on Spark ML: folds, per-fold selection, refit, attributions.

Input is one row per entity: id, label code, and an array of feature values in
dictionary order. Missing cells are null and imputed from training rows only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.dims import inline_table
from cohortviews.functions.values import argmax_code
from cohortviews.operators.labels import balanced_weights
from cohortviews.operators.ranking import ranked
from cohortviews.operators.reshape import array_rows
from cohortviews.operators.select import fold_top_features
from cohortviews.session import small_side, stage, together


def stratified_folds(
    df: DataFrame, label: str, id_col: str, folds: int = 5, seed: int = 42, name: str = "fold"
) -> DataFrame:
    """Assign each row to one validation fold, shuffled inside its class.

    The shuffle is a hash of (id, seed), so folds do not depend on partitioning;
    class sizes per fold differ by at most one. Ranks are found by range
    partitioning, so one dominant class does not end up in one task.
    """
    narrow = df.select(label, id_col).distinct().withColumn("__h", F.xxhash64(F.col(id_col), F.lit(seed)))
    placed = ranked(narrow, [F.asc("__h"), F.asc(id_col)], [label], "__r")
    placed = placed.withColumn(name, ((F.col("__r") - 1) % folds).cast("int"))
    # only the fold comes back to the rows: feature arrays take no part in the ranking
    owner = placed.select(F.col(label).alias("__l"), F.col(id_col).alias("__i"), name)
    same = F.col(id_col).eqNullSafe(F.col("__i")) & F.col(label).eqNullSafe(F.col("__l"))
    return df.join(owner, same).drop("__i", "__l")


def feature_means(df: DataFrame, features: str = "features") -> list[float]:
    """Mean per array position over known values; 0 where nothing is known."""
    rows = (
        array_rows(df, features, ())
        .groupBy("position")
        .agg(F.avg(F.nanvl(F.col("value").cast("double"), F.lit(None).cast("double"))).alias("mean"))
        .collect()  # one number per feature, the size of the model's input row
    )
    means = {r.position: r["mean"] for r in rows}
    return [means.get(i) or 0.0 for i in range(max(means, default=-1) + 1)]


def filled(features: str, means: Sequence[float]) -> Column:
    known = F.transform(features, lambda x: F.nanvl(x.cast("double"), F.lit(None).cast("double")))
    return F.zip_with(known, F.lit(list(means)), lambda x, m: F.coalesce(x, m))


def sliced(features: str, positions: Sequence[int]) -> Column:
    """The chosen positions of the array, in order."""
    wanted = F.lit([p + 1 for p in positions])
    return F.transform(wanted, lambda p: F.element_at(F.col(features), p))


def _prepared(df: DataFrame, positions: Sequence[int], means: Sequence[float]) -> DataFrame:
    picked = df.withColumn("__x", sliced("features", positions))
    return picked.withColumn("vector", array_to_vector(filled("__x", means))).drop("__x")


def _weighted(train: DataFrame, label: str) -> DataFrame:
    weights = small_side(stage(balanced_weights(train, label).select(label, "weight")))
    return train.join(weights, label)


def forest(label: str, seed: int = 42, trees: int = 60, depth: int = 8) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol="vector",
        labelCol=label,
        weightCol="weight",
        probabilityCol="probability",
        numTrees=trees,
        maxDepth=depth,
        seed=seed,
        cacheNodeIds=False,
    )


def selected_positions(
    df: DataFrame, folds: int, top_n: int | None, must_keep: Sequence[int] = (), fold: str = "fold"
) -> dict[int, list[int]]:
    """Chosen array positions per held-out fold, ascending.

    One aggregate serves every fold; at most ``folds * (top_n + panel)`` numbers
    come back, which is what the fold models are built from.
    """
    spark = df.sparkSession
    cells = array_rows(df, "features", [fold], "feature_id")
    panel = inline_table(spark, [(p,) for p in must_keep], "feature_id int")
    chosen = fold_top_features(cells, folds, top_n, panel, fold)
    out: dict[int, list[int]] = {f: [] for f in range(folds)}
    for row in chosen.select(fold, "feature_id").distinct().collect():
        out[row[0]].append(row[1])
    return {f: sorted(p) for f, p in out.items()}


def cross_validate(
    df: DataFrame,
    label: str = "label",
    id_col: str = "id",
    folds: int = 5,
    top_n: int | None = None,
    must_keep: Sequence[int] = (),
    seed: int = 42,
    trees: int = 60,
    depth: int = 8,
) -> DataFrame:
    """Out-of-fold predictions: every row is predicted once, by a model that
    selected features, imputed and weighted on the other folds only.

    Columns: id, fold, actual_code, predicted_code, probabilities.
    """
    data = stage(stratified_folds(df, label, id_col, folds, seed))
    positions = selected_positions(data, folds, top_n, must_keep)

    def one_fold(k: int) -> DataFrame:
        chosen = positions[k]
        train = data.where(F.col("fold") != k)
        held = data.where(F.col("fold") == k)
        means = feature_means(train.withColumn("features", sliced("features", chosen)))
        model = forest(label, seed, trees, depth).fit(_weighted(_prepared(train, chosen, means), label))
        scored = model.transform(_prepared(held, chosen, means))
        return scored.withColumn("probabilities", vector_to_array("probability")).select(
            id_col,
            "fold",
            F.col(label).cast("int").alias("actual_code"),
            argmax_code(F.col("probabilities")).alias("predicted_code"),
            "probabilities",
        )

    parts = together(*[partial(one_fold, k) for k in range(folds)])
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def final_model(
    df: DataFrame,
    label: str = "label",
    top_n: int | None = None,
    must_keep: Sequence[int] = (),
    seed: int = 42,
    trees: int = 60,
    depth: int = 8,
):
    """Refit on all rows: ``(model, positions, means)``."""
    # a second, empty fold makes every row a training row of held-out fold 1
    positions = selected_positions(df.withColumn("fold", F.lit(0)), 2, top_n, must_keep)[1]
    means = feature_means(df.withColumn("features", sliced("features", positions)))
    model = forest(label, seed, trees, depth).fit(_weighted(_prepared(df, positions, means), label))
    return model, positions, means


def importances(spark, model, positions: Sequence[int], names: DataFrame | None = None) -> DataFrame:
    """Importances, largest first; ``names`` is ``(ordinal, feature_id)``."""
    vector = model.featureImportances
    rows = [(int(p), float(vector[i])) for i, p in enumerate(positions)]
    table = inline_table(spark, rows, "ordinal int, importance double")
    if names is not None:
        table = table.join(names, "ordinal")
    return table.orderBy(F.desc("importance"), F.asc("ordinal"))


def linear_attribution(
    df: DataFrame, label: str = "label", reg: float = 0.01, max_iter: int = 50
) -> DataFrame:
    """``(position, class, mean_abs)`` of a multinomial logistic model.

    A feature contributes coef * (x - mean) to a class score, so its mean
    magnitude is |coef| times the feature's mean absolute deviation: one
    aggregate per feature, nothing per row and class.
    """
    means = feature_means(df)
    ready = _weighted(_prepared(df, range(len(means)), means), label)
    fitted = LogisticRegression(
        featuresCol="vector", labelCol=label, weightCol="weight", regParam=reg,
        maxIter=max_iter, family="multinomial",
    ).fit(ready)
    coefficients = fitted.coefficientMatrix.toArray()
    table = df.sparkSession.createDataFrame(
        [(int(c), int(f), float(v)) for c, line in enumerate(coefficients) for f, v in enumerate(line)],
        "class int, position int, coefficient double",
    )
    centred = df.select(
        F.zip_with(filled("features", means), F.lit(list(means)), lambda x, m: F.abs(x - m)).alias("d")
    )
    spread = array_rows(centred, "d", ()).groupBy("position").agg(F.avg("value").alias("mad"))
    return table.join(spread, "position").select(
        "position", "class", (F.abs("coefficient") * F.col("mad")).alias("mean_abs")
    )


def permutation_importance(
    df: DataFrame,
    model,
    positions: Sequence[int],
    means: Sequence[float],
    label: str = "label",
    id_col: str = "id",
    seed: int = 7,
) -> DataFrame:
    """Loss of accuracy when one feature is taken from another row.

    Every row gets one donor: its neighbour in a hashed order, found on ids alone. One scoring pass makes a row for each
    feature, with that feature from the donor, on the way to a two-phase average; nothing is stored for each feature.
    """
    ready = stage(
        _prepared(df, positions, means).select(id_col, F.col(label).alias("y"), vector_to_array("vector").alias("x"))
    )
    order = [F.asc(F.xxhash64(F.col(id_col), F.lit(seed))), F.asc(id_col)]
    placed = stage(ranked(ready.select(id_col), order, name="r"))
    n = placed.count()
    after = placed.select(F.col(id_col).alias("__donor"), F.when(F.col("r") == 1, n).otherwise(F.col("r") - 1).alias("r"))
    donors = ready.select(F.col(id_col).alias("__donor"), F.col("x").alias("d"))
    paired = ready.join(placed.join(after, "r").drop("r"), id_col).join(donors, "__donor")
    each = paired.select("y", "x", "d", F.explode(F.sequence(F.lit(-1), F.lit(len(positions) - 1))).alias("at"))
    swapped = F.transform("x", lambda v, i: F.when(i == F.col("at"), F.get("d", i)).otherwise(v))
    scored = model.transform(each.select("y", "at", array_to_vector(swapped).alias("vector")))
    accuracy = scored.groupBy("at").agg(F.avg((F.col("prediction") == F.col("y")).cast("double")).alias("accuracy"))
    rows = {r["at"]: r.accuracy for r in accuracy.collect()}  # one row for each feature, and the unchanged one
    table = [(int(p), rows[-1] - rows[i]) for i, p in enumerate(positions)] if rows else []
    return inline_table(df.sparkSession, table, "ordinal int, accuracy_loss double")
