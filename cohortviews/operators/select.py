"""Feature selection on the long table: one aggregate, state per feature only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.functions.ids import base_id
from cohortviews.functions.values import coverage_floor, finite_or_null, known, nan_to_null
from cohortviews.operators.ranking import ranked
from cohortviews.session import small_side, stage

ENTITY = "patient_id"
FEATURE = "feature_id"
VALUE = "value"


def entity_count(df: DataFrame, entity: str = ENTITY) -> DataFrame:
    """One row: distinct entities over all rows, null measurements included."""
    return df.agg(F.count_distinct(entity).alias("n_entities"))


def variance(value: Column, ddof: int) -> Column:
    return F.var_pop(value) if ddof == 0 else F.var_samp(value)


def feature_statistics(
    df: DataFrame,
    feature: str = FEATURE,
    value: str = VALUE,
    entity: str = ENTITY,
    ddof: int = 0,
    distinct_entities: bool = False,
) -> DataFrame:
    """``(feature, n_obs, variance)`` of every feature that occurs.

    ``n_obs`` counts rows with a value, so duplicate samples count twice; with
    ``distinct_entities`` an entity counts once. NaN counts as no value.
    """
    x = nan_to_null(F.col(value))
    df = df.where(F.col(feature).isNotNull())
    spread = df.groupBy(feature).agg(F.count(x).alias("n_obs"), variance(x, ddof).alias("variance"))
    if not distinct_entities:
        return spread
    covered = (
        df.where(known(F.col(value)))
        .groupBy(feature)
        .agg(F.count_distinct(entity).alias("n_obs"))
    )
    return (
        spread.drop("n_obs")
        .join(covered, feature, "left")
        .select(feature, F.coalesce("n_obs", F.lit(0)).alias("n_obs"), "variance")
    )


def top_variance_features(
    df: DataFrame,
    n: int,
    min_coverage: float,
    must_keep: DataFrame | None = None,
    feature: str = FEATURE,
    value: str = VALUE,
    entity: str = ENTITY,
    ddof: int = 0,
    distinct_entities: bool = False,
) -> DataFrame:
    """Coverage-gated top-n by variance, plus the forced ids that exist.

    The gate comes before the ranking. ``must_keep`` holds ``base_id`` and is
    matched without version; forced features bypass the gate. Ties go to the
    smaller feature id. Returns ``(feature, n_obs, variance, forced)``, where
    ``forced`` marks features that only the panel brought in. Both parts come
    from one aggregate over the long table.
    """
    stats = feature_statistics(df, feature, value, entity, ddof, distinct_entities)
    people = entity_count(df, entity).scalar() if min_coverage > 0 else F.lit(0)
    return choose_top(stats, people, n, min_coverage, must_keep, feature)


def choose_top(
    stats: DataFrame, people: Column, n: int, min_coverage: float, must_keep: DataFrame | None = None, feature: str = FEATURE
) -> DataFrame:
    """The choice of :func:`top_variance_features` from ``(feature, n_obs, variance)`` and the number of entities."""
    if min_coverage > 0:
        floor = coverage_floor(people, min_coverage)
    else:
        floor = F.lit(1)
    top = (
        stats.where(F.col("n_obs") >= floor)
        .orderBy(F.desc_nulls_last("variance"), F.asc(feature))
        .limit(n)
        .withColumn("forced", F.lit(False))
    )
    if must_keep is None:
        return top
    # an inner join stays above the aggregate (a semi join would be pushed below
    # it and scan the long table again), so both branches share one exchange
    ids = must_keep.select("base_id").distinct()
    forced = stats.join(ids, base_id(F.col(feature)) == F.col("base_id")).select(
        *stats.columns, F.lit(True).alias("forced")
    )
    return top.unionByName(forced).groupBy(feature).agg(
        F.max("n_obs").alias("n_obs"),
        F.max("variance").alias("variance"),
        F.bool_and("forced").alias("forced"),
    )


def recurrent_features(
    df: DataFrame, min_fraction: float, feature: str = FEATURE, entity: str = ENTITY
) -> DataFrame:
    """``(feature, n_entities)`` seen in at least the given share of entities."""
    people = entity_count(df, entity).scalar()
    return (
        df.groupBy(feature)
        .agg(F.count_distinct(entity).alias("n_entities"))
        .where(F.col("n_entities") >= coverage_floor(people, min_fraction))
    )


def keep_features(df: DataFrame, chosen: DataFrame, feature: str = FEATURE) -> DataFrame:
    """Rows of the chosen features only.

    The chosen set is written once (it comes from a full scan) and broadcast if
    its size allows, so the long table is filtered where it lies.
    """
    return df.join(small_side(stage(chosen.select(feature))), feature, "left_semi")


def fold_moments(df: DataFrame, fold: str, feature: str = FEATURE, value: str = VALUE) -> DataFrame:
    """Count, mean and sum of squared deviations per (fold, feature)."""
    x = finite_or_null(F.col(value))
    return df.groupBy(fold, feature).agg(
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        (F.var_pop(x) * F.count(x)).alias("m2"),
    )


def fold_feature_variance(
    df: DataFrame, folds: int, fold: str = "fold", feature: str = FEATURE, value: str = VALUE
) -> DataFrame:
    """Sample variance per (held-out fold, feature) over the other folds' rows.

    Every row is read once: moments per fold are merged pairwise-exactly for
    each held-out fold, instead of repeating rows ``folds - 1`` times.
    """
    moments = fold_moments(df, fold, feature, value)
    held_out = F.explode(F.sequence(F.lit(0), F.lit(folds - 1)))
    training = F.when(F.col("held_out") != F.col(fold), F.struct("n", "mean", "m2"))
    merged = (
        moments.withColumn("held_out", held_out)
        .groupBy("held_out", feature)
        # at most `folds` structs per group, none for a feature that only the held-out fold has
        .agg(F.collect_list(training).alias("parts"))
    )
    present = F.filter("parts", lambda p: p["n"] > 0)
    total = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["n"])
    merged = merged.withColumns({"parts": present, "n": total})
    mean = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["n"] * p["mean"])
    merged = merged.withColumn("mean", F.try_divide(mean, F.col("n")))
    spread = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda a, p: a + p["m2"] + p["n"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")),
    )
    return merged.select(
        F.col("held_out").alias(fold),
        feature,
        F.when(F.col("n") > 1, spread / (F.col("n") - 1)).alias("variance"),
    )


def fold_top_features(
    df: DataFrame,
    folds: int,
    n: int | None,
    must_keep: DataFrame | None = None,
    fold: str = "fold",
    feature: str = FEATURE,
    value: str = VALUE,
) -> DataFrame:
    """``(fold, feature, variance)`` chosen on training rows, per held-out fold.

    No n, or n not above zero, keeps every feature; so does an n as large as the
    feature count. Features without any value rank last. ``must_keep`` holds
    feature names that are added whatever their rank.
    """
    spread = fold_feature_variance(df, folds, fold, feature, value)
    if n is None or n <= 0:
        return spread
    order = [F.desc_nulls_last("variance"), F.asc(feature)]
    placed = ranked(spread, order, [fold])
    keep = F.col("rank") <= n
    if must_keep is not None:
        names = must_keep.select(F.col(feature).alias("__forced")).distinct()
        placed = placed.join(names, F.col(feature) == F.col("__forced"), "left")
        keep = keep | F.col("__forced").isNotNull()
    return placed.where(keep).select(fold, feature, "variance")


def forbid_columns(features: Sequence[str], forbidden: Sequence[str]) -> None:
    """Raise if an id or target column slipped into the feature list."""
    leaked = sorted(set(features) & set(forbidden))
    if leaked:
        raise ValueError(f"forbidden columns among the features: {leaked}")
