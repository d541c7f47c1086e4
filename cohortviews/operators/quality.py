"""Missingness gates, post-conditions and reconciliation.

All rates come from the long cells and a roster: a cell that is absent and a
cell that is null are the same thing, so denominators are roster counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from cohortviews.functions.values import gap_marker, known
from cohortviews.session import small_side


def require_rows(df: DataFrame, what: str) -> DataFrame:
    if df.isEmpty():
        raise RuntimeError(f"{what} has no rows")
    return df


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, keys: Sequence[str], what: str) -> DataFrame:
    """Raise on a repeated key; reads the key columns only."""
    if not duplicate_keys(df.select(*keys), keys).isEmpty():
        raise RuntimeError(f"{what} repeats {', '.join(keys)}")
    return df


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def require_numeric(df: DataFrame, columns: Sequence[str]) -> None:
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, T.NumericType)]
    if wrong:
        raise ValueError(f"features must be numeric: {wrong}")


def require_rate(rate: float) -> None:
    if not 0 <= rate < 1:
        raise ValueError("max_missing_rate must be in [0, 1)")


def missing_rates(
    cells: DataFrame, entities: DataFrame, features: DataFrame | None = None, feature: str = "feature_id"
) -> DataFrame:
    """``(feature, n_observed, missing_rate)`` over a roster of entities.

    ``cells`` holds each (entity, feature) once and only roster entities.
    ``features`` adds those without any cell.
    """
    observed = cells.groupBy(feature).agg(F.count_if(known(F.col("value"))).alias("n_observed"))
    if features is not None:
        observed = (
            features.select(feature)
            .distinct()
            .join(observed, feature, "left")
            .fillna(0, subset=["n_observed"])
        )
    people = entities.agg(F.count("*").alias("n")).scalar()
    return observed.withColumn("missing_rate", 1 - F.try_divide("n_observed", people))


def missing_summary(rates: DataFrame) -> DataFrame:
    """One row: features, mean, 90th percentile, share of all-missing features."""
    return rates.agg(
        F.count("*").alias("n_features"),
        F.avg("missing_rate").alias("mean_rate"),
        F.percentile("missing_rate", F.lit(0.9)).alias("p90_rate"),
        F.avg(F.when(F.col("n_observed") == 0, 1.0).otherwise(0.0)).alias("share_all_missing"),
    )


def _observed(cells: DataFrame, keys: Sequence[str], features: DataFrame | None, feature: str) -> DataFrame:
    """``(feature, n_observed, n_groups)``: values, and groups that have any.

    One pass over the cells; features without any value are counted as such.
    ``features`` adds those that have no cell at all.
    """
    per_group = cells.groupBy(*keys).agg(F.count_if(known(F.col("value"))).alias("n"))
    per_feature = per_group.groupBy(feature).agg(
        F.sum("n").alias("n_observed"), F.count_if(F.col("n") > 0).alias("n_groups")
    )
    if features is None:
        return per_feature
    every = features.select(feature).distinct()
    return every.join(per_feature, feature, "left").fillna(0, subset=["n_observed", "n_groups"])


def structurally_missing(
    cells: DataFrame,
    cohorts: DataFrame,
    features: DataFrame | None = None,
    feature: str = "feature_id",
    cohort: str = "cohort",
) -> DataFrame:
    """Features without any value in at least one cohort."""
    total = cohorts.agg(F.count_distinct(cohort).alias("n")).scalar()
    found = _observed(cells, [feature, cohort], features, feature)
    return found.where(F.col("n_groups") < total).select(feature)


def gate_features(
    cells: DataFrame,
    roster: DataFrame,
    features: DataFrame | None,
    max_missing_rate: float,
    structural: bool = True,
    feature: str = "feature_id",
    cohort: str = "cohort",
) -> DataFrame:
    """``(feature, status)``: structural, sparse or kept.

    Structural gaps are judged first; the sparse gate drops rates strictly above
    the threshold. Both come from one aggregate per (feature, cohort).
    """
    require_rate(max_missing_rate)
    found = _observed(cells, [feature, cohort] if structural else [feature], features, feature)
    people = roster.agg(F.count("*").alias("n")).scalar()
    rate = 1 - F.try_divide("n_observed", people)
    status = F.when(rate > max_missing_rate, "sparse").otherwise("kept")
    if structural:
        groups = roster.agg(F.count_distinct(cohort).alias("n")).scalar()
        status = F.when(F.col("n_groups") < groups, "structural").otherwise(status)
    return found.select(feature, status.alias("status"))


def view_gate(rates: DataFrame, config: DataFrame) -> DataFrame:
    """Per-view threshold: adds ``kept`` to ``(view, feature, missing_rate)``."""
    return rates.join(small_side(config), "view").withColumn(
        "kept", F.col("missing_rate") <= F.col("max_missing")
    )


def view_gate_counts(gated: DataFrame) -> DataFrame:
    return gated.groupBy("view", "likelihood", "max_missing").agg(
        F.count("*").alias("n_in"),
        F.count_if("kept").alias("n_kept"),
        F.count_if(~F.col("kept")).alias("n_dropped"),
    )


def reconcile(
    expected: DataFrame,
    stored: DataFrame,
    keys: Sequence[str] = ("cohort", "modality"),
    entity: str = "patient_id",
) -> DataFrame:
    """Distinct entities expected and stored per key, with difference and mark.

    A key with nothing stored is ``MISSING``; keys only the store has are kept.
    """
    want = expected.groupBy(*keys).agg(F.count_distinct(entity).alias("n_expected"))
    have = stored.groupBy(*keys).agg(F.count_distinct(entity).alias("n_stored"))
    both = want.join(have, list(keys), "full_outer")
    difference = F.coalesce("n_stored", F.lit(0)) - F.coalesce("n_expected", F.lit(0))
    return both.select(
        *keys,
        F.coalesce("n_expected", F.lit(0)).alias("n_expected"),
        F.coalesce("n_stored", F.lit(0)).alias("n_stored"),
        difference.alias("difference"),
        F.when(F.col("n_stored").isNull(), "MISSING").otherwise(gap_marker(difference)).alias("mark"),
    )
