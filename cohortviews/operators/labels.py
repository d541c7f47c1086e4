"""External labels: joins, remaps, codes, audit counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.functions.values import remap
from cohortviews.operators.ranking import ordinals
from cohortviews.session import small_side, stage

NULL_LABEL = "__null__"


def first_per_entity(df: DataFrame, entity: str, order: Sequence[str]) -> DataFrame:
    """The first row of every entity in the given order.

    An aggregate (minimum of a struct), so tasks combine before the shuffle and
    an entity with very many rows is no burden.
    """
    rest = [c for c in df.columns if c != entity and c not in order]
    first = F.min(F.struct(*order, *rest))
    return df.groupBy(entity).agg(first.alias("__r")).select(
        *[F.col(c) if c == entity else F.col("__r")[c].alias(c) for c in df.columns]
    )


def join_labels(base: DataFrame, sources: Sequence[DataFrame], entity: str = "patient_id") -> DataFrame:
    """Left join of any number of one-row-per-entity label tables."""
    return reduce(lambda left, right: left.join(right, entity, "left"), sources, base)


def label_codes(df: DataFrame, label: str, code: str) -> DataFrame:
    """``(label, code)``: 0-based codes in label order, over the class vocabulary."""
    classes = df.select(label).where(F.col(label).isNotNull()).distinct()
    return ordinals(classes, [F.asc(label)], code)


def with_codes(df: DataFrame, label: str, code: str) -> DataFrame:
    return df.join(small_side(stage(label_codes(df, label, code))), label)


def labels_of_type(
    labels: DataFrame, label: str, cancer_type: str, rules: Mapping[str, str] | None = None
) -> DataFrame:
    """Labels with the type prefix (null labels drop out), rare classes folded."""
    picked = labels.where(F.col(label).startswith(cancer_type))
    return picked.withColumn(label, remap(F.col(label), rules or {}))


def label_long(audit: DataFrame, sources: Sequence[str], cohort: str = "cohort") -> DataFrame:
    """``(cohort, source, label)``, one row per entity and source."""
    typed = audit.select(cohort, *[F.col(s).cast("string").alias(s) for s in sources])
    return typed.unpivot([cohort], list(sources), "source", "label")


def label_counts(audit: DataFrame, sources: Sequence[str], cohort: str = "cohort") -> DataFrame:
    """Count per (cohort, source, label); a null label counts as ``__null__``."""
    return (
        label_long(audit, sources, cohort)
        .groupBy(cohort, "source", F.coalesce("label", F.lit(NULL_LABEL)).alias("label"))
        .agg(F.count("*").alias("n"))
    )


def label_totals(audit: DataFrame, sources: Sequence[str], cohort: str = "cohort") -> DataFrame:
    """Entities with and without a label per (cohort, source)."""
    return (
        label_long(audit, sources, cohort)
        .groupBy(cohort, "source")
        .agg(
            F.count("*").alias("n_entities"),
            F.count("label").alias("n_labeled"),
            F.count_if(F.col("label").isNull()).alias("n_unlabeled"),
        )
    )


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """``(label, n, weight)`` with weight = rows / (classes * class rows)."""
    counts = class_counts(df, label)
    total = counts.agg(F.sum("n").alias("rows"), F.count("*").alias("classes"))
    rows, classes = total.select("rows").scalar(), total.select("classes").scalar()
    return counts.withColumn("weight", rows / (classes * F.col("n")))


def rename_label_columns(df: DataFrame, prefix: str = "subtype", new: str = "hoadley_") -> DataFrame:
    """Columns starting with ``prefix`` (any case) become ``new`` + lower case."""
    return df.withColumnsRenamed(
        {c: new + c.lower() for c in df.columns if c.lower().startswith(prefix)}
    )


def columns_with_prefix(df: DataFrame, prefixes: Sequence[str]) -> list[str]:
    return [c for c in df.columns if c.startswith(tuple(prefixes))]


def only_cohort(df: DataFrame, cohort: str, column: str = "cohort") -> DataFrame:
    """Rows of the cohort if there is a cohort column, all rows otherwise."""
    return df.where(F.col(column) == cohort) if column in df.columns else df


def blank_labels(column: Column, nulls: Sequence[str]) -> Column:
    return F.when(~column.isin(list(nulls)), column)
