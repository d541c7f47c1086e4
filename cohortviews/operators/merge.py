"""Inner merges of views: a row for every entity that all views know."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortviews.operators.reshape import quoted


def inner_merge(views: Mapping[str, DataFrame], keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Join one-row-per-entity views; every view array becomes a column.

    Each view comes out of a grouping on the keys, so the joins reuse that
    partitioning and move nothing.
    """
    named = [df.select(*keys, F.col("values").alias(name)) for name, df in views.items()]
    return reduce(lambda left, right: left.join(right, list(keys)), named)


def inner_merge_wide(tables: Sequence[DataFrame], keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """The same for tables that are wide already."""
    return reduce(lambda left, right: left.join(right, list(keys)), tables)


def stack_cohorts(tables: Sequence[DataFrame]) -> DataFrame:
    """Union by name; a column one table lacks is null there, types are widened."""
    kinds: dict[str, str] = {}
    for table in tables:
        for name, kind in table.dtypes:
            known = kinds.get(name)
            if known is None or known == "void":
                kinds[name] = kind
            elif known != kind and kind != "void":
                kinds[name] = _wider(known, kind)
    aligned = [
        t.select([F.col(quoted(c)).cast(kinds[c]).alias(c) for c in t.columns]) for t in tables
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), aligned)


_NUMERIC = ["tinyint", "smallint", "int", "bigint", "float", "double"]


def _wider(a: str, b: str) -> str:
    if a in _NUMERIC and b in _NUMERIC:
        if {a, b} == {"bigint", "float"}:
            return "double"
        return _NUMERIC[max(_NUMERIC.index(a), _NUMERIC.index(b))]
    return "string"


def in_every_view(
    roster: DataFrame, n_views: int, entity: str = "patient_id", view: str = "modality"
) -> DataFrame:
    """Entities of the roster that occur in all views."""
    return (
        roster.groupBy(entity)
        .agg(F.count_distinct(view).alias("n"))
        .where(F.col("n") == n_views)
        .select(entity)
    )


def coverage_funnel(
    roster: DataFrame, entity: str = "patient_id", view: str = "modality"
) -> DataFrame:
    """Entities per view, and ``n_views >= k`` down to the full intersection.

    ``step`` is a view name or ``in_k_views``; the last step of the second kind
    is the intersection.
    """
    pairs = roster.select(entity, view).distinct()
    per_view = pairs.groupBy(view).agg(F.count("*").alias("n_entities")).select(
        F.col(view).alias("step"), "n_entities"
    )
    depth = pairs.groupBy(entity).agg(F.count("*").cast("int").alias("k"))
    at_least = (
        depth.select(F.explode(F.sequence(F.lit(1), F.col("k"))).alias("k"))
        .groupBy("k")
        .agg(F.count("*").alias("n_entities"))
        .select(F.format_string("in_%d_views", "k").alias("step"), "n_entities")
    )
    return per_view.unionByName(at_least)


def modality_volume(
    rows: DataFrame, entity: str = "patient_id", view: str = "modality", file: str | None = None
) -> DataFrame:
    """Rows, entities and, if there is a file column, files per modality.

    Counting per (modality, entity) first gives both numbers from one scan.
    """

    def sizes(column: str, name: str) -> DataFrame:
        each = rows.groupBy(view, column).agg(F.count("*").alias("n"))
        return each.groupBy(view).agg(
            F.sum("n").alias("n_rows"), F.count(column).alias(name)
        )

    out = sizes(entity, "n_entities")
    if file is not None:
        out = out.join(sizes(file, "n_files").drop("n_rows"), view)
    return out
