"""Numeric rules: NaN, transforms per view, argmax, remaps."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def known(value: Column) -> Column:
    """True where a measurement is there: neither null nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def nan_to_null(value: Column) -> Column:
    return F.nanvl(value, F.lit(None).cast("double"))


def finite_or_null(value: Column) -> Column:
    return F.when(~value.isin(float("inf"), float("-inf")), nan_to_null(value))


def log2_plus_one(value: Column) -> Column:
    return F.log2(value + 1)


def m_value(beta: Column, eps: float = 1e-6) -> Column:
    """log2 odds of a beta value kept inside [eps, 1-eps]; null stays null."""
    inside = F.least(F.greatest(beta, F.lit(eps)), F.lit(1.0 - eps))
    return F.when(beta.isNotNull(), F.log2(inside / (1 - inside)))


def view_transform(view: Column, value: Column) -> Column:
    """Counts and expression on a log scale, beta as M-value, the rest as it is."""
    return (
        F.when(view.isin("RNA", "miRNA"), log2_plus_one(value))
        .when(view == "methylation", m_value(value))
        .otherwise(value.cast("double"))
    )


def argmax_code(probabilities: Column) -> Column:
    """Zero-based position of the largest entry, the first one on a tie."""
    return (F.array_position(probabilities, F.array_max(probabilities)) - 1).cast("int")


def remap(label: Column, mapping: Mapping[str, str]) -> Column:
    out = label
    for old, new in mapping.items():
        out = F.when(label == old, new).otherwise(out)
    return out


def pick_by_cohort(cohort: Column, sources: Mapping[str, Column]) -> Column:
    """The label column that belongs to the row's cohort, null for other cohorts."""
    out = F.lit(None)
    for name, column in sources.items():
        out = F.when(cohort == name, column).otherwise(out)
    return out


def gap_marker(difference: Column) -> Column:
    return F.when(difference < 0, " gap").when(difference > 0, " +").otherwise("")


def coverage_floor(entities: Column, fraction: float) -> Column:
    """max(1, n * fraction) with half-even rounding."""
    return F.greatest(F.lit(1.0), F.bround(entities * F.lit(float(fraction)))).cast("long")
