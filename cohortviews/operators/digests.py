"""Reconciliation by digests: two tables are compared row by row only where their digests differ.

A branch is a key (a project's modality) and a slice of its rows by the hash of their id. Its digest does not depend on
order: the number of rows, the sum and the exclusive or of two 64-bit hashes. A side can store its tree with the table,
so a later comparison reads two small tables first, then only the rows of unequal branches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.session import small_side, stage

DIGEST = ("n", "added", "mixed")


def _slice(ids: Sequence[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("slice"), *ids), F.lit(1 << bits)).cast("int")


def _row(ids: Sequence[str], values: Sequence[str], seed: str) -> Column:
    """Hash of a row; a null has a place of its own, so that shifted nulls are seen."""
    names = [*ids, *values]
    return F.xxhash64(F.lit(seed), *names, *[F.col(c).isNull() for c in names])


def digest_tree(rows: DataFrame, keys: Sequence[str], ids: Sequence[str], values: Sequence[str] = (), bits: int = 8) -> DataFrame:
    """``(keys, slice, n, added, mixed)``: one two-phase aggregate, ``2 ** bits`` rows for each key."""
    return rows.groupBy(*keys, _slice(ids, bits).alias("slice")).agg(
        F.count("*").alias("n"),
        F.sum(_row(ids, values, "added").cast("decimal(20,0)")).alias("added"),
        F.bit_xor(_row(ids, values, "mixed")).alias("mixed"),
    )


def rolled_digests(tree: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Digests of whole keys, or of coarser ones, from a tree."""
    return tree.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("added").alias("added"), F.bit_xor("mixed").alias("mixed"))


def unequal(expected: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose digests differ, or that one side lacks; both sides are trees or rolled digests."""

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(*keys, F.struct(*DIGEST).alias(name))

    both = side(expected, "e").join(side(stored, "s"), list(keys), "full_outer")
    return both.where(~F.col("e").eqNullSafe(F.col("s"))).select(*keys)


def unequal_branches(expected_tree: DataFrame, stored_tree: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, slice)`` of unequal branches; slices are only looked at below unequal keys."""
    top = small_side(stage(unequal(rolled_digests(expected_tree, keys), rolled_digests(stored_tree, keys), keys), "unequal"))
    below = [t.join(top, list(keys), "left_semi") for t in (expected_tree, stored_tree)]
    return unequal(*below, [*keys, "slice"])


def differences(
    expected: DataFrame,
    stored: DataFrame,
    expected_tree: DataFrame,
    stored_tree: DataFrame,
    keys: Sequence[str],
    ids: Sequence[str],
    values: Sequence[str] = (),
    bits: int = 8,
) -> DataFrame:
    """``(keys, ids, mark, n_expected, n_stored)`` of the rows that differ: MISSING, EXTRA, CHANGED or REPEATED.

    Trees must have been made with the same ``ids``, ``values`` and ``bits``. Rows are those of unequal branches alone:
    MISSING has no stored row, EXTRA no expected one, CHANGED other values, REPEATED the same values another number of
    times. Keys and ids must not be null.
    """
    branches = small_side(stage(unequal_branches(expected_tree, stored_tree, keys), "branches"))
    names = [*keys, *ids]

    def opened(df: DataFrame, n: str, told: str) -> DataFrame:
        part = df.withColumn("slice", _slice(ids, bits)).join(branches, [*keys, "slice"], "left_semi")
        # equal rows meet equal digests, whatever their order
        seen = [F.min(_row(ids, values, s)).alias(f"a_{s}") for s in ("added", "mixed")]
        seen += [F.max(_row(ids, values, s)).alias(f"z_{s}") for s in ("added", "mixed")]
        each = part.groupBy(*names).agg(F.count("*").alias(n), F.sum(_row(ids, values, "added").cast("decimal(20,0)")).alias("t"), *seen)
        return each.select(*names, n, F.struct("t", *[f"{e}_{s}" for s in ("added", "mixed") for e in "az"]).alias(told))

    both = opened(expected, "n_expected", "e").join(opened(stored, "n_stored", "s"), names, "full_outer")
    same_values = reduce(Column.__and__, [F.col(f"e.{e}_{s}") == F.col(f"s.{e}_{s}") for s in ("added", "mixed") for e in "az"])
    mark = (
        F.when(F.col("s").isNull(), "MISSING").when(F.col("e").isNull(), "EXTRA")
        .when(same_values & (F.col("n_expected") != F.col("n_stored")), "REPEATED").otherwise("CHANGED")
    )
    n = [F.coalesce(c, F.lit(0)).alias(c) for c in ("n_expected", "n_stored")]
    return both.where(~F.col("e").eqNullSafe(F.col("s"))).select(*names, mark.alias("mark"), *n)
