"""Global ranks and running totals without a single-task window.

A window over a whole table, or over one class of it, sends all those rows to a
single task. Here the rows are range-partitioned on (keys, order), each slice is
scanned on its own, and slices are shifted by the totals of the slices before
them. A key that holds a third of all rows is spread over many slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortviews.session import BROADCAST_ROWS, small_side, stage

SLICE = "__slice"


def running_totals(
    df: DataFrame,
    order: Sequence[Column],
    totals: Mapping[str, Column],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add, per output name, the sum of its column up to and including the row.

    ``order`` must be total inside a key (end it with an id).
    """
    names = list(totals)
    staged = df.withColumns({f"__v_{n}": c for n, c in totals.items()})
    staged = staged.repartitionByRange(*[F.col(k) for k in keys], *order)
    # The slice number has to survive task retries, hence the written copy.
    staged = stage(staged.withColumn(SLICE, F.spark_partition_id()), "slices")

    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(*keys, SLICE)
        .agg(*[F.sum(f"__v_{n}").alias(f"__s_{n}") for n in names])
        .select(
            *[F.col(k).alias(f"__k_{k}") for k in keys],
            F.col(SLICE).alias("__slice_of"),
            *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__o_{n}") for n in names],
        )
    )
    inside = (
        Window.partitionBy(*keys, SLICE)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = staged.withColumns({f"__l_{n}": F.sum(f"__v_{n}").over(inside) for n in names})
    same = F.col(SLICE) == F.col("__slice_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    # one row per slice and key in it: broadcast unless there are very many keys,
    # so that the rows themselves are not moved a third time
    return local.join(small_side(stage(offsets, "offsets")), same).select(
        *df.columns, *[(F.col(f"__l_{n}") + F.col(f"__o_{n}")).alias(n) for n in names]
    )


def ranked(
    df: DataFrame, order: Sequence[Column], keys: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """1-based row number in ``order``, inside each key."""
    return running_totals(df, order, {name: F.lit(1).cast("long")}, keys)


def ordinals(names: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Positions from 0 of distinct rows in ``order``.

    Vocabularies (features of a row, classes of a model) are numbered by one
    window while they are proven small, and by range partitions beyond that.
    """
    names = stage(names, "names")
    if names.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        return names.withColumn(name, (F.row_number().over(Window.orderBy(*order)) - 1).cast("long"))
    return ranked(names, order, name=name).withColumn(name, F.col(name) - 1)


def top_per_key(df: DataFrame, order: Sequence[Column], k: int, keys: Sequence[str]) -> DataFrame:
    """Rows of rank 1..k inside each key, with their rank.

    For a small k Spark cuts each task's share to k rows before the shuffle, so
    no key is ever gathered whole; past the optimiser's limit the range-based
    rank is used.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if k > limit:
        return ranked(df, order, keys).where(F.col("rank") <= k)
    window = Window.partitionBy(*keys).orderBy(*order)
    cut = df.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
    return cut.withColumn("rank", F.col("rank").cast("long"))  # as the other plan has it


def best_row(df: DataFrame, metric: str, tie: str) -> DataFrame:
    """The row with the largest metric, the smallest ``tie`` among equals."""
    return df.orderBy(F.desc_nulls_last(metric), F.asc(tie)).limit(1)
