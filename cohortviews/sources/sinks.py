"""Writers. Post-conditions are checked on what was written, not by a second run
of the plan that produced it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame

from cohortviews.operators.quality import require_unique
from cohortviews.sources import folders


def clustered(df: DataFrame, by: Sequence[str], folders_by: Sequence[str] = ()) -> DataFrame:
    """Rows in ranges of ``by`` inside each folder, sorted, so that files, row groups and pages hold few values each.

    End ``by`` with the entity: a feature with a third of all rows then spreads over many ranges.
    """
    order = [*folders_by, *by]
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _writer(df: DataFrame, by: Sequence[str] = ()):
    """Parquet writer; the first clustering column also gets a bloom filter in each row group."""
    writer = df.write.option("compression", "snappy")
    return writer.option(f"parquet.bloom.filter.enabled#{by[0]}", "true") if by else writer


def write_long(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("cohort", "modality"), cluster_by: Sequence[str] = ()
) -> str:
    """Long table, partitioned by folder; clustered inside each, or else in files that follow the plan's partitions."""
    rows = clustered(df, cluster_by, partition_by) if cluster_by else df
    _writer(rows, cluster_by).mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_table(
    df: DataFrame,
    path: str,
    unique: Sequence[str] = (),
    what: str = "result",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> int:
    """Rows of a table that is written once, checked, and only then put at its place.

    Raises on no rows or a repeated key; what was there before stays then. Rows are counted by the footers of the written
    files, keys are read back from them. (An observed count never arrives if the optimiser finds the plan to be empty.)
    ``tables.state`` knows a table by the mark that is written last.
    """
    spark = df.sparkSession
    new, writer = folders.beside(path), _writer(clustered(df, cluster_by, partition_by) if cluster_by else df, cluster_by)
    try:
        writer.partitionBy(*partition_by).parquet(new) if partition_by else writer.parquet(new)
        written = spark.read.schema(df.schema).parquet(new)
        rows = written.count()
        if rows == 0:
            raise RuntimeError(f"{what} has no rows")
        if unique:
            require_unique(written, unique, what)
        folders.commit(spark, new, path)
    except BaseException:
        folders.remove(spark, new)
        raise
    return rows


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_ledger(errors: DataFrame, path: str) -> bool:
    """CSV of the error ledger, only if there are errors; without any, that of an earlier run goes."""
    if errors.isEmpty():
        folders.remove(errors.sparkSession, path)
        return False
    write_csv(errors, path)
    return True


def manifest_row(df: DataFrame, parts: Mapping[str, Column]) -> DataFrame:
    """One row of nested values, to be written as a JSON document."""
    return df.agg(*[c.alias(n) for n, c in parts.items()])


def write_json(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").json(path)
    return path
