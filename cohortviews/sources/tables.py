"""Stored long tables: ``<root>/<project>/<modality>.parquet``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortviews.functions.ids import short_cohort
from cohortviews.functions.values import nan_to_null
from cohortviews.sources import folders

#: Feature and value column of each measurement modality.
MEASUREMENT_COLUMNS = {
    "rna_seq": ("gene_id", "fpkm_uq_unstranded"),
    "methylation": ("probe_id", "beta_value"),
    "rppa": ("peptide_target", "protein_expression"),
    "mirna": ("mirna_id", "reads_per_million_mirna_mapped"),
}


#: Values of one list that Parquet's reader still compares one by one; a longer list is only tested by its ends.
EXACT_LIST = 10


def cluster_columns(modality: str) -> tuple[str, ...]:
    """How the table of a modality is clustered: by feature, then by subject. Others keep the order of their files."""
    return (MEASUREMENT_COLUMNS[modality][0], "patient_id") if modality in MEASUREMENT_COLUMNS else ()


def only_features(df: DataFrame, names: Sequence[str], feature: str = "feature_id") -> DataFrame:
    """Rows of some named features, as lists short enough for the scan to skip files, row groups and pages without them.

    Meant for panels of up to some hundred names; ``select.keep_features`` takes sets that come from a table.
    """
    names = sorted(set(names))
    lists = [F.col(feature).isin(names[at : at + EXACT_LIST]) for at in range(0, len(names), EXACT_LIST)]
    return df.where(reduce(lambda a, b: a | b, lists, F.lit(False)))


def path_of(root: str, project: str, modality: str) -> str:
    return f"{root}/{project}/{modality}.parquet"


def stored(spark: SparkSession, path: str) -> bool:
    """True if a complete table is there (a failed write leaves none)."""
    return state(spark, path) == "stored"


def state(spark: SparkSession, path: str) -> str:
    """``stored``, ``absent``, ``partial`` (no mark that all was written), or ``unreadable``: marked, but no table."""
    if not folders.exists(spark, path):
        return "absent"
    if not folders.committed(spark, path):
        return "partial"
    try:
        spark.read.parquet(path)
    except Exception:  # noqa: BLE001 - a damaged file surfaces as whatever its reader raises
        return "unreadable"
    return "stored"


def read_modality(
    spark: SparkSession, root: str, modality: str, projects: Sequence[str]
) -> DataFrame:
    """Rows of all projects with their short cohort name; one scan per project."""
    parts = [
        spark.read.parquet(path_of(root, p, modality)).withColumn("cohort", short_cohort(F.lit(p)))
        for p in projects
    ]
    return reduce(DataFrame.unionByName, parts)


def read_measurement(
    spark: SparkSession, root: str, modality: str, projects: Sequence[str], value: str | None = None
) -> DataFrame:
    """Canonical ``(cohort, patient_id, feature_id, value)``, NaN as null."""
    feature, default = MEASUREMENT_COLUMNS[modality]
    return read_modality(spark, root, modality, projects).select(
        "cohort",
        "patient_id",
        F.col(feature).alias("feature_id"),
        nan_to_null(F.col(value or default)).alias("value"),
    )
