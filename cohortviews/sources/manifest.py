"""File manifests, destination listings and the sync plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortviews import schemas
from cohortviews.dims import MODALITY_SPECS, inline_table
from cohortviews.functions.ids import object_key, patient_of_barcode


def read_manifest(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Saved repository replies (one page of hits per file) to flat rows.

    The patient is taken from the first case; a hit without cases has none.
    """
    pages = (
        spark.read.schema(schemas.MANIFEST_JSON)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(paths)
    )
    hits = pages.select(F.explode("data.hits").alias("h"))
    return hits.select(
        F.col("h.file_id").alias("file_id"),
        F.col("h.file_name").alias("file_name"),
        patient_of_barcode(F.get("h.cases", F.lit(0))["submitter_id"]).alias("patient_id"),
    )


def select_files(
    listing: DataFrame, project: str, category: str, data_type: str, access: str = "open"
) -> DataFrame:
    """Rows of a listing with project, category, type and access as asked for."""
    return listing.where(
        (F.col("project_id") == project)
        & (F.col("data_category") == category)
        & (F.col("data_type") == data_type)
        & (F.col("access") == access)
    )


def pending_files(manifest: DataFrame, loaded: DataFrame) -> DataFrame:
    """Manifest files that are not loaded yet."""
    return manifest.join(loaded.select("file_id"), "file_id", "left_anti")


def with_modality(listing: DataFrame) -> DataFrame:
    """Files of a wanted data_category and data_type, with the modality folder they go to and whether it is a primary one.

    Folders below ``_excluded`` are kept apart from the first analysis; files of any other kind are not wanted.
    """
    specs = inline_table(listing.sparkSession, MODALITY_SPECS, "data_category string, data_type string, modality string")
    primary = ~F.col("modality").startswith("_excluded/")
    return listing.join(specs, ["data_category", "data_type"]).select(*listing.columns, "modality", primary.alias("is_primary"))


def sync_plan(manifest: DataFrame, listing: DataFrame, prefix: str = "tcga") -> DataFrame:
    """Manifest with its destination ``key`` and ``action``: skipped or to_copy.

    ``manifest`` has project_id, modality, file_id, file_name; ``listing`` has
    the keys that exist.
    """
    keyed = manifest.withColumn(
        "key", object_key(F.lit(prefix), "modality", "file_id", "file_name")
    )
    there = listing.select("key").distinct().withColumn("__there", F.lit(True))
    return keyed.join(there, "key", "left").select(
        *manifest.columns,
        "key",
        F.when(F.col("__there"), "skipped").otherwise("to_copy").alias("action"),
    )


def sync_totals(plan: DataFrame, everything: str = "__all__") -> DataFrame:
    """Counts per project and modality, per project, and overall."""
    return (
        plan.rollup("project_id", "modality")
        .agg(
            F.count("*").alias("n_files"),
            F.count_if(F.col("action") == "skipped").alias("n_skipped"),
            F.count_if(F.col("action") == "to_copy").alias("n_to_copy"),
            F.grouping_id().alias("__level"),
        )
        .select(
            F.when(F.col("__level") == 3, everything).otherwise(F.col("project_id")).alias("project_id"),
            F.when(F.col("__level") >= 1, everything).otherwise(F.col("modality")).alias("modality"),
            "n_files",
            "n_skipped",
            "n_to_copy",
        )
    )
