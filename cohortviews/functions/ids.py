"""Identifiers: barcodes, versioned feature ids, object keys, file paths."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

FILE_ID = r"[/=]([0-9a-f-]{36})/"


def patient_of_barcode(barcode: Column | str) -> Column:
    """First three dash-separated parts; shorter barcodes stay as they are."""
    return F.substring_index(barcode, "-", 3)


def patient_of_sample(sample_id: Column | str) -> Column:
    return F.substring(sample_id, 1, 12)


def base_id(feature: Column | str) -> Column:
    """Feature id without its version, i.e. the text before the first dot."""
    return F.substring_index(feature, ".", 1)


def short_cohort(project: Column | str) -> Column:
    return F.replace(F.col(project) if isinstance(project, str) else project, F.lit("TCGA-"), F.lit(""))


def object_key(*parts: Column | str) -> Column:
    return F.concat_ws("/", *parts)


def file_id_of_path(path: Column | str) -> Column:
    """The 36-character id that is a folder (or a partition value) in the path."""
    return F.regexp_extract(path, FILE_ID, 1)
