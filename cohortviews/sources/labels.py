"""Published label tables: a TSV with drifting headers, and saved JSON replies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortviews import dims, schemas
from cohortviews.functions.ids import patient_of_sample
from cohortviews.operators.labels import (
    blank_labels,
    columns_with_prefix,
    first_per_entity,
    rename_label_columns,
)
from cohortviews.operators.reshape import quoted

ID_NAMES = ("sampleid", "pan.samplesid", "sample_id")


def read_label_table(
    spark: SparkSession, path: str, nulls: Sequence[str] = dims.LABEL_NULLS
) -> DataFrame:
    """One row per patient with its ``hoadley_*`` label columns.

    The id column is the first one with a known name; of several samples of a
    patient the first in sample order counts.
    """
    raw = spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path)
    id_column = next((c for c in raw.columns if c.lower() in ID_NAMES), None)
    if id_column is None:
        raise ValueError(f"no sample id column among {raw.columns}")
    blanked = raw.select(*[blank_labels(F.col(quoted(c)), nulls).alias(c) for c in raw.columns])
    named = rename_label_columns(blanked)
    labels = columns_with_prefix(named, ["hoadley_"])
    keyed = named.select(
        patient_of_sample(F.col(quoted(id_column))).alias("patient_id"),
        F.col(quoted(id_column)).alias("__sample"),
        *[F.col(quoted(c)) for c in labels],
    )
    return first_per_entity(keyed, "patient_id", ["__sample"]).select(
        "patient_id", *[quoted(c) for c in labels]
    )


def read_label_json(spark: SparkSession, paths: str | Sequence[str], column: str) -> DataFrame:
    """Saved label replies, an array of ``{patientId, value}`` per file.

    An empty reply gives an empty frame of the right type.
    """
    raw = spark.read.schema(schemas.LABEL_JSON).option("multiLine", True).json(paths)
    rows = raw.where(F.col("patientId").isNotNull()).select(
        F.col("patientId").alias("patient_id"), F.col("value").alias(column)
    )
    return first_per_entity(rows, "patient_id", [column])
