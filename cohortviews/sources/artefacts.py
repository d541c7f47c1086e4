"""Readers of the artefacts that earlier runs left behind."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

_SCORE = "struct<mean: double, std: double>"
METRICS = (
    f"task string, n_classes int, cv_scores struct<accuracy: {_SCORE}, "
    f"balanced_accuracy: {_SCORE}, macro_f1: {_SCORE}, log_loss: {_SCORE}>"
)
_HITS = "struct<panel_size: bigint, hits: bigint, rate: double>"
PANEL_REPORT = (
    f"cancer string, panel_size bigint, n_features_ranked bigint, "
    f"hits_top10 {_HITS}, hits_top25 {_HITS}, hits_top50 {_HITS}"
)
#: What is read from a line of the factor model's training log, each field by the name that stands before it.
LOG_FIELDS = {
    "iteration": (r"^Iteration (\d+):", "int"),
    "elbo": (r"\bELBO=(\S+?)(?:,|$)", "double"),
    "delta_percent": (r"\(([^()]+)%\)", "double"),
    "factors": (r"\bFactors=(\d+)", "int"),
}


def read_csv_table(spark: SparkSession, paths: str | Sequence[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(paths)


def read_metrics(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Mean and deviation of the three headline scores, one row per run."""
    runs = spark.read.schema(METRICS).option("multiLine", True).json(paths)
    scores = ["accuracy", "balanced_accuracy", "macro_f1"]
    return runs.select(
        "task",
        "n_classes",
        *[F.col(f"cv_scores.{s}.mean").alias(s) for s in scores],
        *[F.col(f"cv_scores.{s}.std").alias(f"{s}_std") for s in scores],
    )


def read_panel_reports(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    runs = spark.read.schema(PANEL_REPORT).option("multiLine", True).json(paths)
    return runs.select(
        "cancer", "panel_size", *[F.col(f"hits_top{k}.hits").alias(f"top{k}") for k in (10, 25, 50)]
    )


def read_training_log(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(iteration, elbo, delta_percent, factors)``; lines that lack a field are dropped."""
    lines = spark.read.text(paths)
    fields = [F.regexp_substr("value", F.lit(p)).isNotNull() for p, _ in LOG_FIELDS.values()]
    whole = lines.where(reduce(Column.__and__, fields))
    return whole.select(*[F.regexp_extract("value", p, 1).try_cast(kind).alias(name) for name, (p, kind) in LOG_FIELDS.items()])
