"""Marker panels against a feature ranking or a feature list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from cohortviews.functions.genome import feature_family
from cohortviews.functions.ids import base_id
from cohortviews.operators.ranking import ranked, top_per_key
from cohortviews.session import small_side


def marker_presence(panel: DataFrame, features: DataFrame, feature: str = "feature_id") -> DataFrame:
    """Panel rows with a ``present`` flag: any version of the gene is a feature."""
    present = features.select(base_id(F.col(feature)).alias("base_id")).distinct()
    flagged = present.withColumn("present", F.lit(True))
    return panel.join(flagged, "base_id", "left").select(
        "panel", "symbol", "base_id", F.coalesce("present", F.lit(False)).alias("present")
    )


def marker_coverage(panel: DataFrame, features: DataFrame, feature: str = "feature_id") -> DataFrame:
    """Per panel: size, present, missing, and the symbols of both."""
    flagged = marker_presence(panel, features, feature)
    # a group is one panel, a fixed dimension
    return flagged.groupBy("panel").agg(
        F.count("*").alias("panel_size"),
        F.count_if("present").alias("n_present"),
        F.count_if(~F.col("present")).alias("n_missing"),
        F.array_sort(F.collect_list(F.when(F.col("present"), F.col("symbol")))).alias("present"),
        F.array_sort(F.collect_list(F.when(~F.col("present"), F.col("symbol")))).alias("missing"),
    )


def annotate(
    ranking: DataFrame, panel: DataFrame, feature: str = "feature", rna_prefix: str = "ENSG"
) -> DataFrame:
    """Add ``kind``, ``label`` and ``in_panel`` for one panel.

    The label is the gene symbol for a panel gene, else the feature name.
    """
    genes = panel.groupBy("base_id").agg(F.max("symbol").alias("__symbol"))
    out = ranking.withColumns(
        {
            "kind": feature_family(F.col(feature), rna_prefix, rest="cnv"),
            "__base": base_id(F.col(feature)),
        }
    )
    match = (F.col("__base") == F.col("base_id")) & (F.col("kind") == "rna")
    return (
        out.join(small_side(genes), match, "left")
        .withColumn("label", F.coalesce("__symbol", F.col(feature)))
        .withColumn("in_panel", F.col("__symbol").isNotNull())
        .drop("__base", "base_id", "__symbol")
    )


def rank_features(scores: DataFrame, score: str, feature: str = "feature") -> DataFrame:
    """1-based rank by score, ties by name."""
    return ranked(scores, [F.desc_nulls_last(score), F.asc(feature)])


def panel_ranks(
    placed: DataFrame, panel: DataFrame, score: str, feature: str = "feature", rna_prefix: str = "ENSG"
) -> DataFrame:
    """Best rank of every panel gene; a gene outside the ranking has null."""
    best = (
        placed.where(F.col(feature).startswith(rna_prefix))
        .groupBy(base_id(F.col(feature)).alias("base_id"))
        .agg(F.min(F.struct("rank", score)).alias("__b"))
    )
    return panel.join(best, "base_id", "left").select(
        *panel.columns,
        F.col("__b")["rank"].alias("rank"),
        F.col("__b").isNotNull().alias("in_features"),
        F.col("__b")[score].alias(score),
    )


def panel_hits(
    placed: DataFrame,
    panel: DataFrame,
    cuts: Sequence[int] = (10, 25, 50),
    feature: str = "feature",
    rna_prefix: str = "ENSG",
) -> DataFrame:
    """Features of the top k that are versions of a panel gene, over panel size."""
    base = base_id(F.col(feature))
    top = placed.where((F.col("rank") <= max(cuts)) & F.col(feature).startswith(rna_prefix)).select(
        base.alias("base_id"), "rank"
    )
    sizes = panel.groupBy("panel").agg(F.count_distinct("base_id").alias("panel_size"))
    genes = panel.select("panel", "base_id").distinct()
    found = genes.join(top, "base_id").groupBy("panel").agg(
        *[F.count_if(F.col("rank") <= k).alias(f"hits_{k}") for k in cuts]
    )
    joined = sizes.join(found, "panel", "left").fillna(0, subset=[f"hits_{k}" for k in cuts])
    long = joined.select(
        "panel",
        "panel_size",
        F.explode(
            F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"hits_{k}").alias("hits")) for k in cuts])
        ).alias("__c"),
    )
    return long.select(
        "panel",
        "panel_size",
        F.col("__c.k").alias("k"),
        F.col("__c.hits").alias("hits"),
        F.coalesce(F.try_divide("__c.hits", "panel_size"), F.lit(0.0)).alias("rate"),
    )


def top_features(placed: DataFrame, k: int) -> DataFrame:
    return placed.where(F.col("rank") <= k)


def per_class_top(
    scores: DataFrame, k: int, label: str = "class", feature: str = "feature", score: str = "score"
) -> DataFrame:
    """Top k features of every class by that class's score."""
    return top_per_key(scores, [F.desc_nulls_last(score), F.asc(feature)], k, [label])
