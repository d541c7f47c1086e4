"""Chromosomes, arms and the view a feature belongs to."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ARM = r"^([0-9]+|X)[pq]$"


def canonical_chromosome(chromosome: Column) -> Column:
    """``chr`` in front unless it is there already."""
    return F.when(chromosome.startswith("chr"), chromosome).otherwise(
        F.concat(F.lit("chr"), chromosome)
    )


def arm_of(chromosome: Column, start: Column, end: Column, centromere: Column) -> Column:
    """Arm by segment midpoint; a midpoint on the centromere, or a null one, is ``q``."""
    side = F.when((start + end) / 2 < centromere, "p").otherwise("q")
    return F.concat(F.replace(chromosome, F.lit("chr"), F.lit("")), side)


def arm_ordinal(arm: Column) -> Column:
    """Sort key of the natural order 1p < 1q < 2p … 22q < Xp < Xq."""
    number = F.substring_index(F.substring_index(arm, "p", 1), "q", 1)
    chromosome = F.when(number == "X", 23).otherwise(number.try_cast("int"))
    return chromosome * 2 + F.when(arm.endswith("q"), 1).otherwise(0)


def feature_family(feature: Column, rna_prefix: str = "ENSG", rest: str | None = None) -> Column:
    """rna / methylation / cnv / other.

    ``rest`` names the family of everything that is neither RNA nor methylation;
    by default arms are ``cnv`` and the remainder ``other``.
    """
    family = F.when(feature.startswith(rna_prefix), "rna").when(
        feature.startswith("cg"), "methylation"
    )
    if rest is not None:
        return family.otherwise(rest)
    return family.when(feature.rlike(ARM), "cnv").otherwise("other")


def view_of(feature: Column, rna_prefix: str = "ENSG") -> Column:
    """View by name prefix; what has no known prefix is a chromosome arm."""
    return (
        F.when(feature.startswith(rna_prefix), "RNA")
        .when(feature.startswith("cg"), "methylation")
        .when(feature.startswith("RPPA_"), "RPPA")
        .when(feature.startswith("MIR_"), "miRNA")
        .when(feature.startswith("MUT_"), "mutations")
        .otherwise("CNV")
    )
