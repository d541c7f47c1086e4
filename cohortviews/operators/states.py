"""Statistics kept as states that can be merged: a new load reads its own rows only.

Moments are exact. A load leaves ``(feature, n, mean, m2)`` and its distinct entities under ``<root>/<load>``; selection
over all loads merges these small tables. Counts of distinct entities and quantiles have sketch states besides, for where
the exact answer would move every (feature, entity) pair again; each names the error it promises.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import sqrt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortviews.functions.values import nan_to_null
from cohortviews.operators.select import choose_top
from cohortviews.sources import folders, sinks, tables

MOMENTS, ENTITIES = "moments.parquet", "entities.parquet"
#: Entries of a theta sketch are 2 to this power; below that many distinct items it is exact.
THETA_LOG2 = 14
#: Size of a quantile sketch, and four standard errors of the ranks it gives.
KLL_K, KLL_RANK_ERROR = 400, 0.0105


# --- moments of loads ---------------------------------------------------------------------------


def moments(rows: DataFrame, keys: Sequence[str], value: str = "value") -> DataFrame:
    """Count, mean and sum of squared deviations of each key; NaN counts as no value."""
    x = nan_to_null(F.col(value).cast("double"))
    return rows.groupBy(*keys).agg(F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"))


def add_load(rows: DataFrame, root: str, load: str, feature: str = "feature_id", entity: str = "patient_id") -> bool:
    """Store the states of one load; False, and nothing is read, if they are stored already.

    ``rows`` are ``(entity, feature, value)``. Rows without a feature count for their entity only. A load without any row
    raises, as an empty table does everywhere.
    """
    spark = rows.sparkSession
    if all(tables.stored(spark, f"{root}/{load}/{part}") for part in (MOMENTS, ENTITIES)):
        return False
    sinks.write_table(moments(rows.where(F.col(feature).isNotNull()), [feature]), f"{root}/{load}/{MOMENTS}", [feature])
    sinks.write_table(rows.select(entity).distinct(), f"{root}/{load}/{ENTITIES}", [entity], what="entities")
    return True


def drop_load(spark: SparkSession, root: str, load: str) -> bool:
    """Take a load back; the others are not touched."""
    return folders.remove(spark, f"{root}/{load}")


def _read(spark: SparkSession, root: str, loads: Sequence[str], part: str) -> DataFrame:
    missing = [load for load in loads if not tables.stored(spark, f"{root}/{load}/{part}")]
    if missing or not loads:
        raise RuntimeError(f"no complete states of {missing or 'any load'} under {root}")
    return reduce(DataFrame.unionByName, [spark.read.parquet(f"{root}/{load}/{part}") for load in loads])


def merged_moments(states: DataFrame, keys: Sequence[str], ddof: int = 0) -> DataFrame:
    """``(keys, n_obs, variance)`` of all states of a key together.

    Deviations are added around the common mean, so large means lose no digits. A group holds a struct for each load.
    """
    parts = F.filter(F.collect_list(F.struct("n", "mean", "m2")), lambda p: p["n"] > 0)
    both = states.groupBy(*keys).agg(parts.alias("parts"), F.sum("n").alias("n_obs"))
    mean = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["n"] * p["mean"])
    both = both.withColumn("mean", F.try_divide(mean, F.col("n_obs")))
    m2 = F.aggregate("parts", F.lit(0.0), lambda a, p: a + p["m2"] + p["n"] * F.pow(p["mean"] - F.col("mean"), F.lit(2)))
    return both.select(*keys, "n_obs", F.when(F.col("n_obs") > ddof, m2 / (F.col("n_obs") - ddof)).alias("variance"))


def top_variance_of_loads(
    spark: SparkSession,
    root: str,
    loads: Sequence[str],
    n: int,
    min_coverage: float,
    must_keep: DataFrame | None = None,
    feature: str = "feature_id",
    entity: str = "patient_id",
    ddof: int = 0,
) -> DataFrame:
    """The result of ``select.top_variance_features`` over the rows of all ``loads``, from their states alone."""
    stats = merged_moments(_read(spark, root, loads, MOMENTS), [feature], ddof)
    people = _read(spark, root, loads, ENTITIES).agg(F.count_distinct(entity)).scalar()
    return choose_top(stats, people, n, min_coverage, must_keep, feature)


# --- distinct counts ----------------------------------------------------------------------------


def entity_sketches(rows: DataFrame, keys: Sequence[str], entity: str = "patient_id") -> DataFrame:
    """``(keys, people)``: a theta sketch of the distinct entities; built map-side, bounded in size."""
    return rows.groupBy(*keys).agg(F.theta_sketch_agg(F.col(entity).cast("string"), THETA_LOG2).alias("people"))


def rolled_up(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketches of coarser keys (none: one row) from finer ones."""
    return sketches.groupBy(*keys).agg(F.theta_union_agg("people", F.lit(THETA_LOG2)).alias("people"))


def distinct_error(union: Column, part: Column | None = None) -> Column:
    """Three standard errors of an estimate: of a union, or of an intersection ``part`` inside it."""
    entries = 2**THETA_LOG2
    spread = 3 / sqrt(entries) * F.sqrt(union * (union if part is None else F.greatest(part, F.lit(1.0))))
    return F.when(union < entries, F.lit(0.0)).otherwise(spread)


def sketched_funnel(sketches: DataFrame, view: str = "modality") -> DataFrame:
    """``(step, n_entities, error)``: entities of every view, of any view, and of all of them, by set operations on sketches.

    Steps are named as in ``merge.coverage_funnel``; those between any and all need the pairs and are not estimated.
    """
    one = rolled_up(sketches, [view])
    size = F.theta_sketch_estimate("people").cast("double")
    each = one.select(F.col(view).alias("step"), size.alias("n"), size.alias("around"))
    # grouped by nothing, so that an empty table has no row: an intersection of no sketch is an error
    whole = one.groupBy(F.lit("all").alias("all_views")).agg(
        F.count("*").alias("views"),
        F.theta_sketch_estimate(F.theta_union_agg("people", F.lit(THETA_LOG2))).cast("double").alias("any"),
        F.theta_sketch_estimate(F.theta_intersection_agg("people")).cast("double").alias("all"),
    )
    steps = F.array(
        F.struct(F.lit("in_1_views").alias("step"), F.col("any").alias("n")),
        F.struct(F.format_string("in_%d_views", "views").alias("step"), F.col("all").alias("n")),
    )
    ends = whole.where("views > 1").select(F.explode(steps).alias("s"), "any").select("s.step", "s.n", F.col("any").alias("around"))
    return each.unionByName(ends).select(
        "step", F.round("n").cast("long").alias("n_entities"), distinct_error(F.col("around"), F.col("n")).alias("error"))


# --- quantiles ----------------------------------------------------------------------------------


def quantile_sketches(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(keys, sketch)`` of the values that are there."""
    x = nan_to_null(F.col(value).cast("double"))
    return rows.where(x.isNotNull()).groupBy(*keys).agg(F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, keys: Sequence[str], shares: Sequence[float]) -> DataFrame:
    """``(keys, n, quantiles)`` of coarser keys (none: one row); ranks are off by less than ``KLL_RANK_ERROR``."""
    whole = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", F.lit(KLL_K)).alias("sketch"))
    return whole.select(
        *keys,
        F.kll_sketch_get_n_double("sketch").alias("n"),
        F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))) for s in shares]).alias("quantiles"),
    )
