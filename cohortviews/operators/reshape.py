"""Long to wide and back.

Inside the library a view is one array per entity plus a feature dictionary;
columns are made from it only where a wide table is written. That keeps plans
small when a view has thousands of features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.dims import centromeres
from cohortviews.functions.genome import arm_of, arm_ordinal, canonical_chromosome, view_of
from cohortviews.functions.values import nan_to_null
from cohortviews.operators.ranking import ordinals
from cohortviews.session import BROADCAST_ROWS


def quoted(name: str) -> str:
    """Column reference that survives dots and other marks in the name."""
    return "`" + name.replace("`", "``") + "`"


def mean_cells(
    df: DataFrame,
    keys: Sequence[str] = ("patient_id",),
    feature: str = "feature_id",
    value: str = "value",
) -> DataFrame:
    """One row per (entity, feature): mean of duplicates, null if all are null."""
    return df.groupBy(*keys, feature).agg(F.avg(nan_to_null(F.col(value))).alias("value"))


def prefixed(df: DataFrame, prefix: str, feature: str = "feature_id") -> DataFrame:
    return df.withColumn(feature, F.concat(F.lit(prefix), F.col(feature)))


def pivot_mean(
    df: DataFrame,
    features: Sequence[str],
    keys: Sequence[str] = ("patient_id",),
    feature: str = "feature_id",
    value: str = "value",
    fill: float | None = None,
) -> DataFrame:
    """Wide table over a declared feature list, mean of duplicates.

    Entities without any row in the list have no row in the result. The list is
    the schema of the result, so it is an argument and not looked up in the data.
    """
    wide = (
        df.where(F.col(feature).isin(list(features)))
        .groupBy(*keys)
        .pivot(feature, list(features))
        .agg(F.avg(nan_to_null(F.col(value))))
    )
    return wide if fill is None else wide.fillna(fill, subset=[quoted(f) for f in features])


def feature_dictionary(
    features: DataFrame, feature: str = "feature_id", order: Sequence[Column] | None = None
) -> DataFrame:
    """``(feature, ordinal)`` with ordinals from 0 in the given (or name) order.

    The names are written once, so using the dictionary again costs no scan.
    """
    numbered = ordinals(features.select(feature).distinct(), order or [F.asc(feature)], "ordinal")
    return numbered.select(feature, F.col("ordinal").cast("int").alias("ordinal"))


def dense_arrays(
    rows: DataFrame,
    dictionary: DataFrame,
    keys: Sequence[str] = ("patient_id",),
    feature: str = "feature_id",
    value: str = "value",
    fill: float | None = None,
    name: str = "values",
    unique: bool = False,
) -> DataFrame:
    """One array per entity, position = ordinal; missing cells are ``fill``.

    Rows of other features are dropped where they are read (the dictionary is
    broadcast if its size allows), duplicates are averaged, and only then is
    anything moved. Gaps are padded between neighbours, which is linear in the
    array length. Entities without any row of the dictionary have no array. With
    ``unique`` every cell has one row already, so nothing is moved for a mean.
    """
    width = dictionary.count()
    small = F.broadcast(dictionary) if width <= BROADCAST_ROWS else dictionary
    gap = F.lit(fill).cast("double")
    one = nan_to_null(F.col(value))
    cell = one.cast("double") if unique else F.avg(one)
    cell = (cell if fill is None else F.coalesce(cell, F.lit(fill))).alias("x")
    placed = rows.join(small, feature)
    cells = placed.select(*keys, "ordinal", cell) if unique else placed.groupBy(*keys, "ordinal").agg(cell)
    # at most one struct per dictionary entry
    entries = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("ordinal", "x"))).alias("__e"))

    def padded(entry: Column, i: Column) -> Column:
        previous = F.coalesce(F.get(F.col("__e"), i - 1)["ordinal"], F.lit(-1))
        return F.concat(F.array_repeat(gap, entry["ordinal"] - previous - 1), F.array(entry["x"]))

    last = F.element_at("__e", -1)["ordinal"]
    return entries.select(
        *keys,
        F.concat(
            F.flatten(F.transform("__e", padded)), F.array_repeat(gap, F.lit(width - 1) - last)
        ).alias(name),
    )


def array_columns(
    df: DataFrame, array: str, names: Sequence[str], keep: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """Spread an array into named columns, for a wide sink."""
    return df.selectExpr(
        *keep, *[f"get({quoted(array)}, {i}) AS {quoted(n)}" for i, n in enumerate(names)]
    )


def array_rows(
    df: DataFrame, array: str, keep: Sequence[str], position: str = "position", value: str = "value"
) -> DataFrame:
    """One row per array entry (scores, loadings, importances)."""
    return df.select(*keep, F.posexplode(array).alias(position, value))


def unpivot_features(
    wide: DataFrame, keys: Sequence[str] = ("patient_id",), rna_prefix: str = "ENSG"
) -> DataFrame:
    """Wide table to ``(keys, view, feature_id, value)``, view taken from the name."""
    features = [c for c in wide.columns if c not in keys]
    typed = wide.select(*keys, *[F.col(quoted(c)).cast("double").alias(c) for c in features])
    long = typed.unpivot(
        list(keys), [F.col(quoted(c)).alias(c) for c in features], "feature_id", "value"
    )
    return long.withColumn("view", view_of(F.col("feature_id"), rna_prefix)).select(
        *keys, "view", "feature_id", "value"
    )


def unpivot_scores(
    wide: DataFrame, prefix: str, key: str = "feature", label: str = "class", value: str = "score"
) -> DataFrame:
    """``<prefix><class>`` columns to ``(key, class, score)`` rows."""
    columns = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.unpivot([key], [F.col(quoted(c)).alias(c) for c in columns], label, value)
    return long.withColumn(label, F.substr(F.col(label), F.lit(len(prefix) + 1)))


def segment_arms(segments: DataFrame) -> DataFrame:
    """Segments on canonical chromosomes with their arm."""
    dimension = F.broadcast(centromeres(segments.sparkSession))
    placed = segments.withColumn("chromosome", canonical_chromosome(F.col("chromosome"))).join(
        dimension, "chromosome"
    )
    arm = arm_of(F.col("chromosome"), F.col("start"), F.col("end"), F.col("centromere"))
    return placed.withColumn("arm", arm)


def arm_means(segments: DataFrame, keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Mean copy number per (entity, arm), not weighted by length."""
    return (
        segment_arms(segments)
        .groupBy(*keys, "arm")
        .agg(F.avg(nan_to_null(F.col("copy_number"))).alias("value"))
        .withColumnRenamed("arm", "feature_id")
    )


def arm_dictionary(cells: DataFrame) -> DataFrame:
    """Arms that occur, in natural chromosome order."""
    return feature_dictionary(cells, order=[arm_ordinal(F.col("feature_id"))])


def distinct_indicators(
    rows: DataFrame, feature: str = "hugo_symbol", keys: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """Set of (entity, feature) pairs with the constant 1.0."""
    return rows.select(*keys, feature).distinct().withColumn("mutated", F.lit(1.0))


def class_columns(
    long: DataFrame, classes: Mapping[str, str] | Sequence[str], key: str, label: str, value: str, prefix: str
) -> DataFrame:
    """``(key, class, score)`` rows to ``<prefix><class>`` columns."""
    wide = long.groupBy(key).pivot(label, list(classes)).agg(F.first(value))
    return wide.select(key, *[F.col(quoted(str(c))).alias(f"{prefix}{c}") for c in classes])
