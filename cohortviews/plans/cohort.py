"""From long tables to one row per subject, and on to model tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from cohortviews import dims
from cohortviews.dims import inline_table
from cohortviews.functions.genome import feature_family, view_of
from cohortviews.functions.values import pick_by_cohort
from cohortviews.operators.labels import join_labels, label_codes, labels_of_type
from cohortviews.operators.merge import inner_merge
from cohortviews.operators.quality import gate_features, require_columns, require_numeric, require_rate, require_unique
from cohortviews.operators.reshape import (
    arm_dictionary,
    arm_means,
    array_columns,
    dense_arrays,
    feature_dictionary,
    mean_cells,
    prefixed,
    quoted,
)
from cohortviews.operators.select import forbid_columns, keep_features, recurrent_features, top_variance_features
from cohortviews.session import small_side, stage, together


@dataclass(frozen=True)
class View:
    """One modality: an array per entity and the names of its positions."""

    name: str
    arrays: DataFrame
    dictionary: DataFrame

    def names(self) -> list[str]:
        """Column names in order; needed where a wide table is written."""
        return [r[0] for r in self.dictionary.orderBy("ordinal").select("feature_id").collect()]


def ranked_view(
    name: str,
    rows: DataFrame,
    n: int,
    min_coverage: float,
    must_keep: DataFrame | None = None,
    keys: Sequence[str] = ("patient_id",),
    ddof: int = 0,
) -> View:
    """Top-n features by variance (selected over all rows), as a view."""
    chosen = top_variance_features(rows, n, min_coverage, must_keep, ddof=ddof)
    dictionary = feature_dictionary(chosen)
    return View(name, dense_arrays(rows, dictionary, keys), dictionary)


def arm_view(
    segments: DataFrame, keys: Sequence[str] = ("patient_id",), name: str = "CNV", natural: bool = True
) -> View:
    """Arm means; segments are read once, the rest works on the means. Arms in natural or in alphabetical order."""
    cells = stage(arm_means(segments, keys), "arms")
    dictionary = arm_dictionary(cells) if natural else feature_dictionary(cells)
    return View(name, dense_arrays(cells, dictionary, keys, unique=True), dictionary)


def whole_view(name: str, rows: DataFrame, prefix: str, keys: Sequence[str] = ("patient_id",)) -> View:
    """Every feature of a panel-sized modality, with prefixed names."""
    cells = stage(mean_cells(prefixed(rows, prefix), keys), "cells")
    dictionary = feature_dictionary(cells)
    return View(name, dense_arrays(cells, dictionary, keys, unique=True), dictionary)


def indicator_view(
    mutations: DataFrame,
    min_fraction: float,
    prefix: str = "MUT_",
    keys: Sequence[str] = ("patient_id",),
    keep_unmutated: bool = False,
    name: str = "mutations",
) -> View:
    """Recurrent genes as 0/1. An entity without any kept gene has no row unless
    ``keep_unmutated`` asks for all entities that have a mutation at all."""
    pairs = mutations.select(
        *keys, F.col("hugo_symbol").alias("feature_id"), F.col("mutated").alias("value")
    )
    rows = stage(prefixed(pairs, prefix), "pairs")
    dictionary = feature_dictionary(recurrent_features(rows, min_fraction))
    arrays = dense_arrays(rows, dictionary, keys, fill=0.0)
    if keep_unmutated:
        empty = F.array_repeat(F.lit(0.0), dictionary.count())
        arrays = rows.select(*keys).distinct().join(arrays, list(keys), "left").select(
            *keys, F.coalesce("values", empty).alias("values")
        )
    return View(name, arrays, dictionary)


def merge(views: Sequence[View], keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    return inner_merge({v.name: v.arrays for v in views}, keys)


#: The older merge: 500 features, no gate, no panel, sample variance, arms in alphabetical order.
OLDER = {"n_rna": 500, "n_methylation": 500, "min_coverage": 0.0, "ddof": 1, "natural_arms": False}


def three_views(
    rna: DataFrame,
    segments: DataFrame,
    methylation: DataFrame,
    n_rna: int = dims.TOP_FEATURES,
    n_methylation: int = dims.TOP_FEATURES,
    min_coverage: float = dims.MIN_COVERAGE,
    must_keep: DataFrame | None = None,
    ddof: int = 0,
    natural_arms: bool = True,
) -> tuple[DataFrame, list[View]]:
    """All cohorts at once: features are selected over every cohort together,
    views are joined inside a cohort, an arm one cohort lacks is null there.

    :data:`OLDER` has the arguments of the older form.
    """
    keys = ("cohort", "patient_id")
    views = together(
        lambda: ranked_view("RNA", rna, n_rna, min_coverage, must_keep, keys, ddof),
        lambda: arm_view(segments, keys, natural=natural_arms),
        lambda: ranked_view("methylation", methylation, n_methylation, min_coverage, None, keys, ddof),
    )
    return merge(views, keys), views


def six_views(
    rna: DataFrame,
    segments: DataFrame,
    methylation: DataFrame,
    protein: DataFrame,
    mirna: DataFrame,
    mutations: DataFrame,
    n_rna: int = dims.TOP_FEATURES,
    n_methylation: int = dims.TOP_FEATURES,
    min_coverage: float = dims.MIN_COVERAGE,
    min_recurrence: float = dims.MIN_RECURRENCE,
    must_keep: DataFrame | None = None,
    keep_unmutated: bool = False,
) -> tuple[DataFrame, list[View]]:
    """One cohort, six views, selection on that cohort only."""
    views = together(
        lambda: ranked_view("RNA", rna, n_rna, min_coverage, must_keep),
        lambda: arm_view(segments),
        lambda: ranked_view("methylation", methylation, n_methylation, min_coverage),
        lambda: whole_view("RPPA", protein, "RPPA_"),
        lambda: whole_view("miRNA", mirna, "MIR_"),
        lambda: indicator_view(mutations, min_recurrence, keep_unmutated=keep_unmutated),
    )
    return merge(views), views


def wide_table(
    merged: DataFrame,
    views: Sequence[View],
    keys: Sequence[str] = ("patient_id",),
    declared: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Columns for a wide sink. ``declared`` fixes a view's column list; a
    declared feature that was not selected is a null column."""
    columns = []
    for view in views:
        position = {n: i for i, n in enumerate(view.names())}
        for n in (declared or {}).get(view.name, position):
            cell = f"get({quoted(view.name)}, {position[n]})" if n in position else "CAST(NULL AS DOUBLE)"
            columns.append(f"{cell} AS {quoted(n)}")
    return merged.selectExpr(*keys, *columns)


def merged_dictionary(views: Sequence[View]) -> DataFrame:
    """``(view, feature_id, ordinal)`` of all views."""
    parts = [v.dictionary.select(F.lit(v.name).alias("view"), "feature_id", "ordinal") for v in views]
    return reduce(DataFrame.unionByName, parts)


def merged_cells(
    merged: DataFrame, views: Sequence[View], keys: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """Every cell of the merged matrix, null ones included: ``(keys, view, feature_id, value)``."""
    return array_cells(merged, merged_dictionary(views), keys)


def array_cells(
    merged: DataFrame, positions: DataFrame, keys: Sequence[str] = ("patient_id",)
) -> DataFrame:
    """The same from stored arrays (one column per view) and their dictionary."""
    names = [c for c in merged.columns if c not in keys]
    by_view = merged.select(
        *keys,
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("view"), F.col(n).alias("x")) for n in names])
        ).alias("__v"),
    )
    cells = by_view.select(
        *keys, F.col("__v.view").alias("view"), F.posexplode("__v.x").alias("ordinal", "value")
    )
    return cells.join(small_side(stage(positions)), ["view", "ordinal"]).select(*keys, "view", "feature_id", "value")


def arrays_of_wide(
    wide: DataFrame, keys: Sequence[str] = ("patient_id",), rna_prefix: str = "ENSG"
) -> tuple[DataFrame, DataFrame]:
    """A wide table back to one array per view, with its dictionary.

    Views come from the column names; a view without columns is left out.
    """
    spark = wide.sparkSession
    require_columns(wide, keys)
    features = [c for c in wide.columns if c not in keys]
    forbid_columns(features, TARGETS)
    require_numeric(wide, features)
    names = inline_table(spark, [(i, c) for i, c in enumerate(features)], "at bigint, feature_id string")
    placed = names.select("at", "feature_id", view_of(F.col("feature_id"), rna_prefix).alias("view"))
    by_view: dict[str, list[str]] = {}
    for row in placed.orderBy("at").collect():  # column names of the given table
        by_view.setdefault(row.view, []).append(row.feature_id)
    arrays = [
        f"array({', '.join(f'CAST({quoted(c)} AS DOUBLE)' for c in columns)}) AS {quoted(view)}"
        for view, columns in by_view.items()
    ]
    entries = [(view, c, i) for view, columns in by_view.items() for i, c in enumerate(columns)]
    return (
        wide.selectExpr(*keys, *arrays),
        inline_table(spark, entries, "view string, feature_id string, ordinal int"),
    )


#: Ids and targets of model tables: never features.
TARGETS = ("patient_id", "cohort", "cohort_code", "subtype", "subtype_code")


def _require_cells(cells: DataFrame, keys: Sequence[str], max_missing_rate: float) -> None:
    require_columns(cells, [*keys, "feature_id", "value"])
    require_numeric(cells, ["value"])
    require_rate(max_missing_rate)


@dataclass(frozen=True)
class ModelTable:
    """Rows (id, label, code, values), feature names and what was dropped."""

    rows: DataFrame
    dictionary: DataFrame
    status: DataFrame
    codes: DataFrame
    label: str

    def manifest(self, max_missing_rate: float, note: str = "") -> DataFrame:
        """One nested row: counts, label map, features, drops by reason and family."""
        named = self.status.withColumn("family", feature_family(F.col("feature_id")))
        by = named.groupBy("status", "family").agg(F.count("*").alias("n"))
        lists = named.groupBy("status").agg(F.array_sort(F.collect_list("feature_id")).alias("f"))

        def family_map(kept: bool):
            rows = by.where((F.col("status") == "kept") == kept).groupBy("family").agg(F.sum("n").alias("n"))
            return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("family", "n")))).alias("m")).scalar()

        def names(status: str):
            return lists.where(F.col("status") == status).select("f").scalar()

        code = [c for c in self.codes.columns if c != self.label][0]
        labels = self.codes.agg(
            F.map_from_entries(F.array_sort(F.collect_list(F.struct(self.label, code)))).alias("m")
        ).scalar()
        empty = F.array().cast("array<string>")
        return self.rows.agg(F.count("*").alias("rows")).select(
            "rows",
            F.lit(self.label).alias("target_column"),
            F.lit(code).alias("target_code_column"),
            labels.alias("label_map"),
            F.coalesce(names("kept"), empty).alias("feature_columns"),
            family_map(True).alias("feature_family_counts"),
            F.lit(max_missing_rate).alias("max_missing_rate"),
            F.struct(
                F.coalesce(names("structural"), empty).alias("structural_missing_in_any_cohort"),
                F.coalesce(names("sparse"), empty).alias("over_missingness_threshold"),
                family_map(False).alias("counts_by_family"),
            ).alias("dropped"),
            F.lit(note).alias("note"),
        )

    def wide(self) -> DataFrame:
        code = [c for c in self.codes.columns if c != self.label][0]
        names = [r[0] for r in self.dictionary.orderBy("ordinal").select("feature_id").collect()]
        return array_columns(self.rows, "values", names, ("patient_id", self.label, code))


def _model_table(
    cells: DataFrame, roster: DataFrame, status: DataFrame, label: str, code: str
) -> ModelTable:
    status = stage(status)
    leaked = status.where(F.col("feature_id").isin(list(TARGETS))).select("feature_id").collect()  # a name each at most
    forbid_columns([r.feature_id for r in leaked], TARGETS)
    dictionary = feature_dictionary(status.where(F.col("status") == "kept"))
    codes = stage(label_codes(roster, label, code))
    arrays = dense_arrays(cells, dictionary)
    nothing = F.array_repeat(F.lit(None).cast("double"), dictionary.count())
    rows = (
        roster.join(small_side(codes), label)
        .join(arrays, "patient_id", "left")
        .select("patient_id", label, code, F.coalesce("values", nothing).alias("values"))
    )
    return ModelTable(rows, dictionary, status, codes, label)


def cohort_model(
    cells: DataFrame, roster: DataFrame, max_missing_rate: float = dims.MAX_MISSING
) -> ModelTable:
    """Cohort classification table.

    ``cells`` is long with the cohort on every row, ``roster`` one row per
    patient and cohort. Features empty in any cohort go first, then features
    missing in more than the allowed share of patients. Nothing is imputed or
    scaled here.
    """
    _require_cells(cells, ["patient_id", "cohort"], max_missing_rate)
    require_columns(roster, ["patient_id", "cohort"])
    require_unique(roster, ["patient_id"], "roster")
    status = gate_features(cells, roster, None, max_missing_rate)
    return _model_table(cells, roster.select("patient_id", "cohort"), status, "cohort", "cohort_code")


def subtype_model(
    cells: DataFrame,
    labels: DataFrame,
    label: str,
    cancer_type: str,
    rules: Mapping[str, str] | None = None,
    max_missing_rate: float = dims.MAX_MISSING,
) -> ModelTable:
    """Subtype table of one cancer type: labelled patients that have cells.

    Labels are picked by prefix, rare classes folded; only the sparse gate
    applies, over the labelled patients.
    """
    _require_cells(cells, ["patient_id"], max_missing_rate)
    require_columns(labels, ["patient_id", label])
    picked = labels_of_type(labels.select("patient_id", label), label, cancer_type, rules)
    present = cells.select("patient_id").distinct()
    roster = stage(
        picked.join(present, "patient_id", "left_semi").select("patient_id", F.col(label).alias("subtype"))
    )
    own = cells.join(roster.select("patient_id"), "patient_id", "left_semi")
    status = gate_features(own, roster, cells, max_missing_rate, structural=False)
    return _model_table(own, roster, status, "subtype", "subtype_code")


def label_audit(
    base: DataFrame, published: DataFrame, per_cohort: Mapping[str, DataFrame]
) -> DataFrame:
    """Patient, cohort, all label columns, and the patient's own cohort's label.

    ``per_cohort`` maps a cohort to ``(patient_id, <cohort>_marker_subtype)``.
    """
    joined = join_labels(base.select("patient_id", "cohort"), [published, *per_cohort.values()])
    own = {c: F.col(f"{c.lower()}_marker_subtype") for c in per_cohort}
    return joined.withColumn("marker_subtype", pick_by_cohort(F.col("cohort"), own))


def selected_cells(rows: DataFrame, chosen: DataFrame, keys: Sequence[str] = ("patient_id",)) -> DataFrame:
    """Long form of a selected view: mean per (entity, chosen feature)."""
    return mean_cells(keep_features(rows, chosen), keys)
