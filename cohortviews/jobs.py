"""Spark jobs over stored tables, one function each, and their command line.

``spark-submit -m``-style use: ``python -m cohortviews.jobs <job> --help``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortviews import dims
from cohortviews.functions.ids import base_id
from cohortviews.operators import attributions as at
from cohortviews.operators import boosting as bo
from cohortviews.operators import evaluate as ev
from cohortviews.operators import factors as fa
from cohortviews.operators import labels as lb
from cohortviews.operators import model as md
from cohortviews.operators import panels as pn
from cohortviews.operators import quality as ql
from cohortviews.operators import reshape as rs
from cohortviews.operators import variational as va
from cohortviews.operators.ranking import best_row
from cohortviews.plans import cohort as co
from cohortviews.session import stage, together
from cohortviews.sources import files, labels, manifest as mf, sinks, tables

PROJECTS = ("TCGA-BRCA", "TCGA-LUAD", "TCGA-PRAD")

#: Stored modality to its raw layout and raw folder; mutations have their own reader.
LAYOUTS = {
    "rna_seq": (files.RNA, "rnaseq"),
    "cnv": (files.SEGMENTS, "cnv"),
    "methylation": (files.METHYLATION, "methylation"),
    "rppa": (files.PROTEIN, "rppa"),
    "mirna": (files.MIRNA, "mirna"),
    "mutations": (None, "mutations"),
}


def ingest(
    spark: SparkSession,
    manifests: str,
    raw: str,
    out: str,
    projects: Sequence[str] = PROJECTS,
    modalities: Sequence[str] = tuple(LAYOUTS),
    at_once: int = 4,
) -> dict[tuple[str, str], str]:
    """Raw files to long tables; what is stored is skipped, a failure is reported
    and the rest goes on. Several tables are loaded at the same time.

    ``manifests`` and ``raw`` are path patterns with ``{project}`` and ``{modality}``.
    """
    def one(project: str, modality: str) -> str:
        target = tables.path_of(out, project, modality)
        layout, folder = LAYOUTS[modality]
        place = {"project": project, "modality": folder}
        try:
            if tables.stored(spark, target):
                return "skipped"
            listing = mf.read_manifest(spark, manifests.format(**place))
            if layout is None:
                rows, errors = files.ingest_mutations(spark, raw.format(**place), listing)
            else:
                rows, errors = files.ingest(spark, raw.format(**place), listing, layout)
            # the ledger first: a table that is there counts as loaded, so its errors must be on record by then
            sinks.write_ledger(errors, f"{out}/{project}/errors_{modality}")
            return f"{sinks.write_table(rows, target, what=f'{project} {modality}', cluster_by=tables.cluster_columns(modality))} rows"
        except Exception as exc:  # noqa: BLE001 - one modality must not stop the others
            return f"failed: {exc}"

    wanted = [(project, modality) for project in projects for modality in modalities]
    return dict(zip(wanted, together(*[partial(one, *w) for w in wanted], at_once=at_once)))


def _store(merged: DataFrame, views, keys, out: str, wide: bool) -> None:
    sinks.write_table(merged, f"{out}/arrays", keys[-1:], "merged matrix")
    co.merged_dictionary(views).write.mode("overwrite").parquet(f"{out}/dictionary")
    if wide:
        stored = merged.sparkSession.read.parquet(f"{out}/arrays")
        sinks.write_table(co.wide_table(stored, views, keys), f"{out}/wide")


def merge_cohorts(
    spark: SparkSession,
    data: str,
    out: str,
    projects: Sequence[str] = PROJECTS,
    n: int = dims.TOP_FEATURES,
    min_coverage: float = dims.MIN_COVERAGE,
    older: bool = False,
    wide: bool = True,
) -> None:
    """Expression, arms and methylation of all projects; ``older`` is the first
    version of the merge (500 features, no gate, no panel, sample variance)."""
    value = "fpkm_unstranded" if older else None
    rule = (
        co.OLDER
        if older
        else {
            "n_rna": n, "n_methylation": n, "min_coverage": min_coverage,
            "must_keep": dims.panel_ids(dims.panels(spark)),
        }
    )
    merged, views = co.three_views(
        tables.read_measurement(spark, data, "rna_seq", projects, value),
        tables.read_modality(spark, data, "cnv", projects),
        tables.read_measurement(spark, data, "methylation", projects),
        **rule,
    )
    _store(merged, views, ("cohort", "patient_id"), out, wide)


def merge_project(
    spark: SparkSession,
    data: str,
    out: str,
    project: str = "TCGA-BRCA",
    n: int = dims.TOP_FEATURES,
    min_coverage: float = dims.MIN_COVERAGE,
    min_recurrence: float = dims.MIN_RECURRENCE,
    keep_unmutated: bool = False,
    wide: bool = True,
) -> None:
    """Six views of one project."""

    def long(modality: str) -> DataFrame:
        return tables.read_measurement(spark, data, modality, [project]).drop("cohort")

    merged, views = co.six_views(
        long("rna_seq"),
        tables.read_modality(spark, data, "cnv", [project]).drop("cohort"),
        long("methylation"),
        long("rppa"),
        long("mirna"),
        tables.read_modality(spark, data, "mutations", [project]).drop("cohort"),
        n_rna=n,
        n_methylation=n,
        min_coverage=min_coverage,
        min_recurrence=min_recurrence,
        must_keep=dims.panel_ids(dims.panels(spark)),
        keep_unmutated=keep_unmutated,
    )
    _store(merged, views, ("patient_id",), out, wide)


def _merged_long(spark: SparkSession, merged: str) -> DataFrame:
    arrays = spark.read.parquet(f"{merged}/arrays")
    keys = tuple(c for c in ("cohort", "patient_id") if c in arrays.columns)
    return co.array_cells(arrays, spark.read.parquet(f"{merged}/dictionary"), keys)


def _store_model(model: co.ModelTable, out: str, max_missing: float, wide: bool) -> None:
    sinks.write_table(model.rows, f"{out}/rows", ["patient_id"], "model table")
    model.dictionary.write.mode("overwrite").parquet(f"{out}/dictionary")
    sinks.write_json(model.manifest(max_missing, "split before fitting anything"), f"{out}/manifest")
    if wide:
        sinks.write_table(model.wide(), f"{out}/wide")


def cohort_table(
    spark: SparkSession, merged: str, out: str, max_missing: float = dims.MAX_MISSING, wide: bool = False
) -> None:
    """Model table for telling cohorts apart."""
    cells = _merged_long(spark, merged)
    roster = spark.read.parquet(f"{merged}/arrays").select("patient_id", "cohort")
    _store_model(co.cohort_model(cells, roster, max_missing), out, max_missing, wide)


def subtype_table(
    spark: SparkSession,
    merged: str,
    audit: str,
    out: str,
    cancer_type: str,
    label: str = "hoadley_subtype_selected",
    max_missing: float = dims.MAX_MISSING,
    wide: bool = False,
) -> None:
    """Model table for the subtypes of one cancer type."""
    model = co.subtype_model(
        _merged_long(spark, merged),
        spark.read.parquet(audit),
        label,
        cancer_type,
        dims.RARE_CLASS_REMAP.get(cancer_type),
        max_missing,
    )
    _store_model(model, out, max_missing, wide)


def classify(
    spark: SparkSession,
    table: str,
    out: str,
    cancer_type: str | None = None,
    top_n: int | None = 500,
    folds: int = 5,
    seed: int = 42,
    trees: int | None = None,
    depth: int | None = None,
    learner: str = "boosted",
) -> None:
    """Cross-validated predictions, scores, importances and attributions.

    ``boosted`` trees (400 rounds of depth 4) learn where missing cells go and are explained along their paths. A ``forest``
    (60 trees of depth 8) imputes them; its attributions are those of a linear model.
    """
    if learner not in ("boosted", "forest"):
        raise ValueError(f"no such learner: {learner}")
    boosted = learner == "boosted"
    trees, depth = trees or (400 if boosted else 60), depth or (4 if boosted else 8)
    settings = bo.Settings(rounds=trees, depth=depth, seed=seed)
    rows = spark.read.parquet(f"{table}/rows")
    names = spark.read.parquet(f"{table}/dictionary")
    label = next((c for c in rows.columns if c in ("cohort", "subtype")), "cohort")
    code = f"{label}_code"
    ql.require_columns(rows, ["patient_id", label, code, "values"])
    ql.require_columns(names, ["feature_id", "ordinal"])
    examples = stage(
        rows.select(F.col("patient_id").alias("id"), F.col(code).cast("int").alias("label"), F.col("values").alias("features"))
    )
    classes = [r[0] for r in rows.select(label, code).distinct().orderBy(code).collect()]
    markers = names.join(
        dims.panels(spark).where(F.col("panel") == cancer_type), base_id(F.col("feature_id")) == F.col("base_id"), "left_semi"
    )
    must_keep = [r.ordinal for r in markers.collect()]  # panel genes only

    if boosted:
        found = stage(bo.cross_validate(examples, "label", "id", folds, top_n, must_keep, settings))
    else:
        found = stage(md.cross_validate(examples, "label", "id", folds, top_n, must_keep, seed, trees, depth))
    flat = found.select(
        F.col("id").alias("patient_id"),
        "fold",
        "actual_code",
        "predicted_code",
        *[F.get("probabilities", F.lit(i)).alias(f"prob_{c}") for i, c in enumerate(classes)],
    )
    sinks.write_csv(flat, f"{out}/oof_predictions")
    per_fold = ev.summary_scores(found, ["fold"]).join(ev.log_loss(found, ["fold"]), "fold")
    metrics = ["accuracy", "balanced_accuracy", "macro_f1", "log_loss"]
    sinks.write_csv(ev.fold_summary(per_fold, metrics), f"{out}/cv_scores")
    # tables by class carry the class's name beside its code
    def with_names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
        for c in columns:
            if c in df.columns:
                found_name = F.get(F.lit([str(x) for x in classes]), F.col(c).try_cast("int"))
                df = df.withColumn(f"{c}_name", F.coalesce(found_name, F.col(c).cast("string")))
        return df

    by_class = ("class", "actual_code", "predicted_code", "actual", "predicted")
    sinks.write_csv(with_names(ev.classification_report(found), by_class), f"{out}/classification_report")
    sinks.write_csv(with_names(ev.confusion_matrix(found, list(range(len(classes)))), by_class), f"{out}/confusion_matrix")
    curve = ev.class_score_rows(found, list(range(len(classes))))
    sinks.write_csv(with_names(ev.roc_points(curve), by_class), f"{out}/roc_points")
    sinks.write_csv(with_names(ev.roc_auc(curve), by_class), f"{out}/roc_auc")
    totals = per_fold.agg(
        F.struct(
            *[F.struct(F.avg(m).alias("mean"), F.stddev_pop(m).alias("std")).alias(m) for m in metrics]
        ).alias("cv_scores")
    )
    document = totals.select(
        F.lit(cancer_type or "cohort").alias("task"), F.lit(len(classes)).alias("n_classes"), "cv_scores"
    )
    sinks.write_json(document, f"{out}/classification_metrics")

    if boosted:
        # a second, empty fold makes every row a training row of held-out fold 1
        positions = md.selected_positions(examples.withColumn("fold", F.lit(0)), 2, top_n, must_keep)[1]
        picked = stage(examples.withColumn("features", md.sliced("features", positions)))
        model, _ = bo.fit(picked, settings=settings)
        shares = dims.inline_table(spark, list(zip(positions, bo.gain_importances(model))), "ordinal int, importance double")
        ranked = shares.join(names, "ordinal")
        scores = at.summary(picked, model)
        losses = [(i, x[0]) for i, x in enumerate(model.losses)]
        sinks.write_csv(dims.inline_table(spark, losses, "round int, log_loss double").orderBy("round"), f"{out}/training_log")
    else:
        model, positions, _ = md.final_model(examples, "label", top_n, must_keep, seed, trees, depth)
        ranked = md.importances(spark, model, positions, names)
        scores = md.linear_attribution(examples.withColumn("features", md.sliced("features", positions)), "label")
    sinks.write_csv(ranked.select("feature_id", "importance").orderBy(F.desc("importance"), "feature_id"), f"{out}/feature_importances")
    chosen = dims.inline_table(spark, list(enumerate(positions)), "position int, ordinal int")
    by_name = scores.join(chosen, "position").join(names, "ordinal")
    summary = by_name.select(F.col("feature_id").alias("feature"), F.col("class").cast("string").alias("class"), "mean_abs")
    overall = summary.groupBy("feature").agg(F.avg("mean_abs").alias("mean_abs_shap"))
    codes = [str(i) for i in range(len(classes))]
    per_class = rs.class_columns(summary, codes, "feature", "class", "mean_abs", "mean_abs_shap_")
    named = per_class.withColumnsRenamed({f"mean_abs_shap_{i}": f"mean_abs_shap_{c}" for i, c in enumerate(classes)})
    sinks.write_csv(overall.join(named, "feature").orderBy(F.desc("mean_abs_shap")), f"{out}/attribution_summary")


def compare_panels(spark: SparkSession, summary: str, out: str, cancer_type: str) -> None:
    """Ranks, hits and per-class tops of an attribution summary against a panel."""
    wide = spark.read.option("header", True).csv(summary)
    scored = [c for c in wide.columns if c.startswith("mean_abs_shap")]
    wide = stage(wide.select("feature", *[F.col(rs.quoted(c)).cast("double").alias(c) for c in scored]))
    panel = dims.panels(spark).where(F.col("panel") == cancer_type)
    placed = stage(pn.rank_features(wide.select("feature", "mean_abs_shap"), "mean_abs_shap"))
    hits = stage(pn.panel_hits(placed, panel))
    sinks.write_csv(pn.annotate(pn.top_features(placed, 25), panel).orderBy("rank"), f"{out}/top25_overall")
    ranks = pn.panel_ranks(placed, panel, "mean_abs_shap").orderBy(F.asc_nulls_last("rank"))
    sinks.write_csv(ranks, f"{out}/panel_gene_ranks")
    per_class = pn.per_class_top(rs.unpivot_scores(wide, "mean_abs_shap_"), 8)
    sinks.write_csv(pn.annotate(per_class, panel).orderBy("class", "rank"), f"{out}/per_class_top8")
    cell = F.struct("panel_size", "hits", "rate")
    report = hits.groupBy(F.col("panel").alias("cancer")).agg(
        F.max("panel_size").alias("panel_size"),
        *[F.max(F.when(F.col("k") == k, cell)).alias(f"hits_top{k}") for k in (10, 25, 50)],
    )
    sized = report.withColumn("n_features_ranked", placed.agg(F.count("*").alias("n")).scalar())
    sinks.write_json(sized, f"{out}/panel_comparison")


def factor_analysis(
    spark: SparkSession,
    merged: str,
    out: str,
    cohort: str | None = None,
    factors: int = 15,
    max_missing: float | None = None,
    max_iter: int | None = None,
    seed: int = 42,
    solver: str = "variational",
    convergence: str = "fast",
) -> None:
    """Gate, transform and factorise the views of a merged matrix.

    ``solver`` is ``variational`` (at most 1,000 iterations, with a training log) or ``als`` (15).
    """
    arrays = spark.read.parquet(f"{merged}/arrays")
    if cohort is not None:
        arrays = lb.only_cohort(arrays, cohort)
    arrays = arrays.drop("cohort")
    cells = co.array_cells(arrays, spark.read.parquet(f"{merged}/dictionary"))
    config = dims.view_config(spark, max_missing)
    gated = fa.gated_views(cells, arrays.select("patient_id"), config)
    if solver == "variational":
        likelihoods = {r.view: r.likelihood for r in config.collect()}  # a row for each view
        model = va.fit_variational(
            va.prepared(gated, likelihoods), likelihoods, factors=factors, max_iter=max_iter or 1000, convergence=convergence, seed=seed
        )
        va.log_lines(model.log).coalesce(1).write.mode("overwrite").text(f"{out}/training_log")
    else:
        model = fa.fit_factors(fa.standardised(gated), factors=factors, max_iter=max_iter or 15, seed=seed)
    sinks.write_csv(fa.score_columns(model.scores, model.factors), f"{out}/factor_scores")
    model.scores.write.mode("overwrite").parquet(f"{out}/factor_arrays")
    sinks.write_csv(model.r2.orderBy("factor", "view"), f"{out}/variance_explained")
    top = ev.top_loadings(fa.loading_rows(model.loadings), 25)
    sinks.write_csv(top.orderBy("view", "factor", "rank"), f"{out}/top_loadings")


def cluster_analysis(
    spark: SparkSession,
    model: str,
    out: str,
    known_labels: str | None = None,
    label: str = "hoadley_subtype_selected",
    cancer_type: str | None = None,
    k_min: int = 2,
    k_max: int = 10,
    restarts: int = 10,
    seed: int = 42,
) -> None:
    """k-means sweep on factor scores, clusters at the best k, agreement with labels."""
    scores = spark.read.parquet(f"{model}/factor_arrays")
    points = stage(scores.select("patient_id", fa.zero_filled("scores").alias("vector")))
    sweep, runs = fa.kmeans_runs(points, "patient_id", k_range=range(k_min, k_max + 1), restarts=restarts, seed=seed)
    sweep = stage(sweep)
    sinks.write_csv(sweep.orderBy("k"), f"{out}/kmeans_silhouette")
    placed = stage(fa.best_clustering(sweep, runs).select("patient_id", "cluster"))
    sinks.write_csv(placed, f"{out}/cluster_assignments")
    sinks.write_csv(ev.cluster_sizes(placed), f"{out}/cluster_sizes")
    best = best_row(sweep, "silhouette", "k").select(
        F.col("k").alias("best_k"), F.col("silhouette").alias("best_silhouette")
    )
    if known_labels is not None:
        known = spark.read.parquet(known_labels).select("patient_id", F.col(label).alias("label"))
        if cancer_type is not None:
            known = known.where(F.col("label").startswith(cancer_type))
        joined = stage(placed.join(known.where(F.col("label").isNotNull()), "patient_id"))
        agreement = ev.cluster_agreement(joined)
        for name in ("n_labeled", "ari", "nmi"):
            best = best.withColumn(name, agreement.select(name).scalar())
        sinks.write_csv(ev.contingency(joined), f"{out}/cluster_contingency")
        sinks.write_csv(ev.cluster_purity(joined), f"{out}/cluster_purity")
    sinks.write_json(best, f"{out}/cluster_vs_subtype")


def label_audit(
    spark: SparkSession, merged: str, label_table: str, label_json: str, out: str, cohorts: Sequence[str] = ("BRCA", "LUAD", "PRAD")
) -> None:
    """Label table per patient, counts, totals and marker coverage.

    ``label_json`` is a path pattern with ``{cohort}``.
    """
    base = spark.read.parquet(f"{merged}/arrays").select("patient_id", "cohort")
    own = {
        c: labels.read_label_json(spark, label_json.format(cohort=c), f"{c.lower()}_marker_subtype") for c in cohorts
    }
    audit = co.label_audit(base, labels.read_label_table(spark, label_table), own)
    path = f"{out}/subtype_label_audit"
    sinks.write_table(audit, path, ["patient_id"], "label audit")
    stored = spark.read.parquet(path)
    sources = [c for c in stored.columns if "subtype" in c.lower()]
    sinks.write_csv(lb.label_counts(stored, sources).orderBy("cohort", "source", F.desc("n")), f"{out}/subtype_counts")
    sinks.write_csv(lb.label_totals(stored, sources), f"{out}/subtype_totals")
    features = spark.read.parquet(f"{merged}/dictionary").where(F.col("view") == "RNA")
    sinks.write_json(pn.marker_coverage(dims.panels(spark), features), f"{out}/subtype_marker_coverage")


def verify(
    spark: SparkSession, manifests: str, data: str, out: str, projects: Sequence[str] = PROJECTS,
    modalities: Sequence[str] = ("rna_seq", "cnv", "methylation"),
) -> DataFrame:
    """Patients in the manifests against patients in the stored tables; a table that cannot be read is an ERROR."""
    want, have, broken = [], [], []
    for project in projects:
        for modality in modalities:
            tag = {"cohort": F.lit(project), "modality": F.lit(modality)}
            listing = mf.read_manifest(spark, manifests.format(project=project, modality=LAYOUTS[modality][1]))
            want.append(listing.select("patient_id").withColumns(tag))
            path = tables.path_of(data, project, modality)
            found = tables.state(spark, path)
            if found == "stored":
                have.append(spark.read.parquet(path).select("patient_id").withColumns(tag))
            elif found != "absent":
                broken.append(f"{project} {modality}")
    expected, stored = want[0], (have[0] if have else want[0].where(F.lit(False)))
    for part in want[1:]:
        expected = expected.unionByName(part)
    for part in have[1:]:
        stored = stored.unionByName(part)
    report = ql.reconcile(expected, stored)
    unreadable = F.concat_ws(" ", "cohort", "modality").isin(broken)
    report = stage(report.withColumn("mark", F.when(unreadable, "ERROR").otherwise(F.col("mark"))))
    sinks.write_csv(report.orderBy("cohort", "modality"), out)
    return report


def sync(spark: SparkSession, manifest: str, listing: str, out: str, prefix: str = "tcga") -> None:
    """Which manifest files the destination lacks, and totals; nothing is copied.

    ``manifest`` is Parquet with project_id, file_id, file_name and either modality or data_category and data_type;
    ``listing`` is Parquet with the existing keys.
    """
    wanted = spark.read.parquet(manifest)
    if "modality" not in wanted.columns:
        wanted = mf.with_modality(wanted)
    plan = mf.sync_plan(wanted, spark.read.parquet(listing), prefix)
    plan.write.mode("overwrite").parquet(f"{out}/plan")
    sinks.write_csv(mf.sync_totals(spark.read.parquet(f"{out}/plan")), f"{out}/totals")


JOBS = {
    "ingest": (ingest, ("manifests", "raw", "out")),
    "merge-cohorts": (merge_cohorts, ("data", "out")),
    "merge-project": (merge_project, ("data", "out")),
    "cohort-table": (cohort_table, ("merged", "out")),
    "subtype-table": (subtype_table, ("merged", "audit", "out", "cancer_type")),
    "classify": (classify, ("table", "out")),
    "compare-panels": (compare_panels, ("summary", "out", "cancer_type")),
    "factors": (factor_analysis, ("merged", "out")),
    "clusters": (cluster_analysis, ("model", "out")),
    "label-audit": (label_audit, ("merged", "label_table", "label_json", "out")),
    "verify": (verify, ("manifests", "data", "out")),
    "sync": (sync, ("manifest", "listing", "out")),
}

#: Optional arguments by name, shared by the jobs that know them.
OPTIONS = {
    "projects": {"nargs": "+"},
    "modalities": {"nargs": "+"},
    "project": {},
    "cohort": {},
    "cancer_type": {},
    "label": {},
    "known_labels": {},
    "prefix": {},
    "n": {"type": int},
    "at_once": {"type": int},
    "top_n": {"type": int},
    "folds": {"type": int},
    "seed": {"type": int},
    "trees": {"type": int},
    "depth": {"type": int},
    "learner": {"choices": ["boosted", "forest"]},
    "solver": {"choices": ["variational", "als"]},
    "convergence": {"choices": ["fast", "medium", "slow"]},
    "factors": {"type": int},
    "max_iter": {"type": int},
    "k_min": {"type": int},
    "k_max": {"type": int},
    "restarts": {"type": int},
    "min_coverage": {"type": float},
    "min_recurrence": {"type": float},
    "max_missing": {"type": float},
    "older": {"action": "store_true"},
    "keep_unmutated": {"action": "store_true"},
    "wide": {"action": argparse.BooleanOptionalAction},
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cohortviews")
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (run, required) in JOBS.items():
        one = jobs.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        for argument in required:
            one.add_argument(f"--{argument.replace('_', '-')}", required=True)
        known = run.__code__.co_varnames[: run.__code__.co_argcount]
        for option, kind in OPTIONS.items():
            if option in known and option not in required:
                one.add_argument(f"--{option.replace('_', '-')}", default=argparse.SUPPRESS, **kind)
    return top


def main(argv: Sequence[str] | None = None) -> None:
    arguments = vars(parser().parse_args(argv))
    run, _ = JOBS[arguments.pop("job")]
    spark = SparkSession.builder.appName("cohortviews").getOrCreate()
    result = run(spark, **arguments)
    if isinstance(result, dict):
        for key, value in result.items():
            print(*key, value)


if __name__ == "__main__":
    main()
