"""Cases that were once wrong: cuts, types, held-out features, guards, damaged input."""

import pytest
from pyspark.sql import functions as F

from cohortviews.operators import evaluate as ev
from cohortviews.operators import factors as fa
from cohortviews.operators import model as md
from cohortviews.operators import quality as ql
from cohortviews.operators import ranking as rk
from cohortviews.operators import reshape as rs
from cohortviews.operators import select as sel
from cohortviews.plans import cohort as co
from cohortviews.sources import files, folders, sinks, tables


def test_long_class_names_stay_whole(spark):
    name = "x" * 1200
    wide = spark.createDataFrame([("f", 1.0)], f"feature string, `score_{name}` double")
    assert rs.unpivot_scores(wide, "score_").first()["class"] == name


def test_rank_type_does_not_depend_on_k(spark):
    df = spark.range(10).withColumn("k", F.lit(1))
    small, large = (rk.top_per_key(df, [F.asc("id")], k, ["k"]) for k in (3, 5000))
    assert small.schema["rank"].dataType == large.schema["rank"].dataType and small.count() == 3


def test_every_wrong_column_is_named(spark):
    names = [f"c{i:02d}" for i in range(14)]
    df = spark.createDataFrame([tuple("a" for _ in names)], names)
    with pytest.raises(ValueError, match="c13"):
        ql.require_numeric(df, names)


def test_feature_of_one_fold_only(spark):
    rows = [(f, "both", float(i)) for f in range(2) for i in range(4)] + [(0, "only0", 1.0), (0, "only0", 9.0)]
    df = spark.createDataFrame(rows, "fold int, feature_id string, value double")
    got = {(r.fold, r.feature_id): r.variance for r in sel.fold_top_features(df, 2, None).collect()}
    assert set(got) == {(f, n) for f in range(2) for n in ("both", "only0")}
    assert got[0, "only0"] is None and got[1, "only0"] == 32.0


def test_sweep_with_a_missing_coordinate(spark):
    rows = [(i, [float(20 * (i % 2)), 0.1 * i]) for i in range(20)]
    rows[3] = (3, [20.0, None])
    df = spark.createDataFrame(rows, "id long, vector array<double>")
    sweep, placed = fa.kmeans_runs(df, "id", k_range=(2, 3), restarts=2)
    best = {r.k: r.silhouette for r in sweep.collect()}
    assert best[2] > 0.9 and placed.count() == 20
    one = ev.silhouette_exact(placed.withColumn("vector", fa.zero_filled("vector")), "id", cluster="cluster_2")
    assert abs(one.agg(F.avg("silhouette")).first()[0] - best[2]) < 1e-9


def test_silhouette_wants_unique_ids(spark):
    df = spark.createDataFrame([(1, [0.0], 0), (1, [1.0], 1)], "id int, vector array<double>, cluster int")
    with pytest.raises(RuntimeError, match="repeats id"):
        ev.silhouette_exact(df, "id")


def test_folds_do_not_move_features(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("label"), F.array(F.rand(1)).alias("features"))
    df.write.mode("overwrite").parquet(path := f"{md.stage(df)._jdf.inputFiles()[0].rsplit('/', 1)[0]}-copy")
    stored = spark.read.parquet(path)
    plan = md.stratified_folds(stored, "label", "id")._jdf.queryExecution().optimizedPlan().toString()
    ranked = plan.split("Join")[-1]
    assert md.stratified_folds(stored, "label", "id").count() == 100 and "features" not in ranked.split("Relation")[-1]


def test_failed_checks_publish_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(RuntimeError, match="no rows"):
        sinks.write_table(spark.range(0), path)
    with pytest.raises(RuntimeError, match="repeats id"):
        sinks.write_table(spark.createDataFrame([(1,), (1,)], "id int"), path, ["id"])
    assert not tables.stored(spark, path) and tables.state(spark, path) == "absent"
    assert sinks.write_table(spark.range(3), path, ["id"]) == 3 and tables.stored(spark, path)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_text("no table")
    assert tables.state(spark, str(tmp_path / "bad")) == "partial"
    (tmp_path / "bad" / folders.MARKER).touch()
    assert tables.state(spark, str(tmp_path / "bad")) == "unreadable"


def test_a_table_without_its_mark_is_none(spark, tmp_path):
    """A later failure leaves what was there; a missing mark makes a table partial; a new write replaces it whole."""
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(1000), path, ["id"])
    with pytest.raises(RuntimeError, match="no rows"):
        sinks.write_table(spark.range(0), path)
    assert tables.stored(spark, path) and spark.read.parquet(path).count() == 1000
    (tmp_path / "t" / folders.MARKER).unlink()
    assert tables.state(spark, path) == "partial" and not tables.stored(spark, path)
    sinks.write_table(spark.range(10), path)
    assert tables.stored(spark, path) and spark.read.parquet(path).count() == 10
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_tables_are_written_once(spark, tmp_path):
    """One write and no second scan of the plan: each partition of the source runs once."""
    runs = spark.sparkContext.accumulator(0)

    def once(batches):
        runs.add(1)
        yield from batches

    rows = spark.range(0, 100, 1, 4).mapInArrow(once, "id long")
    assert sinks.write_table(rows, str(tmp_path / "t"), ["id"]) == 100
    assert runs.value == 4


def test_text_is_parsed_once(spark, tmp_path):
    """Neither the rows nor the ledger of an ingest go back to the files."""
    import shutil

    folder = tmp_path / "in" / "00000001-aaaa-bbbb-cccc-000000000001"
    folder.mkdir(parents=True)
    (folder / "f.tsv").write_text("cg1\t0.1\ncg2\t0.2\n")
    listing = spark.createDataFrame([(folder.name, "f.tsv", "P")], "file_id string, file_name string, patient_id string")
    rows, errors = files.ingest(spark, str(tmp_path / "in"), listing, files.METHYLATION)
    shutil.rmtree(tmp_path / "in")
    assert sorted((r.probe_id, r.beta_value) for r in rows.collect()) == [("cg1", 0.1), ("cg2", 0.2)] and errors.count() == 0


def test_ledger_of_a_clean_run(spark, tmp_path):
    path = str(tmp_path / "ledger")
    errors = spark.createDataFrame([("P", "f", "bad")], "patient_id string, file_id string, error string")
    assert sinks.write_ledger(errors, path) and folders.exists(spark, path)
    assert not sinks.write_ledger(errors.limit(0), path) and not folders.exists(spark, path)


@pytest.mark.parametrize("line", ["cg2", "cg2\t0.5\tx", "cg2\tmany"])
def test_headerless_file_with_a_broken_line(spark, tmp_path, line):
    ids = [f"{i:08d}-aaaa-bbbb-cccc-{i:012d}" for i in range(3)]
    for i, text in ((0, "cg1\t0.1\n"), (1, f"cg1\t0.1\n{line}\n")):
        (tmp_path / ids[i]).mkdir()
        (tmp_path / ids[i] / "f.tsv").write_text(text)
    listing = spark.createDataFrame([(x, "f.tsv", f"P{i}") for i, x in enumerate(ids)], "file_id string, file_name string, patient_id string")
    rows, errors = files.ingest(spark, str(tmp_path), listing, files.METHYLATION)
    assert [r.patient_id for r in rows.collect()] == ["P0"]
    assert {r.patient_id: r.error for r in errors.collect()} == {"P1": "1 unreadable rows", "P2": "no such file, or empty"}


def test_guards_at_the_entry_of_model_tables(spark):
    cells = spark.createDataFrame([("a", 1, "f", 1.0)], "cohort string, patient_id int, feature_id string, value double")
    roster = cells.select("patient_id", "cohort")
    with pytest.raises(ValueError, match="value"):
        co.cohort_model(cells.drop("value"), roster)
    with pytest.raises(ValueError, match="numeric"):
        co.cohort_model(cells.withColumn("value", F.lit("x")), roster)
    with pytest.raises(ValueError, match="forbidden"):
        co.cohort_model(cells.withColumn("feature_id", F.lit("cohort_code")), roster)
    with pytest.raises(ValueError, match="numeric"):
        co.arrays_of_wide(spark.createDataFrame([(1, "x")], "patient_id int, RPPA_a string"))
    with pytest.raises(ValueError, match="forbidden"):
        co.arrays_of_wide(spark.createDataFrame([(1, 1.0)], "patient_id int, subtype_code double"))
