import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortviews import dims
from cohortviews.operators import evaluate as ev
from cohortviews.operators import factors as fa
from cohortviews.operators import kmeans as km
from cohortviews.operators import model as md


@pytest.fixture(scope="module")
def examples(spark):
    """Feature 1 separates the classes, feature 4 helps, the rest is noise; some cells are missing."""
    rng = np.random.default_rng(1)
    rows = []
    for i in range(180):
        y = 0 if i % 3 else (i // 3) % 2 + 1
        x = rng.normal(size=6)
        x[1] += 8 * y
        x[4] -= 2 * y
        cells = [None if rng.random() < 0.05 else float(v) for v in x]
        rows.append((i, y, cells))
    return spark.createDataFrame(rows, "id long, label int, features array<double>")


def test_folds_partition_the_rows(examples):
    placed = md.stratified_folds(examples, "label", "id").collect()
    assert sorted(r.id for r in placed) == list(range(180))
    for y in (0, 1, 2):
        sizes = [sum(1 for r in placed if r.label == y and r.fold == k) for k in range(5)]
        assert max(sizes) - min(sizes) <= 1
    again = md.stratified_folds(examples.repartition(7), "label", "id").collect()
    assert {r.id: r.fold for r in placed} == {r.id: r.fold for r in again}
    other = md.stratified_folds(examples, "label", "id", seed=1).collect()
    assert {r.id: r.fold for r in placed} != {r.id: r.fold for r in other}


def test_cross_validation(examples):
    out = md.cross_validate(examples, top_n=2, must_keep=[0], trees=15, depth=4).cache()
    assert sorted(r.id for r in out.collect()) == list(range(180))
    assert ev.summary_scores(out).first().accuracy > 0.9
    assert all(abs(sum(r.probabilities) - 1) < 1e-6 for r in out.collect())


def test_selection_sees_training_rows_only(examples):
    data = md.stratified_folds(examples, "label", "id")
    chosen = md.selected_positions(data, 5, 1, [0])
    assert chosen == {k: [0, 1] for k in range(5)}


def test_importances_and_permutation(spark, examples):
    model, positions, means = md.final_model(examples, top_n=3, trees=15, depth=4)
    table = md.importances(spark, model, positions).collect()
    assert table[0].ordinal == 1 and abs(sum(r.importance for r in table) - 1) < 1e-9
    losses = {r.ordinal: r.accuracy_loss for r in md.permutation_importance(examples, model, positions, means).collect()}
    assert max(losses, key=losses.get) == 1 and losses[1] > 0.2


def test_linear_attribution(examples):
    rows = md.linear_attribution(examples).groupBy("position").agg(F.avg("mean_abs").alias("s")).orderBy(F.desc("s"))
    assert rows.first().position == 1


def test_kmeans_finds_two_groups(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=3) + (20 if i % 2 else 0)], i % 2) for i in range(60)]
    rows[0] = (0, [None, 0.0, 0.0], 0)  # a missing coordinate counts as zero
    df = spark.createDataFrame(rows, "id long, vector array<double>, truth int")
    sweep, placed = fa.kmeans_runs(df, "id", k_range=range(2, 5), restarts=2)
    sweep.cache()
    best = fa.best_clustering(sweep, placed)
    assert ev.cluster_agreement(best, label="truth").first().ari == 1.0
    assert [r.k for r in sweep.orderBy(F.desc("silhouette")).take(1)] == [2]
    inertia = [r.inertia for r in sweep.orderBy("k").collect()]
    assert inertia == sorted(inertia, reverse=True)


@pytest.fixture(scope="module")
def factor_cells(spark):
    """Rank two plus noise over two views, a tenth of the cells missing."""
    rng = np.random.default_rng(0)
    z, w = rng.normal(size=(80, 2)), rng.normal(size=(30, 2)) * [3, 1.5]
    x = z @ w.T + 0.1 * rng.normal(size=(80, 30))
    rows = [
        (i, "RNA" if j < 20 else "CNV", f"f{j}", float(x[i, j]))
        for i in range(80) for j in range(30) if rng.random() > 0.1
    ]
    return fa.standardised(spark.createDataFrame(rows, "patient_id long, view string, feature_id string, value double"))


def test_standardised(factor_cells):
    per_feature = factor_cells.groupBy("view", "feature_id").agg(F.avg("value").alias("m")).collect()
    assert all(abs(r.m) < 1e-9 for r in per_feature)
    per_view = factor_cells.groupBy("view").agg(F.var_pop("value").alias("v")).collect()
    assert all(abs(r.v - 1) < 1e-9 for r in per_view)


def test_factor_model(factor_cells):
    model = fa.fit_factors(factor_cells, factors=3, max_iter=12)
    r2 = {(r.factor, r.view): r.r2 for r in model.r2.collect()}
    for view in ("RNA", "CNV"):
        assert 85 < sum(v for (_, name), v in r2.items() if name == view) <= 101
    assert all(v <= 100 for v in r2.values())
    z = np.array([r.scores for r in model.scores.orderBy("patient_id").collect()])
    gram = z.T @ z
    assert np.allclose(gram, np.diag(np.diag(gram)), atol=1e-4)
    norms = np.linalg.norm(np.array([r.loadings for r in model.loadings.collect()]), axis=0)
    assert list(norms) == sorted(norms, reverse=True)
    assert fa.score_columns(model.scores, model.factors).columns[1] == "factor_1"
    assert fa.loading_rows(model.loadings).count() == 30 * model.factors


def test_gated_views(spark):
    rows = [(p, "RNA", "a", 3.0) for p in range(10)] + [(p, "RNA", "b", 1.0 if p < 5 else None) for p in range(10)]
    cells = spark.createDataFrame(rows, "patient_id int, view string, feature_id string, value double")
    out = fa.gated_views(cells, cells.select("patient_id").distinct(), dims.view_config(spark)).collect()
    assert {(r.feature_id, r.value) for r in out} == {("a", 2.0)}


def test_kmeans_steps_serve_all_fits(spark):
    """The number of jobs does not grow with the restarts; means, costs and places are those of one another."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 4)) + 6 * rng.normal(size=(5, 4))[np.arange(300) % 5] + 1000
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vector array<double>").repartition(3)
    jobs = spark.sparkContext.statusTracker()

    def run(group, restarts):
        spark.sparkContext.setJobGroup(group, group)
        fits = km.best_fits(df, range(2, 7), restarts=restarts, max_iter=2, tol=0.0)
        spark.sparkContext.setJobGroup("", "")
        return fits, len(jobs.getJobIdsForGroup(group))

    (one, few), (fits, many) = run("one restart", 1), run("eight restarts", 8)
    assert many <= few + 6  # a fit that drew too few rows may ask for one more draw
    assert [f.k for f in fits] == [len(f.means) for f in fits] == [2, 3, 4, 5, 6]
    assert all(b.cost <= a.cost * (1 + 1e-9) for a, b in zip(one, fits))
    for fit, placed in zip(fits, [km.with_clusters(df, {"c": f.means}).orderBy("id").collect() for f in fits]):
        d = ((x[:, None] - fit.means) ** 2).sum(2)
        assert [r.c for r in placed] == d.argmin(1).tolist() and np.isclose(fit.cost, d.min(1).sum(), rtol=1e-9)


def test_kmeans_ends_at_the_means_of_its_clusters(spark):
    """As good as Spark ML's best restart, and no mean moves at the end."""
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 3)) + 8 * rng.normal(size=(4, 3))[np.arange(400) % 4]
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, vector array<double>")
    best, placed = fa.kmeans_best(df, 4)
    own = np.array([r.cluster for r in placed.orderBy("id").collect()])
    assert np.allclose(best.means, [x[own == c].mean(0) for c in range(4)], atol=1e-3)
    theirs = min(KMeans(k=4, seed=s, maxIter=50).fit(df.select(array_to_vector("vector").alias("features"))).summary.trainingCost for s in range(4))
    assert best.cost <= theirs * 1.001


def test_kmeans_of_few_distinct_vectors(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 0.5]) for i in range(50)], "id long, vector array<double>")
    fit = km.best_fits(df, [5], restarts=2)[0]
    assert fit.k == 5 and sorted(fit.means.tolist()) == [[0.0, 0.5], [1.0, 0.5]] and fit.cost == 0
    with pytest.raises(ValueError, match="no rows"):
        km.best_fits(df.limit(0), [2])
