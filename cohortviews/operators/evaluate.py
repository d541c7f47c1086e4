"""Metrics of predictions and clusterings, as aggregates over DataFrames.

Everything past the first grouping works on counts per class pair, threshold or
contingency cell, so the row tables are read once per metric family.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.operators import distances as ds
from cohortviews.operators.quality import require_unique
from cohortviews.operators.ranking import running_totals, top_per_key
from cohortviews.session import small_side, stage

# --- classification --------------------------------------------------------


def confusion_counts(
    df: DataFrame, keys: Sequence[str] = (), actual: str = "actual_code", predicted: str = "predicted_code"
) -> DataFrame:
    """``(keys, actual, predicted, n)`` of the pairs that occur."""
    return df.groupBy(
        *keys, F.col(actual).alias("actual"), F.col(predicted).alias("predicted")
    ).agg(F.count("*").alias("n"))


def class_outcomes(counts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """tp, fp, fn, support per class, from confusion counts.

    Each pair is booked once on its actual and once on its predicted class, so
    no join is needed and classes that are never predicted stay in.
    """
    hit = F.col("actual") == F.col("predicted")
    zero = F.lit(0).cast("long")
    booked = counts.select(
        *keys,
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("class"),
                    F.when(hit, F.col("n")).otherwise(zero).alias("tp"),
                    zero.alias("fp"),
                    F.when(hit, zero).otherwise(F.col("n")).alias("fn"),
                ),
                F.struct(
                    F.col("predicted").alias("class"),
                    zero.alias("tp"),
                    F.when(hit, zero).otherwise(F.col("n")).alias("fp"),
                    zero.alias("fn"),
                ),
            )
        ).alias("b"),
    )
    return (
        booked.groupBy(*keys, F.col("b.class").alias("class"))
        .agg(F.sum("b.tp").alias("tp"), F.sum("b.fp").alias("fp"), F.sum("b.fn").alias("fn"))
        .withColumn("support", F.col("tp") + F.col("fn"))
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top, bottom), F.lit(0.0))


def class_scores(outcomes: DataFrame) -> DataFrame:
    """Precision, recall and f1 per class; a zero division counts as 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return outcomes.withColumns(
        {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn),
        }
    )


def summary_scores(
    df: DataFrame, keys: Sequence[str] = (), actual: str = "actual_code", predicted: str = "predicted_code"
) -> DataFrame:
    """Accuracy, balanced accuracy, macro and weighted F1 per key group."""
    scores = class_scores(class_outcomes(confusion_counts(df, keys, actual, predicted), keys))
    return scores.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("support")).alias("accuracy"),
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg("f1").alias("macro_f1"),
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1"),
    )


def classification_report(
    df: DataFrame, actual: str = "actual_code", predicted: str = "predicted_code"
) -> DataFrame:
    """Per-class rows plus accuracy, macro avg and weighted avg rows."""
    scores = stage(class_scores(class_outcomes(confusion_counts(df, (), actual, predicted))))
    columns = ["precision", "recall", "f1", "support"]
    per_class = scores.select(F.col("class").cast("string").alias("label"), *columns)
    whole = F.sum("support")
    accuracy = F.sum("tp") / whole
    lines = scores.agg(
        F.struct(
            F.lit("accuracy").alias("label"),
            *[accuracy.alias(c) for c in columns[:3]],
            whole.alias("support"),
        ).alias("a"),
        F.struct(
            F.lit("macro avg").alias("label"),
            *[F.avg(c).alias(c) for c in columns[:3]],
            whole.alias("support"),
        ).alias("m"),
        F.struct(
            F.lit("weighted avg").alias("label"),
            *[(F.sum(F.col(c) * F.col("support")) / whole).alias(c) for c in columns[:3]],
            whole.alias("support"),
        ).alias("w"),
    ).select(F.inline(F.array("a", "m", "w")))
    return per_class.unionByName(lines)


def confusion_matrix(
    df: DataFrame,
    classes: Sequence[object] | None = None,
    actual: str = "actual_code",
    predicted: str = "predicted_code",
) -> DataFrame:
    """Long matrix ``(actual, predicted, n, row_share)`` with its zero cells.

    The grid is spanned by the class list, taken from the data if not given.
    """
    counts = stage(confusion_counts(df, (), actual, predicted))
    if classes is None:
        found = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).distinct()
        classes = [r.c for r in found.orderBy("c").collect()]  # the class vocabulary
    kind = counts.schema["actual"].dataType
    names = F.array(*[F.lit(c).cast(kind) for c in classes])
    grid = (
        counts.sparkSession.createDataFrame([(c,) for c in classes], "actual " + kind.simpleString())
        .withColumn("predicted", F.explode(names))
    )
    totals = counts.groupBy("actual").agg(F.sum("n").alias("row_total"))
    return (
        grid.join(counts, ["actual", "predicted"], "left")
        .join(totals, "actual", "left")
        .select(
            "actual",
            "predicted",
            F.coalesce("n", F.lit(0)).alias("n"),
            _ratio(F.coalesce("n", F.lit(0)), F.col("row_total")).alias("row_share"),
        )
    )


def log_loss(
    df: DataFrame,
    keys: Sequence[str] = (),
    actual: str = "actual_code",
    probabilities: str = "probabilities",
    eps: float = float(np.finfo(np.float64).eps),
) -> DataFrame:
    """Mean negative log of the true class's clipped probability."""
    p = F.get(F.col(probabilities), F.col(actual).cast("int"))
    inside = F.least(F.greatest(p, F.lit(eps)), F.lit(1 - eps))
    return df.groupBy(*keys).agg((-F.avg(F.ln(inside))).alias("log_loss"))


def fold_summary(per_fold: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``(metric, mean, std)`` over folds, population standard deviation."""
    long = per_fold.unpivot([], list(metrics), "metric", "score")
    return long.groupBy("metric").agg(
        F.avg("score").alias("mean"), F.stddev_pop("score").alias("std")
    )


def class_score_rows(
    df: DataFrame, classes: Sequence[int], actual: str = "actual_code", probabilities: str = "probabilities"
) -> DataFrame:
    """``(class, score, is_pos)`` for one-vs-rest curves."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(c).alias("class"),
                F.get(F.col(probabilities), F.lit(i)).alias("score"),
                (F.col(actual) == c).cast("long").alias("is_pos"),
            )
            for i, c in enumerate(classes)
        ]
    )
    return df.select(F.inline(pairs))


def threshold_counts(rows: DataFrame) -> DataFrame:
    """Positives and negatives per (class, threshold); combines before shuffling."""
    return rows.groupBy("class", "score").agg(
        F.sum("is_pos").alias("pos"), F.sum(1 - F.col("is_pos")).alias("neg")
    )


def roc_points(rows: DataFrame, origin: bool = True) -> DataFrame:
    """One point per distinct threshold: ``(class, threshold, tp, fp, tpr, fpr)``.

    ``origin`` adds the point above every score, with a null threshold.
    """
    running = running_totals(
        threshold_counts(rows),
        [F.desc("score")],
        {"tp": F.col("pos"), "fp": F.col("neg")},
        ["class"],
    )
    totals = stage(
        rows.groupBy("class").agg(F.sum("is_pos").alias("p"), F.sum(1 - F.col("is_pos")).alias("q"))
    )
    points = running.select("class", F.col("score").alias("threshold"), "tp", "fp")
    if origin:
        zero = F.lit(0).cast("long")
        points = points.unionByName(
            totals.select(
                "class", F.lit(None).cast("double").alias("threshold"), zero.alias("tp"), zero.alias("fp")
            )
        )
    return points.join(small_side(totals), "class").select(
        "class",
        "threshold",
        "tp",
        "fp",
        F.try_divide("tp", "p").alias("tpr"),
        F.try_divide("fp", "q").alias("fpr"),
    )


def roc_auc(rows: DataFrame) -> DataFrame:
    """Area under every one-vs-rest curve.

    With tp counted up to a threshold, each threshold adds the trapezoid
    ``neg * (2 tp - pos) / 2``, so no neighbour lookup is needed.
    """
    running = running_totals(
        threshold_counts(rows), [F.desc("score")], {"tp": F.col("pos")}, ["class"]
    )
    return running.groupBy("class").agg(
        F.try_divide(
            F.sum(F.col("neg") * (2 * F.col("tp") - F.col("pos"))),
            2 * F.sum("pos") * F.sum("neg"),
        ).alias("auc")
    )


# --- clustering ------------------------------------------------------------


def contingency(
    df: DataFrame, cluster: str = "cluster", label: str = "label", labels: Sequence[object] | None = None
) -> DataFrame:
    """Long ``(cluster, label, n, row_percent)`` of rows with a label.

    Zero cells are kept when the labels are given.
    """
    rows = df.where(F.col(label).isNotNull())
    counts = rows.groupBy(cluster, label).agg(F.count("*").alias("n"))
    totals = rows.groupBy(cluster).agg(F.count("*").alias("total"))
    if labels is not None:
        kind = rows.schema[label].dataType
        grid = totals.select(
            cluster, F.explode(F.array(*[F.lit(v).cast(kind) for v in labels])).alias(label)
        )
        counts = grid.join(counts, [cluster, label], "left").fillna(0, subset=["n"])
    return counts.join(totals, cluster).select(
        cluster, label, "n", (100 * F.col("n") / F.col("total")).alias("row_percent")
    )


def contingency_wide(
    df: DataFrame, labels: Sequence[object], cluster: str = "cluster", label: str = "label"
) -> DataFrame:
    rows = df.where(F.col(label).isNotNull())
    return rows.groupBy(cluster).pivot(label, list(labels)).count().fillna(0)


def cluster_purity(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """Majority label, its share in percent, and size per cluster."""
    counts = df.where(F.col(label).isNotNull()).groupBy(cluster, label).agg(F.count("*").alias("n"))
    # the smallest label wins a tie: min over (-n, label)
    return counts.groupBy(cluster).agg(
        F.min(F.struct((-F.col("n")).alias("m"), F.col(label).alias("l"))).alias("b"),
        F.sum("n").alias("n"),
    ).select(
        cluster,
        F.col("b.l").alias("majority"),
        (-100 * F.col("b.m") / F.col("n")).alias("purity_percent"),
        "n",
    )


def cluster_sizes(df: DataFrame, cluster: str = "cluster") -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n"))


def cluster_agreement(df: DataFrame, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """One row: n, adjusted Rand index, normalised mutual information."""
    cells = stage(
        df.where(F.col(label).isNotNull()).groupBy(cluster, label).agg(F.count("*").alias("n"))
    )

    def pairs(n: Column) -> Column:
        return n * (n - 1) / 2

    def plogp(n: Column) -> Column:
        return n * F.ln(n)

    n = F.col("n").cast("double")
    sides = []
    for side in (cluster, label):
        sums = cells.groupBy(side).agg(F.sum("n").alias("n"))
        sides.append(sums.agg(F.sum(pairs(n)).alias("c"), F.sum(plogp(n)).alias("l"), F.count("*").alias("k")))
    both = cells.agg(
        F.sum(pairs(n)).alias("ij"), F.sum(plogp(n)).alias("lij"), F.sum(n).alias("n")
    )
    out = both
    for tag, side in zip("ab", sides):
        for name in ("c", "l", "k"):
            out = out.withColumn(f"{tag}_{name}", side.select(name).scalar())
    expected = F.try_divide(F.col("a_c") * F.col("b_c"), pairs(F.col("n")))
    most = (F.col("a_c") + F.col("b_c")) / 2
    ari = F.when(most == expected, 1.0).otherwise(
        F.try_divide(F.col("ij") - expected, most - expected)
    )
    log_n = F.ln("n")
    mutual = (F.col("lij") - F.col("a_l") - F.col("b_l")) / F.col("n") + log_n
    entropy_a = log_n - F.col("a_l") / F.col("n")
    entropy_b = log_n - F.col("b_l") / F.col("n")
    nmi = F.when((F.col("a_k") == 1) & (F.col("b_k") == 1), 1.0).otherwise(
        F.coalesce(F.try_divide(F.greatest(mutual, F.lit(0.0)), (entropy_a + entropy_b) / 2), F.lit(0.0))
    )
    return out.select(F.col("n").cast("long").alias("n_labeled"), ari.alias("ari"), nmi.alias("nmi"))


def silhouette_squared(
    df: DataFrame, vector: str = "vector", cluster: str = "cluster"
) -> DataFrame:
    """Silhouette under squared Euclidean distance, per row, in linear time.

    The mean squared distance of a point to a cluster follows from the cluster's
    size, sum vector and sum of squared norms, so one row per cluster is enough.
    """
    rows = df.withColumn("__sq", F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    sizes = rows.groupBy(cluster).agg(F.count("*").alias("n"), F.sum("__sq").alias("sq"))
    sums = (
        rows.select(cluster, F.posexplode(vector).alias("i", "x"))
        .groupBy(cluster, "i")
        .agg(F.sum("x").alias("s"))
        # one entry per vector position
        .groupBy(cluster)
        .agg(F.array_sort(F.collect_list(F.struct("i", "s"))).alias("s"))
    )
    centres = (
        sizes.join(sums, cluster)
        .select(F.struct(F.col(cluster).alias("c"), "n", "sq", F.col("s.s").alias("s")).alias("k"))
        .agg(F.collect_list("k").alias("ks"))  # one struct per cluster
    )

    def mean_distance(k: Column, own: bool) -> Column:
        dot = F.aggregate(F.zip_with(F.col(vector), k["s"], lambda x, s: x * s), F.lit(0.0), lambda a, v: a + v)
        total = k["n"] * F.col("__sq") - 2 * dot + k["sq"]
        return F.try_divide(total, k["n"] - 1 if own else k["n"])

    placed = rows.withColumn("ks", centres.scalar())
    a = F.array_max(
        F.transform(F.filter("ks", lambda k: k["c"] == F.col(cluster)), lambda k: mean_distance(k, True))
    )
    b = F.array_min(
        F.transform(F.filter("ks", lambda k: k["c"] != F.col(cluster)), lambda k: mean_distance(k, False))
    )
    score = F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    return placed.withColumns({"a": a, "b": b}).withColumn("silhouette", F.when(F.col("a").isNull(), 0.0).otherwise(score)).drop(
        "ks", "a", "b", "__sq"
    )


def silhouette_exact(
    df: DataFrame, id_col: str, vector: str = "vector", cluster: str = "cluster", block_rows: int = 2048
) -> DataFrame:
    """``(id, cluster, silhouette)`` under Euclidean distance; see :func:`silhouettes_exact`."""
    return silhouettes_exact(df, id_col, [cluster], vector, block_rows).drop("clustering").withColumnRenamed(
        "__cluster", cluster
    )


def silhouettes_exact(
    df: DataFrame, id_col: str, clusterings: Sequence[str], vector: str = "vector", block_rows: int = 2048
) -> DataFrame:
    """``(id, clustering, __cluster, silhouette)`` under Euclidean distance, for several cluster columns of one type.

    The measure itself needs every distance once; all clusterings share it. Rows are hashed into blocks of
    about ``block_rows``; each unordered pair of blocks is measured once, for both of them. Distances never
    become rows, and what is moved are distance sums per row and cluster (see ``distances``). The driver gets a row
    for each cluster. Ids must be unique; rows without a cluster count for none and get 0.
    """
    require_unique(df, [id_col], "the rows of a silhouette")
    n = df.count()
    # enough pairs of blocks for every core, though no block gets tiny for it
    for_cores = math.ceil(math.sqrt(2 * df.sparkSession.sparkContext.defaultParallelism))
    blocks = max(1, math.ceil(n / block_rows), min(for_cores, math.ceil(n / 64)))
    kind = df.schema[id_col].dataType.simpleString()
    ckind = df.schema[clusterings[0]].dataType.simpleString()
    members = df.select(F.posexplode(F.array(*clusterings)).alias("m", "target")).where(F.col("target").isNotNull())
    counted = members.groupBy("m", "target").agg(F.count("*").alias("n")).orderBy("m", "target")
    sizes = [(r.m, r.target, r.n) for r in counted.collect()] or [(-1, None, 0)]  # a row for each cluster
    rows = df.select(
        F.pmod(F.xxhash64(id_col), F.lit(blocks)).cast("int").alias("block"),
        F.col(id_col).alias("id"),
        F.array(*clusterings).alias("c"),
        F.col(vector).cast("array<double>").alias("v"),
    )
    packed = stage(
        rows.groupBy("block").applyInArrow(
            _packed(sizes, len(clusterings)), f"block int, ids array<{kind}>, names array<{ckind}>, codes binary, x binary"),
        "blocks",
    )
    left = packed.select(F.col("block").alias("i"), F.col("codes").alias("ci"), F.col("x").alias("xi"))
    right = packed.select(F.col("block").alias("j"), F.col("codes").alias("cj"), F.col("x").alias("xj"))
    pairs = ds.meet(left, right, F.col("i") <= F.col("j"))
    sums = ds.added(pairs.mapInArrow(_pair_sums(len(sizes), len(clusterings)), "block int, sums binary"), ["block"])
    scored = sums.join(packed.select("block", "ids", "names", "codes"), "block").mapInArrow(
        _scores(sizes, len(clusterings)), f"id {kind}, m int, c {ckind}, silhouette double")
    return scored.select(
        F.col("id").alias(id_col),
        F.get(F.lit(list(clusterings)), F.col("m")).alias("clustering"),
        F.col("c").alias("__cluster"),
        "silhouette",
    )


def _packed(sizes: list[tuple], clusterings: int):
    """Task function that packs a block; the code of a cluster is its place among ``sizes``, -1 without one."""
    code = {(m, name): at for at, (m, name, _) in enumerate(sizes)}
    matrix = ds.vectors_of()

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, names, xs = [], [], []
        for batch in batches:
            ids.append(batch.column("id"))
            names.append(batch.column("c").flatten())
            xs.append(matrix(batch.column("v")))
        ids, names = pa.concat_arrays(ids), pa.concat_arrays(names)
        codes = np.array([code.get((at % clusterings, name), -1) for at, name in enumerate(names.to_pylist())], dtype="<i4")
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.ListArray.from_arrays([0, len(ids)], ids),
             pa.ListArray.from_arrays([0, len(names)], names), pa.array([codes.tobytes()], pa.binary()),
             pa.array([np.vstack(xs).astype("<f8").tobytes()], pa.binary())],
            ["block", "ids", "names", "codes", "x"])

    return pack


def _pair_sums(clusters: int, clusterings: int):
    """Task function for pairs of blocks: per row of either block, distance sums to the other by cluster."""
    distances = ds.between()

    def read(batch: pa.RecordBatch, row: int, side: str) -> tuple[int, np.ndarray, np.ndarray]:
        codes = np.frombuffer(batch.column(f"c{side}")[row].as_buffer(), dtype="<i4").reshape(-1, clusterings)
        member = np.zeros((len(codes), clusters))
        at, m = np.nonzero(codes >= 0)
        member[at, codes[at, m]] = 1.0
        x = np.frombuffer(batch.column(f"x{side}")[row].as_buffer(), dtype="<f8").reshape(len(codes), -1)
        return batch.column(side)[row].as_py(), x, member

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                i, x, mine = read(batch, row, "i")
                j, y, theirs = read(batch, row, "j")
                to, back = totals.setdefault(i, np.zeros((len(x), clusters))), totals.setdefault(j, np.zeros((len(y), clusters)))
                for at, d in distances(x, y):
                    to[at : at + len(d)] += d @ theirs
                    if i != j:
                        back += d.T @ mine[at : at + len(d)]
        for block, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["block", "sums"])

    return sums


def _scores(sizes: list[tuple], clusterings: int):
    """Task function: silhouettes from the whole sums of a block."""
    which, n = np.array([m for m, _, _ in sizes], dtype=int), np.array([float(n) for _, _, n in sizes])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, names = batch.column("ids")[row].values, batch.column("names")[row].values
                codes = np.frombuffer(batch.column("codes")[row].as_buffer(), dtype="<i4").reshape(len(ids), clusterings)
                total = np.frombuffer(batch.column("sums")[row].as_buffer(), dtype="<f8").reshape(len(ids), -1)
                out, at = np.zeros(codes.shape), np.arange(len(ids))
                for m in range(clusterings):
                    own, others = codes[:, m], which == m
                    alone = (own < 0) | (n[own] < 2)
                    a = total[at, own] / np.where(alone, 1.0, n[own] - 1)
                    means = np.where(others, total / n, np.nan)
                    means[at, own] = np.nan
                    b = np.fmin.reduce(means, axis=1)  # none: the only cluster
                    most = np.maximum(a, b)
                    known = ~alone & (others.sum() > 1) & (most != 0)
                    out[known, m] = ((b - a)[known]) / most[known]
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.repeat(at, clusterings))), pa.array(np.tile(np.arange(clusterings, dtype="int32"), len(ids))),
                     names, pa.array(out.ravel())],
                    ["id", "m", "c", "silhouette"])

    return score


# --- factors and attributions ------------------------------------------------


def variance_explained(cells: DataFrame, factors: int) -> DataFrame:
    """``(factor, view, r2)`` in percent from cells with both factor arrays.

    ``cells`` has ``view``, the centred ``value``, the entity scores ``z`` and
    the feature loadings ``w``; one pass with one sum per factor.
    """
    residuals = [
        F.sum(F.pow(F.col("value") - F.get("z", F.lit(k)) * F.get("w", F.lit(k)), F.lit(2))).alias(f"r{k}")
        for k in range(factors)
    ]
    per_view = cells.groupBy("view").agg(F.sum(F.col("value") * F.col("value")).alias("t"), *residuals)
    return per_view.select(
        "view",
        F.posexplode(
            F.array(*[100 * (1 - F.try_divide(F.col(f"r{k}"), F.col("t"))) for k in range(factors)])
        ).alias("k", "r2"),
    ).select((F.col("k") + 1).alias("factor"), "view", "r2")


def attribution_summary(contributions: DataFrame) -> DataFrame:
    """``(feature, class, mean_abs, mean_abs_all)`` from ``(feature, class, contribution)``.

    The overall score is the plain mean of the class scores.
    """
    per_class = contributions.groupBy("feature", "class").agg(
        F.avg(F.abs("contribution")).alias("mean_abs")
    )
    overall = per_class.groupBy("feature").agg(F.avg("mean_abs").alias("mean_abs_all"))
    return per_class.join(overall, "feature").select("feature", "class", "mean_abs", "mean_abs_all")


def top_loadings(loadings: DataFrame, k: int) -> DataFrame:
    """Top k per (view, factor) by magnitude: ``rank`` added."""
    return top_per_key(loadings, [F.desc(F.abs("loading")), F.asc("feature")], k, ["view", "factor"])


def loading_bars(loadings: DataFrame, factor: object, k: int) -> DataFrame:
    """One factor's top k per view by magnitude, listed by signed loading."""
    own = loadings.where(F.col("factor") == factor)
    return top_loadings(own, k).orderBy("view", "loading", "feature")
