"""Exact Euclidean silhouettes that measure only the clusters which can matter.

A silhouette needs the mean distance to the own cluster and to the nearest other one. The mean distance from a point to a
cluster is at least its distance to the cluster's mean, and at most the root of the mean squared distance (both follow
from convexity, and both need one row for each cluster only). A cluster whose least exceeds another one's most cannot be
the nearest, so no distance to its members is computed. Well separated clusterings keep one candidate a point instead of
k - 1; where clusters lie inside each other everything is measured, and the result is the same.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.operators import distances as ds
from cohortviews.operators.quality import require_unique
from cohortviews.session import small_side, stage


def _squared(x: Column | str, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda t, v: t + v)


def _centres(rows: DataFrame) -> DataFrame:
    """``(c, n, mu, spread)`` of each cluster: size, mean, and mean squared distance to the mean."""
    means = (
        rows.select("c", F.posexplode("v").alias("i", "x")).groupBy("c", "i").agg(F.avg("x").alias("x"))
        .groupBy("c").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("mu"))  # one entry for each dimension
        .select("c", F.col("mu.x").alias("mu"))
    )
    means = stage(means, "centres")
    spread = rows.join(small_side(means), "c").groupBy("c").agg(F.count("*").alias("n"), F.avg(_squared("v", F.col("mu"))).alias("spread"))
    return stage(means.join(spread, "c"), "centres")


def candidates(rows: DataFrame, centres: DataFrame) -> DataFrame:
    """Rows with ``near``: the clusters one of which is the nearest other one, by the bounds."""
    listed = centres.agg(F.collect_list(F.struct("c", "mu", "spread")).alias("ks"))  # one struct for each cluster
    others = F.transform(
        F.filter("ks", lambda k: k["c"] != F.col("c")),
        lambda k: F.struct(k["c"].alias("c"), _squared("v", k["mu"]).alias("d"), k["spread"].alias("spread")),
    )
    placed = rows.withColumn("ks", listed.scalar()).withColumn("others", others)
    most = F.array_min(F.transform("others", lambda k: F.sqrt(k["d"] + k["spread"])))
    # a billionth of slack, so that rounding never drops the nearest one
    kept = F.filter("others", lambda k: F.sqrt(k["d"]) * (1 - 1e-9) <= F.col("most") * (1 + 1e-9))
    return placed.withColumn("most", most).withColumn("near", F.transform(kept, lambda k: k["c"])).drop("ks", "others", "most")


def silhouette_bounded(
    df: DataFrame, id_col: str, vector: str = "vector", cluster: str = "cluster", block_rows: int = 2048
) -> DataFrame:
    """``(id, cluster, silhouette, n_distances)``: the values of ``evaluate.silhouette_exact``, and what each one cost.

    Rows are cut into blocks of one cluster and about ``block_rows`` rows; a block of points meets the blocks that some of
    them must be measured against, and what is moved are distance sums per point and cluster (see ``distances``). The driver
    gets a row for each cluster. Points alone in their cluster, or in the only cluster, get 0. Rows without a
    cluster take no part; ids must be unique.
    """
    df = df.where(F.col(cluster).isNotNull())
    require_unique(df, [id_col], "the rows of a silhouette")
    rows = df.select(F.col(id_col).alias("id"), F.col(cluster).alias("c"), F.col(vector).cast("array<double>").alias("v"))
    kind, ckind = (rows.schema[c].dataType.simpleString() for c in ("id", "c"))
    centres = _centres(rows)
    blocks = centres.select("c", "n", F.ceil(F.col("n") / block_rows).cast("int").alias("blocks"))
    sized = small_side(blocks)
    points = candidates(rows, centres).join(sized, "c").withColumn("t", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    sizes = [(r.c, r.n) for r in centres.select("c", "n").orderBy("c").collect()]  # a row for each cluster
    packed = stage(
        points.select("c", "t", "id", "v", "near").groupBy("c", "t").applyInArrow(
            _packed(sizes), f"c {ckind}, code int, t int, ids array<{kind}>, x binary, near binary, targets array<int>"),
        "blocks",
    )
    block = F.struct("code", "t", "x", "near", "targets")
    left, right = packed.select(block.alias("p")), packed.select(block.alias("q"))
    asked = ds.meet(
        left, right,
        (F.struct("p.code", "p.t") <= F.struct("q.code", "q.t"))
        & (F.array_contains("p.targets", F.col("q.code")) | F.array_contains("q.targets", F.col("p.code"))),
    ).select(*[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in "pq" for c in ("code", "t", "x", "near", "targets")])
    sums = ds.added(asked.mapInArrow(_asked_sums(), "code int, t int, sums binary"), ["code", "t"])
    scored = sums.join(packed.drop("x"), ["code", "t"]).mapInArrow(
        _scores(sizes), f"id {kind}, c {ckind}, silhouette double, n_distances long")
    return scored.withColumnsRenamed({"id": id_col, "c": cluster})


def _packed(sizes: list[tuple]):
    """Task function that packs a block of one cluster, with the clusters that each row must be measured against.

    ``near`` has a row for each vector and a column for each of the block's ``targets``, its own cluster among them.
    """
    code = {name: at for at, (name, _) in enumerate(sizes)}
    matrix = ds.vectors_of()

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, ids, xs, near = code[key[0].as_py()], [], [], []
        for batch in batches:
            ids.append(batch.column("id"))
            xs.append(matrix(batch.column("v")))
            near += [[own, *(code[c] for c in names)] for names in batch.column("near").to_pylist()]
        targets = sorted({c for row in near for c in row})
        place = {c: at for at, c in enumerate(targets)}
        wanted = np.zeros((len(near), len(targets)), dtype=bool)
        for at, row in enumerate(near):
            wanted[at, [place[c] for c in row]] = True
        ids = pa.concat_arrays(ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], key[0].type), pa.array([own], pa.int32()), pa.array([key[1].as_py()], pa.int32()),
             pa.ListArray.from_arrays([0, len(ids)], ids), pa.array([np.vstack(xs).astype("<f8").tobytes()], pa.binary()),
             pa.array([wanted.tobytes()], pa.binary()), pa.array([targets], pa.list_(pa.int32()))],
            ["c", "code", "t", "ids", "x", "near", "targets"])

    return pack


def _asked_sums():
    """Task function for two blocks some points of which must be measured against the other; no distance is taken twice."""
    distances = ds.between()

    def read(batch: pa.RecordBatch, row: int, side: str, totals: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
        key = tuple(batch.column(f"{side}_{c}")[row].as_py() for c in ("code", "t"))
        targets = batch.column(f"{side}_targets")[row].as_py()
        near = np.frombuffer(batch.column(f"{side}_near")[row].as_buffer(), dtype=bool).reshape(-1, len(targets))
        x = np.frombuffer(batch.column(f"{side}_x")[row].as_buffer(), dtype="<f8").reshape(len(near), -1)
        return x, near, totals.setdefault(key, np.zeros(near.shape)), targets

    def asking(near: np.ndarray, targets: list[int], code: int) -> tuple[int, np.ndarray]:
        if code not in targets:
            return 0, np.zeros(0, dtype=int)
        at = targets.index(code)
        return at, np.flatnonzero(near[:, at])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for row in range(batch.num_rows):
                p, q = (tuple(batch.column(f"{side}_{c}")[row].as_py() for c in ("code", "t")) for side in "pq")
                x, near, to, targets = read(batch, row, "p", totals)
                at, asks = asking(near, targets, q[0])
                y, near, back, targets = read(batch, row, "q", totals)
                other, answers = asking(near, targets, p[0]) if p != q else (0, asks[:0])
                for start, d in distances(x[asks], y) if len(asks) else ():
                    to[asks[start : start + len(d)], at] += d.sum(1)
                    if len(answers):
                        back[answers, other] += d.sum(0)[answers]
                rest = np.setdiff1d(np.arange(len(x)), asks)
                for _, d in distances(x[rest], y[answers]) if len(rest) and len(answers) else ():
                    back[answers, other] += d.sum(0)
        for (code, t), total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([code], pa.int32()), pa.array([t], pa.int32()), pa.array([total.tobytes()], pa.binary())],
                ["code", "t", "sums"])

    return sums


def _scores(sizes: list[tuple]):
    """Task function: silhouettes from the whole sums of a block, and the distances each one took."""
    n = np.array([float(n) for _, n in sizes])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, targets = batch.column("ids")[row].values, batch.column("targets")[row].as_py()
                shape = (len(ids), len(targets))
                near = np.frombuffer(batch.column("near")[row].as_buffer(), dtype=bool).reshape(shape)
                total = np.frombuffer(batch.column("sums")[row].as_buffer(), dtype="<f8").reshape(shape)
                own, members = targets.index(batch.column("code")[row].as_py()), n[targets]
                a = total[:, own] / max(members[own] - 1, 1.0)
                means = np.where(near, total / members, np.nan)
                means[:, own] = np.nan
                b = np.fmin.reduce(means, axis=1)  # none: the only cluster
                most = np.maximum(a, b)
                known = (most != 0) & near[:, np.arange(len(targets)) != own].any(1) & (members[own] > 1)
                out = np.zeros(len(ids))
                out[known] = (b - a)[known] / most[known]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([batch.column("c")[row].as_py()] * len(ids), batch.column("c").type), pa.array(out),
                     pa.array((near @ members).astype("int64"))],
                    ["id", "c", "silhouette", "n_distances"])

    return score
