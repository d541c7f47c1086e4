"""k-means of several k and restarts at once, a Spark job for each step of all of them.

Rows are packed into blocks once (see ``distances``). A step measures every block against the centres of all fits that
still move, in one matrix product, and what is shuffled are sums of fixed size: for each fit a vector, a size and a cost
per centre, once for each task. Starts are those of k-means||: rows are drawn in proportion to their squared distance to
the centres drawn before, weighed by the rows nearest to them, and reduced to k on the driver (some 4 k candidates a fit).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from cohortviews.operators import distances as ds
from cohortviews.session import stage

BLOCK_ROWS = 2048


class Fit(NamedTuple):
    """Means of k clusters (a row each; fewer if there are fewer distinct vectors), and the squared distances to them."""

    k: int
    cost: float
    means: np.ndarray


def best_fits(
    df: DataFrame,
    ks: Sequence[int],
    vector: str = "vector",
    restarts: int = 10,
    seed: int = 42,
    max_iter: int = 50,
    tol: float = 1e-4,
) -> list[Fit]:
    """For each k the fit with the smallest cost among the restarts.

    A fit ends after ``max_iter`` steps, or once no mean moved further than ``tol``. A mean that loses all rows stays
    where it is. Vectors must be there, of one length and without gaps.
    """
    n = df.count()
    if n == 0:
        raise ValueError("no rows to cluster")
    wide = df.select(F.col(vector).cast("array<double>").alias("v")).repartition(math.ceil(n / BLOCK_ROWS))
    blocks = stage(wide.mapInArrow(_packed(), "block int, n int, x binary"), "blocks")
    wanted = [k for k in ks for _ in range(restarts)]
    centres = _starts(blocks, wanted, [seed + attempt for _ in ks for attempt in range(restarts)])
    moving = list(range(len(wanted)))
    for _ in range(max_iter):
        found = _sums(blocks, {f: centres[f] for f in moving}, means=True)
        still = []
        for f in moving:
            size, _, total = found[f]
            new = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], centres[f])
            if (((new - centres[f]) ** 2).sum(1) > tol * tol).any():
                still.append(f)
            centres[f] = new
        moving = still
        if not moving:
            break
    cost = {f: float(c.sum()) for f, (_, c, _) in _sums(blocks, dict(enumerate(centres))).items()}
    best = (min(range(i * restarts, (i + 1) * restarts), key=cost.__getitem__) for i in range(len(ks)))
    return [Fit(int(wanted[f]), cost[f], centres[f]) for f in best]


def with_clusters(df: DataFrame, means: Mapping[str, np.ndarray], vector: str = "vector") -> DataFrame:
    """Rows with one column for each entry of ``means``: the place of the mean nearest to the row's vector."""
    nearest, matrix, names = _nearest(), ds.vectors_of(), list(means)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            columns, x = batch.columns[:-1], matrix(batch.column("__x"))
            placed = {name: np.zeros(len(x), dtype="int32") for name in names}
            for at in range(0, len(x), 2048):
                for name, (own, _) in zip(names, nearest(x[at : at + 2048], [means[m] for m in names])):
                    placed[name][at : at + 2048] = own
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(p) for p in placed.values()]], [*batch.schema.names[:-1], *names])

    schema = T.StructType([*df.schema.fields, *[T.StructField(name, T.IntegerType()) for name in names]])
    return df.withColumn("__x", F.col(vector).cast("array<double>")).mapInArrow(place, schema)


def _packed():
    """Task function that packs the rows of a partition into one block."""
    matrix = ds.vectors_of()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [matrix(batch.column("v")) for batch in batches if batch.num_rows]
        if parts:
            x = np.vstack(parts).astype("<f8")
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([len(x)], pa.int32()),
                 pa.array([x.tobytes()], pa.binary())],
                ["block", "n", "x"])

    return pack


def _nearest() -> Callable:
    """Task function: for each of several sets of centres the place of the nearest one to each row, and the squared distance."""
    close = ds.CLOSE

    def nearest(x: np.ndarray, sets: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        centre = x.mean(0)  # a common offset would cost digits
        every = np.vstack(sets)
        moved, rows = every - centre, x - centre
        xx, cc = np.einsum("ij,ij->i", rows, rows), np.einsum("ij,ij->i", moved, moved)
        d = rows @ (-2 * moved).T
        d += cc
        start = 0
        for centres in sets:
            part = d[:, start : start + len(centres)]
            own = part.argmin(1)
            least = part[np.arange(len(x)), own] + xx
            # a product has lost digits there: from the difference
            odd = np.flatnonzero(least < close * (xx + cc[start : start + len(centres)][own]))
            gap = x[odd] - centres[own[odd]]
            least[odd] = np.einsum("ij,ij->i", gap, gap)
            yield own, least
            start += len(centres)

    return nearest


def _sums(blocks: DataFrame, centres: Mapping[int, np.ndarray], means: bool = False) -> dict[int, tuple]:
    """For each fit ``(sizes, costs, totals)`` of its centres: rows nearest to each, their squared distances, their sum."""
    fits, sets, nearest = list(centres), list(centres.values()), _nearest()
    width = sets[0].shape[1]
    starts = np.cumsum([0, *map(len, sets)])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((int(starts[-1]), 2 + (width if means else 0)))
        for batch in batches:
            for packed in batch.column("x"):
                x = np.frombuffer(packed.as_buffer(), dtype="<f8").reshape(-1, width)
                member = np.zeros((len(x), len(sums))) if means else None
                for start, end, (own, least) in zip(starts, starts[1:], nearest(x, sets)):
                    sums[start:end, 0] += np.bincount(own, minlength=end - start)
                    sums[start:end, 1] += np.bincount(own, least, minlength=end - start)
                    if means:
                        member[np.arange(len(x)), start + own] = 1.0
                if means:
                    sums[:, 2:] += member.T @ x
        parts = [sums[start:end].tobytes() for start, end in zip(starts, starts[1:])]
        yield pa.RecordBatch.from_arrays([pa.array(fits, pa.int32()), pa.array(parts, pa.binary())], ["fit", "sums"])

    added = ds.added(blocks.select("x").mapInArrow(add, "fit int, sums binary"), ["fit"])
    found = {r.fit: np.frombuffer(r.sums, dtype="<f8").reshape(len(centres[r.fit]), -1) for r in added.collect()}  # a row a fit
    return {f: (s[:, 0], s[:, 1], s[:, 2:]) for f, s in found.items()}


def _starts(blocks: DataFrame, ks: list[int], seeds: list[int], steps: int = 2) -> list[np.ndarray]:
    """First centres of each fit, by k-means||: ``steps`` draws of about 2 k rows, more only while a fit has too few."""
    rngs = [np.random.default_rng([seed, k]) for seed, k in zip(seeds, ks)]
    sizes = blocks.select("block", "n").orderBy("block").collect()  # a row for each block of 2,048 rows
    ends = np.cumsum([r.n for r in sizes])
    picks: dict[int, list[tuple[int, int]]] = {}
    for f, rng in enumerate(rngs):
        row = int(rng.integers(ends[-1]))
        at = int(np.searchsorted(ends, row, side="right"))
        picks.setdefault(sizes[at].block, []).append((f, row - int(ends[at]) + sizes[at].n))
    drawn = _rows_of(blocks.where(F.col("block").isin(list(picks))), lambda block, x: picks.get(block, []))
    centres = [drawn[f] for f in range(len(ks))]
    step = 0
    while True:
        found = _sums(blocks, dict(enumerate(centres)))
        cost = [float(found[f][1].sum()) for f in range(len(ks))]
        asking = [f for f, k in enumerate(ks) if cost[f] > 0 and (step < steps or len(centres[f]) < k)]
        if not asking:
            break
        drawn = _rows_of(blocks, _draw({f: (centres[f], 2 * ks[f] / cost[f], [seeds[f], ks[f], step]) for f in asking}))
        for f, more in drawn.items():
            centres[f] = np.vstack([centres[f], more])
        step += 1
    return [_reduced(centres[f], found[f][0], k, rngs[f]) for f, k in enumerate(ks)]


def _draw(asking: Mapping[int, tuple]):
    """Choice of rows for :func:`_rows_of`: each with a chance in proportion to its squared distance, the same when run again."""
    nearest, sets = _nearest(), [centres for centres, _, _ in asking.values()]

    def draw(block: int, x: np.ndarray) -> Iterator[tuple[int, int]]:
        for (f, (_, share, seed)), (_, least) in zip(asking.items(), nearest(x, sets)):
            chance = np.random.default_rng([*seed, block]).random(len(x))
            yield from ((f, int(row)) for row in np.flatnonzero(chance < share * least))

    return draw


def _rows_of(blocks: DataFrame, choose: Callable) -> dict[int, np.ndarray]:
    """``fit -> rows`` that ``choose(block, rows)`` names as ``(fit, row)``."""

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block, n = batch.column("block")[at].as_py(), batch.column("n")[at].as_py()
                x = np.frombuffer(batch.column("x")[at].as_buffer(), dtype="<f8").reshape(n, -1)
                found = list(choose(block, x))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f for f, _ in found], pa.int32()), pa.array([block] * len(found), pa.int32()),
                     pa.array([row for _, row in found], pa.int32()), pa.array([x[row].tobytes() for _, row in found], pa.binary())],
                    ["fit", "block", "row", "x"])

    rows = blocks.mapInArrow(chosen, "fit int, block int, row int, x binary").orderBy("fit", "block", "row").collect()
    out: dict[int, list[np.ndarray]] = {}
    for r in rows:  # some 2 k rows a fit
        out.setdefault(r.fit, []).append(np.frombuffer(r.x, dtype="<f8"))
    return {f: np.vstack(found) for f, found in out.items()}


def _reduced(candidates: np.ndarray, weights: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k of the weighed candidates, by k-means++; fewer if fewer differ."""
    chosen = [int(rng.choice(len(candidates), p=weights / weights.sum()))]
    least = ((candidates - candidates[chosen[0]]) ** 2).sum(1)
    while len(chosen) < k and (mass := least * weights).sum() > 0:
        chosen.append(int(rng.choice(len(candidates), p=mass / mass.sum())))
        least = np.minimum(least, ((candidates - candidates[chosen[-1]]) ** 2).sum(1))
    return candidates[chosen].copy()
