"""Approximate nearest neighbours by multi-index hashing.

Two learned rotations (principal directions, then iterative quantisation) turn a vector into 2 x dimension sign bits.
Codes are split into substrings of eight bits and each substring is indexed. By the pigeonhole principle a code within
radius r of a query's differs by at most t_i in some substring i if the t_i + 1 sum to r + 1; all substring values that
near are probed, which retrieves every code within the radius, and the vectors found are ranked by Euclidean distance in
double precision. The radius is the one that held nearly all true neighbours of sampled queries in the sample; it only
gets safer with more rows, whose neighbours lie closer. A query with fewer than k codes in it searches wider.

Every row is indexed. Rows are dealt into blocks and queries into chunks, both of fixed size; a task indexes one block
and answers one chunk, and the best k of all blocks are the answer.

Nulls: a vector that is null, zero, of another length than most or with a null or non-finite component takes no part,
neither does a row without an id. Equal distances go to the smaller id; a repeated row is a candidate of its own. A
query never finds rows with its own id. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortviews.llm.vectors import dimension_of, usable

#: Rows that the rotations and the radius are fitted on, on average.
SAMPLE_ROWS = 8000
SAMPLE_QUERIES = 200
#: Share of true neighbours in the sample that the radius must hold.
HELD = 0.98
ROTATIONS, SUBSTRING = 2, 8
BLOCK_ROWS, CHUNK_QUERIES = 2048, 1024


def fit(sample: np.ndarray, k: int, rounds: int = 30) -> dict:
    """Mean, rotations and radius from sampled vectors."""
    mean = sample.mean(0)
    centred = sample - mean
    directions = np.linalg.eigh(centred.T @ centred)[1][:, ::-1].T
    rng = np.random.default_rng(31)
    maps = []
    for _ in range(ROTATIONS):
        turn, _ = np.linalg.qr(rng.normal(size=(sample.shape[1],) * 2))
        x = centred @ directions.T
        for _ in range(rounds):
            u, _, v = np.linalg.svd(np.where(x @ turn >= 0, 1.0, -1.0).T @ x)
            turn = (u @ v).T
        maps.append(directions.T @ turn)
    model = {"mean": mean, "map": np.concatenate(maps, axis=1)}
    bits = codes(model, sample)
    far = []
    for q in range(min(SAMPLE_QUERIES, len(sample))):
        d = ((sample - sample[q]) ** 2).sum(1)
        d[q] = np.inf
        near = np.argsort(d)[: min(k, len(sample) - 1)]
        far.append(np.bitwise_count(bits[near] ^ bits[q]).sum(1))
    far = np.concatenate(far) if far else np.zeros(0)
    model["radius"] = int(np.ceil(np.quantile(far, HELD))) if len(far) else bits.shape[1] * SUBSTRING
    return model


def codes(model: dict, x: np.ndarray) -> np.ndarray:
    """(vectors, substrings) of eight bits each."""
    return np.packbits((x - model["mean"]) @ model["map"] >= 0, axis=1)


class Index:
    """Positions by the value of every substring."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.order = np.argsort(bits, axis=0, kind="stable").astype(np.int32)
        every = np.arange(257)
        self.starts = np.array([np.searchsorted(bits[self.order[:, i], i], every) for i in range(bits.shape[1])])
        self.near = [
            np.array([sum(1 << b for b in c) for d in range(t + 1) for c in combinations(range(SUBSTRING), d)], np.int64)
            for t in range(SUBSTRING + 1)
        ]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Positions of every code at most ``radius`` bits from ``code``."""
        parts = self.bits.shape[1]
        each, more = divmod(radius + 1, parts)
        seen = np.zeros(len(self.bits), bool)
        for i in range(parts):
            t = min(each + (i < more) - 1, SUBSTRING)
            if t < 0:
                continue
            value = self.near[t] ^ int(code[i])
            starts, sizes = self.starts[i][value], self.starts[i][value + 1] - self.starts[i][value]
            before = np.cumsum(sizes) - sizes
            at = np.arange(sizes.sum()) + np.repeat(starts - before, sizes)
            seen[self.order[at, i]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.bits[found] ^ code).sum(1) <= radius]


def search_block(model: dict, ids: np.ndarray, x: np.ndarray, queries: np.ndarray, q: np.ndarray, k: int):
    """(query, row id, distance) of the k nearest rows of a block that each query finds."""
    index, asked = Index(codes(model, x)), codes(model, q)
    widest = index.bits.shape[1] * SUBSTRING
    out = []
    for i in range(len(queries)):
        radius = min(model["radius"], widest)
        while True:
            found = index.within(asked[i], radius)
            found = found[ids[found] != queries[i]]
            if len(found) >= k or radius == widest:
                break
            radius = min(widest, 2 * radius + 1)
        distance = np.sqrt(((x[found] - q[i]) ** 2).sum(1))
        best = np.lexsort((ids[found], distance))[:k]
        out.append((np.full(len(best), queries[i]), ids[found][best], distance[best]))
    return [np.concatenate(c) for c in zip(*out)]


def _vectors(column: pa.ChunkedArray, dimension: int) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64).reshape(-1, dimension)


def nearest(rows: DataFrame, every: int = 100, k: int = 10, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """query_id, rank, vec_id and score: the k nearest of each row whose vec_id is divisible by ``every``."""
    dimension = dimension_of(rows)
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"), dimension))
    seen = rows.agg(F.count("*").alias("n"), F.count_if(F.col("vec_id") % every == 0).alias("q")).first()
    u = F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.filter(u * F.lit(float(seen.n)) < sample_rows).orderBy("vec_id").select("embedding").toArrow()  # bounded
    sample = _vectors(drawn.column(0), dimension) if drawn.num_rows else np.zeros((0, dimension))
    model = fit(sample, k) if len(sample) > 1 else {"mean": np.zeros(dimension), "map": np.eye(dimension), "radius": dimension}

    blocks, chunks = -(-max(1, seen.n) // BLOCK_ROWS), -(-max(1, seen.q) // CHUNK_QUERIES)
    place = F.xxhash64("vec_id", "embedding")
    indexed = rows.select(
        "vec_id",
        "embedding",
        F.pmod(place, F.expr(f"{blocks}L")).alias("block"),
        F.explode(F.sequence(F.expr("0L"), F.expr(f"{chunks - 1}L"))).alias("chunk"),
    )
    asked = rows.filter(F.col("vec_id") % every == 0).select(
        "vec_id",
        "embedding",
        F.explode(F.sequence(F.expr("0L"), F.expr(f"{blocks - 1}L"))).alias("block"),
        F.pmod(place, F.expr(f"{chunks}L")).alias("chunk"),
    )

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids, queries = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        x, q = _vectors(left.column("embedding"), dimension), _vectors(right.column("embedding"), dimension)
        return pa.table([pa.array(c) for c in search_block(model, ids, x, queries, q, k)], names)

    key = ["block", "chunk"]
    found = indexed.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(answer, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
