"""SimHash near-duplicates: fingerprints of word shingles, linked by the generalised pigeonhole principle.

Equal fingerprints form one class, so copies cost one row each and no pairs. The 64 bits are grouped so that correlated
bits share a part. If thresholds t_i of the parts sum to tau - parts + 1, then two fingerprints within tau bits differ
by at most t_i in some part i; a part with threshold -1 is not probed at all. Every class gets thresholds of its own:
dynamic programming over the parts minimises the candidates that the exact value counts of each part predict, so common
values are probed narrowly or not at all. Probes meet the index in one join by (part, value), and the full distance is
checked in the join. A pair is guaranteed from either side, so only the smaller fingerprint looks for the larger.

Value counts have at most 2 ** width rows for each part (width 16), bit counts 64 x 64: both bounded whatever the input.

Nulls: a null text has no words and fingerprint zero, linked like any other. Null ids take part; a component of null
ids alone has a null id. Repeated rows are kept. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.common import map_texts, stage
from cohortviews.llm.components import components

BITS, SEED = 64, 42
WIDTH = 16
PARTS = BITS // WIDTH
#: Thresholds of a part run from -1 (not probed) to this.
WIDEST = 2


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Bit b is set if over half of the XXH64 values of the word shingles have it; 0 without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), len(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.array(
        [digest(joined[a:b], SEED) for a, b in zip(starts[: n - shingle + 1].tolist(), ends[shingle - 1 :].tolist())],
        dtype="<u8",
    )
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], shingle: int = 4) -> DataFrame:
    """The kept columns of ``docs`` and fp, the fingerprint of the text as a signed long."""

    def each(texts: list[bytes | None]) -> list[pa.Array]:
        values = np.array([fingerprint(t, shingle) for t in texts], dtype=np.uint64).view(np.int64)
        return [pa.array(values)]

    return map_texts(docs, keep, "fp long", each)


def _bits(fps: np.ndarray) -> np.ndarray:
    return np.unpackbits(fps.astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_groups(classes: DataFrame) -> list[list[int]]:
    """The bits in ``PARTS`` groups of ``WIDTH``, correlated ones together, from the counts of all classes."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS), np.int64)
        n = 0
        for batch in batches:
            b = _bits(batch.column(0).to_numpy(zero_copy_only=False)).astype(np.float64)
            both += (b.T @ b).astype(np.int64)
            n += len(b)
        cell = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.append(both.ravel(), n))], ["cell", "n"])

    rows = classes.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    cells = np.zeros(BITS * BITS + 1)
    for r in rows:
        cells[r.cell] = r.n
    n, both = max(cells[-1], 1.0), cells[:-1].reshape(BITS, BITS)
    p = np.diag(both) / n
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    related = np.abs((both / n - np.outer(p, p)) / np.outer(spread, spread))
    free, groups = set(range(BITS)), []
    while free:
        group = [min(free, key=lambda b: (-related[b, sorted(free)].sum(), b))]
        free -= set(group)
        while len(group) < WIDTH and free:
            b = min(free, key=lambda x: (-related[x, group].sum(), x))
            group.append(b)
            free.discard(b)
        groups.append(sorted(group))
    return groups


def masks(width: int, distance: int) -> np.ndarray:
    """Values of ``width`` bits with at most ``distance`` ones."""
    return np.array([sum(1 << b for b in c) for d in range(distance + 1) for c in combinations(range(width), d)], np.int64)


def part_values(fps: np.ndarray, group: list[int]) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for k, b in enumerate(group):
        out |= ((fps >> np.int64(b)) & 1) << k
    return out


def thresholds(values: list[np.ndarray], near: np.ndarray, tau: int) -> np.ndarray:
    """(classes, parts): the thresholds that sum to tau - parts + 1 with the fewest predicted candidates and probes.

    ``near[i][t][v]`` counts the classes whose part i lies within t bits of v.
    """
    n, total = len(values[0]), tau + 1  # each part spends t + 1 of it
    best = np.full((total + 1, n), np.inf)
    best[0] = 0
    choice = np.zeros((len(values), total + 1, n), np.int8)
    for i, v in enumerate(values):
        new = np.full_like(best, np.inf)
        for spend in range(total + 1):
            for used in range(0, min(spend, WIDEST + 1) + 1):
                t = used - 1
                cost = best[spend - used] + (near[i][t][v] + len(masks(WIDTH, t)) if t >= 0 else 0)
                better = cost < new[spend]
                new[spend][better] = cost[better]
                choice[i, spend][better] = used
        best = new
    out = np.zeros((n, len(values)), np.int8)
    left = np.full(n, total)
    for i in reversed(range(len(values))):
        used = choice[i, left, np.arange(n)]
        out[:, i] = used - 1
        left = left - used
    return out


def links(classes: DataFrame, tau: int = 4) -> DataFrame:
    """(a, b): every pair of different fingerprints of ``classes`` (fp, unique) within ``tau`` bits, once."""
    spark = classes.sparkSession
    groups = bit_groups(classes)
    fp = F.col("fp")

    def value(group: list[int]):
        out = F.lit(0)
        for k, b in enumerate(group):
            out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, b).bitwiseAND(F.lit(1)).cast("int"), k))
        return out

    index = classes.select(fp.alias("b"), F.posexplode(F.array(*[value(g) for g in groups])).alias("part", "value"))
    counted = index.groupBy("part", "value").agg(F.count("*").alias("n")).collect()  # at most PARTS * 2 ** WIDTH rows
    held = np.zeros((len(groups), 1 << WIDTH), np.int64)
    for r in counted:
        held[r.part, r.value] = r.n
    every = np.arange(1 << WIDTH)
    near = np.zeros((len(groups), WIDEST + 1, 1 << WIDTH), np.int64)
    for t in range(WIDEST + 1):
        for m in masks(WIDTH, t):
            near[:, t] += held[:, every ^ m]
    shared = spark.sparkContext.broadcast((near, held > 0))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, there = shared.value
        by_distance = [masks(WIDTH, t) for t in range(WIDEST + 1)]
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096).to_numpy(zero_copy_only=False)
                values = [part_values(fps, g) for g in groups]
                limits = thresholds(values, near, tau)
                for i, v in enumerate(values):
                    for t, m in enumerate(by_distance):
                        who = np.flatnonzero(limits[:, i] == t)
                        probes = v[who, None] ^ m[None, :]
                        row, col = np.nonzero(there[i][probes])
                        out = [np.full(len(row), i, np.int32), probes[row, col].astype(np.int32), fps[who[row]]]
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in out], ["part", "value", "a"])

    probes = classes.select("fp").mapInArrow(probe, "part int, value int, a long")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= tau)
    return probes.join(index, ["part", "value"]).filter(close).select("a", "b").distinct()


def grouped(prints: DataFrame, tau: int = 4) -> DataFrame:
    """(fp, label): the component of every fingerprint of ``prints``, named by its smallest fingerprint."""
    classes = stage(prints.select("fp").distinct(), "fingerprints")
    found = components(links(classes, tau)).select(F.col("node").alias("fp"), F.col("component").alias("label"))
    return classes.join(found, "fp", "left").select("fp", F.coalesce("label", "fp").alias("label"))


def near_duplicates(docs: DataFrame, tau: int = 4, shingle: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id reachable over links, for every row."""
    prints = stage(fingerprints(docs, ["doc_id"], shingle), "prints")
    labels = stage(grouped(prints, tau), "labels")
    lowest = prints.groupBy("fp").agg(F.min("doc_id").alias("low")).join(labels, "fp")
    named = lowest.groupBy("label").agg(F.min("low").alias("component_id"))
    named = labels.join(named, "label").select("fp", "component_id")
    return (
        prints.join(named, "fp")
        .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
    )


def one_of_each(docs: DataFrame, tau: int = 4, shingle: int = 4) -> DataFrame:
    """``docs`` without near-duplicates: of each component the row with the smallest doc_id stays, whole."""
    row = F.xxhash64(*[F.col(c) for c in docs.columns])
    keyed = docs.withColumns({"__row_key": row, "__id_key": F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1))})
    prints = stage(fingerprints(keyed, ["__id_key", "__row_key"], shingle), "prints")
    labels = grouped(prints, tau)
    per_print = prints.groupBy("fp").agg(F.min(F.struct("__id_key", "__row_key")).alias("first"))
    first = per_print.join(labels, "fp").groupBy("label").agg(F.min("first").alias("first"))
    kept = first.select("first.__id_key", "first.__row_key")
    return keyed.join(kept, ["__id_key", "__row_key"], "left_semi").dropDuplicates(["__id_key", "__row_key"]).select(*docs.columns)
