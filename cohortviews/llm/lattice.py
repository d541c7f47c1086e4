"""Embedding near-duplicates by lattice hashing.

A table projects the normed vectors on eight random orthogonal directions, scales them and decodes them to the E8
lattice: the nearest point is the vector's cell, and the next nearest ones, of the 240 around it, are probed too. Every
vector is listed in these cells in each of several tables, and two vectors are compared where they share a cell. Vectors
of a cell are compared in one matrix product, in double precision, and only pairs of the wanted cosine count.

A pair that meets in several cells counts in the first one alone (both sides' cells are decoded again to tell), so a
task returns sums for each vector and a spanning forest of its links, never all pairs of a group. Equal vectors are one
class with a multiplicity. A cell with very many classes is dealt over tiles of two blocks each, so no task compares
more than two blocks.

Nulls: a vector that is null, zero, of another length than most or with a null or non-finite component links with
nothing and is kept as its own component. Rows are vectors: a repeated row is another vector with the same id. Null ids
take part; a component of null ids alone has a null id. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.common import stage
from cohortviews.llm.components import components
from cohortviews.llm.vectors import dimension_of, number_type, usable
from cohortviews.session import small_side

#: These find 99.5 % of random pairs at exactly the wanted cosine, and more than 99.9 % a third of the way to 1. In few
#: dimensions every table sees about the same distance, none a much shorter one, so there are more tables.
TABLES, PROBES = 8, 3
FEW, MORE_TABLES = 32, 10
#: Mean squared distance in the lattice of a pair at the wanted cosine.
REACH = 0.8
BLOCK = 1024
LATTICE = 8


def _around() -> np.ndarray:
    """The 240 shortest vectors of E8."""
    out = []
    for i, j in combinations(range(LATTICE), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = np.zeros(LATTICE)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) for s in product((0.5, -0.5), repeat=LATTICE) if sum(x < 0 for x in s) % 2 == 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates and an even sum."""
    near = np.rint(x)
    off = x - near
    row, worst = np.arange(len(x)), np.abs(off).argmax(1)
    other = near.copy()
    other[row, worst] += np.where(off[row, worst] >= 0, 1, -1)
    return np.where((near.sum(1) % 2 != 0)[:, None], other, near)


def decode(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8, the integer and the half-integer ones."""
    a, b = _even(x), _even(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(1) <= ((x - b) ** 2).sum(1))[:, None], a, b)


def scale_of(least: float) -> float:
    """What brings a pair of unit vectors at cosine ``least`` to the mean squared distance ``REACH``, in any dimension.

    Capped where hardly any two vectors are that close, so that coordinates stay exact.
    """
    return float(np.sqrt(REACH / max(2 * (1 - least), 1e-10)))


class Hashing:
    """Random projections of ``dimension`` numbers; the same at every run.

    The squared length of a projection on eight of n orthogonal directions is 8 / n of the vector's on average, which
    sqrt(n / 8) undoes. Fewer than eight numbers are turned into eight without a change of lengths.
    """

    def __init__(self, dimension: int, tables: int | None = None, probes: int = PROBES, least: float = 0.9):
        rng = np.random.default_rng(2718)
        tables = tables or (TABLES if dimension > FEW else MORE_TABLES)
        scale = scale_of(least)
        self.probes = probes
        self.maps = []
        for _ in range(tables):
            m = rng.normal(size=(dimension, LATTICE))
            if dimension >= LATTICE:
                m = np.linalg.qr(m)[0] * np.sqrt(dimension / LATTICE)
            else:
                m = np.linalg.qr(m.T)[0].T
            self.maps.append(m * scale)
        self.around = _around()
        self.mix = rng.integers(1, 1 << 62, size=(tables, LATTICE), dtype=np.int64) | 1

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """(vectors, tables, probes): hashed cells of normed vectors."""
        out = np.empty((len(unit), len(self.maps), self.probes), np.int64)
        for t, m in enumerate(self.maps):
            x = unit @ m
            centre = decode(x)
            closer = (x - centre) @ self.around.T
            best = np.argsort(-closer, axis=1, kind="stable")[:, : self.probes - 1]
            points = np.concatenate([centre[:, None], centre[:, None] + self.around[best]], axis=1)
            whole = np.rint(2 * points).astype(np.int64)
            with np.errstate(over="ignore"):
                key = (whole * self.mix[t]).sum(2) + self.mix[t, 0] * 7919
                key ^= key >> 29
                out[:, t] = key * np.int64(-7046029254386353131)
        return out


def normed(x: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaled first so that no square overflows or vanishes."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    return np.array([np.frombuffer(v, kind) for v in column.to_pylist()], np.float64)


def _first_meeting(left: np.ndarray, right: np.ndarray, cell: int) -> np.ndarray:
    """Whether ``cell`` is the first cell that both of a pair are listed in, by table, then by hash."""
    same = (left[:, :, :, None] == right[:, :, None, :]).any(3)
    table = same.any(2).argmax(1)
    row = np.arange(len(left))
    shared = np.where(same[row, table], left[row, table], np.iinfo(np.int64).max)
    return shared.min(1) == cell


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest position that each of ``n`` positions reaches over the links a - b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _linked(hashing: Hashing, unit: np.ndarray, weight: np.ndarray, block: np.ndarray, inner: bool, cell: int, least: float):
    """Weighted link counts and lowest reached position of the members of one tile, or None without links.

    Pairs of one block count in that block's inner tile alone.
    """
    pairs = []
    for at in range(0, len(unit), 256):
        cosine = unit[at : at + 256] @ unit.T
        i, j = np.nonzero(cosine >= least)
        i += at
        keep = i < j
        pairs.append((i[keep], j[keep]))
    a, b = (np.concatenate(x) for x in zip(*pairs))
    if not inner:
        cross = block[a] != block[b]
        a, b = a[cross], b[cross]
    if not len(a):
        return None
    members = np.unique(np.concatenate([a, b]))
    cells = np.empty((len(unit), len(hashing.maps), hashing.probes), np.int64)
    cells[members] = hashing.cells(unit[members])
    first = np.concatenate(
        [_first_meeting(cells[a[k : k + 65536]], cells[b[k : k + 65536]], cell) for k in range(0, len(a), 65536)]
    )
    a, b = a[first], b[first]
    if not len(a):
        return None
    n = np.bincount(a, weight[b], len(unit)) + np.bincount(b, weight[a], len(unit))
    return n.astype(np.int64), _forest(a, b, len(unit))


def _classes(rows: DataFrame) -> DataFrame:
    return rows.filter("usable").groupBy("node").agg(F.count("*").alias("weight"), F.first("embedding").alias("embedding"))


def near_duplicates(rows: DataFrame, least: float = 0.9, tables: int | None = None, probes: int = PROBES) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``rows`` (vec_id, embedding)."""
    rows = rows.select("vec_id", "embedding")
    dimension, kind = dimension_of(rows), number_type(rows)
    hashing = Hashing(dimension, tables, probes, least)
    keyed = rows.select("vec_id", "embedding", usable(F.col("embedding"), dimension).alias("usable"))
    keyed = keyed.withColumn("node", F.when(F.col("usable"), F.xxhash64("embedding")))
    classes = stage(_classes(keyed), "classes")

    def listing(with_vectors: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 1024):
                    part = batch.slice(at, 1024)
                    flat = part.column(2).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                    x = flat.reshape(part.num_rows, dimension)
                    cells = np.sort(hashing.cells(normed(x)).reshape(len(x), -1), axis=1)
                    fresh = np.ones_like(cells, bool)
                    fresh[:, 1:] = cells[:, 1:] != cells[:, :-1]
                    row, col = np.nonzero(fresh)
                    cell = pa.array(cells[row, col])
                    if not with_vectors:
                        yield pa.RecordBatch.from_arrays([cell], ["cell"])
                        continue
                    raw = x.astype(kind)
                    out = [cell, part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row))]
                    vectors = pa.array([raw[i].tobytes() for i in range(len(raw))], pa.binary())
                    yield pa.RecordBatch.from_arrays([*out, vectors.take(pa.array(row))], ["cell", "node", "weight", "vector"])

        return run

    members = classes.select("node", "weight", "embedding")
    crowded = members.mapInArrow(listing(False), "cell long").groupBy("cell").agg(F.count("*").alias("n"))
    crowded = stage(crowded.filter(F.col("n") > 2 * BLOCK).select("cell", F.ceil(F.col("n") / BLOCK).alias("blocks")), "crowded")
    listed = members.mapInArrow(listing(True), "cell long, node long, weight long, vector binary")
    one = F.array(F.lit(0))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    tiles = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda y: F.least(own, y) * F.col("blocks") + F.greatest(own, y)
    )
    dealt = listed.join(small_side(crowded), "cell", "left").select(
        "cell",
        "node",
        "weight",
        "vector",
        F.coalesce(own, F.lit(0)).alias("block"),
        "blocks",
        F.explode(F.when(F.col("blocks").isNull(), one.cast("array<bigint>")).otherwise(tiles)).alias("tile"),
    )
    # block i's own tile is i * blocks + i
    dealt = dealt.withColumn("inner", F.coalesce(F.col("tile") % (F.col("blocks") + 1) == 0, F.lit(True))).drop("blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in _and_last(batches):
            table = pa.Table.from_batches([x for x in (rest, batch) if x is not None]).combine_chunks()
            if not table.num_rows:
                continue
            cell, tile = table.column("cell").to_numpy(), table.column("tile").to_numpy()
            starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (tile[1:] != tile[:-1])))
            ends = np.append(starts[1:], len(cell))
            done = len(starts) if batch is None else len(starts) - 1
            rest = None
            if done < len(starts):
                rest = table.slice(starts[-1]).to_batches()[0]
            node, weight = table.column("node").to_numpy(), table.column("weight").to_numpy()
            block, inner = table.column("block").to_numpy(), table.column("inner").to_numpy()
            out = []
            for s, e in zip(starts[:done].tolist(), ends[:done].tolist()):
                if e - s < 2:
                    continue
                unit = normed(_matrix(table.column("vector").slice(s, e - s), kind))
                found = _linked(hashing, unit, weight[s:e], block[s:e], bool(inner[s]), int(cell[s]), least)
                if found is None:
                    continue
                n, low = found
                ids = node[s:e]
                has = np.flatnonzero(n)
                out.append((ids[has], ids[low[has]], n[has]))
            if out:
                a, b, n = (np.concatenate(x) for x in zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    compared = dealt.repartition("cell", "tile").sortWithinPartitions("cell", "tile").mapInArrow(compare, "a long, b long, n long")
    compared = stage(compared, "compared")
    reached = components(compared.select("a", "b")).withColumnRenamed("component", "label")
    links = compared.groupBy("a").agg(F.sum("n").alias("n"))
    per_class = (
        keyed.filter("usable")
        .groupBy("node")
        .agg(F.min("vec_id").alias("low"), F.count("*").alias("weight"))
        .join(reached, "node", "left")
        .join(links.withColumnRenamed("a", "node"), "node", "left")
        .withColumn("label", F.coalesce("label", "node"))
    )
    per_class = stage(per_class, "linked")
    lowest = per_class.groupBy("label").agg(F.min("low").alias("component_id"))
    named = per_class.join(lowest, "label").select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"))
    return (
        keyed.select("vec_id", "node")
        .join(named, "node", "left")
        .select(
            "vec_id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )


def _and_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    """The batches, then None once: the sign that no more rows of the last group can come."""
    yield from batches
    yield None
