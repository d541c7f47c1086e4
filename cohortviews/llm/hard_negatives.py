"""Hard negatives: for each anchor and each of its best positives, the best other-label rows inside a score window.

Scores are inner products of whole numbers, floor(256 x). Rows are ordered along a Hilbert curve over their most variable
dimensions and written as Parquet blocks of ``BLOCK_ROWS`` consecutive rows, each with a zone map: least and greatest
value of every dimension, and of the label. Anchors lie on the same curve in chunks. Interval arithmetic over a zone map
bounds the scores that an anchor can have in a block from both sides, so a window needs only blocks whose bounds meet it.

A search has two rounds. The first reads the most promising blocks of each window; the last of its best rows is a floor.
The second reads every block whose bounds reach both the window and the floor, and so finds what reading all would.
Zone maps are compared with anchors in tiles of pages and chunk groups; only the numbers of chosen blocks travel then, and
each task reads some hundred blocks for one chunk. Nothing about single rows is collected.

Nulls: a row without id or label, without a vector, with a null or non-finite component, or with another number of
components than most takes no part. Zero vectors take part. Components beyond 131,072 in size count as that, so scores fit
64 bits. Equal scores go to the smaller id. A repeated row is a candidate of its own, equal anchors are one; rows with an
anchor's id are no candidates of it. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from cohortviews.llm.common import stage

SCALE, LARGEST = 256, 1 << 25
#: The curve runs over so many dimensions, in so many bits each; 63 bits together at most.
CURVE_DIMENSIONS, CURVE_BITS = 8, 7
BLOCK_ROWS, CHUNK_ANCHORS = 512, 128
#: Zone maps and chunks of a tile; blocks that a task reads for one chunk, on average.
PAGE_BLOCKS, GROUP_CHUNKS, TASK_BLOCKS = 256, 64, 128
#: Blocks that the first round reads for each window.
SEEDS = 4
LEAST, MOST = -(1 << 62), 1 << 62


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of each row of ``cells`` (whole numbers of ``bits`` bits), by Skilling's transform."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for i in range(n):
            is_set = (x[i] & bit) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(is_set, low, swap)
            x[i] ^= swap
        bit >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.int64)
    bit = 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[n - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in reversed(range(bits)):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def prepared(rows: DataFrame, moved_every: int = 7, labels: int = 10) -> DataFrame:
    """(vec_id, label, x): rows that take part, labels moved where the id is divisible by ``moved_every``, whole components."""
    vector = F.col("embedding")
    odd = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    id_, label = F.col("vec_id").cast("long"), F.col("label").cast("long")
    moved = F.when(id_ % moved_every == 0, (label + 1) % labels).otherwise(label)
    bound = F.lit(float(LARGEST))
    whole = F.transform(
        vector, lambda c: F.greatest(F.least(F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("double"), bound), -bound).cast("int")
    )
    kept = rows.filter(id_.isNotNull() & label.isNotNull() & (F.size(vector) > 0) & ~odd)
    return kept.select(id_.alias("vec_id"), moved.alias("label"), whole.alias("x"))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimension)


def spread(rows: DataFrame, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and standard deviation of each dimension."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, dimension))
        for batch in batches:
            x = _matrix(batch.column(0), dimension).astype(np.float64)
            held += np.stack([np.full(dimension, len(x)), x.sum(0), (x * x).sum(0)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension)), *map(pa.array, held)], ["at", "n", "s", "ss"])

    made = rows.select("x").mapInArrow(sums, "at long, n double, s double, ss double")
    found = made.groupBy("at").agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).orderBy("at").collect()  # a row a dimension
    n, s, ss = (np.array([r[k] for r in found]) for k in ("n", "s", "ss"))
    mean = s / np.maximum(n, 1)
    return mean, np.sqrt(np.maximum(ss / np.maximum(n, 1) - mean * mean, 0))


PACKED = (
    "number long, ids binary, labels binary, x binary, lows binary, highs binary, low_label long, high_label long, low_id long"
)


def packed(rows: DataFrame, dimension: int, mean: np.ndarray, deviation: np.ndarray, size: int, name: str) -> DataFrame:
    """``rows`` along the curve in blocks of ``size``, one row each with its zone map, written as Parquet."""
    along = np.argsort(-deviation, kind="stable")[:CURVE_DIMENSIONS]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(2), dimension)[:, along]
            part = (x - mean[along]) / np.maximum(4 * deviation[along], 1e-9) + 0.5
            cells = np.clip(part * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hilbert(cells, CURVE_BITS))], ["vec_id", "label", "x", "place"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        waiting = 0

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, held, waiting
            ids, labels, x = (np.concatenate([h[k] for h in held]) for k in range(3))
            at = 0
            while len(ids) - at >= size or (last and at < len(ids)):
                i, k, v = ids[at : at + size], labels[at : at + size], x[at : at + size].astype("<i4")
                blobs = [pa.array([b.tobytes()], pa.binary()) for b in (i, k, v, v.min(0), v.max(0))]
                ends = [pa.array([int(n)]) for n in (k.min(), k.max(), i.min())]
                yield pa.RecordBatch.from_arrays([pa.array([number]), *blobs, *ends], [f.split()[0] for f in PACKED.split(", ")])
                number += 1
                at += size
            held, waiting = [(ids[at:], labels[at:], x[at:])], max(0, len(ids) - at)

        for batch in batches:
            held.append((batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2), dimension)))
            waiting += batch.num_rows
            if waiting >= 16 * size:
                yield from blocks(False)
        if waiting:
            yield from blocks(True)

    placed = rows.select("vec_id", "label", "x").mapInArrow(place, "vec_id long, label long, x array<int>, place long")
    ordered = placed.repartitionByRange("place", "vec_id").sortWithinPartitions("place", "vec_id")
    return stage(ordered.select("vec_id", "label", "x").mapInArrow(pack, PACKED), name)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` and ``b``."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


class Anchors:
    """A chunk of anchors with its windows: (anchor, slot, low, high, floor, floor_id) as columns."""

    def __init__(self, row: dict, dimension: int):
        self.number = row["number"]
        self.ids, self.labels = (np.frombuffer(row[k], "<i8") for k in ("ids", "labels"))
        self.x = np.frombuffer(row["x"], "<i4").reshape(-1, dimension)
        self.windows = np.frombuffer(row["windows"], "<i8").reshape(-1, 6)

    @property
    def of(self) -> np.ndarray:
        return self.windows[:, 0]


def needed(chunk: Anchors, lows: np.ndarray, highs: np.ndarray, labels: np.ndarray, low_ids: np.ndarray, same: bool):
    """(windows, blocks): which blocks can hold a row of a window; and the bounds of the scores there."""
    up, down = np.maximum(chunk.x, 0), np.minimum(chunk.x, 0)
    upper = (product(up, highs) + product(down, lows))[chunk.of]
    lower = (product(up, lows) + product(down, highs))[chunk.of]
    mine = chunk.labels[chunk.of][:, None]
    if same:
        fits = (labels[:, 0] <= mine) & (mine <= labels[:, 1])
    else:
        fits = (labels[:, 0] != labels[:, 1]) | (labels[:, 0] != mine)
    low, high, floor, floor_id = (chunk.windows[:, [k]] for k in (2, 3, 4, 5))
    fits &= (upper >= low) & (lower <= high) & ((upper > floor) | ((upper == floor) & (low_ids <= floor_id)))
    return fits, upper, lower


CHOSEN = "chunk long, anchor long, slot long, merit double, block long"


def choose(asked: DataFrame, blocks: DataFrame, dimension: int, same: bool, all_of_them: bool) -> DataFrame:
    """(chunk, block): the blocks that windows need; or only the ``SEEDS`` whose middle is nearest to each window's end."""
    sizes = [t.agg(F.count("*")).first()[0] for t in (asked, blocks)]
    groups, pages = -(-max(1, sizes[0]) // GROUP_CHUNKS), -(-max(1, sizes[1]) // PAGE_BLOCKS)

    def dealt(of: str, n: int) -> Column:
        return F.pmod(F.xxhash64(of), F.lit(n)).cast("int")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    chunks = asked.select("number", "ids", "labels", "x", "windows", dealt("number", groups).alias("group"), every(pages).alias("page"))
    zones = blocks.select("number", "lows", "highs", "low_label", "high_label", "low_id", dealt("number", pages).alias("page"))
    zones = zones.select("*", every(groups).alias("group"))

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        if left.num_rows and right.num_rows:
            lows, highs = (np.frombuffer(b"".join(right.column(k).to_pylist()), "<i4").reshape(-1, dimension) for k in ("lows", "highs"))
            labels = np.column_stack([right.column(k).to_numpy() for k in ("low_label", "high_label")])
            low_ids, numbers = right.column("low_id").to_numpy(), right.column("number").to_numpy()
            for row in left.to_pylist():
                chunk = Anchors(row, dimension)
                fits, upper, lower = needed(chunk, lows, highs, labels, low_ids, same)
                if all_of_them:
                    found = numbers[fits.any(0)]
                    none = np.zeros(len(found), np.int64)
                    out.append((np.full(len(found), chunk.number), none, none, none.astype(float), found))
                else:
                    middle = upper / 2 + lower / 2
                    merit = np.where(fits, -np.abs(middle - chunk.windows[:, [3]]), -np.inf)
                    best = np.argsort(-merit, axis=1, kind="stable")[:, :SEEDS]
                    who, nth = np.nonzero(np.take_along_axis(fits, best, 1))
                    block = best[who, nth]
                    out.append((np.full(len(who), chunk.number), chunk.of[who], chunk.windows[who, 1], merit[who, block], numbers[block]))
        names = [f.split()[0] for f in CHOSEN.split(", ")]
        kinds = [np.int64, np.int64, np.int64, np.float64, np.int64]
        return pa.table([pa.array(np.concatenate([np.zeros(0, t), *[o[k] for o in out]]).astype(t)) for k, t in enumerate(kinds)], names)

    found = chunks.groupBy("page", "group").cogroup(zones.groupBy("page", "group")).applyInArrow(meet, CHOSEN)
    if not all_of_them:
        order = Window.partitionBy("chunk", "anchor", "slot").orderBy(F.desc("merit"), "block")
        found = found.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= SEEDS).select("chunk", "block").distinct()
    return stage(found.select("chunk", "block"), "chosen")


FOUND = "chunk long, anchor long, slot long, score long, vec_id long"


class Best:
    """The best ``keep`` rows of each window so far."""

    def __init__(self, chunk: Anchors, keep: int):
        self.keep, self.chunk = keep, chunk
        self.floor, self.floor_id = chunk.windows[:, 4].copy(), chunk.windows[:, 5].copy()
        self.window, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, window: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        window, score, id_ = (np.concatenate(p) for p in ((self.window, window), (self.score, score), (self.id, id_)))
        by = np.lexsort((id_, -score, window))
        window, score, id_ = window[by], score[by], id_[by]
        rank = np.arange(len(window)) - np.searchsorted(window, window)
        stay = rank < self.keep
        last = rank == self.keep - 1
        self.floor[window[last]], self.floor_id[window[last]] = score[last], id_[last]
        self.window, self.score, self.id = window[stay], score[stay], id_[stay]

    def read(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, same: bool) -> None:
        chunk, of = self.chunk, self.chunk.of
        scores = product(chunk.x, x)
        alike = chunk.labels[:, None] == labels[None, :]
        fits = ((alike if same else ~alike) & (chunk.ids[:, None] != ids[None, :]))[of]
        s = scores[of]
        fits &= (s >= chunk.windows[:, [2]]) & (s <= chunk.windows[:, [3]])
        fits &= (s > self.floor[:, None]) | ((s == self.floor[:, None]) & (ids[None, :] <= self.floor_id[:, None]))
        window, row = np.nonzero(fits)
        self.add(window, s[window, row], ids[row])


def read(asked: DataFrame, chosen: DataFrame, blocks: DataFrame, dimension: int, keep: int, same: bool) -> DataFrame:
    """``FOUND``: the best ``keep`` rows of each window in the chosen blocks."""
    parts = -(-max(1, blocks.agg(F.count("*")).first()[0]) // TASK_BLOCKS)
    chosen = chosen.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(parts)).cast("int"))
    left = chosen.select("chunk", "part").distinct().join(asked.withColumnRenamed("number", "chunk"), "chunk")
    payload = blocks.select(F.col("number").alias("block"), F.col("ids"), F.col("labels"), F.col("x"))
    right = chosen.join(payload, "block").select(*[F.col(c).alias(c) for c in ("chunk", "part", "block", "ids", "labels", "x")])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        names = [f.split()[0] for f in FOUND.split(", ")]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 5, names)
        row = left.slice(0, 1).to_pylist()[0]
        chunk = Anchors(row | {"number": row["chunk"]}, dimension)
        best = Best(chunk, keep)
        for k in range(right.num_rows):
            ids, labels, x = (right.column(c)[k].as_py() for c in ("ids", "labels", "x"))
            best.read(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), np.frombuffer(x, "<i4").reshape(-1, dimension), same)
        w = chunk.windows[best.window]
        return pa.table([pa.array(c) for c in (np.full(len(w), chunk.number), w[:, 0], w[:, 1], best.score, best.id)], names)

    found = left.groupBy("chunk", "part").cogroup(right.groupBy("chunk", "part")).applyInArrow(search, FOUND)
    order = Window.partitionBy("chunk", "anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return stage(found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep), "found")


def _with_windows(chunks: DataFrame, windows: DataFrame) -> DataFrame:
    """``chunks`` that have windows, with these as one binary each: bounded by the anchors of a chunk."""
    names = ["anchor", "slot", "low", "high", "floor", "floor_id"]
    listed = windows.groupBy("number").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("windows"))
    joined = chunks.select("number", "ids", "labels", "x").join(listed, "number")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [np.array([list(w.values()) for w in row], "<i8").tobytes() for row in batch.column(4).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(blobs, pa.binary())], ["number", "ids", "labels", "x", "windows"])

    schema = "number long, ids binary, labels binary, x binary, windows binary"
    return stage(joined.select("number", "ids", "labels", "x", "windows").mapInArrow(pack, schema), "asked")


def search(chunks: DataFrame, windows: DataFrame, blocks: DataFrame, dimension: int, keep: int, same: bool) -> DataFrame:
    """The best ``keep`` rows of each window (number, anchor, slot, low, high): (chunk, anchor, slot, rank, score, vec_id)."""
    open_ = windows.withColumns({"floor": F.lit(LEAST), "floor_id": F.lit(MOST)})
    asked = _with_windows(chunks, open_)
    first = read(asked, choose(asked, blocks, dimension, same, False), blocks, dimension, keep, same)
    floors = first.filter(F.col("rank") == keep).select(
        F.col("chunk").alias("number"), "anchor", "slot", F.col("score").alias("floor"), F.col("vec_id").alias("floor_id")
    )
    raised = windows.join(floors, ["number", "anchor", "slot"], "left").withColumns(
        {"floor": F.coalesce("floor", F.lit(LEAST)), "floor_id": F.coalesce("floor_id", F.lit(MOST))}
    )
    asked = _with_windows(chunks, raised)
    return read(asked, choose(asked, blocks, dimension, same, True), blocks, dimension, keep, same)


MINED = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    rows: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    shares: tuple[int, int] = (30, 90),
) -> DataFrame:
    """``MINED``: hard negatives of each row whose vec_id is divisible by ``every`` and each of its best ``positives``.

    A negative's score lies between ``shares`` per cent of the positive's.
    """
    spark = rows.sparkSession
    whole = prepared(rows)
    sizes = whole.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], MINED)
    dimension = sizes.d
    whole = whole.filter(F.size("x") == dimension)
    mean, deviation = spread(whole, dimension)
    blocks = packed(whole, dimension, mean, deviation, BLOCK_ROWS, "blocks")
    anchors = whole.filter(F.col("vec_id") % every == 0).distinct()
    chunks = packed(anchors, dimension, mean, deviation, CHUNK_ANCHORS, "chunks")

    zero = F.lit(0).cast("long")
    last = (F.length("ids") / 8).cast("long") - 1
    listed = chunks.select("number", F.explode(F.sequence(zero, last)).alias("anchor"))
    windows = listed.select("number", "anchor", zero.alias("slot"), F.lit(LEAST).alias("low"), F.lit(MOST).alias("high"))
    best = search(chunks, windows, blocks, dimension, positives, True).select(
        F.col("chunk").alias("number"), "anchor", F.col("rank").cast("long").alias("slot"), "score", F.col("vec_id").alias("positive_id")
    )
    low, high = (F.expr(f"({k} * score - pmod({k} * score, 100)) div 100") for k in (-shares[0], shares[1]))  # rounded down
    ranges = best.select("number", "anchor", "slot", (-low).alias("low"), high.alias("high")).filter("low <= high")
    found = search(chunks, ranges, blocks, dimension, negatives, False).withColumnRenamed("chunk", "number")

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.frombuffer(blob, "<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), number)), pa.array(np.arange(len(ids))), pa.array(ids)], ["number", "anchor", "anchor_id"]
                )

    named = chunks.select("number", "ids").mapInArrow(names, "number long, anchor long, anchor_id long")
    joined = found.join(best.withColumnRenamed("score", "positive_score"), ["number", "anchor", "slot"]).join(named, ["number", "anchor"])
    return joined.select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
