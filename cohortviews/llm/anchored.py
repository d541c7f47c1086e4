"""Runs of equal-length windows that share an anchor: how equal windows are brought together without moving text.

A window is ``length`` units (bytes or words) of one document. Its anchor is the ``gram`` units in it with the smallest
hash, the leftmost on a tie, so equal windows have equal anchors at equal offsets. Consecutive windows with the same
anchor form a run; a run is one row (anchor, digest of all its units), some forty times fewer rows than windows. Equal
runs hold equal windows. Windows of different runs can only be equal if the anchors are.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cohortviews.llm.common import stage

BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
POSITION_BITS = 24
CHUNK = 1 << 21  # units looked at together; below 2 ** POSITION_BITS


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def rolling(units: np.ndarray, gram: int) -> np.ndarray:
    """Polynomial hash of every ``gram`` consecutive units, by doubling."""
    base, h, size = BASES[0], units.astype(np.uint64) + np.uint64(1), 1
    parts, out, done = gram, None, 0
    while parts:
        if parts & 1:
            if out is None:
                out, done = h, size
            else:
                n = len(units) - done - size + 1
                out = out[:n] * _power(base, size) + h[done : done + n]
                done += size
        parts >>= 1
        if parts:
            n = len(units) - 2 * size + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            h = h[:n] * _power(base, size) + h[size : size + n]
            size *= 2
    return mixed(out[: max(0, len(units) - gram + 1)])


def _power(base: np.uint64, n: int) -> np.uint64:
    return np.uint64(pow(int(base), n, 1 << 64))


class Powers:
    """Powers of a base and of its inverse modulo 2 ** 64."""

    def __init__(self, n: int):
        base = int(BASES[1])
        self.up = self._run(base, n)
        self.down = self._run(pow(base, -1, 1 << 64), n)

    @staticmethod
    def _run(base: int, n: int) -> np.ndarray:
        out = np.full(n + 1, np.uint64(base), np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


def digests(units: np.ndarray, powers: Powers) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function of ``first`` and ``until`` that digests units[first:until]."""
    sums = np.zeros(len(units) + 1, np.uint64)
    np.cumsum((units.astype(np.uint64) + np.uint64(1)) * powers.up[: len(units)], out=sums[1:])

    def of(first: np.ndarray, until: np.ndarray) -> np.ndarray:
        size = (until - first).astype(np.uint64)
        return mixed((sums[until] - sums[first]) * powers.down[first] + size * BASES[0]).view(np.int64)

    return of


def runs(units: np.ndarray, ends: np.ndarray, length: int, gram: int, powers: Powers, names: Collection[str]) -> dict[str, np.ndarray]:
    """Runs of windows of the documents that end at ``ends`` in ``units``.

    Always doc (number of the document), first (window, a position in ``units``), count and anchor; if among ``names``, run
    (a digest of all units), and left and right, digests of the anchor extended to twice its length (0 where that would
    leave the document).
    """
    n, wide = len(units), length - gram + 1
    windows = n - length + 1
    if windows <= 0:
        return dict.fromkeys(("doc", "first", "count", "anchor", "run", "left", "right"), np.zeros(0, np.int64))
    hashes = rolling(units, gram)
    low = np.uint64((1 << POSITION_BITS) - 1)
    key = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
    padded = np.full(-(-len(key) // wide) * wide, np.uint64(2**64 - 1))
    padded[: len(key)] = key
    grid = padded.reshape(-1, wide)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    anchor = (np.minimum(backward[:windows], forward[wide - 1 : wide - 1 + windows]) & low).astype(np.int64)
    starts = np.concatenate([[0], ends[:-1]])
    change = np.zeros(windows, bool)
    change[0] = True
    # a run has at most as many windows as its count can hold; cut by the distance to the anchor, equal runs are cut alike
    piece = (anchor - np.arange(windows)) // MOST_WINDOWS
    change[1:] = (anchor[1:] != anchor[:-1]) | (piece[1:] != piece[:-1])
    change[starts[starts < windows]] = True
    first = np.flatnonzero(change)
    last = np.append(first[1:], windows)  # exclusive
    doc = np.searchsorted(ends, first, side="right")
    last = np.minimum(last, ends[doc] - length + 1)  # windows that would leave their document do not count
    keep = last > first
    doc, first, last = doc[keep], first[keep], last[keep]
    at = anchor[first]
    out = {"doc": doc, "first": first, "count": last - first, "anchor": hashes[at].view(np.int64)}
    if "run" in names:
        of = digests(units, powers)
        out["run"] = of(first, last - 1 + length)
    if "left" in names:
        left, right = at - gram, at + 2 * gram
        to_left, to_right = left >= starts[doc], right <= ends[doc]
        out["left"] = np.where(to_left, of(np.maximum(left, 0), at + gram), 0)
        out["right"] = np.where(to_right, of(at, np.minimum(right, n)), 0)
    return out


#: ``at`` packs the first window of a run and, in the lowest bits, their number.
COUNT_BITS = 8
MOST_WINDOWS = (1 << COUNT_BITS) - 1
NULL_ID = -(1 << 63)


def keyed(docs: DataFrame) -> DataFrame:
    """(id, digest, text) of every row: never null; a null id is the smallest, a null text is empty.

    Rows of one id, like all those without an id, are told apart by a 64-bit digest of the text.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("id"),
        F.xxhash64(text).alias("digest"),
        text.alias("text"),
    )


def original_id(column: str = "id") -> Column:
    return F.when(F.col(column) != NULL_ID, F.col(column)).alias("doc_id")


def packed(first, count):
    return (first << COUNT_BITS) | count


def first_of(at: Column) -> Column:
    return F.shiftrightunsigned(at, COUNT_BITS)


def count_of(at: Column) -> Column:
    return at.bitwiseAND(F.lit((1 << COUNT_BITS) - 1))


RUNS = ("id", "digest", "at", "anchor", "run")


def all_runs(docs: DataFrame, units_of: Callable[[bytes], np.ndarray], length: int, gram: int, names: tuple[str, ...] = RUNS) -> DataFrame:
    """A row with the columns ``names`` for every run of windows of ``docs`` (id, digest, text); left and right come after
    run. What is not named is not computed.

    Texts are joined up to a fixed number of units at a time; a longer one goes through in overlapping pieces.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(CHUNK)
        held: list[tuple[int, int, int, np.ndarray]] = []  # id, digest, offset, units
        size = 0

        def flush() -> pa.RecordBatch:
            units = np.concatenate([h[3] for h in held])
            ends = np.cumsum([len(h[3]) for h in held])
            found = runs(units, ends, length, gram, powers, names)
            ids, texts, offsets = (np.array([h[i] for h in held], np.int64) for i in range(3))
            starts = ends - np.array([len(h[3]) for h in held])
            doc = found["doc"]
            if "id" in names:
                found["id"] = ids[doc]
            if "digest" in names:
                found["digest"] = texts[doc]
            if "at" in names:
                found["at"] = packed(found["first"] - starts[doc] + offsets[doc], found["count"]).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[n]) for n in names], list(names))

        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                ids, digests = part.column(0).to_pylist(), part.column(1).to_pylist()
                for id_, digest, text in zip(ids, digests, part.column(2).cast(pa.binary()).to_pylist()):
                    units = units_of(text)
                    for offset in range(0, max(1, len(units) - length + 1), CHUNK - length):
                        piece = units[offset : offset + CHUNK - 1]
                        if len(piece) < length:
                            continue
                        if size + len(piece) > CHUNK:
                            yield flush()
                            held.clear()
                            size = 0
                        held.append((id_, digest, offset, piece))
                        size += len(piece)
        if held:
            yield flush()

    return docs.select("id", "digest", "text").mapInArrow(run, ", ".join(f"{n} long" for n in names))


def spans_of(rows: DataFrame) -> DataFrame:
    """(id, digest, spans) from (id, digest, first, count), rows of windows to remove."""
    return rows.groupBy("id", "digest").agg(F.collect_list(F.struct("first", "count")).alias("spans"))


def covered(spans: list[tuple[int, int]], length: int, units: int) -> np.ndarray:
    """Which units of a document lie in a window of ``spans`` (first window, windows)."""
    step = np.zeros(units + 1, np.int32)
    for first, count in spans:
        step[first] += 1
        step[first + count - 1 + length] -= 1
    return np.cumsum(step[:-1]) > 0


#: Pieces of text on their way to a shard, and what a shard finds: windows to remove, and digests of windows that stay.
PIECES = "id long, digest long, first long, count int, anchor long, salt int, crowded boolean, piece binary"
FOUND = "id long, digest long, first long, count int, string_a long, string_b long"


def cut(piece_of: Callable[[bytes], Callable[[int, int], bytes]]):
    """The wanted runs of each document as bytes: ``piece_of(text)(first, count)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                out = []
                for row in batch.slice(k, 64).to_pylist():
                    piece = piece_of(row["text"].encode("utf-8"))
                    for x in row["wanted"]:
                        made = piece(x["first"], x["count"])
                        out.append((row["id"], row["digest"], x["first"], x["count"], x["anchor"], x["salt"], x["crowded"], made))
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
                    columns = [pa.array(c, t) for c, t in zip(zip(*out), kinds)]
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PIECES.split(", ")])

    return run


def consecutive(piece: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(piece, first offset, count) of consecutive windows."""
    by = np.lexsort((offset, piece))
    piece, offset = piece[by], offset[by]
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    return piece[first], offset[first], np.diff(np.append(first, len(piece)))


def over_shards(solve: Callable[[pa.Table], pa.RecordBatch], most: int):
    """``solve`` over whole (anchor, salt) groups of sorted pieces, about ``most`` bytes at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
            if size < most:
                continue
            table = pa.concat_tables(held).combine_chunks()
            anchor, salt = table.column("anchor").to_numpy(), table.column("salt").to_numpy()
            ends = np.flatnonzero((anchor[1:] != anchor[:-1]) | (salt[1:] != salt[:-1])) + 1
            length_of = np.cumsum([len(x) for x in table.column("piece").to_pylist()])
            at = 0
            for end in ends.tolist():  # as many whole anchors as fit, and one at least
                if length_of[end - 1] - (length_of[at - 1] if at else 0) >= most or end == ends[-1]:
                    yield solve(table.slice(at, end - at))
                    at = end
            held, size = [table.slice(at)], table.slice(at).nbytes
        if held:
            table = pa.concat_tables(held).combine_chunks()
            if table.num_rows:
                yield solve(table)

    return run


def solved(docs: DataFrame, kinds: DataFrame, shard_runs: int, cutter, solver) -> DataFrame:
    """What shards find in the different runs of one anchor (``FOUND``), written.

    ``kinds`` has anchor, run and earliest (id, digest, at). Runs of an anchor with more than ``shard_runs`` are crowded: dealt
    over several shards, which return the digests of their remaining windows.
    """
    different = kinds.groupBy("anchor").agg(F.count("*").alias("runs")).filter("runs > 1")
    at = F.col("earliest.at")
    wanted = kinds.join(different, "anchor").select(
        F.col("earliest.id").alias("id"),
        F.col("earliest.digest").alias("digest"),
        F.struct(
            first_of(at).alias("first"),
            count_of(at).cast("int").alias("count"),
            "anchor",
            F.pmod(F.xxhash64("run"), F.ceil(F.col("runs") / shard_runs)).cast("int").alias("salt"),
            (F.col("runs") > shard_runs).alias("crowded"),
        ).alias("wanted"),
    )
    wanted = wanted.groupBy("id", "digest").agg(F.collect_list("wanted").alias("wanted"))
    pieces = docs.join(wanted, ["id", "digest"]).select("id", "digest", "text", "wanted").mapInArrow(cutter, PIECES)
    dealt = pieces.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt")
    return stage(dealt.mapInArrow(solver, FOUND), "found")


def across_shards(found: DataFrame, here: Column) -> DataFrame:
    """(id, digest, first, count) to remove: what shards removed, and crowded windows with an earlier ``here`` elsewhere."""
    columns = ["id", "digest", "first", "count"]
    plain = found.filter("string_a is null").select(*columns)
    stayed = found.filter("string_a is not null").withColumn("here", here)
    earliest = stayed.groupBy("string_a", "string_b").agg(F.min("here").alias("earliest"), F.count("*").alias("n"))
    across = stayed.join(earliest.filter("n > 1"), ["string_a", "string_b"]).filter(F.col("here") != F.col("earliest"))
    return plain.unionByName(across.select(*columns))
