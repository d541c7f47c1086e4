"""Substring deduplication of word windows, level by level.

Every word covered by a window of ``length`` words whose words also start in a document with a smaller doc_id goes.
Windows are judged on the input.

Level by level: windows of a quarter of the length are looked at first, those that are the anchors of longer windows
(module ``anchored``); the ones found in two documents are extended to twice their length, to the left and to the right
(a window of the wanted length holds one of the two around its anchor); the ones again found in two documents are
doubled once more, rounded up to the wanted length. Only what was repeated at one length is looked at in the next, until
the windows themselves are compared: equal runs of windows at once, by the smallest document that has them, and
different runs with one anchor window by window, dealt to tasks by anchor. An anchor with very many different runs is
dealt over several tasks, whose remaining windows meet in one more aggregation.

Nulls: a null text has no words, a null id counts as smaller than every other. Rows with one doc_id are one document
for the order: they don't remove each other's words. Texts of fewer than ``length`` words stay. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.anchored import (
    FOUND,
    RUNS,
    Powers,
    across_shards,
    all_runs,
    consecutive,
    count_of,
    covered,
    cut,
    digests,
    first_of,
    keyed,
    original_id,
    over_shards,
    rolling,
    solved,
    spans_of,
)
from cohortviews.llm.common import stage

#: Different runs of one anchor in one task, and bytes of words that a task compares at a time.
SHARD_RUNS, SHARD_BYTES = 4000, 1 << 22


def word_hashes(text: bytes) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w) for w in text.split()], np.uint64)


def _piece(length: int):
    def cut(text: bytes) -> Callable[[int, int], bytes]:
        hashes = word_hashes(text)
        return lambda first, count: hashes[first : first + count - 1 + length].tobytes()

    return cut


def _compare(length: int):
    """Windows of whole anchors whose words also start in a smaller document."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        ids, texts = table.column("id").to_numpy(), table.column("digest").to_numpy()
        firsts, counts = table.column("first").to_numpy(), table.column("count").to_numpy().astype(np.int64)
        crowded = table.column("crowded").to_numpy()
        units = np.frombuffer(b"".join(table.column("piece").to_pylist()), np.uint64)
        sizes = counts - 1 + length
        starts = np.cumsum(sizes) - sizes
        piece = np.repeat(np.arange(len(counts)), counts)
        offset = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = starts[piece] + offset
        a = digests(units, Powers(len(units)))(at, at + length)
        b = rolling(units, length)[at].view(np.int64)
        by = np.lexsort((ids[piece], b, a))
        new = np.ones(len(by), bool)
        new[1:] = (a[by][1:] != a[by][:-1]) | (b[by][1:] != b[by][:-1])
        lowest = ids[piece[by]][np.flatnonzero(new)][np.cumsum(new) - 1]
        later = np.empty(len(by), bool)
        later[by] = ids[piece[by]] > lowest
        p, o, n = consecutive(piece[later], offset[later])
        stay = np.flatnonzero(~later & crowded[piece])
        keys = [pa.array(np.concatenate([np.zeros(len(p), np.int64), x[stay]]), mask=np.arange(len(p) + len(stay)) < len(p)) for x in (a, b)]
        p, o = np.concatenate([p, piece[stay]]), np.concatenate([o, offset[stay]])
        n = np.concatenate([n, np.ones(len(stay), np.int64)]).astype(np.int32)
        columns = [pa.array(ids[p]), pa.array(texts[p]), pa.array(firsts[p] + o), pa.array(n), *keys]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FOUND.split(", ")])

    return over_shards(solve, SHARD_BYTES)


def _in_two_documents(rows: DataFrame, key: str) -> DataFrame:
    both = rows.groupBy(key).agg(F.min("id").alias("low"), F.max("id").alias("high"))
    return both.filter("low < high").select(key)


def removed_windows(docs: DataFrame, length: int = 50, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(id, digest, first, count): windows of ``docs`` (id, digest, text) that start in a smaller document too."""
    seen = all_runs(docs, word_hashes, length, length // 4, ("id", "anchor"))
    first_level = stage(_in_two_documents(seen, "anchor"), "level")
    extended = all_runs(docs, word_hashes, length, length // 4, (*RUNS, "left", "right"))
    runs = stage(extended.join(first_level, "anchor", "left_semi"), "runs")
    sides = F.array(F.col("left"), F.col("right"))
    wider = runs.select("id", F.explode(sides).alias("side")).filter("side <> 0")
    second_level = stage(_in_two_documents(wider, "side"), "level")
    doubled = (
        runs.select("id", "digest", "at", "anchor", "run", F.explode(sides).alias("side"))
        .join(second_level, "side", "left_semi")
        .select("id", "digest", "at", "anchor", "run")
        .distinct()
    )
    runs = stage(doubled, "runs")
    kinds = runs.groupBy("anchor", "run").agg(F.min(F.struct("id", "digest", "at")).alias("earliest"), F.max("id").alias("high"))
    kinds = stage(kinds, "kinds")
    at = F.col("at")
    copies = (
        runs.join(kinds.filter("high > earliest.id").select("anchor", "run", "earliest"), ["anchor", "run"])
        .filter(F.col("id") > F.col("earliest.id"))
        .select("id", "digest", first_of(at).alias("first"), count_of(at).cast("int").alias("count"))
    )
    # equal runs of one document, at several places or in several rows of one id, share the fate of its first one
    found = solved(docs, kinds, shard_runs, cut(_piece(length)), _compare(length))
    across = across_shards(found, F.col("id"))
    return copies.unionByName(_everywhere(across, runs, kinds))


def _everywhere(removed: DataFrame, runs: DataFrame, kinds: DataFrame) -> DataFrame:
    """``removed`` windows of the earliest of equal runs, and the same windows of the equal runs in its document."""
    at, early = F.col("at"), F.col("earliest.at")
    twins = (
        runs.join(kinds.select("anchor", "run", "earliest"), ["anchor", "run"])
        .filter((F.col("id") == F.col("earliest.id")) & (F.struct("id", "digest", "at") != F.col("earliest")))
        .select(
            "id",
            F.col("earliest.digest").alias("digest"),
            first_of(early).alias("early"),
            count_of(early).alias("windows"),
            F.col("digest").alias("twin_digest"),
            first_of(at).alias("twin"),
        )
    )
    inside = (F.col("first") >= F.col("early")) & (F.col("first") < F.col("early") + F.col("windows"))
    again = removed.join(twins, ["id", "digest"]).filter(inside)
    return removed.unionByName(
        again.select("id", F.col("twin_digest").alias("digest"), (F.col("first") - F.col("early") + F.col("twin")).alias("first"), "count")
    )


def deduplicated(docs: DataFrame, length: int = 50, with_kept: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row; the kept words, joined by blanks, if asked for."""
    texts = keyed(docs)
    spans = spans_of(removed_windows(texts, length))
    schema = "id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                out = []
                for id_, text, spans_ in zip(*(part.column(c).to_pylist() for c in ("id", "text", "spans"))):
                    words = text.encode("utf-8").split()
                    gone = covered([(s["first"], s["count"]) for s in spans_ or []], length, len(words))
                    kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                    row = (id_, len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8"))
                    out.append(row[: 4 + with_kept])
                kinds = [pa.int64()] * 3 + [pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], [f.split()[0] for f in schema.split(", ")]
                )

    joined = texts.join(spans, ["id", "digest"], "left").select("id", "text", "spans")
    return joined.mapInArrow(run, schema).select(original_id(), *[f.split()[0] for f in schema.split(", ")[1:]])
