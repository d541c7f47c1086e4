"""Suffix-array deduplication of byte strings.

Every byte covered by a string of ``length`` bytes that also starts earlier goes; earlier means a smaller doc_id, or an
earlier start in the same document (rows with one doc_id: by a digest of their texts). Strings are judged on the input.

Runs of strings that share an anchor (module ``anchored``) deal the work. Only runs whose anchor occurs again go on.
Equal runs collapse to the earliest one, all others are removed whole: a passage copied a million times costs a
million rows of two-phase aggregation and one text. What is left are different runs with one anchor, as at the edges of
copied passages. Their bytes are dealt to shards by anchor; a shard builds its suffix array by induced sorting and the
permuted common prefixes, which put equal strings side by side, and the earliest of each class stays. An anchor with
very many different runs is dealt over several shards; these also return the digests of the strings that stay, and the
earliest over all shards is found by one more aggregation.

Nulls: a null text is empty, a null id counts as smaller than every other. Repeated rows (id and text) are one document
for the order, so neither removes the other. Texts shorter than ``length`` stay. No rows give no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortviews.llm.anchored import (
    FOUND,
    across_shards,
    all_runs,
    consecutive,
    count_of,
    covered,
    cut,
    first_of,
    keyed,
    original_id,
    over_shards,
    solved,
    spans_of,
)
from cohortviews.llm.common import stage
from cohortviews.llm.suffix_array import permuted_common_prefixes, suffix_array

GRAM = 24
#: Different runs of one anchor in one shard, and bytes that a shard sorts at a time.
SHARD_RUNS, SHARD_BYTES = 4000, 1 << 20


def _units(text: bytes) -> np.ndarray:
    return np.frombuffer(text, np.uint8)


def _piece(length: int):
    def cut(text: bytes) -> Callable[[int, int], bytes]:
        return lambda first, count: text[first : first + count - 1 + length]

    return cut


def later_windows(pieces: list[bytes], counts: np.ndarray, order: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Windows of ``pieces`` by a suffix array: (piece, offset) of all, and which have an earlier equal.

    ``order`` ranks the pieces from the earliest to the latest; windows of one piece by offset.
    """
    sizes = np.array([len(p) + 1 for p in pieces])
    raw = np.frombuffer(b"\0".join([*pieces, b""]), np.uint8)
    starts = np.cumsum(sizes) - sizes
    text = raw.astype(np.int32) + 2
    text[starts + sizes - 1] = 1  # between pieces
    text = np.append(text, 0)
    sa = suffix_array(text, length)
    owner = np.repeat(np.arange(len(pieces)), sizes)
    offset = np.arange(len(raw)) - starts[owner]
    window = np.append(offset < counts[owner], False)
    prefixes = permuted_common_prefixes(np.append(raw, 0).astype(np.uint8), sa, length)
    inside = window[sa]
    ordered = sa[inside]
    joined = np.zeros(len(sa), bool)
    joined[1:] = (prefixes[sa[1:]] >= length) & inside[1:] & inside[:-1]
    fresh = ~joined[inside]
    starts_of = np.flatnonzero(fresh)
    rank = (order[owner[ordered]].astype(np.int64) << 32) | offset[ordered]
    if len(rank):
        lowest = np.minimum.reduceat(rank, starts_of)[np.cumsum(fresh) - 1]
    else:
        lowest = rank
    return owner[ordered], offset[ordered], rank != lowest


def _shard(length: int):
    """Suffix arrays over whole anchors of the sorted pieces."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        ids, digests = table.column("id").to_numpy(), table.column("digest").to_numpy()
        firsts, counts = table.column("first").to_numpy(), table.column("count").to_numpy()
        crowded = table.column("crowded").to_numpy()
        pieces = table.column("piece").to_pylist()
        order = np.empty(len(pieces), np.int64)
        order[np.lexsort((firsts, digests, ids))] = np.arange(len(pieces))
        piece, offset, later = later_windows(pieces, counts, order, length)
        p, o, n = consecutive(piece[later], offset[later])
        stay = np.flatnonzero(~later & crowded[piece])
        strings = [hashlib.blake2b(pieces[a][b : b + length], digest_size=16).digest() for a, b in zip(piece[stay], offset[stay])]
        keys = np.frombuffer(b"".join(strings), np.int64).reshape(-1, 2)
        none = pa.nulls(len(p), pa.int64())
        p, o = np.concatenate([p, piece[stay]]), np.concatenate([o, offset[stay]])
        n = np.concatenate([n, np.ones(len(stay), np.int64)])
        columns = [pa.array(ids[p]), pa.array(digests[p]), pa.array(firsts[p] + o), pa.array(n.astype(np.int32))]
        columns += [pa.chunked_array([none, pa.array(keys[:, k])]).combine_chunks() for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in FOUND.split(", ")])

    return over_shards(solve, SHARD_BYTES)


def removed_windows(docs: DataFrame, length: int = 100, gram: int = GRAM, shard_runs: int = SHARD_RUNS) -> DataFrame:
    """(id, digest, first, count): the strings of ``docs`` (id, digest, text) with an earlier equal, as runs of starts."""
    seen = all_runs(docs, _units, length, gram, ("anchor",))
    again = stage(seen.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"), "anchors")
    runs = stage(all_runs(docs, _units, length, gram).join(again, "anchor", "left_semi"), "runs")
    kinds = runs.groupBy("anchor", "run").agg(F.min(F.struct("id", "digest", "at")).alias("earliest"), F.count("*").alias("n"))
    kinds = stage(kinds, "kinds")
    at = F.col("at")
    copies = (
        runs.join(kinds.filter("n > 1").select("anchor", "run", "earliest"), ["anchor", "run"])
        .filter(F.struct("id", "digest", "at") != F.col("earliest"))
        .select("id", "digest", first_of(at).alias("first"), count_of(at).cast("int").alias("count"))
    )
    found = solved(docs, kinds, shard_runs, cut(_piece(length)), _shard(length))
    return copies.unionByName(across_shards(found, F.struct("id", "digest", "first")))


def deduplicated(docs: DataFrame, length: int = 100, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row; the kept bytes in kept, if asked for."""
    texts = keyed(docs)
    spans = spans_of(removed_windows(texts, length))
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                out = []
                for id_, text, spans_ in zip(*(part.column(c).to_pylist() for c in ("id", "text", "spans"))):
                    data = text.encode("utf-8")
                    gone = covered([(s["first"], s["count"]) for s in spans_ or []], length, len(data))
                    kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
                    n_spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
                    out.append((id_, len(data), int(gone.sum()), n_spans, hashlib.sha256(kept).hexdigest(), kept)[: 5 + with_kept])
                kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], [f.split()[0] for f in schema.split(", ")]
                )

    joined = texts.join(spans, ["id", "digest"], "left").select("id", "text", "spans")
    return joined.mapInArrow(run, schema).select(original_id(), *[f.split()[0] for f in schema.split(", ")[1:]])
