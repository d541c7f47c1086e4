"""Thousands of different texts without an id, or under one id, in the substring operators."""

import hashlib
import random
import zlib

import pytest
import xxhash

from cohortviews.llm import passages, substring_dedup


def _rank(row):
    """Null ids first, then ids; rows of one id by the digest of their text."""
    digest = xxhash.xxh64_intdigest(row[1].encode(), 42)
    return (row[0] is not None, row[0] or 0, digest - (1 << 64) * (digest >> 63))


def _rows():
    """5,000 texts without id and 3,000 of one id, among them pairs of equal lengths with equal 19 low bits of a CRC32."""
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    passages_ = [" ".join(word() for _ in range(30)) for _ in range(40)]
    rows, seen = [], {}
    while len(rows) < 8000:
        text = " ".join([word(), *([rng.choice(passages_)] * (rng.random() < 0.4)), *[word() for _ in range(3)]])
        rows.append((None if len(rows) < 5000 else 7, text))
        seen.setdefault((rows[-1][0], len(text), zlib.crc32(text.encode()) & ((1 << 19) - 1)), set()).add(text)
    assert any(len(v) > 1 for v in seen.values())
    return rows + [(9, p) for p in passages_[:5]]


@pytest.fixture(scope="module")
def rows():
    return _rows()


def test_op2(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_removed, r.kept_sha256) for r in substring_dedup.deduplicated(docs).collect())
    seen, want = set(), []
    for i, text in sorted(rows, key=_rank):
        data = text.encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            if data[p : p + 100] in seen:
                gone[p : p + 100] = b"\1" * 100
            seen.add(data[p : p + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        want.append((i or 0, len(data), sum(gone), hashlib.sha256(kept).hexdigest()))
    assert got == sorted(want)


def test_op7(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed, r.kept_sha256) for r in passages.deduplicated(docs, 20).collect())
    first, want = {}, []
    for i, text in sorted(rows, key=_rank):
        w = text.split()
        gone = [False] * len(w)
        for p in range(len(w) - 19):
            if first.setdefault(tuple(w[p : p + 20]), i) != i:
                gone[p : p + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        want.append((i or 0, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert got == sorted(want)
