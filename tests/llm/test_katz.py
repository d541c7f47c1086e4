"""Katz backoff scores against a dictionary model in plain Python."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import SF, words

from cohortviews.llm import katz, queries

START, END, K = ("start",), ("end",), 5


def tokens(text):
    return words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) + [END]


def is_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def factors(counts):
    """Good-Turing factors of counts 1 to 5; half an occurrence less where the estimate is unusable."""
    n = Counter(counts)
    out = {}
    rest = (K + 1) * n[K + 1] / n[1] if n[1] else 1.0
    for r in range(1, K + 1):
        d = ((r + 1) * n[r + 1] / (r * n[r]) - rest) / (1 - rest) if rest < 1 and n[r] else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Model:
    """All counts in dictionaries; probabilities by recursion."""

    def __init__(self, texts):
        self.c, self.pair = Counter(), Counter()
        for t in texts:
            w = tokens(t)
            self.c.update(w)
            self.pair.update(zip([START, *w], w))
        self.n = sum(self.c.values())
        self.d1, self.d2 = factors(self.c.values()), factors(self.pair.values())
        freed = sum((1 - self.d1.get(c, 1)) * c for c in self.c.values())
        self.total, self.unknown = (self.n, freed / self.n) if freed > 0 else (self.n + 1, 1 / (self.n + 1))
        self.after = defaultdict(list)
        for v, w in self.pair:
            self.after[v].append(w)
        self.weight = {}
        for v, seen in self.after.items():
            c = sum(self.pair[v, w] for w in seen)
            freed = sum((1 - self.d2.get(self.pair[v, w], 1)) * self.pair[v, w] for w in seen)
            total = c if freed > 0 else c + 1
            self.weight[v] = total, (freed if freed > 0 else 1) / total / (1 - sum(self.p(w) for w in seen))

    def p(self, w, v=None):
        if v is None:
            return self.d1.get(self.c[w], 1) * self.c[w] / self.total if self.c[w] else self.unknown
        if v not in self.weight:
            return self.p(w)
        total, weight = self.weight[v]
        n = self.pair[v, w]
        return self.d2.get(n, 1) * n / total if n else weight * self.p(w)


def plain(rows):
    model = Model([t for i, t in rows if not is_out(i)])
    out = []
    for i, t in rows:
        w = tokens(t)
        base = sum(math.log10((model.c[x] + 1) / (model.n + len(model.c) + 1)) for x in w)
        score = sum(math.log10(model.p(x, v)) for v, x in zip([START, *w], w))
        out.append((i, is_out(i), len(w), sum(model.c[x] > 0 for x in w), model.n, base, score))
    return model, out


def same(df, want):
    got = [tuple(r) for r in df.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()]
    key = lambda r: (r[0] is None, r[0], r[2], round(r[6], 6))
    assert len(got) == len(want)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key)):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9, abs_tol=1e-9)


@pytest.fixture(scope="module")
def given(spark):
    rows = [(r.doc_id, r.text) for r in queries.documents(spark, SF).collect()]
    return rows, *plain(rows)


def test_given_table(spark, given):
    rows, _, want = given
    df = queries.QUERIES["op11_katz"](spark, SF)
    same(df, want)
    held = [r for r in want if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)  # better than the base on texts that taught nothing


def test_small_chunks_and_crowded_words(spark, given, monkeypatch):
    rows, _, want = given
    monkeypatch.setattr(katz, "SHORT_CODES", 40)
    monkeypatch.setattr(katz, "BUCKET_TOKENS", 500)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    same(katz.score_documents(docs, katz.held_out(), chunk_bytes=20_000, group_tokens=300), want)


def test_probabilities_sum_to_one(given):
    _, model, _ = given
    for v in [START, "no such word", *list(model.after)[:200]]:
        known = sum(model.p(w, v) for w in model.c)
        unknown = model.p(("unknown",), v)
        assert math.isclose(known + unknown, 1, rel_tol=1e-9)


def test_discounts():
    assert katz.discounts([0] * 6).tolist() == [1.0, *[(r - 0.5) / r for r in range(1, 6)], 1.0]
    kinds = [100, 40, 20, 12, 8, 5]
    want = factors([r for r, n in enumerate(kinds, 1) for _ in range(n)])
    assert np.allclose(katz.discounts(kinds)[1:6], [want[r] for r in range(1, 6)])


def test_edges(spark, edge, none):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    same(katz.score_documents(edge, katz.held_out()), plain(rows)[1])
    assert katz.score_documents(none, katz.held_out()).count() == 0
    held = [(i, "a b c") for i in range(200) if is_out(i)]
    same(katz.score_documents(spark.createDataFrame(held, "doc_id long, text string"), katz.held_out()), plain(held)[1])
