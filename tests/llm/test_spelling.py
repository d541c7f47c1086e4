"""Spelling variants against a brute-force version in plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest_llm import SF

from cohortviews.llm import queries, spelling


def occurrences(rows, least):
    out = Counter()
    for i, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= least:
                out[run] += 1
    return out


def near_words(words):
    near, holes = defaultdict(set), defaultdict(list)
    for w in words:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].append(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for a in group:
            near[a].update(b for b in group if b != a)
    return near


def plain(rows, least=7, least_n=2, factor=10):
    n = {w: c for w, c in occurrences(rows, least).items() if c >= least_n}
    near, form, out = near_words(n), {}, {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n.get(form[w]))
    return out


def found(df):
    rows = df.collect()
    out = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}
    assert len(out) == len(rows)
    return out


def test_given_table(spark):
    docs = queries.documents(spark, SF)
    assert found(queries.QUERIES["op13_spelling"](spark, SF)) == plain([(r.doc_id, r.text) for r in docs.collect()])


def planted():
    """Frequent words, their variants at all places, variants of variants, anagrams, accents, and one very long word."""
    rng = random.Random(3)
    letters = "abcdefgÀéÿ×"
    out = []
    for k in range(25):
        base = "".join(rng.choice(letters) for _ in range(rng.randrange(7, 12)))
        texts = [base] * 450
        for _ in range(6):
            at, c = rng.randrange(len(base) + 1), rng.choice(letters)
            for other in (base[:at] + c + base[at:], base[:at] + c + base[at + 1 :], base[:at] + base[at + 1 :]):
                texts += [other] * rng.choice((1, 2, 20, 45)) + [other[::-1]] * 2
                at2 = rng.randrange(len(other))
                texts += [other[:at2] + rng.choice(letters) + other[at2 + 1 :]] * 3
        out.append((k, " ".join(texts)))
    long_ = "abc" * 2000
    out += [(100, " ".join([long_] * 30 + [long_ + "d"] * 2 + ["b" + long_[1:]] * 3)), (101, "Short WORDWORD wordword, wordWord")]
    return out


def test_planted_variants(spark):
    rows = planted()
    got = found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string")))
    want = plain(rows)
    assert got == want
    assert any(form and root != form for form, root, *_ in want.values())  # ways of more than one step


def test_crowded_blocks_become_tiles(spark, monkeypatch):
    rows = planted()
    want = plain(rows)
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 3)
    monkeypatch.setattr(spelling, "TILE_VISITORS", 2)
    assert found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"))) == want


def test_other_parameters(spark):
    rows = [(1, "cat cat cat car cart carts dog"), (2, "Cat dogs dogs dog")]
    got = found(spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), 3, 1, 2))
    assert got == plain(rows, 3, 1, 2)


def test_edges(spark, edge, none):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert found(spelling.variants(edge)) == plain(rows)
    assert found(spelling.variants(none)) == {}


@pytest.mark.parametrize("a,b,one", [
    ("abcdefg", "abcdefg", False), ("abcdefg", "abcdefh", True), ("abcdefg", "bacdefg", False), ("abcdefg", "abcdef", True),
    ("abcdefg", "xabcdefg", True), ("aaaaaaa", "aaaaaaaa", True), ("abcdefg", "abcdefgxy", False), ("abcdefg", "gabcdef", False),
])
def test_one_edit(a, b, one):
    x, y = spelling.Words([a]), spelling.Words([b])
    zero = np.zeros(1, np.int64)
    assert spelling.one_edit(x, zero, y, zero)[0] == one
    assert (len(spelling.near(x, y)[0]) == 1) == one
