"""Hard negatives against brute force over all pairs."""

import math

import numpy as np
import pytest
from conftest_llm import SF

from cohortviews.llm import hard_negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=100):
    whole = []
    for i, v, k in rows:
        if i is None or k is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = np.clip([math.floor(256 * float(np.float32(c))) for c in v], -hard_negatives.LARGEST, hard_negatives.LARGEST)
        whole.append((i, (k + 1) % 10 if i % 7 == 0 else k, tuple(int(c) for c in x)))
    sizes = [len(x) for _, _, x in whole]
    width = max(sorted(set(sizes)), key=sizes.count, default=0)
    whole = [r for r in whole if len(r[2]) == width]
    out = []
    for a, k, x in {r for r in whole if r[0] % every == 0}:
        scored = [(-sum(p * q for p, q in zip(x, y)), i, other) for i, other, y in whole if i != a]
        for minus, positive, _ in sorted(s for s in scored if s[2] == k)[:5]:
            p = -minus
            fit = sorted((s, i) for s, i, other in scored if other != k and 30 * p <= -100 * s <= 90 * p)[:10]
            out += [(a, positive, r, i, p, -s) for r, (s, i) in enumerate(fit, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select(*[f.split()[0] for f in hard_negatives.MINED.split(", ")]).collect())


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.embeddings(spark, SF).collect()]
    want = plain(rows)
    assert want and found(queries.QUERIES["op12_hard_negatives"](spark, SF)) == want


def clustered(n=3000, clusters=40, d=12, seed=1):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(clusters, d))
    of = rng.integers(0, clusters, n)
    x = (centre[of] + 0.05 * rng.normal(size=(n, d))).astype(np.float32)
    return [(i, x[i].tolist(), int((of[i] + rng.integers(0, 2)) % 10)) for i in range(n)]


@pytest.fixture
def small_blocks(monkeypatch):
    for name, value in {"BLOCK_ROWS": 16, "CHUNK_ANCHORS": 4, "PAGE_BLOCKS": 7, "GROUP_CHUNKS": 2, "TASK_BLOCKS": 5}.items():
        monkeypatch.setattr(hard_negatives, name, value)


def test_many_blocks(spark, small_blocks):
    rows = clustered()
    assert found(hard_negatives.mine(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_zone_maps_spare_blocks(spark, small_blocks, monkeypatch):
    """Of clustered vectors most blocks are never read."""
    monkeypatch.setattr(hard_negatives, "CHUNK_ANCHORS", 1)
    shares = []
    real = hard_negatives.read

    def counting(asked, chosen, blocks, *rest):
        shares.append(chosen.count() / (asked.count() * blocks.count()))
        return real(asked, chosen, blocks, *rest)

    monkeypatch.setattr(hard_negatives, "read", counting)
    hard_negatives.mine(spark.createDataFrame(clustered(), SCHEMA)).collect()
    assert len(shares) == 4 and max(shares) < 0.3, shares


def test_ties_repeats_and_extremes(spark, small_blocks):
    """A third of all rows is one vector; zero, huge, odd and missing vectors; rows and ids that repeat."""
    rows = clustered(600)
    rows = [(i, [0.5] * 12, k) if i % 3 == 0 else (i, v, k) for i, v, k in rows]
    rows += [(700, [0.0] * 12, 3), (800, [3e38] * 12, 4), (900, [-1e9] + [0.1] * 11, 5), (1000, None, 1), (1100, [0.1] * 12, None)]
    rows += [(1200, [float("nan")] + [0.1] * 11, 1), (1300, [None] + [0.1] * 11, 1), (1400, [0.1] * 5, 1), (None, [0.1] * 12, 1), (1500, [], 1)]
    rows += [rows[5], rows[5], rows[100], (100, [0.25] * 12, 2), (400, [float("inf")] * 12, 2)]
    assert found(hard_negatives.mine(spark.createDataFrame(rows, SCHEMA))) == plain(rows)


def test_no_rows_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert hard_negatives.mine(empty).count() == 0
    assert hard_negatives.mine(spark.createDataFrame([(100, None, 1), (200, [float("nan")], 1)], SCHEMA)).count() == 0
    rows = clustered(300)
    extra = ", ".join(f"{c} string" for c in ("number", "chunk", "x", "place", "score", "rank", "anchor", "slot", "page", "block"))
    df = spark.createDataFrame([(*r, *["z"] * 10) for r in rows], f"{SCHEMA}, {extra}")
    assert found(hard_negatives.mine(df)) == plain(rows)


@pytest.mark.parametrize("dimensions,bits", [(2, 4), (3, 3), (4, 2)])
def test_curve_goes_through_neighbouring_cells(dimensions, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dimensions), -1).reshape(-1, dimensions)
    key = hard_negatives.hilbert(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(1)
    assert (steps == 1).all()
