"""Sharding, mixing and the operators on vectors against brute force, and over edge cases."""

import zlib

import numpy as np
from conftest_llm import SF, by_id, documents, words

from cohortviews.llm import components, lattice, mixing, multi_index, queries, sharding, suffix_array


def test_op1_is_gapless_and_near_equal(spark, edge, none):
    rows = queries.QUERIES["op1_sharding"](spark, "/root/testdata/sf0.01").collect()
    texts = dict(documents("/root/testdata/sf0.01"))
    assert len(rows) == len(texts)
    sizes, slots = {}, {}
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 16, zlib.crc32(data))
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == set(range(40))
    share = sum(sizes.values()) / 40
    assert max(abs(s - share) for s in sizes.values()) <= max(r.size for r in rows)
    got = sharding.shard_by_bytes(edge, 3).collect()
    assert len(got) == edge.count() and {r.size for r in got if r.doc_id in (2, 3)} == {16}
    assert sharding.shard_by_bytes(none, 3).count() == 0


def test_op1_hot_key_is_subdivided(spark):
    """A third of all rows are copies: their ranges are cut by id, and shards stay near equal."""
    from pyspark.sql import functions as F

    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("copy " * 20)).otherwise(F.concat(F.lit("t"), F.md5(F.col("id").cast("string")))).alias("text")
    )
    rows = sharding.stage(sharding.sized(docs), "t")
    total = rows.agg({"size": "sum"}).first()[0]
    bounds = sharding.splitters(rows, total, 64)
    hot = [k for k, t in bounds if t != sharding.FIRST]
    assert len(set(hot)) == 1 and len(hot) >= 20
    sizes = sharding.shard_by_bytes(docs, 10, least=64).groupBy("shard").agg({"size": "sum"}).collect()
    assert len(sizes) == 10 and max(r[1] for r in sizes) - min(r[1] for r in sizes) <= 2 * 116 + 2 * total / 64


def test_op5_targets_and_takes(spark, edge, none):
    sources = {r.doc_id: r.source for r in queries.documents(spark, "/root/testdata/sf0.01").select("doc_id", "source").collect()}
    run = lambda: by_id(queries.QUERIES["op5_mixing"](spark, "/root/testdata/sf0.01"))
    got = run()
    size, taken = {}, {}
    for doc_id, text in documents("/root/testdata/sf0.01"):
        r = got[doc_id]
        assert r["size"] == len(words(text)) and r["taken"] <= 3 * r["size"]
        s = sources[doc_id]
        size[s] = size.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["taken"]
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size))}
    total = sum(size.values())
    for doc_id, r in got.items():
        s = sources[doc_id]
        assert r["source_size"] == size[s]
        assert abs(r["target"] - total * weights[s] / sum(weights.values())) < 1e-6 * total  # none reaches three times here
        assert abs(taken[s] - r["target"]) <= max(mixing.BLOCK_WORDS, 0.02 * r["target"])
    assert got == run()
    rows = mixing.mix_counts(edge).collect()
    assert len(rows) == edge.count() and all(r.taken <= 3 * r["size"] for r in rows)
    assert mixing.mix_counts(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    assert mixing.mixed_documents(edge).columns == edge.columns


def test_op5_excess_is_reshared():
    out = mixing.targets([("a", 10), ("b", 1000), ("c", 1000), (None, 10)])
    assert [s.name for s in out] == ["a", "b", "c", None]
    assert [s.target for s in out] == [30.0, 1960 * 2 / 3, 1960 / 3, 30.0]


def test_op5_permutations_are_bijections(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 7, 64, 1000):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(5)).alias("p")).collect()
        assert sorted(r.p for r in rows) == list(range(n))


def _vectors(spark, n=300, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 64))
    x[1] = 2.5 * x[0]
    for i in range(2, 40):
        x[i] = x[i - 1] + rng.normal(size=64) * 0.2
    for i in range(40, 50):
        x[i] = x[40]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(n, None, 1), (n + 1, [0.0] * 64, 1), (n + 2, [1.0] * 63 + [None], 1), (n + 3, [1.0] * 63 + [float("nan")], 1)]
    rows += [(n + 4, [float("inf")] * 64, 1), (n + 5, [1.0, 2.0], 1), (n + 6, [1e-200] * 64, 1)]
    return x, spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")


def _components(linked):
    low = np.arange(len(linked))
    while True:
        new = np.array([min(low[linked[i]].min(), low[i]) for i in range(len(linked))])
        if (new == low).all():
            return low
        low = new


def test_op3_links_and_components(spark):
    x, df = _vectors(spark)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = unit @ unit.T >= 0.9
    np.fill_diagonal(linked, False)
    got = by_id(lattice.near_duplicates(df), "vec_id")
    low = _components(linked | np.eye(len(x), dtype=bool))
    for i in range(len(x)):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (linked[i].sum(), low[i], low[i] == i)
    for i in range(len(x), len(x) + 7):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)
    assert lattice.near_duplicates(df.limit(0)).count() == 0


def test_op3_crowded_cells_are_tiled(spark, monkeypatch):
    x, df = _vectors(spark, 200, 5)
    want = by_id(lattice.near_duplicates(df), "vec_id")
    monkeypatch.setattr(lattice, "BLOCK", 3)
    assert by_id(lattice.near_duplicates(df), "vec_id") == want


def test_op3_decodes_to_the_lattice():
    x = np.random.default_rng(1).normal(size=(500, 8)) * 3
    p = lattice.decode(x)
    doubled = np.rint(2 * p)
    assert np.allclose(doubled, 2 * p) and ((doubled % 2).std(1) == 0).all() and (p.sum(1) % 2 == 0).all()
    around = p[:, None] + lattice._around()[None]
    assert (((x - p) ** 2).sum(1) <= ((x[:, None] - around) ** 2).sum(2).min(1) + 1e-9).all()


def test_op10_recall_and_contract(spark):
    x, df = _vectors(spark, 1000)
    got = multi_index.nearest(df, 100, 10).collect()
    valid = {i: v for i, v in enumerate(x)} | {1006: np.full(64, 1e-200)}
    ids, m = np.array(list(valid)), np.array(list(valid.values()))
    hits = 0
    for q in range(0, 1000, 100):
        d = np.sqrt(((m - valid[q]) ** 2).sum(1))
        d[ids == q] = np.inf
        best = ids[np.lexsort((ids, d))][:10]
        rows = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in rows] == list(range(1, 11)) and all(abs(d[ids == v][0] - s) < 1e-12 for _, v, s in rows)
        assert [(s, v) for _, v, s in rows] == sorted((s, v) for _, v, s in rows)
        hits += len(set(best) & {v for _, v, _ in rows})
    assert hits >= 90
    assert {r.query_id for r in got} == set(range(0, 1000, 100))
    few = df.filter("vec_id < 4")
    assert [(r.query_id, r.vec_id) for r in multi_index.nearest(few, 2, 10).filter("query_id = 0").collect()] and multi_index.nearest(few, 2, 10).count() == 6
    assert multi_index.nearest(df.limit(0)).count() == 0


def test_op10_recall_on_given_vectors(spark):
    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, m = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], np.float64)
    got = queries.QUERIES["op10_multi_index"](spark, sf).collect()
    hits = wanted = 0
    for q in ids[ids % 100 == 0]:
        d = ((m - m[ids == q][0]) ** 2).sum(1)
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))][:10])
        hits += len(best & {r.vec_id for r in got if r.query_id == q})
        wanted += 10
    assert hits >= 0.95 * wanted


def test_index_returns_every_code_within_the_radius():
    bits = np.random.default_rng(2).integers(0, 256, size=(3000, 4), dtype=np.uint8)
    index = multi_index.Index(bits)
    for radius in (0, 3, 7, 11):
        for code in bits[:20]:
            want = np.flatnonzero(np.bitwise_count(bits ^ code).sum(1) <= radius)
            assert (index.within(code, radius) == want).all()


def test_components_of_a_long_path(spark):
    rows = [(i, i + 1) for i in range(200)] + [(500, 501), (501, 502), (7, 7), (600, 500), (502, 600)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert {got[i] for i in range(201)} == {0} and {got[i] for i in (500, 501, 502, 600)} == {500}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_suffix_array_and_common_prefixes():
    rng = np.random.default_rng(4)
    for n in range(0, 80):
        text = np.append(rng.integers(1, int(rng.choice([2, 3, 200])), size=n), 0).astype(np.int32)
        sa = suffix_array.suffix_array(text, 100)
        assert sa.tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())
        shared = suffix_array.permuted_common_prefixes(text.astype(np.uint8), sa, 20)
        for a, b in zip(sa[:-1], sa[1:]):
            k = 0
            while k < 20 and max(a, b) + k <= n and text[a + k] == text[b + k]:
                k += 1
            assert shared[b] == k
