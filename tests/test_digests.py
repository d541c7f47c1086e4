from pyspark.sql import functions as F

from cohortviews.operators import digests as dg

KEYS, IDS, VALUES = ["project"], ["file"], ["size", "note"]
SCHEMA = "project string, file string, size long, note string"
ROWS = [(f"p{i % 3}", f"f{i:03d}", i, None if i % 4 else "x") for i in range(120)]


def compared(spark, a, b, bits=4):
    sides = [spark.createDataFrame(rows, SCHEMA) for rows in (a, b)]
    trees = [dg.digest_tree(s, KEYS, IDS, VALUES, bits) for s in sides]
    found = dg.differences(*sides, *trees, KEYS, IDS, VALUES, bits).collect()
    branches = dg.unequal_branches(*trees, KEYS).collect()
    return {(r.project, r.file): (r.mark, r.n_expected, r.n_stored) for r in found}, branches


def test_equal_tables_in_any_order(spark):
    assert compared(spark, ROWS, ROWS[::-1]) == ({}, [])
    assert compared(spark, [], []) == ({}, [])


def test_every_kind_of_difference(spark):
    changed = [r for r in ROWS if r[1] != "f003"]
    changed = [(p, f, s + 1, n) if f == "f006" else (p, f, s, n) for p, f, s, n in changed]
    changed += [("p0", "f900", 1, None), ("p0", "f009", 9, None), ("p9", "f001", 1, "y")]
    found, branches = compared(spark, ROWS, changed)
    assert found == {
        ("p0", "f003"): ("MISSING", 1, 0),
        ("p0", "f006"): ("CHANGED", 1, 1),
        ("p0", "f900"): ("EXTRA", 0, 1),
        ("p0", "f009"): ("REPEATED", 1, 2),
        ("p9", "f001"): ("EXTRA", 0, 1),
    }
    assert {r.project for r in branches} == {"p0", "p9"} and len(branches) <= 5


def test_shifted_nulls_and_swapped_values_are_seen(spark):
    one = [("p", "a", 1, None), ("p", "b", None, "1")]
    other = [("p", "a", None, "1"), ("p", "b", 1, None)]
    assert {k: v[0] for k, v in compared(spark, one, other)[0].items()} == {("p", "a"): "CHANGED", ("p", "b"): "CHANGED"}


def test_pairs_do_not_cancel(spark):
    """An exclusive or alone would not see a row that comes twice more; the sum and the count do."""
    twice = ROWS + [ROWS[0]] * 2
    assert compared(spark, ROWS, twice)[0] == {("p0", "f000"): ("REPEATED", 1, 3)}


def test_equal_keys_are_not_opened(spark):
    a = spark.createDataFrame(ROWS, SCHEMA)
    b = a.withColumn("size", F.when(F.col("project") == "p1", F.col("size") + 1).otherwise(F.col("size")))
    top = dg.unequal(*[dg.rolled_digests(dg.digest_tree(t, KEYS, IDS, VALUES), KEYS) for t in (a, b)], KEYS)
    assert [r.project for r in top.collect()] == ["p1"]
