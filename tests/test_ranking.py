import random

import pandas as pd
from pyspark.sql import functions as F

from cohortviews.operators import ranking as rk


def frame(spark, n=2000, seed=3):
    """One key holds a third of the rows; scores repeat."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else f"k{rng.randrange(40)}"
        rows.append((key, i, float(rng.randrange(25)), rng.randrange(5)))
    return spark.createDataFrame(rows, "key string, id long, score double, w long").repartition(7), pd.DataFrame(
        rows, columns=["key", "id", "score", "w"]
    )


def test_rank_inside_keys(spark):
    df, pdf = frame(spark)
    got = rk.ranked(df, [F.desc("score"), F.asc("id")], ["key"]).toPandas()
    pdf = pdf.sort_values(["key", "score", "id"], ascending=[True, False, True])
    pdf["rank"] = pdf.groupby("key").cumcount() + 1
    assert dict(zip(got["id"], got["rank"])) == dict(zip(pdf["id"], pdf["rank"]))


def test_global_rank(spark):
    df, pdf = frame(spark)
    got = rk.ranked(df, [F.asc("score"), F.asc("id")]).toPandas()
    expected = pdf.sort_values(["score", "id"])["id"].tolist()
    assert got.sort_values("rank")["id"].tolist() == expected


def test_running_totals_and_null_keys(spark):
    rows = [(None, 1, 2), (None, 2, 3), ("a", 1, 5), ("a", 2, 7), ("a", 3, 11)]
    df = spark.createDataFrame(rows, "k string, i int, w int")
    got = rk.running_totals(df, [F.asc("i")], {"t": F.col("w")}, ["k"]).collect()
    assert {(r.k, r.i): r.t for r in got} == {(None, 1): 2, (None, 2): 5, ("a", 1): 5, ("a", 2): 12, ("a", 3): 23}


def test_top_per_key_same_on_both_paths(spark):
    df, _ = frame(spark)
    order = [F.desc("score"), F.asc("id")]
    small = rk.top_per_key(df, order, 4, ["key"]).select("id", "rank")
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "3")
    try:
        large = rk.top_per_key(df, order, 4, ["key"]).select("id", "rank")
        assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_best_row_first_on_tie(spark):
    df = spark.createDataFrame([(2, 0.3), (3, 0.5), (4, 0.5), (5, None)], "k int, s double")
    assert rk.best_row(df, "s", "k").first()["k"] == 3
