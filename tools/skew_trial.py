"""Time the core operators on many rows, a third of them in one feature and a
third in one subject: ``skew_trial.py [rows]``."""

from __future__ import annotations

import os
import sys
import time

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortviews.operators import evaluate as ev  # noqa: E402
from cohortviews.operators.model import stratified_folds  # noqa: E402
from cohortviews.operators.select import top_variance_features  # noqa: E402
from cohortviews.plans.cohort import ranked_view  # noqa: E402
from cohortviews.session import local_session, stage  # noqa: E402


def spread(salt: int, n: int):
    return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n))


def timed(name: str, run):
    start = time.perf_counter()
    out = run()
    print(f"{name}: {time.perf_counter() - start:.1f} s", flush=True)
    return out


def main(rows: int) -> None:
    spark = local_session(8, 64)
    spark.sparkContext.setLogLevel("ERROR")
    ids = spark.range(rows)
    long = ids.select(
        F.when(spread(1, 3) == 0, 0).otherwise(spread(3, 20_000)).alias("patient_id"),
        F.when(spread(2, 3) == 0, "ENSG0.1")
        .otherwise(F.format_string("ENSG%d.1", spread(4, 60_000)))
        .alias("feature_id"),
        (spread(5, 100_000) / 7.0).alias("value"),
    )
    long = timed("write", lambda: stage(long, "trial"))
    timed("select 5000 features", lambda: top_variance_features(long, 5000, 0.001).count())
    view = timed("build view", lambda: ranked_view("RNA", long, 5000, 0.001))
    timed("arrays", lambda: view.arrays.write.format("noop").mode("overwrite").save())
    people = stage(
        spark.range(rows // 10).select(
            "id",
            F.when(F.col("id") % 3 == 0, 0).otherwise(spread(6, 10)).cast("int").alias("label"),
            (spread(7, 1_000_000) / 1e6).alias("score"),
        ),
        "people",
    )
    timed("folds", lambda: stratified_folds(people, "label", "id").groupBy("label", "fold").count().count())
    scored = people.select(F.col("label").alias("class"), "score", (F.col("id") % 2).alias("is_pos"))
    timed("roc", lambda: ev.roc_auc(scored).count())


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 40_000_000)
