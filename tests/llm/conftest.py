import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

EDGE = [
    (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, "b"),
    (4, " \t\n ", "de", None),
    (5, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (5, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
    (None, "der hund und die katze sitzen auf der bank und warten", "de", None),
    (None, None, None, None),
    (7, "wort " * 6000, "de", "b"),
    (8, "ein sehr langer text " * 3000 + "ß é 漢字 😀", "de", "c"),
    (9, "12345 !!! ...", "en", "c"),
]
SCHEMA = "doc_id long, text string, lang string, source string"
CLASHING = (
    "n_chars", "size", "shard", "slot", "key", "tie", "range", "order", "s", "from", "block", "row", "id", "digest", "at",
    "anchor", "fp", "label", "score", "accepted", "lang_pred", "held_out", "tokens", "spans", "taken", "target", "row_key",
)


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns with names that operators use inside."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGE, SCHEMA)
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in CLASHING]).drop("n_chars").withColumn(
        "n_chars", F.length("text").cast("long")
    )


@pytest.fixture(scope="session")
def none(edge):
    """The same columns without rows."""
    return edge.limit(0)

