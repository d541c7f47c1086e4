"""What several operators share: table readers, words, staging of results needed twice."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cohortviews.session import stage  # noqa: F401  (re-exported for the operators)

#: A word, as Java's and Python's regular expressions both read it.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def slots_of(rows: int, per_slot: int, least: int) -> int:
    """How many work units ``rows`` need at ``per_slot`` each: grows with the input, never below ``least``."""
    return max(least, -(-rows // per_slot))


def map_texts(
    docs: DataFrame, keep: list[str], schema: str, each: Callable[[list[bytes | None]], list[pa.Array]], rows: int = 256
) -> DataFrame:
    """``each`` over the UTF-8 texts of ``docs``, ``rows`` at a time, beside the kept columns.

    ``each`` returns one array for each column of ``schema``, with a value for each text.
    """
    kept = docs.select(*keep).schema
    full = T.StructType(kept.fields + T.StructType.fromDDL(schema).fields)
    target = to_arrow_schema(full)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = part.column(len(keep)).cast(pa.binary()).to_pylist()
                made = part.columns[: len(keep)] + each(texts)
                yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, target)], schema=target)

    return docs.select(*keep, "text").mapInArrow(run, full)
