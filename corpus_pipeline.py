"""The corpus pipeline: five operators in a row over ``documents``, each on all that the one before kept.

Language identification drops what no language model accepts; near-dedup keeps one document of each group;
the secret scan masks what it finds; mixing draws the documents to the weights of their sources; SentencePiece encodes.
Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortviews.llm import language, mixing, pieces, secret_scan, simhash
from cohortviews.llm.common import documents, stage
from cohortviews.llm.queries import piece_model

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a language model accepts; null and letterless texts go."""
    return language.accepted(docs.select(*COLUMNS))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (fingerprints of four-word shingles, 4 bits or fewer apart), the smallest doc_id."""
    return simhash.one_of_each(docs.select(*COLUMNS), tau=4, shingle=4)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by its kind in angle brackets; n_chars follows the text."""
    return secret_scan.masked(docs.select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each document and repetition with the words that the mix takes of it."""
    return mixing.mixed_documents(docs.select(*COLUMNS))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, digests of ids and decoded text, and the ids themselves."""
    return pieces.encode_documents(docs.select(*COLUMNS), piece_model(), ("doc_id", "source"), with_ids=True, memory_mb=64)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
]

#: Hashes and models of the stages have no SQL twin; tests/llm holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read as the next one's input."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
