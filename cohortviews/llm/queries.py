"""The queries of the operators over the given tables, with their SQL twins where SQL can state them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from cohortviews.llm import (
    hard_negatives,
    katz,
    language,
    lattice,
    mixing,
    multi_index,
    passages,
    pieces,
    secret_scan,
    sharding,
    simhash,
    spelling,
    substring_dedup,
)
from cohortviews.llm.common import documents, embeddings


def piece_model() -> str:
    """Where the public SentencePiece model lies; it is read there, never copied."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


@query(
    "op1_sharding",
    """
    WITH bytes AS (
        SELECT doc_id, coalesce(text, '') AS t FROM documents
    ), crc_table AS (
        SELECT list(c ORDER BY i) AS tab FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM (SELECT unnest(range(256))::BIGINT AS i))
    ), sized AS (
        SELECT doc_id, octet_length(encode(t))::BIGINT + 16 AS size, md5(t)[1:16] AS key, hex(encode(t)) AS h
        FROM bytes
    ), summed AS (
        SELECT doc_id, size, key,
            xor(list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(range(size - 16), lambda p: ('0x' || h[2 * p + 1 : 2 * p + 2])::BIGINT)),
                lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS text_crc32
        FROM sized, crc_table
    ), ordered AS (
        SELECT *, sum(size) OVER (ORDER BY key, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS until,
            row_number() OVER (ORDER BY key, doc_id NULLS FIRST, size) AS nth,
            sum(size) OVER ()::BIGINT AS total,
            greatest(2048, (count(*) OVER () + 199999) // 200000) AS ranges
        FROM summed
    ), grouped AS (
        SELECT *, sum(size) OVER (PARTITION BY key)::BIGINT AS g, max(until) OVER (PARTITION BY key) AS g_until FROM ordered
    ), placed AS (
        SELECT *, least(39, (CASE WHEN g * ranges <= total THEN 2 * g_until - g ELSE 2 * until - size END) * 40
            // (2 * total))::INTEGER AS shard
        FROM grouped
    )
    SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
        (nth - min(nth) OVER (PARTITION BY shard))::BIGINT AS slot, NULL::INTEGER AS grown_shard
    FROM placed
    """,
)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(documents(spark, sf_dir), 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op5_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_counts(documents(spark, sf_dir))


@query("op8_simhash")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir), 4, 4)


@query("op4_secrets")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.find_secrets(documents(spark, sf_dir))


@query("op6_sentencepiece")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(documents(spark, sf_dir), piece_model())


@query("op9_language")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(documents(spark, sf_dir))


@query("op3_lattice")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(embeddings(spark, sf_dir), 0.9)


@query("op10_multi_index")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.nearest(embeddings(spark, sf_dir), 100, 10)


@query("op2_suffix_array")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(documents(spark, sf_dir), 100)


@query("op7_passages")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.deduplicated(documents(spark, sf_dir), 50)


@query("op11_katz")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score_documents(documents(spark, sf_dir), katz.held_out(2, 7))


@query(
    "op12_hard_negatives",
    """
    WITH whole AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND NOT list_bool_or(list_transform(embedding, lambda x: x IS NULL OR NOT isfinite(x)))
    ), scored AS (
        SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.x, b.x)::BIGINT AS score
        FROM whole a JOIN whole b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
    ), positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
        (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
        vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
    """,
)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(embeddings(spark, sf_dir))


@query(
    "op13_spelling",
    """
    WITH RECURSIVE crc_table AS (
        SELECT list(c ORDER BY i) AS tab FROM (
            SELECT i, list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
            FROM (SELECT unnest(range(256))::BIGINT AS i))
    ), runs AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS id,
            translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS run
        FROM documents
    ), counted AS (
        SELECT run, hex(encode(id || ':' || run)) AS h, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY id, run
    ), hashed AS (
        SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT,
                list_transform(range(length(h) // 2), lambda p: ('0x' || h[2 * p + 1 : 2 * p + 2])::BIGINT)),
                lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) AS crc
        FROM counted, crc_table
    ), slipped AS (
        SELECT k, CASE WHEN crc % 31 = 0
            THEN left(run, (crc % length(run))::INT) || substr(run, (crc % length(run))::INT + 2) ELSE run END AS word
        FROM hashed
    ), words AS (
        SELECT word, sum(k)::BIGINT AS n FROM slipped WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2
    ), holes AS (
        SELECT word, n, i, left(word, i - 1) AS l, substr(word, i + 1) AS r
        FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)
    ), near AS (
        SELECT a.word, b.word AS other, b.n AS other_n FROM holes a JOIN holes b USING (i, l, r) WHERE a.word <> b.word
        UNION
        SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.l || a.r = b.word
        UNION
        SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.l || a.r = b.word
    ), best AS (
        SELECT word, count(*) AS n_near, min({'m': -other_n, 'w': other}) AS b FROM near GROUP BY word
    ), formed AS (
        SELECT w.word, CASE WHEN -b.b.m >= 10 * w.n THEN b.b.w END AS form, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near,
            CASE WHEN -b.b.m >= 10 * w.n THEN -b.b.m END AS form_n
        FROM words w LEFT JOIN best b ON w.word = b.word
    ), ways AS (
        SELECT word, word AS root FROM formed
        UNION ALL
        SELECT w.word, f.form FROM ways w JOIN formed f ON w.root = f.word WHERE f.form IS NOT NULL
    ), ends AS (
        SELECT w.word, w.root FROM ways w JOIN formed f ON w.root = f.word WHERE f.form IS NULL
    )
    SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON f.word = e.word
    """,
)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir))
