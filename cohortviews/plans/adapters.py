"""The given star-schema tables seen as cohort tables, in Spark and in SQL.

Each adapter has a SQL twin with the same rows, used as a common table
expression by the comparison queries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from cohortviews.dims import CENTROMERES
from cohortviews.session import stage

#: Panels over part brands; Brand#99 is in no table.
BRAND_PANELS = {
    "P1": {"ALPHA": "Brand#1", "BETA": "Brand#2", "GAMMA": "Brand#3", "DELTA": "Brand#4"},
    "P2": {"EPSILON": "Brand#5", "ZETA": "Brand#7", "ETA": "Brand#11", "THETA": "Brand#13"},
    "P3": {"BETA": "Brand#2", "IOTA": "Brand#17", "KAPPA": "Brand#21", "LAMBDA": "Brand#99"},
}
BRAND_IDS = sorted({g for genes in BRAND_PANELS.values() for g in genes.values()})
BRAND_FEATURES = [f"Brand#{b}.{s}" for b in range(1, 26) for s in range(4)]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PROBES = [f"cg_{e}_{k}" for e in EVENT_TYPES for k in range(10)]
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
DIMS = 64


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; the schema is read from its footer only once."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their customer; orders lie between the two."""
    items = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("patient_id"))
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def line_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items joined once for all adapters that read them, and written.

    ``cohorts`` and ``parts`` hold what customer and part have for the line's keys, null where they have nothing, so that an
    adapter repeats and drops lines just as its own join would. Lines move twice, by order and by part.
    """
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag"
    )
    people = table(spark, sf_dir, "customer").groupBy(F.col("c_custkey").alias("patient_id")).agg(
        F.collect_list(F.struct(F.col("c_mktsegment").alias("cohort"))).alias("cohorts")  # a row for each customer
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("patient_id"))
    parts = table(spark, sf_dir, "part").groupBy("p_partkey").agg(
        F.collect_list(F.struct("p_brand", "p_size", "p_type")).alias("parts")  # a row for each part
    )
    sold = items.join(orders.join(people, "patient_id", "left"), F.col("l_orderkey") == F.col("o_orderkey"))
    sold = sold.drop("l_orderkey", "o_orderkey").join(parts, F.col("l_partkey") == F.col("p_partkey"), "left").drop("p_partkey")
    return stage(sold, "lines")


def _cohort_lines(facts: DataFrame) -> DataFrame:
    return facts.select("*", F.inline("cohorts")).drop("cohorts")


def _part_lines(facts: DataFrame) -> DataFrame:
    return facts.select("*", F.inline("parts")).drop("parts")


def _with_cohort(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    people = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("patient_id"), F.col("c_mktsegment").alias("cohort")
    )
    return df.join(people, "patient_id")


def _brand_size() -> Column:
    return F.concat("p_brand", F.lit("."), F.col("p_size") % 4)


def expression(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """RNA-like: versioned ids, every seventh line without a value. ``facts`` are those of :func:`line_facts`."""
    value = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice"))
    if facts is None:
        parts = table(spark, sf_dir, "part").select("p_partkey", _brand_size().alias("feature_id"))
        rows = _sales(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey"))
        rows = _with_cohort(rows, spark, sf_dir)
    else:
        rows = _part_lines(_cohort_lines(facts)).withColumn("feature_id", _brand_size())
    return rows.select("cohort", "patient_id", "feature_id", value.alias("value"))


SQL_EXPRESSION = """expression AS (
  SELECT c.c_mktsegment AS cohort, o.o_custkey AS patient_id,
         p.p_brand || '.' || CAST(p.p_size % 4 AS VARCHAR) AS feature_id,
         CASE WHEN l.l_linenumber <> 7 THEN l.l_extendedprice END AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey)"""


def part_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hundred features at any factor: a quarter of them seldom has a value, some have none in one cohort."""
    size = F.col("p_size") % 4
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", size.alias("size"), F.concat("p_brand", F.lit("."), size).alias("feature_id")
    )
    rows = _with_cohort(_sales(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey")), spark, sf_dir)
    seldom = (F.col("size") == 3) & (F.col("l_quantity") >= 5)
    nowhere = F.col("p_brand").endswith("5") & (F.col("cohort") == "MACHINERY")
    value = F.when((F.col("l_linenumber") != 7) & ~seldom & ~nowhere, F.col("l_extendedprice"))
    return rows.select("cohort", "patient_id", "feature_id", value.alias("value"))


SQL_PART_EXPRESSION = """part_expression AS (
  SELECT c.c_mktsegment AS cohort, o.o_custkey AS patient_id,
         p.p_brand || '.' || CAST(p.p_size % 4 AS VARCHAR) AS feature_id,
         CASE WHEN l.l_linenumber <> 7 AND NOT (p.p_size % 4 = 3 AND l.l_quantity >= 5)
           AND NOT (p.p_brand LIKE '%5' AND c.c_mktsegment = 'MACHINERY') THEN l.l_extendedprice END AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey JOIN part p ON l.l_partkey = p.p_partkey)"""


def methylation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Beta-like values in (0, 1); several rows per cell."""
    k = F.get_json_object("props", "$.k").cast("int") % 10
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("patient_id"),
        F.concat_ws("_", F.lit("cg"), "event_type", k).alias("feature_id"),
        (F.col("value") / (1 + F.col("value"))).alias("value"),
    )
    return _with_cohort(rows, spark, sf_dir).select("cohort", "patient_id", "feature_id", "value")


SQL_METHYLATION = """methylation AS (
  SELECT c.c_mktsegment AS cohort, e.user_id AS patient_id,
         'cg_' || e.event_type || '_' ||
         CAST(CAST(regexp_extract(e.props, '"k": *([0-9]+)', 1) AS INTEGER) % 10 AS VARCHAR) AS feature_id,
         e.value / (1 + e.value) AS value
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""


def protein(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    if facts is None:
        parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        rows = _sales(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    else:
        rows = _part_lines(facts)
    return rows.select("patient_id", F.col("p_type").alias("feature_id"), F.col("l_quantity").alias("value"))


SQL_PROTEIN = """protein AS (
  SELECT o.o_custkey AS patient_id, p.p_type AS feature_id, l.l_quantity AS value
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey)"""


def mirna(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("patient_id"), F.col("event_type").alias("feature_id"), "value"
    )


SQL_MIRNA = """mirna AS (SELECT user_id AS patient_id, event_type AS feature_id, value FROM events)"""


def segments(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Intervals on 25 chromosomes, of which Y and M are not canonical."""
    n_parts = table(spark, sf_dir, "part").agg(F.count("*").alias("n")).scalar()
    number = F.col("l_suppkey") % 25
    chromosome = (
        F.when(number == 22, "X")
        .when(number == 23, "Y")
        .when(number == 24, "M")
        .otherwise((number + 1).cast("string"))
    )
    start = F.floor(F.col("l_partkey") * F.lit(1e8) / n_parts)
    lines = _with_cohort(_sales(spark, sf_dir), spark, sf_dir) if facts is None else _cohort_lines(facts)
    return lines.select(
        "patient_id",
        chromosome.alias("chromosome"),
        start.alias("start"),
        (start + (F.col("l_quantity") * 100000).cast("long")).alias("end"),
        (F.col("l_discount") + 0.0).alias("copy_number"),
        "cohort",
    )


def _sql_segments() -> str:
    cent = ", ".join(f"('{c}', {b})" for c, b in CENTROMERES.items())
    return f"""segments AS (
  SELECT c.c_mktsegment AS cohort, o.o_custkey AS patient_id,
         CASE l.l_suppkey % 25 WHEN 22 THEN 'X' WHEN 23 THEN 'Y' WHEN 24 THEN 'M'
              ELSE CAST(l.l_suppkey % 25 + 1 AS VARCHAR) END AS chromosome,
         CAST(floor(l.l_partkey * CAST(1e8 AS DOUBLE) / (SELECT count(*) FROM part)) AS BIGINT) AS seg_start,
         CAST(l.l_quantity * 100000 AS BIGINT) AS seg_len,
         l.l_discount + 0.0 AS copy_number
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
centromere(chromosome, bp) AS (VALUES {cent}),
arms AS (
  SELECT s.cohort, s.patient_id, s.chromosome || CASE
           WHEN (s.seg_start + s.seg_start + s.seg_len) / CAST(2 AS DOUBLE) < m.bp THEN 'p' ELSE 'q' END AS arm,
         s.copy_number
  FROM segments s JOIN centromere m ON m.chromosome = 'chr' || s.chromosome)"""


SQL_ARMS = _sql_segments()


def variants(spark: SparkSession, sf_dir: str, facts: DataFrame | None = None) -> DataFrame:
    """Variant calls: return flag as the class, brand and size as the gene."""
    if facts is None:
        parts = table(spark, sf_dir, "part").select("p_partkey", _brand_size().alias("hugo_symbol"))
        rows = _sales(spark, sf_dir).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    else:
        rows = _part_lines(facts).withColumn("hugo_symbol", _brand_size())
    return rows.select("patient_id", "hugo_symbol", F.col("l_returnflag").alias("variant_class"))


SQL_MUTATION = """mutation AS (
  SELECT DISTINCT o.o_custkey AS patient_id,
         p.p_brand || '.' || CAST(p.p_size % 4 AS VARCHAR) AS hugo_symbol
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  WHERE l.l_returnflag IN ('A', 'R'))"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with rule-based folds, clusters, predictions and probabilities."""
    e = table(spark, sf_dir, "embeddings").withColumn("vector", F.col("embedding").cast("array<double>"))
    raw = [F.abs(F.get("vector", F.lit(i))) + F.lit(0.01) for i in range(10)]
    total = raw[0]
    for r in raw[1:]:
        total = total + r
    wrong = F.when(F.col("vec_id") % 7 == 0, 1).otherwise(0)
    return e.select(
        "vec_id",
        "vector",
        "label",
        (F.col("vec_id") % 5).cast("int").alias("fold"),
        (F.col("vec_id") % 4).cast("int").alias("cluster"),
        F.col("label").alias("actual_code"),
        ((F.col("label") + wrong) % 10).cast("int").alias("predicted_code"),
        F.array(*[r / total for r in raw]).alias("probabilities"),
    )


def _sql_vectors() -> str:
    raw = [f"(abs(CAST(embedding[{i + 1}] AS DOUBLE)) + CAST(0.01 AS DOUBLE))" for i in range(10)]
    total = " + ".join(raw)
    return f"""vectors AS (
  SELECT vec_id, label, embedding, CAST(vec_id % 5 AS INTEGER) AS fold,
         CAST(vec_id % 4 AS INTEGER) AS cluster, label AS actual_code,
         (label + CASE WHEN vec_id % 7 = 0 THEN 1 ELSE 0 END) % 10 AS predicted_code,
         [{", ".join(f"{r} / total" for r in raw)}] AS probabilities
  FROM (SELECT *, {total} AS total FROM embeddings) t)"""


SQL_VECTORS = _sql_vectors()


def vector_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings in long form, one feature per dimension."""
    return vectors(spark, sf_dir).select(
        "vec_id", "label", "fold", F.posexplode("vector").alias("dim", "value")
    ).withColumn("feature_id", F.format_string("dim_%02d", F.col("dim")))


SQL_VECTOR_CELLS = """cells AS (
  SELECT vec_id, label, CAST(vec_id % 5 AS INTEGER) AS fold, i - 1 AS dim,
         'dim_' || lpad(CAST(i - 1 AS VARCHAR), 2, '0') AS feature_id, CAST(x AS DOUBLE) AS value
  FROM (SELECT vec_id, label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i
        FROM embeddings) t)"""


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with two label sources; both are null where unlabelled."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string"), F.col("toxic").cast("string")
    )
    return (
        table(spark, sf_dir, "documents")
        .select("doc_id", F.col("lang").alias("cohort"), "source")
        .join(labels, "doc_id", "left")
        .select(F.col("doc_id").alias("patient_id"), "cohort", "source", "quality", "toxic")
    )


SQL_DOCUMENTS = """labelled AS (
  SELECT d.doc_id AS patient_id, d.lang AS cohort, d.source,
         CAST(l.quality AS VARCHAR) AS quality, CAST(l.toxic AS VARCHAR) AS toxic
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def sql_panel(name: str = "panel") -> str:
    rows = ", ".join(
        f"('{p}', '{s}', '{g}')" for p, genes in BRAND_PANELS.items() for s, g in genes.items()
    )
    return f"{name}(panel, symbol, base_id) AS (VALUES {rows})"


def sql_top(source: str, n: int, coverage: float, name: str, forced: Sequence[str] = (), var: str = "var_pop") -> str:
    """CTEs for gated top-n (plus forced ids) over a long table."""
    ids = ", ".join(f"'{g}'" for g in forced)
    force = (
        f" UNION ALL SELECT feature_id, n_obs, variance, TRUE AS forced FROM {name}_stats "
        f"WHERE split_part(feature_id, '.', 1) IN ({ids})"
        if forced
        else ""
    )
    return f"""{name}_stats AS (
  SELECT feature_id, count(value) AS n_obs, {var}(value) AS variance FROM {source} GROUP BY feature_id),
{name}_floor AS (
  SELECT greatest(1, round_even(count(DISTINCT patient_id) * CAST({coverage} AS DOUBLE), 0)) AS f FROM {source}),
{name} AS (
  SELECT feature_id, max(n_obs) AS n_obs, max(variance) AS variance, bool_and(forced) AS forced FROM (
    SELECT * FROM (SELECT feature_id, n_obs, variance, FALSE AS forced FROM {name}_stats
                   WHERE n_obs >= (SELECT f FROM {name}_floor)
                   ORDER BY variance DESC NULLS LAST, feature_id LIMIT {n}) t{force}) u
  GROUP BY feature_id)"""
