"""Raw measurement files derived from the given tables.

The readers are exercised on files that Spark writes first, under the shared
staging folder. One subject is one nation; a subject's rows are spread over
files of bounded size, so a nation with very many rows is no single file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortviews.plans.adapters import table
from cohortviews.session import small_side, stage, staging_path

ROWS_PER_FILE = 500_000
HITS_PER_PAGE = 10_000
TAB = "\t"

# Fixed value: sample of variant classes, the last two of which do not count.
VARIANT_CLASSES = ("Missense_Mutation", "Nonsense_Mutation", "Splice_Site", "In_Frame_Del", "Frame_Shift_Ins", "Silent", "Intron")


def uuid_of(kind: str, key: Column) -> Column:
    h = F.md5(F.concat(F.lit(kind), key.cast("string")))
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def sql_uuid(kind: str, key: str) -> str:
    h = f"md5('{kind}' || CAST({key} AS VARCHAR))"
    return " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))


def barcode(key: Column) -> Column:
    return F.concat(F.lit("TC-"), F.lpad(key.cast("string"), 2, "0"), F.lit("-SUBJ"))


SQL_BARCODE = "'TC-' || lpad(CAST({key} AS VARCHAR), 2, '0') || '-SUBJ'"


def manifest(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        uuid_of(kind, key).alias("file_id"),
        F.concat(F.lit(kind), key, F.lit(".tsv")).alias("file_name"),
        barcode(key).alias("patient_id"),
        key.alias("nation"),
    )


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the supplier's nation."""
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"))
    return table(spark, sf_dir, "lineitem").join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the customer's nation."""
    people = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"))
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").join(people, F.col("user_id") == F.col("c_custkey")).withColumn("k", k)


def placed_lines(rows: DataFrame, files: DataFrame) -> DataFrame:
    """``(file_id, chunk, at, line)`` of the files to write; lines are given their place where they lie."""
    parts = rows.groupBy("nation").agg(F.count("*").alias("n")).select(
        "nation", F.ceil(F.col("n") / ROWS_PER_FILE).cast("int").alias("parts")
    )
    sized = small_side(stage(files.join(parts, "nation"), "sized"))  # a row for each file id
    heads = sized.select(
        "file_id", "preamble", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("chunk")
    ).select("file_id", "chunk", F.posexplode("preamble").alias("at", "line"))
    body = rows.join(sized, "nation").select(
        "file_id",
        F.pmod(F.xxhash64("salt"), F.col("parts")).cast("int").alias("chunk"),
        F.lit(1_000).alias("at"),
        "line",
    )
    return heads.unionByName(body)


def write_files(
    rows: DataFrame, files: DataFrame, path: str, compression: str = "none", mode: str = "overwrite"
) -> str:
    """Write ``(nation, salt, line)`` rows, one folder per file id.

    ``files`` is ``(nation, file_id, preamble)``; the preamble lines open every
    physical file of the id. Lines move once, to the file they lie in.
    """
    (
        placed_lines(rows, files)
        .repartition("file_id", "chunk")
        .sortWithinPartitions("file_id", "chunk", "at")
        .select("file_id", "chunk", "line")
        .write.mode(mode)
        .option("compression", compression)
        .partitionBy("file_id", "chunk")
        .text(path)
    )
    return path


def line_of(*cells: Column | str) -> Column:
    """Tab-separated cells; an empty string for null."""
    return F.concat_ws(TAB, *[F.coalesce(c.cast("string") if isinstance(c, Column) else F.col(c).cast("string"), F.lit("")) for c in cells])


RNA_HEADER = TAB.join(
    ("gene_id", "gene_name", "gene_type", "unstranded", "stranded_first", "stranded_second",
     "tpm_unstranded", "fpkm_unstranded", "fpkm_uq_unstranded")
)
RNA_PREAMBLE = ["# gene-model: GENCODE v36", RNA_HEADER] + [
    name + TAB * 3 + TAB.join(("10", "x", "")) + TAB * 3
    for name in ("N_unmapped", "N_multimapping", "N_noFeature", "N_ambiguous")
]


def lines(*texts: str) -> Column:
    return F.array(*[F.lit(t) for t in texts])


def rna_files(spark: SparkSession, sf_dir: str, damaged: bool = False) -> str:
    s = sales(spark, sf_dir)
    gene = F.concat(F.lit("ENSG"), F.lpad(F.col("l_partkey").cast("string"), 11, "0"), F.lit("."), F.col("l_linenumber"))
    rows = s.select(
        "nation",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").alias("salt"),
        line_of(
            gene, F.concat(F.lit("G"), F.col("l_partkey")), "l_returnflag", F.col("l_quantity").cast("int"),
            F.lit(0), F.lit(0), "l_discount", F.col("l_extendedprice") / 2, "l_extendedprice",
        ).alias("line"),
    )
    files = manifest(spark, sf_dir, "rna")
    preamble = lines(*RNA_PREAMBLE)
    if damaged:
        wrong = lines("not" + TAB + "a" + TAB + "valid" + TAB + "header")
        unreadable = lines(*RNA_PREAMBLE, TAB.join(("ENSG0.1", "g", "t", "1", "1", "1", "1.0", "many", "1.0")))
        preamble = F.when(F.col("nation") % 5 == 3, wrong).when(F.col("nation") % 5 == 4, unreadable).otherwise(preamble)
    return write_files(rows, files.withColumn("preamble", preamble), staging_path(spark, "rna"))


def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sales(spark, sf_dir)
    start = F.col("l_partkey") * 1000
    return s.select(
        "nation",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").alias("salt"),
        line_of(
            F.concat(F.lit("A"), F.col("l_suppkey")), F.col("l_suppkey") % 22 + 1, start,
            start + (F.col("l_quantity") * 1000).cast("long"), "l_linenumber", F.col("l_discount") - F.col("l_tax"),
        ).alias("line"),
    )


SEGMENT_HEADER = TAB.join(("GDC_Aliquot", "Chromosome", "Start", "End", "Num_Probes", "Segment_Mean"))


def segment_files(spark: SparkSession, sf_dir: str) -> str:
    files = manifest(spark, sf_dir, "cnv").withColumn("preamble", lines(SEGMENT_HEADER))
    return write_files(segment_rows(spark, sf_dir), files, staging_path(spark, "cnv"))


def methylation_files(spark: SparkSession, sf_dir: str, damaged: bool = False) -> str:
    v = visits(spark, sf_dir)
    beta = F.when(F.col("event_type") == "error", "NA").otherwise((F.col("value") / (1 + F.col("value"))).cast("string"))
    rows = v.select("nation", F.col("event_id").alias("salt"), line_of(F.concat(F.lit("cg"), "event_type", "k"), beta).alias("line"))
    preamble = F.array().cast("array<string>")
    if damaged:  # a field too few, a field too many
        preamble = F.when(F.col("nation") % 5 == 3, lines("cg2")).when(F.col("nation") % 5 == 4, lines("cg2\t0.5\tx")).otherwise(preamble)
    files = manifest(spark, sf_dir, "meth").withColumn("preamble", preamble)
    return write_files(rows, files, staging_path(spark, "meth"))


PROTEIN_HEADER = TAB.join(("AGID", "lab_id", "catalog_number", "set_id", "peptide_target", "protein_expression"))


def protein_files(spark: SparkSession, sf_dir: str) -> str:
    """Windows line ends, as in the published files."""
    v = visits(spark, sf_dir)
    value = F.when(F.col("k") == 7, "NA").otherwise(F.col("value").cast("string"))
    line = line_of(F.concat(F.lit("AG"), "k"), F.lit(1), F.lit("c"), F.lit("s"), F.concat(F.upper("event_type"), "k"), value)
    rows = v.select("nation", F.col("event_id").alias("salt"), F.concat(line, F.lit("\r")).alias("line"))
    files = manifest(spark, sf_dir, "rppa").withColumn("preamble", lines(PROTEIN_HEADER + "\r"))
    return write_files(rows, files, staging_path(spark, "rppa"))


MIRNA_HEADER = TAB.join(("miRNA_ID", "read_count", "reads_per_million_miRNA_mapped", "cross-mapped"))


def mirna_files(spark: SparkSession, sf_dir: str) -> str:
    v = visits(spark, sf_dir)
    rpm = F.when(F.col("event_type") == "view", 0.0).otherwise(F.col("value"))
    rows = v.select(
        "nation", F.col("event_id").alias("salt"),
        line_of(F.concat(F.lit("hsa-mir-"), "k"), "event_id", rpm, F.lit("N")).alias("line"),
    )
    files = manifest(spark, sf_dir, "mirna").withColumn("preamble", lines(MIRNA_HEADER))
    return write_files(rows, files, staging_path(spark, "mirna"))


def mutation_files(spark: SparkSession, sf_dir: str) -> str:
    """Compressed; odd and even subjects order their columns differently."""
    s = sales(spark, sf_dir)
    symbol = (
        F.when(F.col("l_partkey") % 11 == 0, "")
        .when(F.col("l_partkey") % 13 == 0, "Unknown")
        .otherwise(F.concat(F.lit("GENE"), F.col("l_partkey") % 97))
    )
    kind = F.element_at(F.array(*[F.lit(c) for c in VARIANT_CLASSES]), F.col("l_linenumber"))
    even = line_of(symbol, "l_orderkey", kind, "l_returnflag")
    odd = line_of(kind, "l_returnflag", symbol, "l_orderkey")
    is_even = F.col("nation") % 2 == 0
    rows = s.select(
        "nation",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate").alias("salt"),
        F.when(is_even, even).otherwise(odd).alias("line"),
    )
    version = "#version gdc-1.0.0"
    files = manifest(spark, sf_dir, "maf").withColumn(
        "preamble",
        F.when(is_even, lines(version, TAB.join(("Hugo_Symbol", "Entrez_Gene_Id", "Variant_Classification", "Strand")))).otherwise(
            lines(version, TAB.join(("Variant_Classification", "Strand", "Hugo_Symbol", "Entrez_Gene_Id")))
        ),
    )
    return write_files(rows, files, staging_path(spark, "maf"), compression="gzip")


def write_pages(rows: DataFrame, key: str, document: Column, name: str) -> str:
    """One JSON document per file, each over a bounded group of rows.

    ``document`` is an aggregate over the rows of a page.
    """
    spark = rows.sparkSession
    path = staging_path(spark, name)
    pages = max(1, -(-rows.count() // HITS_PER_PAGE))
    page = F.pmod(F.xxhash64(key), F.lit(pages)).cast("int").alias("page")
    rows.groupBy(page).agg(document.alias("value")).repartition("page").write.partitionBy("page").text(path)
    return path
