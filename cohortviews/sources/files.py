"""Per-subject measurement files to long tables.

All files of a modality are read by one scan; the file a row came from is a
column. A file with a wrong header or an unreadable number contributes no row
and one ledger entry, other files are not affected.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cohortviews import dims
from cohortviews.functions.ids import file_id_of_path
from cohortviews.session import small_side, stage

CORRUPT, KIND, UNREADABLE = "_corrupt", "_kind", "_unreadable"


@dataclass(frozen=True)
class Layout:
    """How one modality's files look and what is taken from them.

    ``output`` maps result column to (raw column, type); ``nulls`` are spellings
    of a missing number; rows whose first column starts with ``drop_prefix`` are
    summary rows.
    """

    columns: tuple[str, ...]
    output: Mapping[str, tuple[str, str]] = field(hash=False)
    header: bool = True
    comment: str | None = None
    nulls: tuple[str, ...] = ()
    drop_prefix: str | None = None


RNA = Layout(
    columns=(
        "gene_id", "gene_name", "gene_type", "unstranded", "stranded_first", "stranded_second",
        "tpm_unstranded", "fpkm_unstranded", "fpkm_uq_unstranded",
    ),
    output={
        "gene_id": ("gene_id", "string"),
        "gene_name": ("gene_name", "string"),
        "gene_type": ("gene_type", "string"),
        "fpkm_unstranded": ("fpkm_unstranded", "double"),
        "tpm_unstranded": ("tpm_unstranded", "double"),
        "fpkm_uq_unstranded": ("fpkm_uq_unstranded", "double"),
    },
    comment="#",
    drop_prefix="N_",
)
SEGMENTS = Layout(
    columns=("GDC_Aliquot", "Chromosome", "Start", "End", "Num_Probes", "Segment_Mean"),
    output={
        "chromosome": ("Chromosome", "string"),
        "start": ("Start", "bigint"),
        "end": ("End", "bigint"),
        "copy_number": ("Segment_Mean", "double"),
    },
)
#: Methylation as an older loader reads it: no spelling of a missing number, so any text in its place spoils the file.
METHYLATION_STRICT = Layout(
    columns=("probe_id", "beta_value"),
    output={"probe_id": ("probe_id", "string"), "beta_value": ("beta_value", "double")},
    header=False,
)
METHYLATION = Layout(
    columns=("probe_id", "beta_value"),
    output={"probe_id": ("probe_id", "string"), "beta_value": ("beta_value", "double")},
    header=False,
    nulls=("NA",),
)
MIRNA = Layout(
    columns=("miRNA_ID", "read_count", "reads_per_million_miRNA_mapped", "cross-mapped"),
    output={
        "mirna_id": ("miRNA_ID", "string"),
        "reads_per_million_mirna_mapped": ("reads_per_million_miRNA_mapped", "double"),
    },
)
PROTEIN = Layout(
    columns=("AGID", "lab_id", "catalog_number", "set_id", "peptide_target", "protein_expression"),
    output={
        "peptide_target": ("peptide_target", "string"),
        "protein_expression": ("protein_expression", "double"),
    },
    nulls=("NA",),
)


def _raw(name: str) -> Column:
    return F.col(f"`{name}`")


def scan(spark: SparkSession, paths: str | Sequence[str], layout: Layout, whole: bool = False) -> DataFrame:
    """Every line as strings, with ``path`` and ``file_id``; headers are rows here.

    ``whole`` parses all fields of a line even if few are used: only then does a wrong number of fields show.
    """
    ddl = ", ".join(f"`{c}` string" for c in layout.columns) + f", {CORRUPT} string"
    reader = (
        spark.read.schema(ddl)
        .option("sep", "\t")
        .option("quote", "")
        .option("header", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", True)
        .option("columnPruning", not whole)
    )
    if layout.comment:
        reader = reader.option("comment", layout.comment)
    return with_file(reader.csv(paths))


def split_lines(text: DataFrame, layout: Layout) -> DataFrame:
    """Lines of text (``value``) as ``scan`` with ``whole`` has them, beside their other columns, at a third of its cost.

    A field that is empty is null; a line with fields too few or too many gives those it has, and itself as ``CORRUPT``.
    Lines of white space only, and comments, are none.
    """
    fields, n = F.col("_fields"), len(layout.columns)
    lines = text.withColumn("value", F.make_valid_utf8("value")).where(F.col("value").rlike(r"[^\x00-\x20]"))
    if layout.comment:
        lines = lines.where(~F.col("value").startswith(layout.comment))
    return lines.withColumn("_fields", F.split("value", "\t", -1)).select(
        *[F.nullif(F.get(fields, F.lit(i)), F.lit("")).alias(c) for i, c in enumerate(layout.columns)],
        F.when(F.size(fields) != n, F.col("value")).alias(CORRUPT),
        *[c for c in text.columns if c != "value"],
    )


def with_file(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.withColumns({"path": path, "file_id": file_id_of_path(path)})


def is_header(layout: Layout) -> Column:
    if not layout.header:
        return F.lit(False)
    return reduce(lambda a, b: a & b, [_raw(c).eqNullSafe(F.lit(c)) for c in layout.columns])


def is_summary(layout: Layout) -> Column:
    if layout.drop_prefix is None:
        return F.lit(False)
    return F.coalesce(_raw(layout.columns[0]).startswith(layout.drop_prefix), F.lit(False))


def _text(layout: Layout, raw: str) -> Column:
    value = _raw(raw)
    return F.when(~value.isin(list(layout.nulls)), value) if layout.nulls else value


def is_unreadable(layout: Layout) -> Column:
    """A field count that is off, or a number that does not parse."""
    bad = F.col(CORRUPT).isNotNull()
    for raw, kind in layout.output.values():
        if kind != "string":
            text = _text(layout, raw)
            bad = bad | (text.isNotNull() & text.try_cast(kind).isNull())
    return bad


#: What a landed line is.
DATA, HEADER, SUMMARY = 0, 1, 2


def typed_lines(raw: DataFrame, layout: Layout, columns: Sequence[str] | None = None, beside: Sequence[str] = ()) -> DataFrame:
    """Every line of a whole scan with what it is, whether it is unreadable, and the typed output columns (or some).

    Columns named by ``beside`` are taken along.
    """
    kind = F.when(is_summary(layout), SUMMARY)
    if layout.header:
        first = layout.columns[0]
        kind = kind.when(is_header(layout), HEADER).when(_raw(first).eqNullSafe(F.lit(first)), SUMMARY)
    kind = kind.otherwise(DATA)
    data_row = ~is_header(layout) & ~is_summary(layout)
    wanted = {n: layout.output[n] for n in columns} if columns else layout.output
    return raw.select(
        "path",
        "file_id",
        kind.cast("tinyint").alias(KIND),
        (data_row & is_unreadable(layout)).alias(UNREADABLE),
        *[
            (_text(layout, raw_name) if type_ == "string" else _text(layout, raw_name).try_cast(type_)).alias(name)
            for name, (raw_name, type_) in wanted.items()
        ],
        *beside,
    )


def file_verdicts(lines: DataFrame, layout: Layout) -> DataFrame:
    """``(file_id, error)`` of every file of typed lines; no error where all its parts can be used."""
    verdict = lines.groupBy("path", "file_id").agg(
        F.count_if(F.col(KIND) == HEADER).alias("headers"), F.count_if(UNREADABLE).alias("unreadable")
    )
    no_header = F.lit(layout.header) & (F.col("headers") == 0)
    error = F.when(no_header, "unexpected header").when(
        F.col("unreadable") > 0, F.format_string("%d unreadable rows", F.col("unreadable"))
    )
    return verdict.withColumn("error", error).groupBy("file_id").agg(F.min("error").alias("error"))


def ledger(errors: DataFrame, manifest: DataFrame) -> DataFrame:
    return manifest.join(errors, "file_id").select("patient_id", "file_id", "error")


def absent_files(seen: DataFrame, manifest: DataFrame) -> DataFrame:
    """Ledger rows for manifest files without a single line on disk; ``seen`` has the file ids that have one."""
    return manifest.join(seen.select("file_id").distinct(), "file_id", "left_anti").select(
        "patient_id", "file_id", F.lit("no such file, or empty").alias("error")
    )


def ingest(
    spark: SparkSession,
    paths: str | Sequence[str],
    manifest: DataFrame,
    layout: Layout,
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, ledger)``: long rows of all usable manifest files.

    The text is parsed once: typed lines land under the shared folder with their file and whether they can be read;
    files are judged on two narrow columns of that, and the rows of usable ones are its columns. Manifest files that are
    not there are in the ledger too.
    """
    landed = stage(typed_lines(scan(spark, paths, layout, whole=True), layout, columns), "landed")
    rows, errors, verdicts = usable_rows(landed, manifest, layout)
    return rows.drop("file_id"), errors.unionByName(absent_files(verdicts, manifest))


def usable_rows(lines: DataFrame, manifest: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of usable files, with ``file_id``, the ledger of those that are not, and all verdicts, from typed lines."""
    verdicts = stage(file_verdicts(lines, layout), "verdicts")
    errors = verdicts.where(F.col("error").isNotNull())
    rows = lines.where(F.col(KIND) == DATA).drop("path", KIND, UNREADABLE)
    good = rows.join(small_side(errors.select("file_id")), "file_id", "left_anti")
    owners = small_side(stage(manifest.select("file_id", "patient_id")))
    out = good.join(owners, "file_id")
    return out.select("file_id", "patient_id", *[c for c in rows.columns if c != "file_id"]), ledger(errors, manifest), verdicts


# --- files read by column name -------------------------------------------------


def lines_by_name(
    spark: SparkSession, paths: str | Sequence[str], names: Sequence[str], comment: str = "#", sep: str = "\t"
) -> tuple[DataFrame, DataFrame]:
    """``(rows, headers)`` for wide files whose column order differs by file.

    The header is the line that holds all wanted names; positions are looked up
    per file. Compressed files are fine. ``headers`` has one row per usable file.
    """
    text = with_file(
        spark.read.option("recursiveFileLookup", True).text(paths)
    )
    clean = F.regexp_replace("value", "\r$", "")
    lines = text.where(~F.col("value").startswith(comment) & (F.col("value") != "")).select(
        "path", "file_id", F.split(clean, sep, -1).alias("f")
    )
    header = reduce(lambda a, b: a & b, [F.array_contains("f", n) for n in names])
    heads = stage(
        lines.where(header)
        .groupBy("path", "file_id")
        .agg(F.min("f").alias("h"))
        .select(
            "path",
            "file_id",
            *[(F.array_position("h", n) - 1).cast("int").alias(f"at_{i}") for i, n in enumerate(names)],
        )
    )
    positions = small_side(heads.drop("file_id"))
    rows = (
        lines.where(~header)
        .join(positions, "path")
        .select("file_id", *[F.get("f", F.col(f"at_{i}")).alias(n) for i, n in enumerate(names)])
    )
    return rows, heads


def ingest_mutations(
    spark: SparkSession,
    paths: str | Sequence[str],
    manifest: DataFrame,
    classes: Sequence[str] = dims.PROTEIN_ALTERING,
) -> tuple[DataFrame, DataFrame]:
    """``(rows, ledger)``: set of (patient, gene) with a protein-altering variant."""
    rows, heads = lines_by_name(spark, paths, ("Hugo_Symbol", "Variant_Classification"))
    kept = altering(rows, "Hugo_Symbol", "Variant_Classification", classes).join(
        small_side(stage(manifest.select("file_id", "patient_id"))), "file_id"
    )
    bad = manifest.join(heads.select("file_id").distinct(), "file_id", "left_anti").select(
        "patient_id", "file_id", F.lit("unexpected header").alias("error")
    )
    out = kept.select("patient_id", F.col("Hugo_Symbol").alias("hugo_symbol")).distinct()
    return out.withColumn("mutated", F.lit(1.0)), bad


def altering(df: DataFrame, symbol: str, variant_class: str, classes: Sequence[str]) -> DataFrame:
    """Variants of the wanted classes with a usable gene symbol."""
    gene = F.col(symbol)
    return df.where(
        F.col(variant_class).isin(list(classes)) & gene.isNotNull() & ~gene.isin("", "Unknown")
    )
