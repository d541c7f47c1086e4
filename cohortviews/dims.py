"""Reference dimensions, kept as plain fixed values and served as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

# ---------------------------------------------------------------------------
# GRCh38 centromere positions in base pairs.
CENTROMERES = {
    "chr1": 123400000,
    "chr2": 93900000,
    "chr3": 90900000,
    "chr4": 50400000,
    "chr5": 48800000,
    "chr6": 59800000,
    "chr7": 60100000,
    "chr8": 45200000,
    "chr9": 43300000,
    "chr10": 39800000,
    "chr11": 53400000,
    "chr12": 35500000,
    "chr13": 17700000,
    "chr14": 17200000,
    "chr15": 19000000,
    "chr16": 36800000,
    "chr17": 25100000,
    "chr18": 18500000,
    "chr19": 26200000,
    "chr20": 28100000,
    "chr21": 12000000,
    "chr22": 15000000,
    "chrX": 60600000,
}

# Published subtype marker panels, gene symbol to Ensembl id.
MARKER_PANELS = {
    "BRCA": {
        "ESR1": "ENSG00000091831",
        "PGR": "ENSG00000082175",
        "ERBB2": "ENSG00000141736",
        "MKI67": "ENSG00000148773",
        "FOXA1": "ENSG00000129514",
        "FOXC1": "ENSG00000054598",
        "BCL2": "ENSG00000171791",
        "CDH1": "ENSG00000039068",
        "MYC": "ENSG00000136997",
        "BIRC5": "ENSG00000089685",
        "AURKA": "ENSG00000087586",
        "CCNB1": "ENSG00000134057",
        "MYBL2": "ENSG00000101057",
        "KRT5": "ENSG00000186081",
        "KRT14": "ENSG00000186847",
        "KRT17": "ENSG00000128422",
        "EGFR": "ENSG00000146648",
        "FGFR4": "ENSG00000160867",
        "CDC20": "ENSG00000117399",
        "MELK": "ENSG00000165304",
    },
    "LUAD": {
        "NKX2-1": "ENSG00000136352",
        "SFTPB": "ENSG00000168878",
        "SFTPC": "ENSG00000168484",
        "TP63": "ENSG00000073282",
        "KRT5": "ENSG00000186081",
        "KRT6A": "ENSG00000205420",
        "MUC1": "ENSG00000185499",
    },
    "PRAD": {
        "AR": "ENSG00000169083",
        "ERG": "ENSG00000157554",
        "ETV1": "ENSG00000006468",
        "ETV4": "ENSG00000175832",
        "FLI1": "ENSG00000151702",
        "SPOP": "ENSG00000121067",
        "FOXA1": "ENSG00000129514",
        "PTEN": "ENSG00000171862",
        "TP53": "ENSG00000141510",
    },
}

# Variant classes that change the protein or its splicing.
PROTEIN_ALTERING = (
    "Missense_Mutation",
    "Nonsense_Mutation",
    "Frame_Shift_Del",
    "Frame_Shift_Ins",
    "In_Frame_Del",
    "In_Frame_Ins",
    "Splice_Site",
    "Splice_Region",
    "Translation_Start_Site",
    "Nonstop_Mutation",
)

# Rare classes folded into one, per cancer type.
RARE_CLASS_REMAP = {
    "PRAD": {
        "PRAD.3-ETV4": "PRAD.8-other",
        "PRAD.6-FOXA1": "PRAD.8-other",
        "PRAD.4-FLI1": "PRAD.8-other",
        "PRAD.7-IDH1": "PRAD.8-other",
    },
    "LUAD": {"LUAD.1": "LUAD.other"},
}

# Spellings of "no label" in the published subtype table.
LABEL_NULLS = ("", "NA", "Not_Applicable", "[Not Applicable]", "NotApplicable")

# Repository category and data type of each modality folder.
MODALITY_SPECS = (
    ("Transcriptome Profiling", "Gene Expression Quantification", "rnaseq"),
    ("Copy Number Variation", "Masked Copy Number Segment", "cnv"),
    ("DNA Methylation", "Methylation Beta Value", "methylation"),
    ("Simple Nucleotide Variation", "Masked Somatic Mutation", "mutations"),
    ("Transcriptome Profiling", "miRNA Expression Quantification", "mirna"),
    ("Proteome Profiling", "Protein Expression Quantification", "rppa"),
    ("Clinical", "Clinical Supplement", "clinical"),
    ("Biospecimen", "Biospecimen Supplement", "_excluded/biospecimen"),
    ("Transcriptome Profiling", "Isoform Expression Quantification", "_excluded/mirna_isoforms"),
)

# Per view, how missing a feature may be and its noise model.
VIEW_CONFIG = {
    "RNA": (0.20, "gaussian"),
    "methylation": (0.40, "gaussian"),
    "CNV": (0.20, "gaussian"),
    "RPPA": (0.20, "gaussian"),
    "miRNA": (0.20, "gaussian"),
    "mutations": (0.20, "bernoulli"),
}

# Thresholds of the published run.
TOP_FEATURES = 5000
MIN_COVERAGE = 0.80
MIN_RECURRENCE = 0.02
MAX_MISSING = 0.20
# ---------------------------------------------------------------------------

#: Arm columns in natural chromosome order.
ARM_COLUMNS = [name[3:] + side for name in CENTROMERES for side in "pq"]


def inline_table(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A fixed small table as a local relation, without a Python worker."""

    def literal(value: object) -> str:
        if isinstance(value, str):
            return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
        return f"{value!r}D" if isinstance(value, float) else str(value)

    columns = [c.strip().split(" ") for c in ddl.split(",")]
    typed = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in columns)
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(name for name, _ in columns)
    if not rows:
        empty = ", ".join(f"CAST(NULL AS {kind}) AS {name}" for name, kind in columns)
        return spark.sql(f"SELECT {empty} WHERE false")
    return spark.sql(f"SELECT {typed} FROM VALUES {values} AS t({names})")


def centromeres(spark: SparkSession) -> DataFrame:
    return inline_table(spark, list(CENTROMERES.items()), "chromosome string, centromere bigint")


def panels(
    spark: SparkSession, definition: Mapping[str, Mapping[str, str]] = MARKER_PANELS
) -> DataFrame:
    """``(panel, symbol, base_id)``, one row per panel gene."""
    rows = [(p, s, g) for p, genes in definition.items() for s, g in genes.items()]
    return inline_table(spark, rows, "panel string, symbol string, base_id string")


def panel_ids(panel: DataFrame) -> DataFrame:
    """Union of all panels as a set of base ids."""
    return panel.select("base_id").distinct()


def view_config(spark: SparkSession, max_missing: float | None = None) -> DataFrame:
    """``(view, max_missing, likelihood)``; a given rate overrides every view."""
    rows = [
        (view, rate if max_missing is None else float(max_missing), likelihood)
        for view, (rate, likelihood) in VIEW_CONFIG.items()
    ]
    return inline_table(spark, rows, "view string, max_missing double, likelihood string")
