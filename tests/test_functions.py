import math

from pyspark.sql import functions as F

from cohortviews.functions import genome, ids, values


def column(spark, ddl, rows, expression):
    df = spark.createDataFrame(rows, ddl)
    return [r[0] for r in df.select(expression).collect()]


def test_barcodes_keep_three_parts(spark):
    rows = [("TCGA-BH-A18H-01A-11R-A115-07",), ("TCGA-E2-A14P",), ("TCGA-AN-A04A-01A",)]
    assert column(spark, "b string", rows, ids.patient_of_barcode("b")) == [
        "TCGA-BH-A18H", "TCGA-E2-A14P", "TCGA-AN-A04A",
    ]


def test_ids(spark):
    rows = [("ENSG00000141736.14",), ("ENSG1",), ("a.b.c",)]
    assert column(spark, "f string", rows, ids.base_id("f")) == ["ENSG00000141736", "ENSG1", "a"]
    paths = [("file:/x/744a6d3d-b666-49aa-8d26-47f34e3d1eb5/a.tsv",), ("file:/x/short/a.tsv",)]
    assert column(spark, "p string", paths, ids.file_id_of_path("p")) == [
        "744a6d3d-b666-49aa-8d26-47f34e3d1eb5", "",
    ]
    assert column(spark, "c string", [("TCGA-BRCA",)], ids.short_cohort("c")) == ["BRCA"]


def test_arms(spark):
    rows = [
        ("chr1", 0, 10, 5), ("chr1", 0, 12, 5), ("chrX", 0, 8, 5), ("chr2", None, 8, 5), ("chr3", 0, 10, 6),
    ]
    arm = genome.arm_of(F.col("c"), F.col("s"), F.col("e"), F.col("m"))
    assert column(spark, "c string, s long, e long, m long", rows, arm) == ["1q", "1q", "Xp", "2q", "3p"]


def test_arm_order(spark):
    df = spark.createDataFrame([(a,) for a in ("Xq", "10p", "2q", "1q", "Xp", "1p", "22q", "2p")], "a string")
    ordered = [r.a for r in df.orderBy(genome.arm_ordinal(F.col("a"))).collect()]
    assert ordered == ["1p", "1q", "2p", "2q", "10p", "22q", "Xp", "Xq"]


def test_families_and_views(spark):
    rows = [("ENSG1.2",), ("cg001",), ("12q",), ("RPPA_TP53",), ("Xp",), ("p",)]
    f = F.col("f")
    assert column(spark, "f string", rows, genome.feature_family(f)) == [
        "rna", "methylation", "cnv", "other", "cnv", "other",
    ]
    assert column(spark, "f string", rows, genome.feature_family(f, rest="cnv"))[3] == "cnv"
    assert column(spark, "f string", rows, genome.view_of(f)) == [
        "RNA", "methylation", "CNV", "RPPA", "CNV", "CNV",
    ]


def test_transforms_keep_null(spark):
    rows = [("RNA", 3.0), ("methylation", 0.5), ("methylation", 1.0), ("methylation", None), ("CNV", -0.2), ("RNA", None)]
    got = column(spark, "v string, x double", rows, values.view_transform(F.col("v"), F.col("x")))
    assert got[0] == 2.0 and got[1] == 0.0 and got[3] is None and got[4] == -0.2 and got[5] is None
    assert math.isclose(got[2], math.log2((1 - 1e-6) / 1e-6), rel_tol=1e-9)


def test_nan_and_infinity(spark):
    rows = [(1.0,), (float("nan"),), (float("inf"),), (None,)]
    assert column(spark, "x double", rows, values.finite_or_null(F.col("x"))) == [1.0, None, None, None]
    assert column(spark, "x double", rows, values.known(F.col("x"))) == [True, False, True, False]


def test_argmax_takes_the_first(spark):
    rows = [([0.2, 0.5, 0.5, 0.1],), ([1.0],)]
    assert column(spark, "p array<double>", rows, values.argmax_code(F.col("p"))) == [1, 0]


def test_floor_rounds_half_to_even(spark):
    rows = [(5,), (7,), (0,), (3,)]
    assert column(spark, "n long", rows, values.coverage_floor(F.col("n"), 0.5)) == [2, 4, 1, 2]


def test_gap_marker(spark):
    assert column(spark, "d int", [(-1,), (0,), (2,)], values.gap_marker(F.col("d"))) == [" gap", "", " +"]
