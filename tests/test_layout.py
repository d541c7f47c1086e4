from pyspark.sql import functions as F

from cohortviews.sources import sinks, tables


def scanned(df):
    """Rows that leave the scan, before the filter above it."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_scan_reads_in_proportion_to_the_features_asked_for(spark, tmp_path):
    i = F.col("id")
    rows = spark.range(300_000, numPartitions=8).select(
        F.concat(F.lit("c"), (i % 2).cast("string")).alias("cohort"),
        (i % 977).alias("patient_id"),
        F.format_string("f%04d", F.when(i % 3 == 0, 500).otherwise(F.pmod(F.xxhash64("id"), F.lit(1000)))).alias("feature_id"),
        (i % 13).cast("double").alias("value"),
    )
    asked = [f"f{n:04d}" for n in range(10, 22)]
    counts = {}
    for name, by in (("plain", ()), ("clustered", ("feature_id", "patient_id"))):
        path = sinks.write_long(rows, str(tmp_path / name), ["cohort"], by)
        part = tables.only_features(spark.read.parquet(path), asked)
        counts[name] = scanned(part)
        assert part.count() == rows.where(F.col("feature_id").isin(asked)).count()
        assert spark.read.parquet(path).count() == 300_000
    assert counts["plain"] == 300_000 and counts["clustered"] < 0.4 * 300_000


def test_no_names_give_no_rows(spark):
    df = spark.createDataFrame([("f", 1.0), (None, 2.0)], "feature_id string, value double")
    assert tables.only_features(df, []).count() == 0
    assert tables.only_features(df, ["f", "f", "g"]).count() == 1


def test_tables_of_measurements_are_clustered(spark, tmp_path):
    assert tables.cluster_columns("rna_seq") == ("gene_id", "patient_id") and tables.cluster_columns("cnv") == ()
    rows = spark.range(1000).select((F.col("id") % 10).cast("string").alias("gene_id"), F.col("id").cast("string").alias("patient_id"))
    path = str(tmp_path / "t")
    assert sinks.write_table(rows, path, cluster_by=tables.cluster_columns("rna_seq")) == 1000 and tables.stored(spark, path)
    stored = spark.read.parquet(path).withColumn("file", F.input_file_name()).withColumn("at", F.monotonically_increasing_id())
    seen = [(r.gene_id, r.patient_id) for r in stored.orderBy("file", "at").collect()]
    assert seen == sorted(seen)
