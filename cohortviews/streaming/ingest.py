"""Each file is loaded exactly once, and if asked for each of its rows, whatever is restarted or delivered again.

The file source's checkpoint remembers which files were seen. With keys that name a row within its file, which rows have
come is state of the query, in the same checkpoint: a part that is delivered again under another name adds nothing. This
state is a table, the new lines of each batch with their digests, so its size is bounded by disk and not by memory; a batch
reads the digests (12 bytes a line) of all earlier ones. A micro-batch writes to folders of its own, replaced if the batch is
run again, so a lost driver between write and commit leaves no duplicates. A file may come in several parts; one damaged part,
whenever it comes, takes the whole file back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQuery

from cohortviews.functions.ids import file_id_of_path
from cohortviews.schemas import LEDGER
from cohortviews.session import BROADCAST_ROWS, small_side, stage
from cohortviews.sources import folders
from cohortviews.sources.files import CORRUPT, HEADER, KIND, UNREADABLE, Layout, split_lines, typed_lines, usable_rows

#: What tells the lines of all files apart: a digest of file and line, and a shorter one of the file.
DIGEST, OWNER = "_digest", "_owner"
#: Folder of the checkpoint that holds the state: the lines that were new in each batch.
LINES = "lines"


def stream_lines(spark: SparkSession, folder: str, layout: Layout, files_per_batch: int) -> DataFrame:
    reader = spark.readStream.option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
    text, parts = reader.text(folder).select("value", F.col("_metadata.file_path").alias("path")), listed_parts(spark, folder)
    lines = split_lines(text, layout)  # judged and read in one pass
    if parts is None:
        return lines.withColumn("file_id", file_id_of_path("path"))
    lines = lines.join(F.broadcast(parts), "path", "left")
    return lines.withColumn("file_id", F.coalesce("listed", file_id_of_path("path"))).drop("listed")


def listed_parts(spark: SparkSession, folder: str) -> DataFrame | None:
    """``(path, listed)``: the file ids of the parts that lie in ``folder`` now, few enough to broadcast, or none.

    Lines look their id up here, as to search the path of each line takes about as long as to parse it. A part that comes
    later is not listed; its lines are searched.
    """
    if not folders.exists(spark, folder):
        return None
    there = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    parts = stage(there.select(F.col("_metadata.file_path").alias("path")).withColumn("listed", file_id_of_path("path")), "parts")
    return parts if parts.count() <= BROADCAST_ROWS else None


def marked_lines(raw: DataFrame, layout: Layout, keys: Sequence[str] = ()) -> DataFrame:
    """Typed lines; with ``keys``, output columns that name a row within its file, also digests that tell lines apart.

    Headers belong to their part, so each part keeps its own; lines that cannot be read are told apart by all their fields.
    A part is named by a digest of its path, as lines with digests move.
    """
    if not keys:
        return typed_lines(raw, layout)
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in layout.columns], F.col(CORRUPT))
    lines = typed_lines(raw.withColumn(DIGEST, whole), layout, beside=(DIGEST,)).withColumn("path", F.xxhash64("path"))
    digest = F.when(F.col(KIND) == HEADER, F.col("path")).when(~F.col(UNREADABLE), F.xxhash64(*keys)).otherwise(F.col(DIGEST))
    return lines.withColumns({DIGEST: F.xxhash64("file_id", KIND, digest), OWNER: F.hash("file_id", KIND)})


def new_lines(batch: DataFrame, batch_id: int, state: str) -> DataFrame:
    """Marked lines that no earlier line repeats, kept in the folder ``state``; one line of a key stays.

    Lines move once, by their digest, to where they meet each other and the digests that came before in one sorted pass.
    """
    key, spark = [DIGEST, OWNER], batch.sparkSession
    first = F.row_number().over(Window.partitionBy(*key).orderBy("path")) == 1
    lines = batch.repartition(*key).withColumn("first", first).where("first").drop("first")
    if folders.exists(spark, state):
        came = spark.read.schema(f"{DIGEST} bigint, {OWNER} int, batch_id bigint").parquet(state)
        lines = lines.join(came.where(F.col("batch_id") < batch_id), key, "left_anti")
    path = f"{state}/batch_id={batch_id}"
    lines.write.mode("overwrite").parquet(path)
    return spark.read.schema(batch.schema).parquet(path).drop(*key)


def load_new_files(
    spark: SparkSession,
    folder: str,
    manifest: DataFrame,
    layout: Layout,
    target: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    keys: Sequence[str] = (),
) -> StreamingQuery:
    """Load everything that is new in ``folder`` and stop.

    Rows go to ``<target>/rows`` with their file id, bad files to ``<target>/errors``. A second
    call with the same checkpoint loads only rows added since.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        lines = new_lines(batch, batch_id, f"{checkpoint}/{LINES}") if keys else stage(batch, "batch")
        rows, errors, _ = usable_rows(lines, manifest, layout)
        rows.write.mode("overwrite").parquet(f"{target}/rows/batch_id={batch_id}")
        errors.write.mode("overwrite").parquet(f"{target}/errors/batch_id={batch_id}")

    return (
        marked_lines(stream_lines(spark, folder, layout, files_per_batch), layout, keys)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def loaded_rows(spark: SparkSession, target: str, schema: str) -> DataFrame:
    """Rows of all batches, without those of files that any batch found damaged."""
    rows = spark.read.schema(f"file_id string, {schema}").parquet(f"{target}/rows").drop("batch_id")
    bad = spark.read.schema(LEDGER).parquet(f"{target}/errors").select("file_id").distinct()
    return rows.join(small_side(stage(bad, "bad-files")), "file_id", "left_anti").drop("file_id")
