"""Session defaults, the shared staging folder, and lineage cuts.

Nothing here sets a partition count for a cluster: the session that is handed in
decides, and adaptive execution coalesces from there.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

T = TypeVar("T")

#: A side of at most this many rows may be hinted as a broadcast. Rows of the
#: sides concerned hold an id and a few numbers, so this stays far below 100 MB.
BROADCAST_ROWS = 200_000


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benches on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("cohortviews")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder of its own.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="cohortviews-")
    sc.setCheckpointDir(folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; never used twice."""
    return f"{shared_root(spark)}/staged-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "table", by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and scan that instead.

    Cuts the lineage where a result is needed more than once, or where a
    partition number has to stay the same when a task is run again. The copy
    outlives executors, later passes read only the columns they use, and the
    planner knows its size. With ``by``, rows that agree in these columns lie in
    a folder of their own, which a filter on them reads alone.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def together(*jobs: Callable[[], T], at_once: int | None = None) -> list[T]:
    """Run independent builders at the same time (``at_once`` at most), results in order.

    Each one submits its own Spark jobs, so executors that one job leaves idle
    work on another.
    """
    if not jobs:
        return []
    if len(jobs) == 1:
        return [jobs[0]()]
    with ThreadPool(min(len(jobs), at_once or len(jobs))) as pool:
        waiting = [pool.apply_async(inheritable_thread_target(job)) for job in jobs]
        return [w.get() for w in waiting]


def small_side(materialised: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the (already written) side is proven small.

    Past the bound the frame is returned without a hint and Spark plans a
    shuffled join.
    """
    if materialised.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(materialised)
    return materialised
