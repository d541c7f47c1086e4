"""Folders of a table: whether one is complete, and how a complete one takes its place."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

#: Written into a table's folder after everything else; without it the folder is no table. Readers skip the name.
MARKER = "_COMMITTED"


def _handle(spark: SparkSession, path: str):
    """The file system of a path (any that Spark reads) and the path in its terms."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _handle(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> bool:
    """Whether there was something to remove."""
    fs, at = _handle(spark, path)
    return fs.delete(at, True)


def beside(path: str) -> str:
    """A fresh folder next to ``path``, hidden from scans of the parent."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_new-{name}-{uuid.uuid4().hex}"


def commit(spark: SparkSession, new: str, path: str) -> None:
    """Put the finished folder ``new`` at ``path`` and mark it; what was there goes first.

    Until the mark is written ``path`` counts as no table, so a driver lost in between leaves nothing half loaded.
    """
    fs, source = _handle(spark, new)
    _, target = _handle(spark, path)
    _, mark = _handle(spark, f"{path.rstrip('/')}/{MARKER}")
    fs.delete(mark, False)
    fs.delete(target, True)
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise RuntimeError(f"cannot move {new} to {path}")
    fs.create(mark, True).close()


def committed(spark: SparkSession, path: str) -> bool:
    return exists(spark, f"{path.rstrip('/')}/{MARKER}")
