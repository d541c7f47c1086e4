"""Sums of Euclidean distances between blocks of vectors.

A block is one row: its vectors packed as doubles. Blocks meet in a cartesian product of written partitions, which moves
nothing through a shuffle; a task keeps one sum for each row of its blocks and target, whatever number of blocks it sees.
What is shuffled are these sums, once for each pair of partitions that a block lies in.

Task functions are built inside functions so that they travel with the job: workers need numpy and pyarrow, not this package.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

#: Below this share of both squared lengths a squared distance is computed from the difference: a product has lost digits.
CLOSE = 1e-6


def vectors_of() -> Callable:
    """Task function: the vectors of an array column as a matrix; raises if one is null or of another length."""

    def matrix(column: pa.ListArray) -> np.ndarray:
        widths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
        if column.null_count or len(widths) != 1:
            raise ValueError("vectors must be there, and of one length")
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), int(widths[0]))

    return matrix


def between() -> Callable:
    """Task function: ``(at, distances)`` of the rows of ``x`` from ``at`` on to all rows of ``y``, 256 rows at a time."""
    close = CLOSE

    def distances(x: np.ndarray, y: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        centre = x.mean(0)  # a common offset would cost digits
        x, y = x - centre, y - centre
        xx, yy = np.einsum("ij,ij->i", x, x), np.einsum("ij,ij->i", y, y)
        twice = -2 * x
        for at in range(0, len(x), 256):
            part = slice(at, at + 256)
            d = twice[part] @ y.T
            d += xx[part, None]
            d += yy
            if not d.min() > close * (xx[part].max() + yy.max()):
                r, s = np.nonzero(d < close * (xx[part, None] + yy))
                for k in range(0, len(r), 4096):
                    rk, sk = r[k : k + 4096], s[k : k + 4096]
                    gap = x[part][rk] - y[sk]
                    d[rk, sk] = np.einsum("ij,ij->i", gap, gap)
            yield at, np.sqrt(d, out=d)

    return distances


def meet(left: DataFrame, right: DataFrame, condition: Column) -> DataFrame:
    """Pairs of blocks for which the condition holds; neither side is shuffled or broadcast."""
    return left.hint("shuffle_replicate_nl").join(right.hint("shuffle_replicate_nl"), condition)


def added(parts: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, sums)``: the sums of one block, added part by part."""
    kinds = ", ".join(f"{k} {parts.schema[k].dataType.simpleString()}" for k in keys)

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for part in batch.column("sums"):
                sums = np.frombuffer(part.as_buffer(), dtype="<f8")
                total = sums.copy() if total is None else total + sums
        columns = [pa.array([k.as_py()], k.type) for k in key]
        yield pa.RecordBatch.from_arrays([*columns, pa.array([total.tobytes()], pa.binary())], [*keys, "sums"])

    return parts.groupBy(*keys).applyInArrow(add, f"{kinds}, sums binary")
