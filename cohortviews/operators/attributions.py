"""What every feature adds to every score of boosted trees, by Shapley values along the trees' paths.

A leaf is a product of conditions, one for each feature on its path (several splits by one feature count as one). A row
meets a condition or not; without the feature, a share of the cover passes it. For d features a leaf's Shapley values
follow from the polynomial whose factors are (share + meets x): all rows of a batch are worked on at once, leaf by leaf,
without enumerating subsets. For each row the values add up to its score minus the base value.

The forest travels with the job; its size is that of the model. Summaries are added up where the rows lie, so only one
number for each class and feature leaves a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortviews.operators.boosting import MISSING, Boosted, Tree, bins_of


@dataclass
class Path:
    """A leaf: its value, the features on its path, the share of cover that passes each, and the splits to meet."""

    value: float
    share: np.ndarray
    features: list[int]
    splits: list[tuple[int, int, int, bool, bool]]  # place in features, feature, bin, missing goes left, left is wanted

    def meets(self, bins: np.ndarray) -> np.ndarray:
        """(rows, features of the path): whether a row passes all splits by a feature."""
        out = np.ones((len(bins), len(self.features)), bool)
        for place, f, threshold, missing_left, wants_left in self.splits:
            x = bins[:, f]
            goes_left = np.where(x == MISSING, missing_left, x <= threshold)
            out[:, place] &= goes_left == wants_left
        return out


def paths(tree: Tree) -> list[Path]:
    """All leaves of a tree."""
    out: list[Path] = []

    def walk(node: int, shares: dict[int, float], splits: list[tuple[int, int, bool, bool]]) -> None:
        f = tree.feature[node]
        if f < 0:
            features = list(shares)
            placed = [(features.index(s[0]), *s) for s in splits]
            out.append(Path(tree.value[node], np.array([shares[x] for x in features]), features, placed))
            return
        for child, left in ((tree.left[node], True), (tree.right[node], False)):
            part = tree.cover[child] / tree.cover[node]
            walk(child, shares | {f: shares.get(f, 1.0) * part}, [*splits, (f, tree.bin[node], tree.missing_left[node], left)])

    if tree.feature:
        walk(0, {}, [])
    return out


def leaf_values(path: Path, bins: np.ndarray) -> np.ndarray:
    """(rows, features of the path): the Shapley values of one leaf."""
    met = path.meets(bins).astype(np.float64)
    d = len(path.features)
    out = np.zeros((len(bins), d))
    weight = [factorial(s) * factorial(d - s - 1) / factorial(d) for s in range(d)]
    for i in range(d):
        # coefficient s: the sum over subsets of s other features that are known, the rest passing by their shares
        sums = np.zeros((len(bins), d))
        sums[:, 0] = 1.0
        size = 0
        for j in range(d):
            if j != i:
                known = sums[:, : size + 1] * met[:, [j]]
                sums[:, : size + 1] *= path.share[j]
                sums[:, 1 : size + 2] += known
                size += 1
        out[:, i] = path.value * (met[:, i] - path.share[i]) * (sums @ np.array(weight))
    return out


def base_values(model: Boosted, number: int = 0) -> list[float]:
    """The mean score of each class over the cover of the trees: what no feature explains."""
    out = [0.0] * model.classes
    for one in model.trees(number):
        for k, tree in enumerate(one):
            out[k] += sum(p.value * float(np.prod(p.share)) for p in paths(tree))
    return out


def _values(forest: list[list[Path]], bins: np.ndarray, width: int) -> np.ndarray:
    """(rows, classes, features)."""
    out = np.zeros((len(bins), len(forest), width))
    for k, leaves in enumerate(forest):
        for path in leaves:
            found = leaf_values(path, bins)
            for place, f in enumerate(path.features):
                out[:, k, f] += found[:, place]
    return out


def _forest(model: Boosted, number: int) -> list[list[Path]]:
    return [[p for one in model.trees(number) for p in paths(one[k])] for k in range(model.classes)]


def _step(width: int, classes: int) -> int:
    """Rows at a time, so that their values stay near 64 MB."""
    return max(1, (1 << 23) // max(1, width * classes))


def attributions(df: DataFrame, model: Boosted, id_col: str = "id", features: str = "features", number: int = 0) -> DataFrame:
    """(id, contributions): for every row and class one value a feature, as an array of arrays."""
    forest, cuts, width = _forest(model, number), model.cuts, len(model.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _step(width, len(forest))):
                part = batch.slice(at, _step(width, len(forest)))
                values = _values(forest, bins_of(part.column(1), cuts), width)
                flat = pa.array(values.ravel())
                inner = pa.ListArray.from_arrays(np.arange(0, values.size + 1, max(width, 1), dtype=np.int32), flat)
                outer = pa.ListArray.from_arrays(np.arange(0, len(inner) + 1, len(forest), dtype=np.int32), inner)
                yield pa.RecordBatch.from_arrays([part.column(0), outer], ["id", "contributions"])

    wanted = df.select(F.col(id_col).alias("id"), F.col(features).cast("array<double>").alias("features"))
    kind = wanted.schema["id"].dataType.simpleString()
    return wanted.mapInArrow(run, f"id {kind}, contributions array<array<double>>").withColumnRenamed("id", id_col)


def summary(df: DataFrame, model: Boosted, features: str = "features", number: int = 0) -> DataFrame:
    """(position, class, mean_abs): mean size of the contributions over all rows; nothing is kept for single rows."""
    forest, cuts, width = _forest(model, number), model.cuts, len(model.cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = np.zeros((len(forest), width)), 0
        for batch in batches:
            for at in range(0, batch.num_rows, _step(width, len(forest))):
                bins = bins_of(batch.column(0).slice(at, _step(width, len(forest))), cuts)
                held += np.abs(_values(forest, bins, width)).sum(0)
                n += len(bins)
        k, f = np.divmod(np.arange(held.size), max(width, 1))
        columns = [pa.array(f.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(held.ravel()), pa.array(np.full(held.size, n))]
        yield pa.RecordBatch.from_arrays(columns, ["position", "class", "s", "n"])

    made = df.select(F.col(features).cast("array<double>")).mapInArrow(run, "position int, class int, s double, n long")
    added = made.groupBy("position", "class").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    return added.select("position", "class", F.try_divide("s", "n").alias("mean_abs"))
