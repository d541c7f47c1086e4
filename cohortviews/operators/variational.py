"""Variational factor model of several views, on tiles of the observed cells.

A cell is explained by ``intercept + scores of the entity . loadings of the feature``. Gaussian views carry a noise
precision for each feature, 0/1 views a logistic likelihood under its quadratic lower bound. Every (view, factor) has a
precision of its own, so that a factor can switch off in one view and stay in another. Only observed cells count.

Entities and features are cut into blocks; a tile holds the cells of one block of each, missing ones as NaN, and all tiles
of a block of entities lie in one row, written once. A pass reads these rows where they lie: it finds the scores of a block
from the loadings, uses them for its part of the loadings' sums, and forgets them. So scores are neither written nor moved,
and a task gives one row of sums for each block of features, whatever its entities. A task holds one row and these sums. The
driver gets k x k sums for each view, already aggregated.

Scores and the parameters of the logistic bound are found together, repeated from a fixed start until they stay, so that they
follow from the loadings alone. Each half of an iteration maximises the same lower bound over one side, so the bound never
falls while the number of factors stays. Scores and loadings can be turned against each other without a change of the fit;
every few iterations the driver looks for the k x k turn that lifts the bound most, which shuts down idle factors in tens of
passes instead of hundreds. The sums of a pass are turned, not the scores.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from math import ceil, lgamma, log, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from cohortviews.dims import inline_table
from cohortviews.functions.values import known
from cohortviews.operators.factors import FactorModel, standardised
from cohortviews.operators.ranking import ranked
from cohortviews.session import small_side, stage

#: Entities of a block, more or less, and features of a tile.
ENTITY_BLOCK = 512
FEATURE_BLOCK = 128
#: Cells of a block of entities, more or less: with many features it has fewer entities.
BLOCK_CELLS = 4_000_000
#: Loadings of at most so many blocks of features are sent to the tiles; beyond that tiles and loadings are shuffled.
BROADCAST_BLOCKS = 512
#: Change of log(1 + square) of the logistic bound's parameters below which they stay, and rounds at most.
STAY = 1e-5
ROUNDS = 500
#: Shape and rate of every precision's prior.
PRIOR = 1e-3
#: Prior precision of intercepts.
INTERCEPT = 1e-3
#: Change of the bound, in percent of the first one, below which training stops.
CONVERGENCE = {"fast": 5e-4, "medium": 5e-5, "slow": 5e-6}

TILES = "tiles array<struct<view string, binary boolean, db int, x binary>>"
SUMS = "view string, db int, sums binary, tau binary, totals array<double>"
WEIGHTS = (
    "view string, db int, w binary, ww binary, tau binary, bound double, logdet double, n_features long, "
    "squares array<double>, gains array<double>, spread double"
)


@dataclass
class VariationalModel(FactorModel):
    """A factor model with its training log ``(iteration, elbo, delta_percent, factors)``."""

    scores: DataFrame
    loadings: DataFrame
    r2: DataFrame
    factors: int
    log: DataFrame


def prepared(cells: DataFrame, likelihoods: Mapping[str, str]) -> DataFrame:
    """Observed cells: Gaussian views centred and scaled, 0/1 views as they are."""
    binary = F.col("view").isin([v for v, kind in likelihoods.items() if kind == "bernoulli"])
    numbers = standardised(cells.where(~binary))
    return numbers.unionByName(cells.where(binary & known(F.col("value"))).select(numbers.columns))


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of log gamma: shifted up to 6 or more, then the asymptotic series."""
    x = np.array(x, dtype=float)
    shift = np.zeros_like(x)
    while (low := x < 6).any():
        shift[low] -= 1 / x[low]
        x[low] += 1
    inverse = 1 / (x * x)
    tail = inverse * (1 / 12 - inverse * (1 / 120 - inverse * (1 / 252 - inverse * (1 / 240 - inverse / 132))))
    return shift + np.log(x) - 0.5 / x - tail


def gamma_divergence(shape: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """Kullback-Leibler divergence of Gamma(shape, rate) from the prior."""
    logs = np.array([lgamma(s) for s in np.ravel(shape)]).reshape(np.shape(shape))
    return (
        (shape - PRIOR) * digamma(shape) - logs + lgamma(PRIOR)
        + PRIOR * (np.log(rate) - log(PRIOR)) + shape * (PRIOR - rate) / rate
    )


def _array(batch: pa.RecordBatch, name: str, row: int, width: int) -> np.ndarray:
    return np.frombuffer(batch.column(name)[row].as_buffer(), dtype="<f8").reshape(-1, width)


def _bytes(array: np.ndarray) -> bytes:
    return np.ascontiguousarray(array, dtype="<f8").tobytes()


def _packed(full: np.ndarray) -> np.ndarray:
    """The upper triangles of symmetric matrices."""
    rows, columns = np.triu_indices(full.shape[-1])
    return full[..., rows, columns]


def _unpacked(packed: np.ndarray, a: int) -> np.ndarray:
    rows, columns = np.triu_indices(a)
    full = np.empty((*packed.shape[:-1], a, a))
    full[..., rows, columns] = full[..., columns, rows] = packed
    return full


def _facing(ww: np.ndarray, a: int) -> np.ndarray:
    """Packed moments as the columns that give the whole inner products with other packed ones."""
    rows, columns = np.triu_indices(a)
    return (ww * np.where(rows == columns, 1.0, 2.0)).T


def _curvature(square: np.ndarray) -> np.ndarray:
    """Precision that the logistic bound gives a cell, from its squared parameter."""
    at = np.sqrt(np.maximum(square, 1e-12))
    return np.tanh(at / 2) / (2 * at)


def _pseudo(x: np.ndarray, binary: bool, zz: np.ndarray, ww: np.ndarray, a: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Precision and precision times target of each cell, and the part of its bound that neither side's update changes."""
    seen = ~np.isnan(x)
    filled = np.where(seen, x, 0.0)
    if not binary:
        return seen.astype(float), filled, np.zeros_like(x)
    square = np.maximum(zz @ _facing(ww, a), 1e-12)
    at, precision = np.sqrt(square), _curvature(square)
    constant = -np.logaddexp(0.0, -at) - at / 2 + precision * square / 2
    return seen * precision, np.where(seen, filled - 0.5, 0.0), seen * constant


def tiled(cells: DataFrame, entity: str, binary: list[str]) -> tuple[DataFrame, DataFrame]:
    """Blocks of entities ``(ub, ids, tiles)`` in one row each, and the places of features ``(view, feature_id, db, c)``.

    ``cells`` are ``(entity, view, feature_id, value)``; of several values of one cell the mean counts. A digest of the entity
    decides its block, so nothing but the cells themselves moves.
    """
    cells = cells.where(F.col(entity).isNotNull())
    items = stage(ranked(cells.select("view", "feature_id").distinct(), [F.asc("view"), F.asc("feature_id")], name="i"))
    first = F.broadcast(items.groupBy("view").agg(F.min("i").alias("first")))  # a row for each view
    place = F.col("i") - F.col("first")
    items = stage(items.join(first, "view").select(
        "view", "feature_id", (F.col("i") - 1).cast("int").alias("at"),
        F.floor(place / FEATURE_BLOCK).cast("int").alias("db"), (place % FEATURE_BLOCK).cast("int").alias("c")))
    parts = items.groupBy("view", "db").agg(F.min("at").alias("start"), F.count("*").alias("n")).orderBy("start")
    layout = [tuple(r) for r in parts.collect()]  # a row for each block of features
    if not layout:
        raise ValueError("no observed cell to factorise")
    width = sum(n for *_, n in layout)
    size = max(1, min(ENTITY_BLOCK, BLOCK_CELLS // width))
    blocks = max(1, ceil(cells.agg(F.approx_count_distinct(entity)).first()[0] / size))
    placed = cells.join(small_side(items), ["view", "feature_id"]).select(
        F.pmod(F.xxhash64(entity), F.lit(blocks)).cast("int").alias("ub"), entity, "at", F.col("value").cast("double").alias("value"))
    tile = pa.struct([("view", pa.string()), ("binary", pa.bool_()), ("db", pa.int32()), ("x", pa.binary())])

    def build(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict = {}
        sums, counts = np.zeros((size, width)), np.zeros((size, width), dtype="int32")
        for batch in batches:
            ids = batch.column(entity).dictionary_encode()
            kind = ids.type.value_type
            here = np.array([rows.setdefault(i, len(rows)) for i in ids.dictionary.to_pylist()], dtype=int)
            if len(rows) > len(sums):
                more = ((0, max(len(rows) - len(sums), len(sums) // 4)), (0, 0))
                sums, counts = np.pad(sums, more), np.pad(counts, more)
            at = (here[ids.indices.to_numpy()], batch.column("at").to_numpy())
            np.add.at(sums, at, batch.column("value").to_numpy())
            np.add.at(counts, at, 1)
        names = sorted(rows)
        order = [rows[i] for i in names]
        sums, counts = sums[order], counts[order]
        sums[counts == 0] = np.nan
        x = np.divide(sums, counts, out=sums, where=counts > 1)
        tiles = [{"view": v, "binary": v in binary, "db": db, "x": _bytes(x[:, start : start + n])} for v, db, start, n in layout]
        yield pa.RecordBatch.from_arrays(
            [pa.array([key[0].as_py()], pa.int32()), pa.array([names], pa.list_(kind)), pa.array([tiles], pa.list_(tile))],
            ["ub", "ids", "tiles"])

    schema = StructType().add("ub", IntegerType()).add("ids", ArrayType(cells.schema[entity].dataType))
    schema = schema.add("tiles", StructType.fromDDL(TILES)["tiles"].dataType)
    return stage(placed.groupBy("ub").applyInArrow(build, schema), "tiles"), items


@dataclass
class Tile:
    """Cells of one block of entities and one of features, with the features' moments."""

    view: str
    binary: bool
    db: int
    x: np.ndarray
    w: np.ndarray
    ww: np.ndarray
    tau: np.ndarray


def _over_blocks(tiles: DataFrame, weights: DataFrame, a: int, work: Callable, schema, shuffled: bool, ids: bool = False) -> DataFrame:
    """``work`` over the ``(ub, ids, tiles)`` of each task; tiles of a block follow each other, each with its loadings."""
    named = F.when(F.col("pos") == 0, F.col("ids")).alias("ids")
    parts = tiles.select("ub", *(["ids"] if ids else []), F.size("tiles").alias("n"), F.posexplode("tiles").alias("pos", "t"))
    parts = parts.select("ub", *([named] if ids else []), "n", "t.*")
    moments = weights.select("view", "db", "w", "ww", "tau")

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        ub, names, held = None, None, []
        for batch in batches:
            for row in range(batch.num_rows):
                here = batch.column("ub")[row].as_py()
                if held and here != ub:
                    raise RuntimeError("tiles of a block of entities came apart")
                ub = here
                if ids and batch.column("ids")[row].is_valid:
                    names = batch.column("ids")[row].values
                w = _array(batch, "w", row, a)
                held.append(Tile(
                    batch.column("view")[row].as_py(), batch.column("binary")[row].as_py(), batch.column("db")[row].as_py(),
                    _array(batch, "x", row, len(w)), w, _array(batch, "ww", row, a * (a + 1) // 2), _array(batch, "tau", row, 1)[:, 0]))
                if len(held) == batch.column("n")[row].as_py():
                    yield ub, names, held
                    held = []
        if held:
            raise RuntimeError("tiles of a block of entities are missing")

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(gathered(batches))

    def of_block(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(gathered(batches))

    if shuffled:
        return parts.join(moments, ["view", "db"]).groupBy("ub").applyInArrow(of_block, schema)
    return parts.join(F.broadcast(moments), ["view", "db"]).mapInArrow(of_task, schema)


def _moments(mean: np.ndarray, covariance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and packed second moments of scores, the intercept's 1 before them."""
    full = np.ones((len(mean), mean.shape[1] + 1))
    full[:, 1:] = mean
    second = full[:, :, None] * full[:, None, :]
    second[:, 1:, 1:] += covariance
    return full, _packed(second)


def _solved(p: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a = h.shape[1]
    p = _unpacked(p, a)
    covariance = np.linalg.inv(np.eye(a - 1) + p[:, 1:, 1:])
    return np.einsum("uij,uj->ui", covariance, h[:, 1:] - p[:, 0, 1:]), covariance


def posterior(tiles: list[Tile]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the scores of a block of entities that maximise the bound, given the loadings.

    With 0/1 views the parameters of the logistic bound and the scores depend on each other. They are renewed in turn, with a
    squared extrapolation between (Varadhan and Roland 2008), for each entity until its parameters stay.
    """
    n, a = len(tiles[0].x), tiles[0].w.shape[1]
    p, h = np.zeros((n, a * (a + 1) // 2)), np.zeros((n, a))
    for t in tiles:
        known_cells = ~np.isnan(t.x)
        if t.binary:
            h += np.where(known_cells, t.x - 0.5, 0.0) @ t.w
        else:
            p += (known_cells * t.tau) @ t.ww
            h += (np.where(known_cells, t.x, 0.0) * t.tau) @ t.w
    logistic = [t for t in tiles if t.binary]
    if not logistic:
        return _solved(p, h)
    seen = np.hstack([~np.isnan(t.x) for t in logistic]).astype(float)
    ww = np.vstack([t.ww for t in logistic])
    facing = _facing(ww, a)

    def renewed(at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mean, covariance = _solved(p[at] + (seen[at] * _curvature(np.expm1(place))) @ ww, h[at])
        return np.log1p(np.maximum(_moments(mean, covariance)[1] @ facing, 0.0)) * seen[at], mean, covariance

    mean, covariance = np.zeros((n, a - 1)), np.broadcast_to(np.eye(a - 1), (n, a - 1, a - 1)).copy()
    place = np.log1p(np.maximum(_moments(mean, covariance)[1] @ facing, 0.0)) * seen
    live = np.arange(n)
    for turn in range(ROUNDS):
        one, _, _ = renewed(live, place)
        two, mean[live], covariance[live] = renewed(live, one)
        moving = np.abs(two - one).max(1) > STAY
        if not moving.any():
            break
        live, place, one, two = live[moving], place[moving], one[moving], two[moving]
        step, bend = one - place, two - 2 * one + place
        length = np.sqrt((step * step).sum(1) / np.maximum((bend * bend).sum(1), 1e-300))
        length = np.clip(length, 1.0, 50.0 if turn < 50 else 1.0)[:, None]  # 1: no extrapolation
        place = np.clip(place + 2 * length * step + length * length * bend, 0.0, 50.0)
    return mean, covariance


def _start(items: DataFrame, k: int) -> DataFrame:
    """Loadings of zero."""
    a = k + 1

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for view, db, n in zip(*(batch.column(c).to_pylist() for c in ("view", "db", "n"))):
                yield _weight_row(view, db, np.zeros((n, a)), np.zeros((n, a * (a + 1) // 2)), np.ones(n))

    return stage(items.groupBy("view", "db").agg(F.count("*").alias("n")).mapInArrow(weights, WEIGHTS), "weights")


def _weight_row(view, db, mean, second, tau, bound=0.0, logdet=0.0, n=0, squares=(), gains=(), spread=0.0) -> pa.RecordBatch:
    numbers = pa.list_(pa.float64())
    return pa.RecordBatch.from_pydict({
        "view": [view], "db": pa.array([db], pa.int32()), "w": [_bytes(mean)], "ww": [_bytes(second)],
        "tau": [_bytes(tau)], "bound": [float(bound)], "logdet": [float(logdet)],
        "n_features": pa.array([int(n)], pa.int64()), "squares": pa.array([list(squares)], numbers),
        "gains": pa.array([list(gains)], numbers), "spread": [float(spread)]})


def sums_of_pass(tiles: DataFrame, weights: DataFrame, k: int, shuffled: bool, seed: int | None = None) -> DataFrame:
    """Scores from the loadings (or, with ``seed``, random ones), and what the next loadings need of them.

    A task gives a row for each block of features, and one without a view: number of entities, sums of the logarithms of
    their covariances' determinants and of their second moments.
    """
    a = k + 1

    def work(blocks: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        sums, taus, totals = {}, {}, np.zeros(2 + a * (a + 1) // 2)
        for ub, _, held in blocks:
            n = len(held[0].x)
            if seed is None:
                mean, covariance = posterior(held)
            else:
                mean, covariance = np.random.default_rng([seed, ub]).normal(size=(n, k)), np.broadcast_to(np.eye(k), (n, k, k))
            z, zz = _moments(mean, covariance)
            totals += np.concatenate([[n, np.linalg.slogdet(covariance)[1].sum()], zz.sum(0)])
            for t in held:
                precision, target, constant = _pseudo(t.x, t.binary, zz, t.ww, a)
                square = target * target / np.where(precision > 0, precision, 1.0)
                out = np.hstack([
                    precision.T @ zz, target.T @ z, (precision > 0).sum(0)[:, None], square.sum(0)[:, None],
                    constant.sum(0)[:, None]])
                at = (t.view, t.db)
                if at in sums:
                    sums[at] += out
                else:
                    sums[at], taus[at] = out, t.tau.copy()
        if not sums:
            return
        numbers = pa.list_(pa.float64())
        for (view, db), out in sums.items():
            yield pa.RecordBatch.from_pydict({
                "view": [view], "db": pa.array([db], pa.int32()), "sums": [_bytes(out)], "tau": [_bytes(taus[view, db])],
                "totals": pa.array([[]], numbers)})
        yield pa.RecordBatch.from_pydict({
            "view": pa.array([None], pa.string()), "db": pa.array([-1], pa.int32()), "sums": [b""], "tau": [b""],
            "totals": pa.array([totals.tolist()], numbers)})

    return stage(_over_blocks(tiles, weights, a, work, SUMS, shuffled), "sums")


def update_weights(
    sums: DataFrame, turn: np.ndarray, precisions: Mapping[str, np.ndarray], k: int, binary: list[str]
) -> DataFrame:
    """Loadings and noise of every feature, given the sums of a pass over scores that ``turn`` turns; with each block's part of
    the bound."""
    a = k + 1
    full = np.eye(a)
    full[1:, 1:] = turn

    def solve(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        view, db = (part.as_py() for part in key)
        total, tau = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                part = _array(batch, "sums", row, a * (a + 1) // 2 + a + 3)
                if total is None:
                    total, tau = part.copy(), _array(batch, "tau", row, 1)[:, 0]
                else:
                    total += part
        p, h = full @ _unpacked(total[:, : -a - 3], a) @ full.T, total[:, -a - 3 : -3] @ full.T
        n, square, constant = total[:, -3], total[:, -2], total[:, -1]
        real = n > 0
        system = tau[:, None, None] * p + np.diag(np.concatenate([[INTERCEPT], precisions[view]]))
        covariance = np.linalg.inv(system)
        mean = np.einsum("dij,dj->di", covariance, tau[:, None] * h)
        second = covariance + mean[:, :, None] * mean[:, None, :]
        fitted, spread = (h * mean).sum(1), (p * second).sum((1, 2))
        if view in binary:
            bound = constant + fitted - spread / 2
        else:
            left = np.maximum(square - 2 * fitted + spread, 0.0)
            shape, rate = PRIOR + n / 2, PRIOR + left / 2
            tau = np.where(real, shape / rate, 1.0)
            bound = n / 2 * (digamma(shape) - np.log(rate) - log(2 * pi)) - tau * left / 2 - gamma_divergence(shape, rate)
        base = mean[:, :1]
        moved = h[:, 1:] - p[:, 0, 1:] * base
        gains = 2 * mean[:, 1:] * moved - mean[:, 1:] ** 2 * np.diagonal(p, axis1=1, axis2=2)[:, 1:]
        around = square - 2 * base[:, 0] * h[:, 0] + base[:, 0] ** 2 * p[:, 0, 0]
        yield _weight_row(
            view, db, mean, _packed(second), tau, bound[real].sum(),
            np.linalg.slogdet(covariance)[1][real].sum(), real.sum(),
            second[real].sum(0).ravel(), gains[real].sum(0), around[real].sum())

    parts = sums.where(F.col("view").isNotNull()).select("view", "db", "sums", "tau")
    return stage(parts.groupBy("view", "db").applyInArrow(solve, WEIGHTS), "weights")


def _each(column: str, n: int) -> Column:
    return F.array(*[F.sum(F.get(column, F.lit(i))) for i in range(n)]).alias(column)


def _view_sums(weights: DataFrame, k: int) -> dict:
    """Numbers of each view: a row for each, whatever the blocks."""
    rows = weights.groupBy("view").agg(
        *[F.sum(c).alias(c) for c in ("bound", "logdet", "n_features", "spread")], _each("squares", (k + 1) ** 2), _each("gains", k))
    return {r.view: r for r in rows.collect()}


def _square(sums, k: int) -> np.ndarray:
    return np.array(sums.squares).reshape(k + 1, k + 1)


def _precisions(squares: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Shape and rate of each factor's precision in a view, given the summed squares of its loadings."""
    return np.full(len(squares), PRIOR + n / 2), PRIOR + squares / 2


def _bound_and_precisions(views: dict, k: int, divergence: float) -> tuple[float, dict]:
    """The whole lower bound, with each view's factor precisions renewed first."""
    bound, precisions = -divergence, {}
    for view, sums in views.items():
        squares = np.diagonal(_square(sums, k))
        shape, rate = _precisions(squares[1:], sums.n_features)
        precisions[view] = shape / rate
        expected = log(INTERCEPT) + (digamma(shape) - np.log(rate)).sum()
        prior = sums.n_features * expected - INTERCEPT * squares[0] - (precisions[view] * squares[1:]).sum()
        bound += sums.bound + 0.5 * (sums.logdet + sums.n_features * (k + 1) + prior) - gamma_divergence(shape, rate).sum()
    return float(bound), precisions


def turn_bound(turn: np.ndarray, n: int, zz: np.ndarray, views: list[tuple[int, np.ndarray]]) -> float:
    """What depends on ``turn`` in the bound, if scores become ``turn . z`` and loadings ``turn^-T . w``.

    ``zz`` and each view's matrix are sums of second moments over ``n`` entities and the view's features; each view's
    precisions are at their best for the turned loadings.
    """
    back = np.linalg.inv(turn)
    value = (n - sum(d for d, _ in views)) * np.linalg.slogdet(turn)[1] - 0.5 * np.trace(turn @ zz @ turn.T)
    for d, ww in views:
        value -= ((PRIOR + d / 2) * np.log(PRIOR + np.diagonal(back.T @ ww @ back) / 2)).sum()
    return float(value)


def best_turn(n: int, zz: np.ndarray, views: list[tuple[int, np.ndarray]], sweeps: int = 6, angles: int = 90) -> np.ndarray:
    """A turn with a bound at least that of no turn: scores to unit variance, then plane by plane the best angle."""
    k = len(zz)
    values, vectors = np.linalg.eigh(zz / n)
    turn = vectors / np.sqrt(np.maximum(values, 1e-12)) @ vectors.T
    back = np.linalg.inv(turn)
    turned = [back.T @ ww @ back for _, ww in views]
    weight = np.array([PRIOR + d / 2 for d, _ in views])[:, None]
    theta = np.linspace(0, np.pi / 2, angles, endpoint=False)
    c, s = np.cos(theta), np.sin(theta)
    for _ in range(sweeps):
        for i in range(k):
            for j in range(i + 1, k):
                ii, ij, jj = (np.array([t[p] for t in turned])[:, None] for p in ((i, i), (i, j), (j, j)))
                one, other = c * c * ii + 2 * c * s * ij + s * s * jj, s * s * ii - 2 * c * s * ij + c * c * jj
                loss = (weight * (np.log(PRIOR + one / 2) + np.log(PRIOR + other / 2))).sum(0)
                at = int(loss.argmin())
                if at == 0:
                    continue
                plane = np.eye(k)
                plane[i, i] = plane[j, j] = c[at]
                plane[i, j], plane[j, i] = s[at], -s[at]
                turned = [plane @ t @ plane.T for t in turned]
                turn = plane @ turn
    return turn if turn_bound(turn, n, zz, views) > turn_bound(np.eye(k), n, zz, views) else np.eye(k)


@dataclass
class ScoreTotals:
    """Number of entities, sum of their covariances' log determinants, sum of their scores' second moments."""

    n: int
    logdet: float
    squares: np.ndarray

    def divergence(self, turn: np.ndarray) -> float:
        """Kullback-Leibler divergence of the turned scores from their prior."""
        trace = np.trace(turn @ self.squares @ turn.T)
        return float(0.5 * (trace - self.n * len(turn) - self.logdet) - self.n * np.linalg.slogdet(turn)[1])


def _totals(sums: DataFrame, k: int) -> ScoreTotals:
    a = k + 1
    row = sums.where(F.col("view").isNull()).agg(_each("totals", 2 + a * (a + 1) // 2)).first()
    return ScoreTotals(int(row.totals[0]), row.totals[1], _unpacked(np.array(row.totals[2:]), a)[1:, 1:])


def _kept(weights: DataFrame, keep: list[int], k: int) -> DataFrame:
    """Loadings of the factors ``keep`` of ``k``; intercepts stay."""
    a, chosen = k + 1, [0, *(f + 1 for f in keep)]

    def map_weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                second = _unpacked(_array(batch, "ww", row, a * (a + 1) // 2), a)[:, chosen][:, :, chosen]
                yield _weight_row(
                    batch.column("view")[row].as_py(), batch.column("db")[row].as_py(), _array(batch, "w", row, a)[:, chosen],
                    _packed(second), _array(batch, "tau", row, 1))

    return stage(weights.mapInArrow(map_weights, WEIGHTS), "weights")


def _turn(scores: ScoreTotals, views: dict, k: int) -> tuple[np.ndarray, dict]:
    """The best turn of the scores, and the factor precisions of the loadings turned against it."""
    sums = {v: (s.n_features, _square(s, k)[1:, 1:]) for v, s in views.items()}
    turn = best_turn(scores.n, scores.squares, list(sums.values()))
    back = np.linalg.inv(turn)
    renewed = {v: _precisions(np.diagonal(back.T @ ww @ back), d) for v, (d, ww) in sums.items()}
    return turn, {v: shape / rate for v, (shape, rate) in renewed.items()}


def fit_variational(
    cells: DataFrame,
    likelihoods: Mapping[str, str],
    entity: str = "patient_id",
    factors: int = 15,
    max_iter: int = 1000,
    convergence: str = "fast",
    seed: int = 42,
    min_r2: float = 0.001,
    settle: int = 5,
    turn_every: int = 2,
) -> VariationalModel:
    """Factor model of :func:`prepared` cells ``(entity, view, feature_id, value)``.

    ``likelihoods`` names ``gaussian`` or ``bernoulli`` (values 0 and 1) for each view; a view not named is Gaussian.
    Every ``turn_every`` iterations both sides are turned. After ``settle`` iterations a factor that explains less than
    ``min_r2`` (a share) of every view is dropped, the weakest one in each iteration, though never the last. Factors come in
    the order of what they explain in all views together; the scores are those of the last loadings.
    Shares of 0/1 views are those of the bound's Gaussian targets. A table without cells raises ``ValueError``.
    """
    spark = cells.sparkSession
    binary = [v for v, kind in likelihoods.items() if kind == "bernoulli"]
    tiles, items = tiled(cells, entity, binary)
    shuffled = items.select("view", "db").distinct().count() > BROADCAST_BLOCKS
    names = [r.view for r in items.select("view").distinct().collect()]  # a row for each view
    k, history, first, last = factors, [], None, None
    precisions, turn = {v: np.ones(k) for v in names}, np.eye(k)
    sums = sums_of_pass(tiles, _start(items, k), k, shuffled, seed)
    totals = _totals(sums, k)
    for iteration in range(1, max_iter + 1):
        dropped = False
        weights = update_weights(sums, turn, precisions, k, binary)
        views = _view_sums(weights, k)
        bound, precisions = _bound_and_precisions(views, k, totals.divergence(turn))
        first = bound if first is None else first
        delta = 0.0 if last is None else 100 * (bound - last) / abs(first)
        history.append((iteration, bound, delta, k))
        shares = np.array([np.array(s.gains) / max(s.spread, 1e-300) for s in views.values()])
        best = shares.max(0)
        if k > 1 and iteration > settle and best.min() < min_r2:
            keep = [f for f in range(k) if f != int(best.argmin())]
            weights = _kept(weights, keep, k)
            precisions = {v: p[keep] for v, p in precisions.items()}
            k, last, dropped = k - 1, None, True
        elif (last is not None and abs(delta) < CONVERGENCE[convergence]) or iteration == max_iter:
            break
        else:
            last = bound
        sums = sums_of_pass(tiles, weights, k, shuffled)
        totals, turn = _totals(sums, k), np.eye(k)
        if iteration % turn_every == 0 and not dropped:
            turn, renewed = _turn(totals, views, k)
            precisions = precisions if (turn == np.eye(k)).all() else renewed
    if shares.shape[1] != k:  # the last iteration dropped a factor
        weights = update_weights(sums, turn, precisions, k, binary)
        views = _view_sums(weights, k)
        shares = np.array([np.array(s.gains) / max(s.spread, 1e-300) for s in views.values()])
    order = [int(f) for f in np.argsort(-shares.sum(0), kind="stable")]
    r2 = [(rank, v, float(100 * shares[i][f])) for rank, f in enumerate(order, 1) for i, v in enumerate(views)]
    log_table = inline_table(spark, history, "iteration int, elbo double, delta_percent double, factors int").withColumn(
        "delta_percent", F.when(F.col("iteration") > 1, F.col("delta_percent")))
    return VariationalModel(
        scores=_scores(tiles, weights, entity, order, k, shuffled),
        loadings=_loadings(weights, order, k).join(items, ["view", "db", "c"]).select("view", "feature_id", "loadings"),
        r2=inline_table(spark, r2, "factor int, view string, r2 double"),
        factors=k,
        log=log_table,
    )


def _scores(tiles: DataFrame, weights: DataFrame, entity: str, order: list[int], k: int, shuffled: bool) -> DataFrame:
    """Mean scores of every entity, in the order of the factors."""

    def rows(blocks: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        for _, ids, held in blocks:
            means = posterior(held)[0][:, order]
            yield pa.RecordBatch.from_arrays([ids, pa.array(means.tolist(), pa.list_(pa.float64()))], [entity, "scores"])

    schema = StructType().add(entity, tiles.schema["ids"].dataType.elementType).add("scores", ArrayType(DoubleType()))
    return stage(_over_blocks(tiles, weights, k + 1, rows, schema, shuffled, ids=True), "scores")


def _loadings(weights: DataFrame, order: list[int], k: int) -> DataFrame:
    """Mean loadings of every place of the blocks of features, in the order of the factors."""
    chosen = [f + 1 for f in order]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                means = _array(batch, "w", row, k + 1)[:, chosen]
                n = len(means)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column("view")[row].as_py()] * n, pa.string()),
                     pa.array([batch.column("db")[row].as_py()] * n, pa.int32()), pa.array(np.arange(n, dtype="int32")),
                     pa.array(means.tolist(), pa.list_(pa.float64()))], ["view", "db", "c", "loadings"])

    return weights.select("view", "db", "w").mapInArrow(rows, "view string, db int, c int, loadings array<double>")


def log_lines(log_table: DataFrame) -> DataFrame:
    """The training log as lines of text, in the form that ``artefacts.read_training_log`` reads."""
    change = F.coalesce(F.format_string(", deltaELBO (%s%%)", F.col("delta_percent").cast("string")), F.lit(""))
    return log_table.orderBy("iteration").select(
        F.concat(
            F.lit("Iteration "), F.col("iteration").cast("string"), F.lit(": ELBO="), F.col("elbo").cast("string"),
            F.when(F.col("delta_percent").isNull(), F.lit("")).otherwise(change),
            F.lit(", Factors="), F.col("factors").cast("string"),
        ).alias("value")
    )
