import os
from urllib.parse import urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortviews.operators import variational as va
from cohortviews.session import stage
from cohortviews.sources.artefacts import read_training_log

LIKELIHOODS = {"a": "gaussian", "b": "gaussian", "m": "bernoulli"}


def planted(seed=5, n=240):
    """Factor 1 moves all views, factor 2 view ``a`` only, factor 3 ``b`` and the 0/1 view; a tenth of the cells is missing."""
    rng = np.random.default_rng(seed)
    z = rng.normal(size=(n, 3))
    active = {"a": (30, [1, 1, 0]), "b": (20, [1, 0, 1]), "m": (40, [1, 0, 1])}
    rows = []
    for view, (d, on) in active.items():
        w = rng.normal(size=(d, 3)) * np.array(on)
        signal = z @ w.T
        if view == "m":
            x = (rng.random(signal.shape) < 1 / (1 + np.exp(-2 * signal + 0.7))).astype(float)
        else:
            x = signal + 0.5 * rng.normal(size=signal.shape) + 3
        gone = rng.random(x.shape) < 0.1
        rows += [
            (f"p{u:04d}", view, f"{view}{j:03d}", None if gone[u, j] else float(x[u, j])) for u in range(n) for j in range(d)
        ]
    return z, rows


@pytest.fixture(scope="module")
def model(spark):
    z, rows = planted()
    cells = spark.createDataFrame(rows, "patient_id string, view string, feature_id string, value double")
    return z, va.fit_variational(va.prepared(cells, LIKELIHOODS), LIKELIHOODS, factors=6, max_iter=60, seed=3)


def test_bound_never_falls_and_noise_factors_go(model):
    log = model[1].log.orderBy("iteration").collect()
    for before, after in zip(log, log[1:]):
        if before.factors == after.factors:
            assert after.elbo >= before.elbo - 1e-7 * abs(before.elbo)
    assert log[0].factors == 6 and log[-1].factors == 3 == model[1].factors
    assert log[0].delta_percent is None


def test_planted_factors_come_back(model):
    z, fitted = model
    rows = sorted(fitted.scores.collect(), key=lambda r: r.patient_id)
    found = np.array([r.scores for r in rows])
    assert found.shape == (240, 3)
    full = np.hstack([np.ones((240, 1)), found])
    left = z - full @ np.linalg.lstsq(full, z, rcond=None)[0]
    assert (1 - left.var(0) / z.var(0) > 0.9).all()


def test_factors_switch_off_by_view(model):
    share = {(r.view, r.factor): r.r2 for r in model[1].r2.collect()}
    assert all(v <= 100 for v in share.values())
    assert sum(1 for f in (1, 2, 3) if share[("b", f)] < 1) == 1
    assert sum(1 for f in (1, 2, 3) if share[("a", f)] < 1) == 1
    loadings = model[1].loadings.collect()
    assert {(r.view, r.feature_id[0]) for r in loadings} == {("a", "a"), ("b", "b"), ("m", "m")}
    assert len(loadings) == 90


def test_log_can_be_read_back(spark, model, tmp_path):
    va.log_lines(model[1].log).coalesce(1).write.text(str(tmp_path / "log"))
    read = {r.iteration: (r.elbo, r.factors) for r in read_training_log(spark, str(tmp_path / "log")).collect()}
    wanted = {r.iteration: (r.elbo, r.factors) for r in model[1].log.collect() if r.delta_percent is not None}
    assert read == wanted


def test_blocks_do_not_matter(spark, monkeypatch):
    """Few entities and features in each (padded) tile, so that every sum runs over several blocks, against one tile a view."""
    _, rows = planted(seed=8, n=60)
    cells = spark.createDataFrame([r for r in rows if r[1] != "m"], "patient_id string, view string, feature_id string, value double")
    ready = va.prepared(cells, LIKELIHOODS)
    whole = va.fit_variational(ready, LIKELIHOODS, factors=3, max_iter=40, settle=99)
    monkeypatch.setattr(va, "ENTITY_BLOCK", 16)
    monkeypatch.setattr(va, "FEATURE_BLOCK", 8)
    parts = va.fit_variational(ready, LIKELIHOODS, factors=3, max_iter=40, settle=99)
    last = [m.log.orderBy(F.desc("iteration")).first().elbo for m in (whole, parts)]
    assert abs(last[0] - last[1]) < 0.001 * abs(last[0])


def test_special_functions():
    x = np.array([0.01, 0.5, 1.0, 7.5, 400.0])
    assert np.allclose(va.digamma(x)[2], -0.5772156649015329, atol=1e-10)
    assert np.allclose(va.digamma(x + 1), va.digamma(x) + 1 / x, atol=1e-9)
    assert abs(va.gamma_divergence(np.array([va.PRIOR]), np.array([va.PRIOR]))[0]) < 1e-9


def test_empty_table(spark):
    cells = spark.createDataFrame([], "patient_id string, view string, feature_id string, value double")
    with pytest.raises(ValueError):
        va.fit_variational(cells, LIKELIHOODS)


def plain(spark, n, seed=8):
    _, rows = planted(seed=seed, n=n)
    return va.prepared(spark.createDataFrame(rows, "patient_id string, view string, feature_id string, value double"), LIKELIHOODS)


def test_what_a_pass_writes_and_moves_does_not_grow_with_entities(spark, monkeypatch):
    """eight times the entities, yet a further iteration writes about as much, and a pass over the tiles shuffles nothing."""
    staged = []

    def recorded(df, name="table", by=()):
        plan = df._jdf.queryExecution().executedPlan().toString()
        out = stage(df, name, by)
        size = sum(os.path.getsize(urlparse(f).path) for f in out.inputFiles())
        over_tiles = any("staged-tiles" in f for f in df.inputFiles())
        staged.append((name, size, over_tiles, "Exchange hashpartitioning" in plan))
        return out

    monkeypatch.setattr(va, "stage", recorded)
    monkeypatch.setattr(va, "ENTITY_BLOCK", 16)

    def written(cells, max_iter):
        staged.clear()
        va.fit_variational(cells, LIKELIHOODS, factors=4, max_iter=max_iter, settle=99, convergence="slow")
        return sum(size for _, size, *_ in staged)

    def further(n):
        cells = stage(plain(spark, n))
        return written(cells, 6) - written(cells, 4)

    few, many = further(64), further(512)
    assert many < 4 * few  # a row of sums for each task, of which there are at most 8
    passes = [shuffles for *_, over_tiles, shuffles in staged if over_tiles]
    assert len(passes) >= 4 and not any(passes)
    assert [name for name, *_ in staged].count("scores") == 1


def test_posterior_is_the_fixed_point(monkeypatch):
    """Extrapolated rounds end where plain ones end, also with loadings that separate the classes; Gaussian cells are solved at once."""
    rng = np.random.default_rng(1)
    n, k = 40, 3

    def tile(binary, d, scale):
        w = np.hstack([rng.normal(size=(d, 1)), scale * rng.normal(size=(d, k))])
        ww = w[:, :, None] * w[:, None, :] + 0.01 * np.eye(k + 1)
        x = (rng.random((n, d)) < 0.5).astype(float) if binary else rng.normal(size=(n, d))
        x[rng.random((n, d)) < 0.2] = np.nan
        return va.Tile("m" if binary else "a", binary, 0, x, w, va._packed(ww), np.full(d, 1.0 if binary else 2.0)), ww

    def plain_rounds(tiles, rounds):
        p, h = np.zeros((n, k + 1, k + 1)), np.zeros((n, k + 1))
        mean, covariance = np.zeros((n, k)), np.broadcast_to(np.eye(k), (n, k, k))
        for _ in range(rounds):
            z = np.hstack([np.ones((n, 1)), mean])
            zz = z[:, :, None] * z[:, None, :]
            zz[:, 1:, 1:] += covariance
            p[:], h[:] = 0, 0
            for t, ww in tiles:
                seen = ~np.isnan(t.x)
                at = np.sqrt(np.einsum("uij,dij->ud", zz, ww))
                precision = np.tanh(at / 2) / (2 * at) if t.binary else t.tau * np.ones_like(at)
                target = np.where(seen, t.x - 0.5, 0) if t.binary else np.where(seen, t.x, 0) * t.tau
                p += np.einsum("ud,dij->uij", seen * precision, ww)
                h += target @ t.w
            covariance = np.linalg.inv(np.eye(k) + p[:, 1:, 1:])
            mean = np.einsum("uij,uj->ui", covariance, h[:, 1:] - p[:, 0, 1:])
        return mean, covariance

    for scale in (0.3, 1.0, 4.0):
        tiles = [tile(False, 5, 1.0), tile(True, 12, scale), tile(True, 4, scale)]
        mean, covariance = va.posterior([t for t, _ in tiles])
        wanted = plain_rounds(tiles, 3000)
        assert np.allclose(mean, wanted[0], atol=1e-3) and np.allclose(covariance, wanted[1], atol=1e-3)
        only = tiles[:1]
        assert np.allclose(va.posterior([only[0][0]])[0], plain_rounds(only, 1)[0], atol=1e-12)


def test_many_blocks_of_features_are_shuffled(spark, monkeypatch):
    """Beyond the broadcast limit tiles meet their loadings by a shuffle, with the same rows."""
    cells = stage(plain(spark, 60))
    monkeypatch.setattr(va, "ENTITY_BLOCK", 16)
    monkeypatch.setattr(va, "FEATURE_BLOCK", 8)
    models = []
    for limit in (512, 0):
        monkeypatch.setattr(va, "BROADCAST_BLOCKS", limit)
        models.append(va.fit_variational(cells, LIKELIHOODS, factors=3, max_iter=6, settle=99))
    logs = [[r.elbo for r in m.log.orderBy("iteration").collect()] for m in models]
    assert np.allclose(*logs, rtol=1e-6)
    found = [{r.patient_id: r.scores for r in m.scores.collect()} for m in models]
    assert found[0].keys() == found[1].keys() and len(found[0]) == 60
    assert all(np.allclose(found[0][u], found[1][u], atol=1e-3) for u in found[0])


def test_tiles_hold_every_cell_once(spark, monkeypatch):
    """Blocks that outgrow their size, number ids, an entity without an id, several values of a cell."""
    monkeypatch.setattr(va, "ENTITY_BLOCK", 4)
    monkeypatch.setattr(va, "FEATURE_BLOCK", 2)
    rows = [(u, "a", f"f{j}", float(100 * u + j)) for u in range(101) for j in range(5) if (u + j) % 3]
    rows += [(7, "a", "f0", 706.0), (None, "a", "f0", 1.0), (7, "m", "g", 1.0)]
    cells = spark.createDataFrame(rows, "patient_id long, view string, feature_id string, value double")
    tiles, items = va.tiled(cells, "patient_id", ["m"])
    names = {(r.view, r.db, r.c): r.feature_id for r in items.collect()}
    found = {}
    for block in tiles.collect():
        assert block.ids == sorted(block.ids)
        for t in block.tiles:
            width = sum(1 for view, db, _ in names if (view, db) == (t.view, t.db))
            x = np.frombuffer(bytes(t.x)).reshape(len(block.ids), width)
            assert t.binary == (t.view == "m")
            for (r, c) in zip(*np.nonzero(~np.isnan(x))):
                key = (block.ids[r], t.view, names[t.view, t.db, c])
                assert key not in found
                found[key] = x[r, c]
    wanted = {(u, v, f): x for u, v, f, x in rows if u is not None}
    wanted[7, "a", "f0"] = 703.0
    assert found == wanted
