import re

import numpy as np
import pytest

from trajloom.llm import embedding_dedup as ed


def brute(rows, threshold=0.9):
    fine = {}
    for k, (i, v) in enumerate(rows):
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        fine[k] = np.array(v, np.float32).astype(np.float64)
    n, low = [0] * len(rows), {i: i for i, _ in rows if i is not None}
    links = []
    for a in fine:
        for b in fine:
            x, y = fine[a], fine[b]
            if a != b and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                n[a] += 1
                links.append((rows[a][0], rows[b][0]))
    moved = True
    while moved:
        moved = False
        for a, b in links:
            m = min(low[a], low[b])
            moved |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sorted(((i, c, low.get(i), i is None or low[i] == i) for (i, _), c in zip(rows, n)), key=str)


def vectors():
    rng = np.random.default_rng(4)
    rows, centres = [], rng.normal(size=(12, 16))
    for k in range(220):
        v = centres[k % 12] + rng.normal(0, (0.05, 0.35, 0.45)[k % 3], 16)
        rows.append((k, (v * 10.0 ** rng.integers(-3, 4)).tolist()))
    rows += [(300 + k, [1.0] + [0.0] * 15) for k in range(30)]
    nan = float("nan")
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [nan] + [1.0] * 15), (404, [None] + [1.0] * 15), (405, [float("inf")] * 16)]
    rows += [(406, [1.0, 2.0]), (407, [2.0, 4.0]), (408, [1e-30] * 16), (409, [1e30] * 16), (None, [1.0] + [0.0] * 15)]
    return rows


@pytest.mark.parametrize("tile", [4096, 40])
def test_equals_brute_force(spark, tile):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, p int, label int")
    got = ed.near_vectors(df, tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_error_bound_holds():
    rng = np.random.default_rng(5)
    for dim in (3, 64, 1500):
        x, y = ed.Tile(rng.normal(size=(40, dim)) ** 3), ed.Tile(rng.normal(size=(50, dim)) * 100)
        near = (x.q.astype(float) * x.scale[:, None]) @ (y.q.astype(float) * y.scale[:, None]).T
        bound = x.length[:, None] * y.error + x.error[:, None] * y.length + x.error[:, None] * y.error
        assert (np.abs(near - x.unit @ y.unit.T) <= bound + 1e-12).all()


@pytest.mark.parametrize("dim", [8, 2100])
def test_links_are_those_of_double_precision(dim):
    rng = np.random.default_rng(6)
    base = rng.normal(size=dim)
    v = base + rng.normal(0, 0.34, (150, dim))
    t = ed.Tile(v)
    got = np.concatenate([b for _, b in ed.links(t, t, rows=32)])
    u = v / np.linalg.norm(v, axis=1)[:, None]
    assert (got == (u @ u.T >= 0.9)).mean() == 1 and 0 < got.mean() <= 1


def test_empty_table(spark):
    assert ed.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_a_vector_travels_once_for_each_band(spark, monkeypatch):
    """Bands are made for the tasks and not for the tiles, a task holds one group, and nothing is sorted for it."""
    plans = {}

    def stored(df, kind, stored=ed.stored):
        plans[kind] = df._jdf.queryExecution().executedPlan().toString()
        return stored(df, kind)

    monkeypatch.setattr(ed, "stored", stored)
    df = spark.createDataFrame([(i, v) for i, v in vectors()], "vec_id long, embedding array<float>")
    ed.near_vectors(df, tile=20).collect()  # 4 shuffle partitions: 10 groups of 4 bands, of 13 tiles
    assert re.search(r"shufflepartitionidpassthrough\(.*, 10\), REPARTITION_BY_NUM", plans["found"]) and "Sort" not in plans["found"]


@pytest.mark.parametrize("tile", [1, 3])
def test_empty_bands(spark, tile):
    rows = vectors()[:5]
    got = ed.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_band_count():
    assert ed.band_count(0, 0, 4096, 8) == ed.band_count(4096, 4096 * 64, 4096, 8) == 1
    assert [ed.band_count(10**6, 64 * 10**6, 4096, p) for p in (1, 24, 200)] == [16, 16, 28]  # held by size, size, tasks
    assert ed.band_count(10**6, 2048 * 10**6, 4096, 24) == 245  # a tile is the least


@pytest.mark.parametrize("dim", [3, 64, 1024, 1500])
def test_float32_products_of_quantised_vectors_are_exact(dim):
    rng = np.random.default_rng(7)
    x, y = ed.Tile(rng.normal(size=(20, dim))), ed.Tile(rng.choice([-1.0, 1.0], (20, dim)) * 10.0 ** rng.integers(-9, 9, (20, 1)))
    whole = x.q.astype(np.int64) @ y.q.astype(np.int64).T
    assert (ed.products(x.near, y.near) == whole * x.scale[:, None] * y.scale).all()
    assert (np.frexp(x.scale)[0] == 0.5).all() and (np.abs(x.q).max(1) >= 63).all()


def test_far_blocks_are_left_out():
    """One row and one column hold a link; blocks of rows without any are not returned."""
    x = np.eye(64)[np.arange(60) % 8]
    x[40] = np.eye(64)[20]
    got = list(ed.links(ed.Tile(x), ed.Tile(np.eye(64)[10:30]), rows=16))
    assert [lo for lo, _ in got] == [32]
    assert np.argwhere(got[0][1]).tolist() == [[8, 10]]


@pytest.mark.parametrize("dense", [0.0, 1.0])
def test_open_pairs_are_settled_alike_in_dense_blocks(monkeypatch, dense):
    """Nearly all pairs lie at the threshold, some of them exactly on it."""
    monkeypatch.setattr(ed, "DENSE", dense)
    rng = np.random.default_rng(8)
    v = rng.normal(size=24) + rng.normal(0, 0.3, (300, 24))
    v[:40], v[40:80] = [9.0, *[0.0] * 22, np.sqrt(19)], [1.0] + [0.0] * 23
    t = ed.Tile(v)
    got = np.concatenate([b for _, b in ed.links(t, t, rows=64)])
    want = np.einsum("ik,jk->ij", t.unit, t.unit, optimize=False)
    assert ((got == (want >= 0.9)) | (np.abs(want - 0.9) < 1e-15)).all()
    assert (got[:80, :80] == got[:80, :80].T).all() and 0.1 < got[80:, 80:].mean() < 0.95
    each = np.array([[np.einsum("ij,ij->i", t.unit[[a]], t.unit[[b]])[0] for b in range(30, 50)] for a in range(30, 50)])
    assert (got[30:50, 30:50] == (each >= 0.9)).all()
