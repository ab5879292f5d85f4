import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, a int, p int, rank int"


def brute(rows, asked, positives=5, negatives=5, low=80, high=100):
    fine = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            fine[(i, label, tuple(math.floor(256 * float(np.float32(x))) for x in v))] = None
    out = []
    for i, label, v in fine:
        if not asked(i):
            continue
        others = [(-sum(x * y for x, y in zip(v, w)), j, m) for j, m, w in fine if j != i and len(w) == len(v)]
        same = sorted({(s, j) for s, j, m in others if m == label})[:positives]
        rest = sorted({(s, j) for s, j, m in others if m != label})
        for ps, j in same:
            band = [(s, k) for s, k in rest if low * -ps <= 100 * -s <= high * -ps][:negatives]
            out += [(i, j, r, k, -ps, -s) for r, (s, k) in enumerate(band, 1)]
    return sorted(out)


def vectors(n=400, dim=24, labels=4, seed=3):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=dim) * 0.4
    rows = [(k, (centre + rng.normal(size=dim) * (0.05, 0.4)[k % 2]).tolist(), int(rng.integers(labels)) if k % 3 else 0) for k in range(n)]
    rows += [(1000 + k, rows[5][1], k % 2) for k in range(60)]  # ties
    rows += [rows[7]] * 5 + [rows[20]] * 3 + [(20, rows[9][1], 2), (40, [1.0, 2.0], 1), (41, [2.0, 1.0], 1), (42, [1.5, 1.0], 2)]
    nan = float("nan")
    rows += [(None, rows[1][1], 1), (60, None, 1), (80, [nan] * dim, 1), (100, [None] + [0.0] * (dim - 1), 0), (500, rows[1][1], None), (520, [], 1), (521, [], 1), (522, [], 2)]
    rows += [(540, [float("inf")] * dim, 0), (560, [0.0] * dim, 3), (580, (-centre).tolist(), 1)]
    return rows


def run(spark, rows, **more):
    df = spark.createDataFrame([(i, v, c, 1, "v", 2, 3, 4) for i, v, c in rows], SCHEMA).repartition(5)
    return sorted(map(tuple, hn.mine(df, F.col("vec_id") % 20 == 0, **more).collect()))


@pytest.mark.parametrize("bytes_", [1 << 20, 1500])
def test_equals_brute_force(spark, bytes_):
    rows = vectors()
    want = brute(rows, lambda i: i % 20 == 0)
    assert len(want) > 300
    assert run(spark, rows, block_bytes=bytes_) == want


def test_other_counts_and_band(spark):
    rows = vectors(150, 5, 2, 8)
    want = brute(rows, lambda i: i % 20 == 0, 2, 7, 50, 90)
    assert run(spark, rows, positives=2, negatives=7, low=50, high=90) == want


def test_components_beyond_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(k, (rng.normal(size=6) * 1e6).tolist(), k % 3) for k in range(60)]
    assert run(spark, rows) == brute(rows, lambda i: i % 20 == 0)


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(4)
    for dim in (2, 7, 64, 130):
        make = lambda n: hn.Vectors(np.arange(n), np.zeros(n), np.floor(rng.normal(1, 3, (n, dim)) * 256))
        a, r = make(30), make(40)
        true, widths = a.values @ r.values.T, []
        for (am, ad), (rm, rd) in zip(a.levels, r.levels):
            mid, off = am @ rm.T, ad @ rd.T
            assert (np.abs(true - mid) <= off + 1e-6).all()
            widths.append(off.mean())
        assert widths == sorted(widths, reverse=True)
        least = np.quantile(true, 0.9, axis=1)
        u, v = hn.open_pairs(a, r, np.ones((30, 40), bool), least, np.full(30, np.inf))
        kept = np.zeros((30, 40), bool)
        kept[u, v] = True
        assert kept[true >= least[:, None]].all()


def test_summaries_settle_pairs_of_smooth_vectors():
    rng = np.random.default_rng(6)
    steps = np.repeat(rng.normal(size=(300, 8)), 8, axis=1)
    v = hn.Vectors(np.arange(300), np.zeros(300), np.floor(256 * (steps + rng.normal(0, 0.02, steps.shape))))
    true = v.values @ v.values.T
    u, _ = hn.open_pairs(v, v, np.ones((300, 300), bool), np.quantile(true, 0.98, axis=1), np.full(300, np.inf))
    assert len(u) < 0.03 * 300 * 300


def test_vectors_are_not_shuffled(spark):
    df = spark.createDataFrame([(i, v, c, 1, "v", 2, 3, 4) for i, v, c in vectors()], SCHEMA)
    held = {24: hn.Vectors(np.arange(3), np.zeros(3), np.ones((3, 24)))}
    rows = df.selectExpr("vec_id as id", "cast(label as long) label", "embedding v")
    plan = hn._scan(rows, held, None, 1, 5, 256)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and all("v#" not in x for x in plan.splitlines() if "Exchange" in x)


def test_empty_table(spark):
    assert run(spark, []) == []
