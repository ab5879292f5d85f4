"""The audits against plain numpy, and their edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajloom.operators import audit, quality

RNG = np.random.default_rng(8)


def turn(v):
    a = np.linalg.norm(v)
    k = np.array([[0, -v[2], v[1]], [v[2], 0, -v[0]], [-v[1], v[0], 0]]) / a
    return np.eye(3) + np.sin(a) * k + (1 - np.cos(a)) * k @ k


def degrees(a, b):
    return np.degrees(np.arccos(np.clip((np.trace(a.T @ b) - 1) / 2, -1, 1)))


def mat(r, t):
    m = np.eye(4)
    m[:3, :3], m[:3, 3] = r, t
    return m


def flat(x):
    return [float(v) for v in np.asarray(x).reshape(-1)]


def test_metric_report_equals_numpy(spark):
    camera, k = mat(turn(np.array([0.3, -0.2, 2.0])), [0.1, 0.2, -2.0]), np.array([[500, 0, 320], [0, 510, 240], [0, 0, 1.0]])
    rows, want = [], {n: [] for n in ("metric_position", "metric_orientation", "true_translation", "true_rotation_deg", "pixel_error")}
    for i in range(60):
        a = RNG.normal(0, 0.8, 6)
        b = a + RNG.normal(0, 0.05, 6)
        reachable = i % 4 != 0
        bad = i % 9 == 5
        rows.append(("c", "left", i, flat(a), None if bad else flat(b), 0.01 * i, float("nan") if i == 7 else 0.02 * i, reachable, flat(k), flat(camera)))
        if not reachable or bad:
            continue
        want["metric_position"].append(0.01 * i)
        if i != 7:
            want["metric_orientation"].append(0.02 * i)
        want["true_translation"].append(np.linalg.norm(a[:3] - b[:3]))
        want["true_rotation_deg"].append(degrees(turn(a[3:]), turn(b[3:])))
        seen = [(np.linalg.inv(camera) @ np.r_[p[:3], 1])[:3] for p in (a, b)]
        if min(p[2] for p in seen) > 1e-6:
            u, v = ((k @ (p / p[2]))[:2] for p in seen)
            want["pixel_error"].append(np.linalg.norm(u - v))
    rows[5] = (*rows[5][:9], flat(np.eye(4)))  # only the first frame's camera counts
    schema = (
        "sample_id string, side string, frame_index int, pose array<double>, reached array<double>, position_error double, "
        "orientation_error double, reachable boolean, intrinsics array<double>, camera_extrinsics array<double>"
    )
    df = spark.createDataFrame(rows, schema)
    assert 5 < len(want["pixel_error"])
    for r in audit.metric_report(df).collect():
        v = np.array(want[r.stat])
        assert r.n == len(v)
        np.testing.assert_allclose([r["mean"], r.p95, r["max"]], [v.mean(), np.percentile(v, 95), v.max()], rtol=1e-9, err_msg=r.stat)
    hint = audit.swap_hint(df).first()
    assert hint.used_frames == len(want["true_translation"]) and not hint.likely_swapped
    none = audit.metric_report(df.where("not reachable")).collect()
    assert none == []


def test_exchanged_components_are_noticed(spark):
    rows = []
    for i in range(20):
        a = RNG.normal(0, 0.5, 6)
        b = a + RNG.normal(0, 0.2, 6)
        t, r = float(np.linalg.norm(a[:3] - b[:3])), float(np.radians(degrees(turn(a[3:]), turn(b[3:]))))
        rows.append(("c", "left", i, flat(a), flat(b), r, t, True, flat(np.eye(3)), flat(np.eye(4))))
    schema = (
        "sample_id string, side string, frame_index int, pose array<double>, reached array<double>, position_error double, "
        "orientation_error double, reachable boolean, intrinsics array<double>, camera_extrinsics array<double>"
    )
    assert audit.swap_hint(spark.createDataFrame(rows, schema)).first().likely_swapped


def test_storage_report_of_equal_tables_is_zero(spark):
    ids, poses = [("c", i) for i in range(12)], RNG.normal(0, 0.6, (12, 2, 6))
    stored = [(*k, flat(np.eye(4)), flat(p[0]), None if k[1] == 3 else flat(p[1])) for k, p in zip(ids, poses)]
    world = [[mat(turn(p[s][3:]), p[s][:3] + np.array(audit.BASES[n])) for s, n in enumerate(audit.SIDES)] for p in poses]
    again = [(*k, flat(p[0]), flat(p[1]), flat(w[0]), flat(w[1])) for k, p, w in zip(ids[:9], poses, world)]
    head = "sample_id string, frame_index int, "
    a = spark.createDataFrame(stored, head + "camera_extrinsics array<double>, left_pose array<double>, right_pose array<double>")
    b = spark.createDataFrame(again, head + "left_pose array<double>, right_pose array<double>, left_world array<double>, right_world array<double>")
    got = {(r.side, r.stat): r for r in audit.storage_report(a, b).collect()}
    assert len(got) == 8
    for (side, stat), r in got.items():
        assert r.n == (9 if side == "left" else 8)
        assert r["max"] < (1e-12 if "translation" in stat else 1e-5)
    over_all = audit.storage_report(a, b, by=()).collect()
    assert len(over_all) == 8 and {r.n for r in over_all} == {8, 9}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_statistics_of_several_values_are_those_of_each(spark, by):
    df = spark.range(3000).select((F.col("id") % 3).alias("g"), (F.col("id") * 1.0).alias("a"), F.when(F.col("id") % 3 != 1, F.sqrt("id")).alias("b"))
    got = {(*[r[c] for c in by], r.stat): (r.n, r["mean"], r.p95, r["max"]) for r in quality.stats_of(df, {"a": F.col("a"), "b": F.col("b")}, by).collect()}
    for name in ("a", "b"):
        for r in quality.safe_stats(df, name, by).collect():
            n, *values = got[(*[r[c] for c in by], name)]
            assert n == r.n
            for x, y in zip(values, (r["mean"], r.p95, r["max"])):
                assert (x is None and y is None) or abs(x - y) < 1e-9
    assert len(got) == 2 * (3 if by else 1)


def test_rows_without_a_group_keep_their_facts(spark):
    df = spark.createDataFrame([(None, 0, 1.0), (None, 1, 5.0), ("a", 4, 2.0), ("a", 2, 3.0)], "sample_id string, frame_index int, v double")
    got = {(r.sample_id, r.frame_index): r.first_v for r in quality.with_first(df, ["v"]).collect()}
    assert got == {(None, 0): 1.0, (None, 1): 1.0, ("a", 4): 3.0, ("a", 2): 3.0}
