"""Recurrences against plain loops, and long clips against short ones."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajloom.operators import arm, recurrence, series, smoothing, transfers


RNG = np.random.default_rng(5)


def frame(spark, clips: dict, col="v", kind="array<double>"):
    rows = []
    for cid, values in clips.items():
        for i, v in enumerate(values):
            if isinstance(v, np.ndarray):
                v = None if np.isnan(v).any() else [float(x) for x in v]
            rows.append((cid, i, v))
    return spark.createDataFrame(rows, f"sample_id string, frame_index int, {col} {kind}")


def collect(df, col):
    out: dict = {}
    for r in df.orderBy("sample_id", "frame_index").collect():
        out.setdefault(r["sample_id"], []).append(r[col])
    return out


def dense(values, dim):
    return np.array([[np.nan] * dim if v is None else v for v in values], dtype=float)


# ---------------------------------------------------------------- loop versions


def equivalents(v, ref, wraps):
    angle = np.linalg.norm(v)
    if angle < 1e-10:
        cands = [np.zeros(3)]
    else:
        cands = [v / angle * (angle + 2 * np.pi * k) for k in range(-wraps - 1, wraps + 1)]
    best = v
    for c in cands:
        if np.linalg.norm(c - ref) < np.linalg.norm(best - ref):
            best = c
    return best


def loop_unwrap(vs, wraps=2):
    out, last = [], None
    for v in vs:
        if np.isfinite(v).all():
            v = v if last is None else equivalents(v, last, wraps)
            last = v
        out.append(v)
    return np.array(out)


def loop_pose(obs, cfg, fps):
    """The full 12-state filter with dense matrices and physical padding."""
    good = np.isfinite(obs).all(axis=1)
    if not good.any():
        return obs
    n, pad = len(obs), cfg.edge_pad if len(obs) > 1 else 0
    first, last = obs[good][0], obs[good][-1]
    z = np.concatenate([np.tile(first, (pad, 1)), obs, np.tile(last, (pad, 1))])
    z[:, 3:] = loop_unwrap(np.where(np.isfinite(z).all(axis=1)[:, None], z, np.nan)[:, 3:])
    ok = np.isfinite(z).all(axis=1)
    dt = 1.0 / fps
    f = np.eye(12)
    f[:6, 6:] = dt * np.eye(6)
    h = np.eye(6, 12)
    q = np.zeros((12, 12))
    for i, g in enumerate([cfg.q_pos] * 3 + [cfg.q_rot] * 3):
        q[i, i], q[i, i + 6], q[i + 6, i], q[i + 6, i + 6] = g * dt**4 / 4, g * dt**3 / 2, g * dt**3 / 2, g * dt**2
    r0 = np.diag([cfg.r_pos] * 3 + [cfg.r_rot] * 3)
    x, p = np.zeros(12), np.diag([0.01] * 6 + [1.0] * 6)
    at = np.flatnonzero(ok)
    x[:6] = z[at[0]]
    if at[0] == 0 and len(at) > 1:
        x[6:] = (z[at[1]] - z[at[0]]) / max(at[1] * dt, 1e-8)
    xs, ps, xp, pp = [], [], [], []
    for t in range(len(z)):
        x, p = f @ x, f @ p @ f.T + q
        xp.append(x), pp.append(p)
        if ok[t]:
            m = z[t].copy()
            m[3:] = equivalents(m[3:], x[3:6], cfg.wraps)
            d = m - x[:6]
            far_p = cfg.gate_pos is not None and np.linalg.norm(d[:3]) > cfg.gate_pos
            far_r = cfg.gate_rot is not None and np.linalg.norm(d[3:]) > cfg.gate_rot
            if not (far_p and far_r):
                r = r0.copy()
                r[:3, :3] *= cfg.outlier_scale if far_p else 1
                r[3:, 3:] *= cfg.outlier_scale if far_r else 1
                k = p @ h.T @ np.linalg.inv(h @ p @ h.T + r)
                x = x + k @ d
                c = np.eye(12) - k @ h
                p = c @ p @ c.T + k @ r @ k.T
        xs.append(x), ps.append(p)
    s = xs[-1]
    out = [s]
    for t in range(len(z) - 2, -1, -1):
        g = ps[t] @ f.T @ np.linalg.pinv(pp[t + 1])
        s = xs[t] + g @ (s - xp[t + 1])
        out.append(s)
    out = np.array(out[::-1])[pad : pad + n, :6]
    out[:, 3:] = smoothing.canonical_rotvec(out[:, 3:])
    return out


def loop_joint(obs, cfg):
    n, d = obs.shape
    f = np.eye(2 * d)
    f[:d, d:] = cfg.dt * np.eye(d)
    h = np.eye(d, 2 * d)
    q = np.diag([cfg.q_pos] * d + [cfg.q_vel] * d)
    x = np.concatenate([obs[0], (obs[1] - obs[0]) / cfg.dt if n > 1 else np.zeros(d)])
    p = np.diag([cfg.p_pos] * d + [cfg.p_vel] * d)
    xs, ps, xp, pp = [], [], [], []
    for t in range(n):
        x, p = f @ x, f @ p @ f.T + q
        xp.append(x), pp.append(p)
        k = p @ h.T @ np.linalg.inv(h @ p @ h.T + cfg.r * np.eye(d))
        x = x + k @ (obs[t] - x[:d])
        c = np.eye(2 * d) - k @ h
        p = c @ p @ c.T + cfg.r * k @ k.T
        xs.append(x), ps.append(p)
    s, out = xs[-1], [xs[-1]]
    for t in range(n - 2, -1, -1):
        g = ps[t] @ f.T @ np.linalg.inv(pp[t + 1])
        s = xs[t] + g @ (s - xp[t + 1])
        out.append(s)
    return np.array(out[::-1])[:, :d]


def poses(n, gaps=0.2, jump=0.0):
    walk = np.cumsum(RNG.normal(0, 0.02, (n, 6)), axis=0)
    walk[:, 3:] *= 8
    walk[:, 3:] = smoothing.canonical_rotvec(walk[:, 3:])
    walk[RNG.random(n) < gaps] = np.nan
    far = RNG.random(n) < jump
    walk[far, 3:] += 2.0
    return walk


# ---------------------------------------------------------------- short clips


@pytest.mark.parametrize(
    "cfg",
    [
        smoothing.PoseFilter(),
        smoothing.PoseFilter(edge_pad=0, gate_rot=None),
        smoothing.PoseFilter(edge_pad=3, gate_pos=0.05, gate_rot=0.4),
    ],
)
def test_pose_smoother_equals_dense_filter(spark, cfg):
    clips = {"a": poses(40), "b": poses(7), "c": poses(60, jump=0.1), "one": poses(1, 0.0), "none": np.full((5, 6), np.nan)}
    clips["lead"] = poses(20, 0.0)
    clips["lead"][:6] = np.nan
    clips["lead"][-4:] = np.nan
    got = collect(smoothing.smooth_pose(frame(spark, clips), "v", cfg, out="s"), "s")
    for cid, obs in clips.items():
        want = loop_pose(obs, cfg, 30.0)
        np.testing.assert_allclose(dense(got[cid], 6), want, atol=1e-8, err_msg=cid)


def test_pose_smoother_uses_each_clips_rate(spark):
    clips = {"a": poses(30), "b": poses(30)}
    df = frame(spark, clips).withColumn("fps", F.when(F.col("sample_id") == "a", 30.0).otherwise(12.0))
    got = collect(smoothing.smooth_pose(df, "v", out="s", fps="fps"), "s")
    for cid, fps in (("a", 30.0), ("b", 12.0)):
        np.testing.assert_allclose(dense(got[cid], 6), loop_pose(clips[cid], smoothing.PoseFilter(), fps), atol=1e-8)


def test_joint_smoother_equals_dense_filter(spark):
    clips = {"a": np.cumsum(RNG.normal(0, 0.1, (50, 6)), 0), "b": RNG.normal(0, 1, (1, 6)), "c": RNG.normal(0, 1, (9, 6))}
    got = collect(smoothing.smooth_joints(frame(spark, clips), "v", [-9.0] * 6, [9.0] * 6, out="s"), "s")
    for cid, obs in clips.items():
        np.testing.assert_allclose(dense(got[cid], 6), loop_joint(obs, smoothing.JointFilter()), atol=1e-9)


def test_smoothing_a_constant_returns_it(spark):
    clips = {"a": np.tile([0.1, 0.2, 0.3, 0.4, 0.5, 0.6], (20, 1))}
    s = collect(smoothing.smooth_pose(frame(spark, clips), "v", out="s"), "s")["a"]
    np.testing.assert_allclose(dense(s, 6), clips["a"], atol=1e-12)


def test_unwrap(spark):
    spin = np.outer(np.linspace(0.1, 9.0, 40), [0.0, 0.6, 0.8])
    clips = {"a": smoothing.canonical_rotvec(spin)}
    clips["a"][5] = np.nan
    got = dense(collect(smoothing.unwrap_rotvec(frame(spark, clips), "v", out="u"), "u")["a"], 3)
    np.testing.assert_allclose(got, loop_unwrap(clips["a"]), atol=1e-12)
    assert np.nanmax(np.abs(np.diff(got, axis=0))) < 0.6  # no jumps left


# ---------------------------------------------------------------- long clips: blocks must not show


def long_clips():
    return {"hot": poses(110), "s": poses(5), "gap": np.vstack([poses(8, 0.0), np.full((70, 6), np.nan), poses(12, 0.0)])}


def test_pose_smoother_blocks(spark):
    cfg = smoothing.PoseFilter(edge_pad=5)
    df = frame(spark, long_clips())
    whole = collect(smoothing.smooth_pose(df, "v", cfg, out="s", continuous=True), "s")
    parts = collect(smoothing.smooth_pose(df, "v", cfg, out="s", continuous=True, block=40), "s")
    for cid in whole:
        np.testing.assert_allclose(dense(parts[cid], 6), dense(whole[cid], 6), atol=1e-9, err_msg=cid)


def test_other_recurrences_blocks(spark):
    df = frame(spark, {"hot": np.cumsum(RNG.normal(0, 0.1, (90, 2)), 0), "s": RNG.normal(0, 1, (3, 2))})
    one = df.withColumn("x", F.abs(F.col("v")[0]))
    runs = {
        "joint": lambda b: collect(smoothing.smooth_joints(df, "v", [-9.0] * 2, [9.0] * 2, out="o", block=b), "o"),
        "ema": lambda b: collect(smoothing.ema_bidir(one, "x", 0.05, 1, out="o", block=b), "o"),
        "grip": lambda b: collect(
            smoothing.smooth_gripper(one.withColumn("x", F.when(F.col("frame_index") % 50 < 4, F.col("x"))), "x", out="o", block=b), "o"
        ),
        "rate": lambda b: collect(smoothing.rate_limit(df, "v", 2, 0.03, out="o", block=b), "o"),
        "unwrap": lambda b: collect(
            smoothing.unwrap_rotvec(
                df.withColumn("r", F.array(F.col("v")[0] * 9, F.col("v")[1] * 9, F.lit(1.0))), "r", out="o", block=b
            ), "o",
        ),
    }
    for name, run in runs.items():
        whole, parts = run(4096), run(40)
        for cid in whole:
            np.testing.assert_allclose(np.array(parts[cid]), np.array(whole[cid]), atol=1e-10, err_msg=name)


def test_series_blocks(spark):
    n = 90
    vals = [None if RNG.random() < 0.5 else float(RNG.random()) for _ in range(n)]
    gap = [None] * 20 + [0.5, 0.7] + [None] * 30
    df = frame(spark, {"hot": vals, "gap": gap, "none": [None] * 25, "one": [0.3]}, kind="double")
    df = df.withColumn("ok", F.col("v").isNotNull())
    for name, run in {
        "interp": lambda b: series.interp_gaps(df, "v", "ok", out="o", block=b),
        "ffill": lambda b: series.ffill_signal(df, "v", out="o", block=b),
        "near": lambda b: series.nearest_flagged(df, "ok", out="o", block=b),
        "median": lambda b: series.moving_median(df.withColumn("w", F.coalesce("v", F.lit(0.25))), "w", 5, out="o", block=b),
        "delta": lambda b: series.frame_delta(df.withColumn("w", F.array("v", "frame_index")), "w", out="o", block=b),
    }.items():
        assert collect(run(7), "o") == collect(run(4096), "o"), name


def test_moving_median_against_numpy(spark):
    x = RNG.random(31)
    df = frame(spark, {"a": list(map(float, x)), "two": [0.9, 0.1]}, kind="double")
    for size, odd in ((3, 3), (4, 5), (9, 9)):
        got = collect(series.moving_median(df, "v", size, out="o", block=8), "o")
        for cid, v in (("a", x), ("two", np.array([0.9, 0.1]))):
            p = np.pad(v, odd // 2, mode="edge")
            np.testing.assert_allclose(got[cid], [np.median(p[i : i + odd]) for i in range(len(v))])


def test_gap_fill_edges(spark):
    df = frame(spark, {"a": [None, 0.2, None, None, 0.8, None], "none": [None, None]}, kind="double")
    got = collect(series.interp_gaps(df.withColumn("ok", F.col("v").isNotNull()), "v", "ok", out="o"), "o")
    np.testing.assert_allclose(got["a"], [0.2, 0.2, 0.4, 0.6, 0.8, 0.8])
    assert got["none"] == [0.0, 0.0]


def test_gripper_smoothing_single_frame_and_disabled(spark):
    df = frame(spark, {"one": [1.7], "nan": [None], "two": [float("inf"), -3.0]}, kind="double")
    got = collect(smoothing.smooth_gripper(df, "v", out="o"), "o")
    assert got["one"] == [1.0] and got["nan"] == [0.0]
    off = collect(smoothing.smooth_gripper(df, "v", smoothing.GripperFilter(enabled=False), out="o"), "o")
    assert off["two"] == [1.0, 0.0]


def test_continuity_special_cases(spark):
    df = frame(spark, {"one": [np.zeros(2)], "a": [np.zeros(2), np.array([0.1, -0.3]), np.array([0.1, -0.3])]})
    got = {r["sample_id"]: (r["max_abs_delta"], r["mean_abs_delta"]) for r in series.continuity(df, "v").collect()}
    assert got["one"] == (0.0, 0.0)
    np.testing.assert_allclose(got["a"], (0.3, 0.1))


# ---------------------------------------------------------------- arms

CHAIN = arm.Chain.of(arm.ARM_JOINTS)


def reachable_poses(n):
    q = np.cumsum(RNG.normal(0, 0.04, (n, 6)), axis=0) + 0.2
    r, p = CHAIN.forward(q)
    return np.concatenate([p, arm.matrix_rotvec(r)], axis=1)


def test_rotations():
    v = RNG.normal(0, 1, (50, 3))
    v[0], v[1] = 0.0, [np.pi, 0, 0]
    v = smoothing.canonical_rotvec(v)
    r = arm.rotvec_matrix(v)
    np.testing.assert_allclose(r @ r.transpose(0, 2, 1), np.tile(np.eye(3), (50, 1, 1)), atol=1e-12)
    np.testing.assert_allclose(np.linalg.det(r), 1.0)
    np.testing.assert_allclose(arm.matrix_rotvec(r), v, atol=1e-9)


def test_se3_log_undoes_the_exponential():
    w, v = RNG.normal(0, 1, (20, 3)), RNG.normal(0, 1, (20, 3))
    w = smoothing.canonical_rotvec(w)
    w[0] = 1e-6
    k = np.zeros((20, 3, 3))
    k[:, 0, 1], k[:, 0, 2], k[:, 1, 2] = -w[:, 2], w[:, 1], -w[:, 0]
    k -= k.transpose(0, 2, 1)
    big = np.zeros((20, 4, 4))
    big[:, :3, :3], big[:, :3, 3] = k, v
    total, term = np.tile(np.eye(4), (20, 1, 1)), np.tile(np.eye(4), (20, 1, 1))
    for i in range(1, 40):
        term = term @ big / i
        total = total + term
    np.testing.assert_allclose(arm.se3_log(total[:, :3, :3], total[:, :3, 3]), np.concatenate([v, w], 1), atol=1e-9)


def test_jacobian_is_the_derivative():
    q = RNG.normal(0, 0.5, (4, 6))
    r, p, jac = CHAIN.forward(q, jacobian=True)
    h = 1e-6
    for i in range(6):
        d = q.copy()
        d[:, i] += h
        r2, p2 = CHAIN.forward(d)
        back = r.transpose(0, 2, 1)
        step = arm.se3_log(back @ r2, np.einsum("nij,nj->ni", back, p2 - p)) / h
        np.testing.assert_allclose(step, jac[:, :, i], atol=1e-5)


def test_ik_reaches_reachable_poses(spark):
    clips = {"a": reachable_poses(25), "b": reachable_poses(12)}
    clips["a"][4] = np.nan
    cfg = arm.Solver(smooth=False)
    df = arm.solve_ik(frame(spark, clips, "pose"), CHAIN, cfg=cfg, initial=[0.2] * 6)
    rows = df.orderBy("sample_id", "frame_index").collect()
    assert all(r["reachable"] for r in rows if r["pose"] is not None)
    gap = [r for r in rows if r["pose"] is None][0]
    assert not gap["reachable"] and gap["position_error"] is None and gap["joint_position"] is not None
    # the reported errors are those of the joints
    again = arm.fk_errors(df.drop("position_error", "orientation_error", "reachable"), CHAIN, "pose", "joint_position")
    for x, y in zip(rows, again.orderBy("sample_id", "frame_index").collect()):
        assert x["reachable"] == y["reachable"]
        if x["position_error"] is not None:
            assert abs(x["position_error"] - y["position_error"]) < 1e-9


def test_ik_far_target_is_unreachable(spark):
    clips = {"a": np.tile([9.0, 9.0, 9.0, 0.0, 0.0, 0.0], (4, 1))}
    rows = arm.solve_ik(frame(spark, clips, "pose"), CHAIN).collect()
    assert not any(r["reachable"] for r in rows)
    assert all(abs(v) <= arm.LIMIT for r in rows for v in r["joint_position"])


def test_ik_blocks(spark):
    far = reachable_poses(24)
    far[8:12, :3] += 3.0
    clips = {"hot": far, "s": reachable_poses(5)}
    df = frame(spark, clips, "pose")
    whole = collect(arm.solve_ik(df, CHAIN), "joint_position")
    parts = collect(arm.solve_ik(df, CHAIN, block=12), "joint_position")
    for cid in whole:
        np.testing.assert_allclose(np.array(parts[cid]), np.array(whole[cid]), atol=1e-8)


def test_retry_takes_the_nearest_reachable_seed():
    """Unreachable frames restart from the nearest reachable frame; newly reachable ones join the pool."""
    cfg = arm.Solver(max_frame_delta=0.05)
    q = np.concatenate([np.full((3, 1, 6), 0.2), np.full((3, 1, 6), 0.5)])
    r, p = CHAIN.forward(q.reshape(-1, 6))
    pose = np.concatenate([p, arm.matrix_rotvec(r)], axis=1).reshape(6, 1, 6)
    active = np.ones(6, int)
    x = {"pose": pose, "frame_index": np.arange(6.0).reshape(6, 1, 1)}
    made, _ = arm.track_kernel(CHAIN, cfg, "pose", [0.2] * 6).step(x, {}, active, np.full((1, 6), np.nan))
    x.update(made)
    before = arm._reached(cfg, x["_e"][..., 0], x["_e"][..., 1]).sum()
    x.update(arm.next_reached_kernel(cfg, 6).step(x, {}, active, np.full((1, 7), np.nan))[0])
    out, _ = arm.retry_kernel(CHAIN, cfg, "pose").step(x, {}, active, np.full((1, 7), np.nan))
    after = arm._reached(cfg, out["_e2"][..., 0], out["_e2"][..., 1]).sum()
    assert after > before


def loop_solve(cfg, pose, seed, prev):
    """Damped least squares for one target, written out."""
    rt, pt = arm.rotvec_matrix(pose[None, 3:]), pose[None, :3]
    weight = np.repeat([cfg.position_weight, cfg.orientation_weight], 3)

    def measure(q):
        e = CHAIN.error(q[None], rt, pt)[0]
        return e, np.linalg.norm(e[:3]), np.linalg.norm(e[3:]), (weight * e * e).sum() + cfg.continuity_weight * ((q - prev) ** 2).sum()

    q, best = seed.copy(), seed.copy()
    e, pe, oe, cost = measure(q)
    best_cost, early = cost, cfg.early()
    for _ in range(cfg.max_iterations):
        if pe <= early[0] and oe <= early[1]:
            break
        jac = CHAIN.forward(q[None], jacobian=True)[2][0]
        h = jac.T @ (weight[:, None] * jac) + (cfg.damping + cfg.continuity_weight) * np.eye(6)
        step = np.linalg.solve(h, jac.T @ (weight * e) + cfg.continuity_weight * (prev - q))
        step = np.clip(step, -cfg.max_joint_step, cfg.max_joint_step)
        to, least = None, cost
        for k in arm.TRIALS:
            trial = CHAIN.clip(q + k * step)
            c = measure(trial)[3]
            if c + 1e-12 < least:
                to, least = trial, c
        if to is None:
            break
        moved = (np.abs(to - q) > 1e-10).any()
        q = to
        e, pe, oe, cost = measure(q)
        if cost + 1e-12 < best_cost:
            best, best_cost = q.copy(), cost
        if not moved:
            break
    return best


def test_solver_equals_the_loop():
    """Reachable targets, far ones and joints at their limits, as lanes of several targets each."""
    cfg = arm.Solver(max_iterations=40)
    poses = np.stack([reachable_poses(3) for _ in range(12)], axis=1)
    poses[1, :4, :3] += 0.3
    poses[2, 4:8, 3:] = RNG.normal(0, 2, (4, 3))
    seeds = np.clip(RNG.normal(0, 1.5, (3, 12, 6)), -arm.LIMIT, arm.LIMIT)
    at, got = np.zeros(12, int), np.zeros((3, 12, 6))

    def ask(idle):
        new = idle[at[idle] < 3]
        seed = seeds[at[new], new].T
        return new, arm.target_of(poses[at[new], new]), seed, seed

    def tell(done, q, pe, oe):
        got[at[done], done] = q.T
        at[done] += 1

    arm.search(CHAIN, cfg, 12, ask, tell)
    want = np.array([[loop_solve(cfg, poses[t, i], seeds[t, i], seeds[t, i]) for i in range(12)] for t in range(3)])
    np.testing.assert_allclose(got, want, atol=1e-5)


def test_lanes_do_not_wait_for_each_other(monkeypatch):
    """Slow frames at different times cost the rounds of one lane, not of all; results are those of lanes alone."""
    counts, search = [], arm.search
    monkeypatch.setattr(arm, "search", lambda *a: counts.append(search(*a)))
    cfg, n = arm.Solver(), 10
    poses = np.stack([reachable_poses(n) for _ in range(n)], axis=1)
    poses[np.arange(n), np.arange(n), :3] += 2.0

    def solve(x):
        x, active = {"pose": x, "frame_index": np.arange(float(n))[:, None, None].repeat(x.shape[1], 1)}, np.full(n, x.shape[1])
        for k in (arm.track_kernel(CHAIN, cfg, "pose", [0.2] * 6), arm.next_reached_kernel(cfg, 6), arm.retry_kernel(CHAIN, cfg, "pose")):
            x.update(k.step(x, {}, active, np.full((x["pose"].shape[1], k.state), np.nan))[0])
        return x["_q2"]

    alone = [solve(poses[:, [i]]) for i in range(n)]
    each = np.array(counts).reshape(n, 2)
    counts.clear()
    whole = solve(poses)
    assert (np.array(counts) <= each.max(axis=0) + n).all() and counts[0] < each[:, 0].sum() / 3
    np.testing.assert_allclose(whole, np.concatenate(alone, axis=1), atol=1e-5)


# ---------------------------------------------------------------- transfers


def clamp(y, targets, limit):
    for x in targets:
        y = y + min(max(x - y, -limit), limit)
    return y


@pytest.mark.parametrize("seed", range(12))
def test_clamp_map_is_the_composition(seed):
    rng = np.random.default_rng(seed)
    targets = np.cumsum(rng.normal(0, (0.2, 2.0)[seed % 2], rng.integers(1, 80))) * rng.choice([0.1, 1.0])
    limit = float(rng.choice([0.05, 0.5, 3.0]))
    knots, values = transfers.clamp_map(targets, limit)
    assert (np.diff(knots) >= -1e-12).all() and (np.diff(values) >= -1e-12).all()
    spread = np.concatenate([rng.uniform(-9, 9, 60), knots, targets])
    got = [transfers.clamp_value(knots, values, y) for y in spread]
    np.testing.assert_allclose(got, [clamp(y, targets, limit) for y in spread], atol=1e-9)


def test_joint_covariance_is_that_of_the_steps():
    cfg = smoothing.JointFilter()
    now, path = tuple(np.array([v]) for v in (cfg.p_pos, 0.0, cfg.p_vel)), []
    for _ in range(900):
        path.append([float(v[0]) for v in now])
        now = smoothing._correct(*smoothing._predict(*now, 1.0, (cfg.q_pos, 0.0, cfg.q_vel)), cfg.r, gain_limit=1e3)[2]
    at = np.array([0, 3, 40, 899])
    np.testing.assert_allclose(smoothing.joint_covariance(at, cfg), np.array(path)[at], rtol=1e-12)
    far = smoothing.joint_covariance(np.array([10**9]), cfg)
    np.testing.assert_allclose(far[0], path[-1], rtol=1e-9)


def test_rounds():
    """What does not depend on each other settles in one round; guesses take two."""
    pose, _ = smoothing.pose_kernels("p", smoothing.PoseFilter(), continuous=True)
    grip, _ = smoothing.gripper_kernels("g", "ok", smoothing.GripperFilter())
    settles, _ = recurrence._levels(pose + grip)
    assert settles[: len(pose)] == [1, 1, 3, 4, 5] and max(settles[len(pose) :]) == 4


def jobs(spark, run):
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        df = run()
        return df, len(spark.sparkContext.statusTracker().getJobIdsForGroup("planning"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_planning_starts_no_job_and_runs_the_source_once(spark):
    df = frame(spark, long_clips())
    smooth, n = jobs(spark, lambda: smoothing.smooth_pose(df, "v", smoothing.PoseFilter(edge_pad=5), out="s", block=40))
    assert n == 0
    smooth.collect()
    plan = smooth._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("Scan ExistingRDD") <= 3  # the shuffle of the frames and the guard
    assert "Reused" in final


@pytest.mark.parametrize("jump", [0.0, 0.15])
def test_short_clips_stay_bit_equal_beside_a_long_one(spark, jump):
    cfg = smoothing.PoseFilter(edge_pad=4, gate_pos=0.05, gate_rot=0.4)
    short = {"a": poses(30, jump=jump), "b": poses(11)}
    hot = np.vstack([np.full((95, 6), np.nan), poses(300, jump=jump), np.full((90, 6), np.nan), poses(20)])
    alone = collect(smoothing.smooth_pose(frame(spark, short), "v", cfg, out="s"), "s")
    beside = collect(smoothing.smooth_pose(frame(spark, short | {"hot": hot}), "v", cfg, out="s", block=40), "s")
    for cid in short:
        assert alone[cid] == beside[cid]
    np.testing.assert_allclose(dense(beside["hot"], 6), loop_pose(hot, cfg, 30.0), atol=1e-8)


def test_long_unwrapping_and_limits_equal_plain_loops(spark):
    spin = np.outer(np.cumsum(RNG.normal(0.1, 0.4, 420)), [0.0, 0.6, 0.8]) + RNG.normal(0, 0.01, (420, 3))
    clips = {"a": smoothing.canonical_rotvec(spin)}
    clips["a"][40:125] = np.nan
    df = frame(spark, clips)
    got = dense(collect(smoothing.unwrap_rotvec(df, "v", out="u", block=40), "u")["a"], 3)
    assert np.array_equal(got, loop_unwrap(clips["a"]), equal_nan=True) or np.nanmax(np.abs(got - loop_unwrap(clips["a"]))) < 1e-11
    slow = dense(collect(smoothing.rate_limit(df, "v", 3, 0.02, out="o", block=40), "o")["a"], 3)
    prev, want = None, []
    for v in clips["a"]:
        prev = v if prev is None else np.where(np.isnan(v), prev, prev + np.clip(v - prev, -0.02, 0.02))
        want.append(prev)
    np.testing.assert_allclose(slow, want, atol=1e-10)


def test_rows_without_a_clip_id_are_a_clip(spark):
    df = frame(spark, {None: np.cumsum(RNG.normal(0, 0.1, (90, 2)), 0), "s": RNG.normal(0, 1, (3, 2))})
    run = lambda b: sorted(smoothing.smooth_joints(df, "v", [-9.0] * 2, [9.0] * 2, out="o", block=b).collect(), key=str)
    for x, y in zip(run(40), run(4096), strict=True):
        np.testing.assert_allclose(x.o, y.o, atol=1e-10)
