"""Smoothers built on the block recurrences: EMA, rate limit, rotation unwrapping, Kalman."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import clean_signal, clip_bounds, is_finite
from .blocks import KEYS
from .recurrence import FRAMES, Kernel, Packed, pack, recur, scan, unpack
from .transfers import Affine, Choices, Clamps, FirstTwo, Latest, first_two, per_axis

TWO_PI = 2.0 * np.pi


# ---------------------------------------------------------------- EMA, rate limit


def ema_kernel(src: str, out: str, alpha: float, reverse: bool) -> Kernel:
    alpha = float(np.clip(alpha, 1e-3, 1.0))
    decay = 1.0 - alpha

    def step(x, _, active, state):
        values = x[src]
        y = np.full_like(values, np.nan)
        cur = state.copy()
        times = range(len(active) - 1, -1, -1) if reverse else range(len(active))
        for t in times:
            m = active[t]
            v = values[t, :m]
            prev = cur[:m]
            cur[:m] = np.where(np.isnan(prev), v, alpha * v + decay * prev)
            y[t, :m] = cur[:m]
        return {out: y}, cur

    return Kernel(step, {out: 1}, 1, reverse, Affine(1, [[0]]), (src,))


def ema_bidir(
    df: DataFrame,
    col: str,
    alpha: float = 0.35,
    passes: int = 1,
    out: str | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Forward then backward exponential average, seeded with the first value, ``passes`` times."""
    kernels: list[Kernel] = []
    src = col
    for i in range(max(1, int(passes))):
        kernels += [ema_kernel(src, f"_f{i}", alpha, False), ema_kernel(f"_f{i}", f"_b{i}", alpha, True)]
        src = f"_b{i}"
    return recur(df, {col: 1}, kernels, {src: 1}, {src: out or col}, keys, block)


def rate_limit(
    df: DataFrame,
    col: str,
    dim: int,
    limit: float,
    out: str | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Clip every frame's change to +-limit relative to the limited previous frame."""

    def step(x, _, active, state):
        values = x[col]
        y = np.full_like(values, np.nan)
        cur = state.copy()
        for t in range(len(active)):
            m = active[t]
            v, prev = values[t, :m], cur[:m]
            moved = prev + np.clip(v - prev, -limit, limit)
            cur[:m] = np.where(np.isnan(prev), v, np.where(np.isnan(v), prev, moved))
            y[t, :m] = cur[:m]
        return {"_limited": y}, cur

    kernel = Kernel(step, {"_limited": dim}, dim, transfer=Clamps(dim, limit, lambda x: x[col]))
    return recur(df, {col: dim}, [kernel], {"_limited": dim}, {"_limited": out or col}, keys, block)


@dataclass(frozen=True)
class GripperFilter:
    """Settings of the gripper smoothing chain."""

    enabled: bool = True
    hold_invalid: bool = True
    median_window: int = 3
    ema_alpha: float = 0.35
    ema_passes: int = 1


def fill_kernels(src: str, ok: str, out: str) -> list[Kernel]:
    """Linear interpolation over invalid frames: the last valid point forward, the next one backward."""

    def carry(x, active, state, times):
        pts = np.full((*x[src].shape[:2], 2), np.nan)
        cur = state.copy()
        for t in times:
            m = active[t]
            good = x[ok][t, :m, 0] > 0
            here = np.concatenate([x["frame_index"][t, :m], x[src][t, :m]], axis=1)
            cur[:m] = np.where(good[:, None], here, cur[:m])
            pts[t, :m] = cur[:m]
        return pts, cur

    def forward(x, _, active, state):
        pts, cur = carry(x, active, state, range(len(active)))
        return {"_prev": pts}, cur

    def backward(x, _, active, state):
        pts, cur = carry(x, active, state, range(len(active) - 1, -1, -1))
        a, b, f = x["_prev"], pts, x["frame_index"][:, :, 0]
        line = (b[..., 1] - a[..., 1]) / (b[..., 0] - a[..., 0]) * (f - a[..., 0]) + a[..., 1]
        y = np.where(np.isnan(a[..., 0]), b[..., 1], np.where(np.isnan(b[..., 0]), a[..., 1], line))
        y = np.where(x[ok][..., 0] > 0, x[src][..., 0], np.nan_to_num(y))
        return {out: y[..., None]}, cur

    return [
        Kernel(forward, {"_prev": 2}, 2, transfer=Latest(2), uses=(src, ok)),
        Kernel(backward, {out: 1}, 2, True, Latest(2), uses=(src, ok, "_prev"), reads=(src, ok)),
    ]


def median_kernels(src: str, out: str, size: int) -> list[Kernel]:
    """Centred moving median with replicated edges: the k values behind, then the k values ahead.

    A block holds more than k frames, so its own last (or first) k values are its state.
    """
    k = (size + 1 - size % 2) // 2

    def forward(x, _, active, state):
        v = x[src]
        behind = np.full((*v.shape[:2], k), np.nan)
        cur = state.copy()
        for t in range(len(active)):
            m = active[t]
            cur[:m] = np.where(np.isnan(cur[:m]).any(axis=1, keepdims=True), v[t, :m], cur[:m])
            behind[t, :m] = cur[:m]
            cur[:m] = np.concatenate([cur[:m, 1:], v[t, :m]], axis=1)
        return {"_behind": behind}, cur

    def backward(x, _, active, state):
        v, y = x[src], np.full_like(x[src], np.nan)
        cur = state.copy()
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            cur[:m] = np.where(np.isnan(cur[:m]).any(axis=1, keepdims=True), v[t, :m], cur[:m])
            y[t, :m, 0] = np.median(np.concatenate([x["_behind"][t, :m], v[t, :m], cur[:m]], axis=1), axis=1)
            cur[:m] = np.concatenate([cur[:m, 1:], v[t, :m]], axis=1)
        return {out: y}, cur

    return [
        Kernel(forward, {"_behind": k}, k, transfer=Latest(k), uses=(src,)),
        Kernel(backward, {out: 1}, k, True, Latest(k), uses=(src, "_behind"), reads=(src,)),
    ]


def gripper_kernels(src: str, ok: str, cfg: GripperFilter) -> tuple[list[Kernel], str]:
    """The whole gripper chain as recurrences, so that it takes one shuffle; returns the last output too."""
    kernels: list[Kernel] = []
    if cfg.hold_invalid:
        kernels += fill_kernels(src, ok, "_filled")
        src = "_filled"
    if cfg.median_window > 1:
        kernels += median_kernels(src, "_median", int(cfg.median_window))
        src = "_median"
    for i in range(max(1, int(cfg.ema_passes))):
        kernels += [ema_kernel(src, f"_ef{i}", cfg.ema_alpha, False), ema_kernel(f"_ef{i}", f"_eb{i}", cfg.ema_alpha, True)]
        src = f"_eb{i}"
    return kernels, src


def _unit_range(c: str) -> Column:
    return F.least(F.greatest(F.col(c), F.lit(0.0)), F.lit(1.0))


def smooth_gripper(
    df: DataFrame,
    col: str,
    cfg: GripperFilter = GripperFilter(),
    out: str | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Clean, fill gaps, median, two-way EMA, clip.

    A single frame passes the filters unchanged, as it must: it is only cleaned.
    """
    out = out or col
    marked = df.withColumns({"_ok": is_finite(F.col(col)).cast("double"), out: clean_signal(F.col(col))})
    if not cfg.enabled:
        return marked.drop("_ok")
    kernels, last = gripper_kernels(out, "_ok", cfg)
    inputs = {out: 1, "_ok": 1, "frame_index": 1}
    done = recur(marked, inputs, kernels, {last: 1}, {last: out}, keys, block)
    return done.drop("_ok").withColumn(out, _unit_range(out))


# ---------------------------------------------------------------- rotation vectors


def equivalents(v: np.ndarray, wraps: int) -> list[np.ndarray]:
    """Rotation vectors of the same rotations, the given ones first."""
    angle = np.linalg.norm(v, axis=1, keepdims=True)
    tiny = angle < 1e-10
    axis = np.divide(v, angle, out=np.zeros_like(v), where=~tiny)
    return [v.copy(), *[np.where(tiny, 0.0, axis * (angle + k * TWO_PI)) for k in range(-wraps - 1, wraps + 1)]]


def nearest_equivalent(v: np.ndarray, ref: np.ndarray, wraps: int) -> np.ndarray:
    """Rotation vector of the same rotation nearest to ``ref``, row by row.

    All equivalents lie on the axis line at ``angle + 2 pi k``; the flipped axis
    gives the same points with one further wrap at one end.
    """
    best, *others = equivalents(v, wraps)
    best_d = np.linalg.norm(v - ref, axis=1)
    for cand in others:
        d = np.linalg.norm(cand - ref, axis=1)
        better = d < best_d
        best[better] = cand[better]
        best_d = np.where(better, d, best_d)
    usable = np.isfinite(v).all(axis=1) & np.isfinite(ref).all(axis=1)
    return np.where(usable[:, None], best, v)


def unwrap_kernel(src: str, out: str, dim: int, wraps: int, at: int = 0) -> Kernel:
    """Carry the last valid vector; ``at`` is where the rotation starts in ``src``."""

    def step(x, _, active, state):
        values = x[src]
        y = values.copy()
        cur = state.copy()
        for t in range(len(active)):
            m = active[t]
            v = values[t, :m, at : at + 3]
            good = np.isfinite(values[t, :m]).all(axis=1)
            seen = np.isfinite(cur[:m]).all(axis=1)
            pick = np.where((good & seen)[:, None], nearest_equivalent(v, cur[:m], wraps), v)
            y[t, :m, at : at + 3] = pick
            cur[:m] = np.where(good[:, None], pick, cur[:m])
        return {out: y}, cur

    def vectors(x):
        return x[src][..., at : at + 3], np.isfinite(x[src]).all(axis=2)

    table = Choices(vectors, lambda v: np.stack(equivalents(v, wraps), axis=1))
    return Kernel(step, {out: dim}, 3, transfer=table, uses=(src,))


def unwrap_rotvec(
    df: DataFrame,
    col: str,
    dim: int = 3,
    at: int = 0,
    wraps: int = 2,
    out: str | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Make rotation vectors continuous along each clip.

    ``col`` may hold a whole pose of ``dim`` values with the rotation at ``at``.
    """
    kernel = unwrap_kernel(col, "_unwrapped", dim, wraps, at)
    return recur(df, {col: dim}, [kernel], {"_unwrapped": dim}, {"_unwrapped": out or col}, keys, block)


def canonical_rotvec(v: np.ndarray) -> np.ndarray:
    """Same rotation with an angle in [0, pi]."""
    angle = np.linalg.norm(v, axis=-1, keepdims=True)
    wrapped = np.mod(angle, TWO_PI)
    signed = np.where(wrapped > np.pi, wrapped - TWO_PI, wrapped)
    return np.divide(v, angle, out=np.zeros_like(v), where=angle > 1e-12) * signed


# ---------------------------------------------------------------- Kalman


def _stable(*parts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Covariance entries limited to +-1e6, as the model prescribes."""
    return tuple(np.clip(np.nan_to_num(p, nan=1e6, posinf=1e6, neginf=-1e6), -1e6, 1e6) for p in parts)


def _predict(a, b, c, dt, q):
    """Covariance [[a, b], [b, c]] of a constant-velocity axis, one step on."""
    return _stable(a + 2 * dt * b + dt * dt * c + q[0], b + dt * c + q[1], c + q[2])


def _correct(a, b, c, r, gain_limit=None):
    """Measure the first component with noise r: gains and the Joseph-form covariance."""
    s = a + r
    k1 = np.nan_to_num(a / s)
    k2 = np.nan_to_num(b / s)
    if gain_limit is not None:
        k1, k2 = np.clip(k1, -gain_limit, gain_limit), np.clip(k2, -gain_limit, gain_limit)
    u = 1.0 - k1
    na = u * u * a + k1 * k1 * r
    nb = u * (b - k2 * a) + k1 * k2 * r
    nc = c - 2 * k2 * b + k2 * k2 * a + k2 * k2 * r
    return k1, k2, _stable(na, nb, nc)


def _rts_gain(cov, pred, dt):
    """Backward gain of one axis: P F' inverse(P predicted), as four entries."""
    a, b, c = cov
    pa, pb, pc_ = pred
    det = pa * pc_ - pb * pb
    ok = np.abs(det) > 1e-300
    inv = np.where(ok, 1.0 / np.where(ok, det, 1.0), 0.0)
    m11, m12, m21, m22 = a + dt * b, b, b + dt * c, c
    return (
        (m11 * pc_ - m12 * pb) * inv,
        (m12 * pa - m11 * pb) * inv,
        (m21 * pc_ - m22 * pb) * inv,
        (m22 * pa - m21 * pb) * inv,
    )


@dataclass(frozen=True)
class PoseFilter:
    """Settings of the pose smoother."""

    fps: float = 30.0  # used where the frames carry no rate of their own
    edge_pad: int = 24
    q_pos: float = 120.0
    q_rot: float = 120.0
    r_pos: float = 2e-3
    r_rot: float = 4e-3
    gate_pos: float | None = None
    gate_rot: float | None = 1.2
    outlier_scale: float = 1e6
    wraps: int = 2


def _white(q: float, dt: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (q * dt**4 / 4.0, q * dt**3 / 2.0, q * dt**2)


def _advance(s: np.ndarray, z: np.ndarray, dt: np.ndarray, cfg: PoseFilter) -> np.ndarray:
    """One filter step of ``[n, 18]`` states on observations ``z`` (NaN: none).

    The noise is the same for the three axes of position and of rotation, so the
    12x12 covariance is two 2x2 blocks: a state is 6 values, 6 velocities and
    3 + 3 covariance entries.
    """
    pos, vel = s[:, :6] + dt[:, None] * s[:, 6:12], s[:, 6:12]
    cp = _predict(s[:, 12], s[:, 13], s[:, 14], dt, _white(cfg.q_pos, dt))
    cr = _predict(s[:, 15], s[:, 16], s[:, 17], dt, _white(cfg.q_rot, dt))
    seen = np.isfinite(z).all(axis=1)
    z = np.where(seen[:, None], z, pos)
    turned = nearest_equivalent(z[:, 3:], pos[:, 3:], cfg.wraps)
    innov = np.concatenate([z[:, :3], turned], axis=1) - pos
    far_p, far_r = np.zeros(len(s), bool), np.zeros(len(s), bool)
    if cfg.gate_pos is not None and cfg.gate_pos > 0:
        far_p = np.linalg.norm(innov[:, :3], axis=1) > cfg.gate_pos
    if cfg.gate_rot is not None and cfg.gate_rot > 0:
        far_r = np.linalg.norm(innov[:, 3:], axis=1) > cfg.gate_rot
    use = seen & ~(far_p & far_r)
    k1p, k2p, up = _correct(*cp, np.where(far_p, cfg.r_pos * cfg.outlier_scale, cfg.r_pos))
    k1r, k2r, ur = _correct(*cr, np.where(far_r, cfg.r_rot * cfg.outlier_scale, cfg.r_rot))
    k1, k2 = _by_axis(k1p, k1r), _by_axis(k2p, k2r)
    out = np.empty_like(s)
    out[:, :6] = np.where(use[:, None], pos + k1 * innov, pos)
    out[:, 6:12] = np.where(use[:, None], vel + k2 * innov, vel)
    for i in range(3):
        out[:, 12 + i] = np.where(use, up[i], cp[i])
        out[:, 15 + i] = np.where(use, ur[i], cr[i])
    return out


def _by_axis(p: np.ndarray, r: np.ndarray) -> np.ndarray:
    """A position and a rotation factor spread over the six axes."""
    return np.concatenate([np.repeat(p[:, None], 3, axis=1), np.repeat(r[:, None], 3, axis=1)], axis=1)


def _back(f: np.ndarray, nxt: np.ndarray, dt: np.ndarray, cfg: PoseFilter) -> np.ndarray:
    """Smoothed state ``[n, 12]`` of a frame from its filtered and the next smoothed state."""
    cp, cr = (f[:, 12], f[:, 13], f[:, 14]), (f[:, 15], f[:, 16], f[:, 17])
    gp = _rts_gain(cp, _predict(*cp, dt, _white(cfg.q_pos, dt)), dt)
    gr = _rts_gain(cr, _predict(*cr, dt, _white(cfg.q_rot, dt)), dt)
    g = [_by_axis(p, r) for p, r in zip(gp, gr)]
    dpos = nxt[:, :6] - (f[:, :6] + dt[:, None] * f[:, 6:12])
    dvel = nxt[:, 6:12] - f[:, 6:12]
    return np.concatenate([f[:, :6] + g[0] * dpos + g[1] * dvel, f[:, 6:12] + g[2] * dpos + g[3] * dvel], axis=1)


def _interval(const: dict, lanes: int, cfg: PoseFilter) -> np.ndarray:
    """Frame interval of the clip each lane belongs to."""
    return const["dt"][:, 0] if "dt" in const else np.full(lanes, 1.0 / max(cfg.fps, 1e-6))


def _count(const: dict, active: np.ndarray) -> np.ndarray:
    """Frames of each lane's clip; a clip of several blocks has more than any limit here."""
    lanes = active[0]
    return np.where(const["_many"][:, 0] > 0, np.inf, (active[:, None] > np.arange(lanes)[None, :]).sum(axis=0))


def _own_first(obs: np.ndarray, const: dict) -> np.ndarray:
    """The first two valid rows (frame number, pose) of each lane."""
    good, rows = np.isfinite(obs).all(axis=2), np.arange(obs.shape[1])
    out = []
    for _ in range(2):
        at, any_ = good.argmax(axis=0), good.any(axis=0)[:, None]
        out.append(np.where(any_, np.concatenate([const["_start"] + at[:, None], obs[at, rows]], axis=1), np.nan))
        good = good.copy()
        good[at, rows] = False
    return np.concatenate(out, axis=1)


def pose_first(src: str) -> Kernel:
    """Carries the first two valid poses behind a block to it; a clip may start with blocks without any."""

    def step(x, const, active, state):
        return {"_later": state}, first_two(_own_first(x[src], const), state)

    return Kernel(step, {"_later": 14}, 14, True, FirstTwo(7), uses=(src,))


def _start(obs: np.ndarray, later: np.ndarray, dt: np.ndarray, const: dict, active: np.ndarray, cfg: PoseFilter) -> np.ndarray:
    """Pose and velocity a clip starts from."""
    own, count = _own_first(obs, const), _count(const, active)
    both = first_two(own, later)
    a, b = both[:, :7], both[:, 7:].copy()
    b[:, 4:] = np.where(np.isnan(own[:, 7:8]), nearest_equivalent(b[:, 4:], a[:, 4:], cfg.wraps), b[:, 4:])
    init = np.full((len(both), 12), np.nan)
    some = np.isfinite(a[:, 0])
    init[some, :6], init[some, 6:] = a[some, 1:], 0.0
    # Without padding, a clip that starts valid starts with the velocity to its next valid pose.
    moving = ((cfg.edge_pad <= 0) | (count <= 1)) & (a[:, 0] == 0) & np.isfinite(b[:, 0])
    gap = np.maximum(b[:, 0] * dt, 1e-8)
    init[moving, 6:] = ((b[:, 1:] - a[:, 1:]) / gap[:, None])[moving]
    return init


def pose_forward(src: str, cfg: PoseFilter) -> Kernel:
    """Forward filter over unwrapped observations (xyz, rotation vector).

    The leading padding repeats the first pose, so it leaves the state as it is
    and only settles the covariance: it needs no frames. The last observation is
    carried along for the trailing padding.
    """

    def step(x, const, active, state):
        obs = x[src]
        dt, count = _interval(const, obs.shape[1], cfg), _count(const, active)
        init = _start(obs, x["_later"], dt, const, active, cfg)
        start = np.concatenate([init, np.tile([0.01, 0.0, 1.0, 0.01, 0.0, 1.0], (len(init), 1))], axis=1)
        padded = start.copy()
        for _ in range(cfg.edge_pad):
            padded = _advance(padded, init[:, :6], dt, cfg)
        start[:, 12:] = np.where((count > 1)[:, None], padded[:, 12:], start[:, 12:])
        start = np.concatenate([start, np.full((len(start), 6), np.nan)], axis=1)
        cur = np.where(np.isnan(state[:, :18]).any(axis=1, keepdims=True), start, state)
        filt = np.full((*obs.shape[:2], 24), np.nan)
        for t in range(len(active)):
            m = active[t]
            z = obs[t, :m]
            cur[:m, :18] = _advance(cur[:m, :18], z, dt[:m], cfg)
            cur[:m, 18:] = np.where(np.isfinite(z).all(axis=1, keepdims=True), z, cur[:m, 18:])
            filt[t, :m] = cur[:m]
        return {"_filt": filt}, cur

    # gates make a step depend on its state: no transfer
    return Kernel(step, {"_filt": 24}, 24, uses=(src, "_later"))


def pose_backward(cfg: PoseFilter) -> Kernel:
    """Backward (RTS) pass over the filtered states, started behind the trailing padding."""

    def tail(f: np.ndarray, dt: np.ndarray) -> np.ndarray:
        """Smoothed state of the first padding frame."""
        states, s = [], f[:, :18]
        for _ in range(cfg.edge_pad):
            s = _advance(s, f[:, 18:], dt, cfg)
            states.append(s)
        nxt = states[-1][:, :12]
        for s in reversed(states[:-1]):
            nxt = _back(s, nxt, dt, cfg)
        return nxt

    def step(x, const, active, state):
        filt = x["_filt"]
        dt, count = _interval(const, filt.shape[1], cfg), _count(const, active)
        out = np.full((*filt.shape[:2], 6), np.nan)
        cur = state.copy()
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            f = filt[t, :m]
            new = np.flatnonzero(np.isnan(cur[:m]).any(axis=1))
            ends = new[(count[new] > 1)] if cfg.edge_pad > 0 else new[:0]
            if len(ends):
                cur[ends] = tail(f[ends], dt[ends])
            lone = np.isnan(cur[:m]).any(axis=1, keepdims=True)
            cur[:m] = np.where(lone, f[:, :12], _back(f, cur[:m], dt[:m], cfg))
            out[t, :m, :3] = cur[:m, :3]
            out[t, :m, 3:] = canonical_rotvec(cur[:m, 3:6])
        return {"_smooth": out}, cur

    return Kernel(step, {"_smooth": 6}, 12, True, Affine(12, per_axis(6)), ("_filt",))


def smooth_pose(
    df: DataFrame,
    col: str,
    cfg: PoseFilter = PoseFilter(),
    out: str | None = None,
    fps: str | None = None,
    continuous: bool = False,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Constant-velocity Kalman filter and backward smoother of pose vectors.

    ``fps`` names a column with the clip's frame rate; ``continuous`` unwraps the
    smoothed rotations along the clip, else their angle is in [0, pi]. Invalid
    frames are filled as long as the clip has a valid one; a clip without any
    stays NULL. Both ends are padded with copies of the first and last valid pose.
    """
    p = _pose_pack(df, {col: 6}, fps, cfg, keys, block)
    kernels, last = pose_kernels(col, cfg, continuous)
    return unpack(scan(p, kernels, {last: 6}), p, {last: 6}, {last: out or col})


def pose_kernels(col: str, cfg: PoseFilter, continuous: bool) -> tuple[list[Kernel], str]:
    """Kernels of the pose smoother and the name of their last output."""
    kernels = [unwrap_kernel(col, "_obs", 6, cfg.wraps, at=3), pose_first(col), pose_forward("_obs", cfg), pose_backward(cfg)]
    if not continuous:
        return kernels, "_smooth"
    return [*kernels, unwrap_kernel("_smooth", "_smooth2", 6, 2, at=3)], "_smooth2"


def _pose_pack(df: DataFrame, inputs: dict[str, int], fps: str | None, cfg: PoseFilter, keys: Sequence[str], block: int) -> Packed:
    """Packed frames with the frame interval of each clip."""
    p = pack(df, inputs, keys, block)
    if not fps:
        return p
    rate = F.coalesce(F.col("_rest")[0][fps].cast("double"), F.lit(float(cfg.fps)))
    dt = F.lit(1.0) / F.greatest(rate, F.lit(1e-6))
    return replace(p, df=p.df.withColumn("_c_dt", F.array(dt)), consts={"dt": 1})


def smooth_hand(
    df: DataFrame,
    pose: str,
    gripper: str,
    cfg: PoseFilter = PoseFilter(),
    grip: GripperFilter = GripperFilter(),
    smooth: bool = True,
    fps: str | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Pose smoothing (or only unwrapping) and gripper smoothing of the same clips in one shuffle."""
    marked = df.withColumns({"_ok": is_finite(F.col(gripper)).cast("double"), gripper: clean_signal(F.col(gripper))})
    inputs = {pose: 6, gripper: 1, "_ok": 1, "frame_index": 1}
    if smooth:
        p = _pose_pack(marked, inputs, fps, cfg, keys, block)
        kernels, last = pose_kernels(pose, cfg, continuous=True)
    else:
        p = pack(marked, inputs, keys, block)
        kernels, last = [unwrap_kernel(pose, "_unwrapped", 6, 2, at=3)], "_unwrapped"
    emit, names = {last: 6}, {last: pose}
    if grip.enabled:
        more, signal = gripper_kernels(gripper, "_ok", grip)
        kernels, emit[signal], names[signal] = kernels + more, 1, gripper
    done = unpack(scan(p, kernels, emit), p, emit, names).drop("_ok")
    return done.withColumn(gripper, _unit_range(gripper))


@dataclass(frozen=True)
class JointFilter:
    """Settings of the joint smoother."""

    dt: float = 1.0
    q_pos: float = 5e-5
    q_vel: float = 1.5e-3
    r: float = 8e-3
    p_pos: float = 2e-4
    p_vel: float = 2e-2


def joint_kernels(src: str, out: str, dim: int, cfg: JointFilter) -> list[Kernel]:
    """Forward and backward pass; all joints share one 2x2 covariance.

    State: ``dim`` positions, ``dim`` velocities, 3 covariance entries.
    """
    dt = max(cfg.dt, 1e-6)
    q = (cfg.q_pos, 0.0, cfg.q_vel)

    def forward(x, _, active, state):
        obs = x[src]
        nxt_obs = obs[1] if len(obs) > 1 else obs[0]
        speed = np.where(np.isnan(nxt_obs), 0.0, (nxt_obs - obs[0]) / dt)
        start = np.concatenate([obs[0], speed, np.tile([cfg.p_pos, 0.0, cfg.p_vel], (obs.shape[1], 1))], axis=1)
        cur = np.where(np.isnan(state).any(axis=1, keepdims=True), start, state)
        filt = np.full((*obs.shape[:2], 2 * dim + 3), np.nan)
        for t in range(len(active)):
            m = active[t]
            s = cur[:m]
            pos, vel = s[:, :dim] + dt * s[:, dim : 2 * dim], s[:, dim : 2 * dim]
            cov = _predict(s[:, -3], s[:, -2], s[:, -1], dt, q)
            k1, k2, new = _correct(*cov, cfg.r, gain_limit=1e3)
            innov = obs[t, :m] - pos
            cur[:m] = np.concatenate(
                [pos + k1[:, None] * innov, vel + k2[:, None] * innov, np.stack(new, axis=1)], axis=1
            )
            filt[t, :m] = cur[:m]
        return {"_jf": filt}, cur

    def backward(x, _, active, state):
        filt = x["_jf"]
        y = np.full((*filt.shape[:2], dim), np.nan)
        cur = state.copy()
        for t in range(len(active) - 1, -1, -1):
            m = active[t]
            f = filt[t, :m]
            cov = (f[:, -3], f[:, -2], f[:, -1])
            g = [np.clip(v, -1e3, 1e3)[:, None] for v in _rts_gain(cov, _predict(*cov, dt, q), dt)]
            dpos = cur[:m, :dim] - (f[:, :dim] + dt * f[:, dim : 2 * dim])
            dvel = cur[:m, dim:] - f[:, dim : 2 * dim]
            smooth = np.concatenate(
                [f[:, :dim] + g[0] * dpos + g[1] * dvel, f[:, dim : 2 * dim] + g[2] * dpos + g[3] * dvel], axis=1
            )
            first = np.isnan(cur[:m]).any(axis=1, keepdims=True)
            cur[:m] = np.where(first, f[:, : 2 * dim], smooth)
            y[t, :m] = cur[:m, :dim]
        return {out: y}, cur

    def known(starts):
        return np.concatenate([np.zeros((len(starts), 2 * dim)), joint_covariance(starts, cfg)], axis=1)

    size = 2 * dim + 3
    return [
        Kernel(forward, {"_jf": size}, size, transfer=Affine(size, per_axis(dim, 3), known), uses=(src,)),
        Kernel(backward, {out: dim}, 2 * dim, True, Affine(2 * dim, per_axis(dim)), ("_jf",)),
    ]


def joint_covariance(frames: np.ndarray, cfg: JointFilter) -> np.ndarray:
    """Covariance ``[n, 3]`` behind so many frames: it follows from their number, and repeats itself before long."""
    dt, q = max(cfg.dt, 1e-6), (cfg.q_pos, 0.0, cfg.q_vel)
    path, place, last = [], {}, int(max(frames, default=0))
    now = (float(cfg.p_pos), 0.0, float(cfg.p_vel))
    while now not in place and len(path) <= last:
        place[now] = len(path)
        path.append(now)
        _, _, new = _correct(*_predict(*[np.array([v]) for v in now], dt, q), cfg.r, gain_limit=1e3)
        now = tuple(float(v[0]) for v in new)
    back = place.get(now, len(path))
    period = max(1, len(path) - back)
    return np.array([path[int(n) if n < len(path) else back + (int(n) - back) % period] for n in frames]).reshape(-1, 3)


def smooth_joints(
    df: DataFrame,
    col: str,
    lower: Sequence[float | None],
    upper: Sequence[float | None],
    cfg: JointFilter = JointFilter(),
    out: str | None = None,
    keys: Sequence[str] = KEYS,
    block: int = FRAMES,
) -> DataFrame:
    """Kalman filter and backward smoother of joint vectors, clipped to their limits."""
    dim = len(lower)
    out = out or col
    kernels = joint_kernels(col, "_joint", dim, cfg)
    done = recur(df, {col: dim}, kernels, {"_joint": dim}, {"_joint": out}, keys, block)
    return done.withColumn(out, clip_bounds(F.col(out), lower, upper))


def smooth_gripper_joints(
    df: DataFrame,
    col: str,
    closed: Sequence[float],
    opened: Sequence[float],
    cfg: JointFilter = JointFilter(),
    out: str | None = None,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """The joint smoother for finger targets; the limits are the closed and open positions."""
    lower = [min(a, b) for a, b in zip(closed, opened)]
    upper = [max(a, b) for a, b in zip(closed, opened)]
    return smooth_joints(df, col, lower, upper, cfg, out, keys)

