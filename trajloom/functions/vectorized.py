"""Arrow-batched functions for what column expressions cannot say.

Nearest rotations need an SVD, general inverses a solver, and the keyed draws
must equal a given hash and generator bit by bit. Each call works on a whole
Arrow batch; nothing runs per row in Python except the keyed hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .keys import hash_share

VECTOR = T.ArrayType(T.DoubleType())

# Joint order of a 21-joint and a 16-joint hand.
HAND_21 = {"wrist": 0, "thumb": [1, 2, 3, 4], "index": [5, 6, 7, 8], "pinky": [17, 20]}
HAND_16 = {"wrist": 0, "thumb": [13, 14, 15], "index": [1, 2, 3], "pinky": [10, 12]}


def to_dense(col: pa.Array, dim: int) -> np.ndarray:
    """List column to ``[n, dim]``; missing values and rows of another size are NaN."""
    sizes = pc.fill_null(pc.list_value_length(col), -1).to_numpy(zero_copy_only=False)
    good = sizes == dim
    flat = col.filter(pa.array(good)).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if good.all():
        return flat.reshape(-1, dim)
    out = np.full((len(col), dim), np.nan)
    out[good] = flat.reshape(-1, dim)
    return out


def to_lists(values: np.ndarray) -> pa.Array:
    """``[n, dim]`` to a list column; a row with a non-finite value is NULL."""
    n, dim = values.shape
    bad = ~np.isfinite(values).all(axis=1)
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(values).reshape(-1)), mask=pa.array(bad))


@F.arrow_udf(VECTOR)
def inv_transform(m: pa.Array) -> pa.Array:
    """Inverse of 4x4 matrices; non-finite or singular is NULL."""
    x = to_dense(m, 16).reshape(-1, 4, 4)
    out = np.full_like(x, np.nan)
    ok = np.isfinite(x).all(axis=(1, 2))
    with np.errstate(all="ignore"):
        det = np.linalg.det(np.where(ok[:, None, None], x, np.eye(4)))
        ok &= det != 0.0
        if ok.any():
            out[ok] = np.linalg.inv(x[ok])
    return to_lists(out.reshape(-1, 16))


def nearest_rotvec(m: np.ndarray) -> np.ndarray:
    """3x3 matrices to the rotation vector of their nearest rotation; non-finite stays NaN."""
    from ..operators.arm import matrix_rotvec

    out = np.full((len(m), 3), np.nan)
    ok = np.isfinite(m).all(axis=(1, 2))
    if ok.any():
        u, _, vt = np.linalg.svd(m[ok])
        u[:, :, -1] *= np.where(np.linalg.det(u @ vt) < 0.0, -1.0, 1.0)[:, None]
        out[ok] = matrix_rotvec(u @ vt)
    return out


@F.arrow_udf(VECTOR)
def mat_to_aa(m: pa.Array) -> pa.Array:
    """3x3 to axis-angle after projection to the nearest rotation; non-finite is NULL."""
    return to_lists(nearest_rotvec(to_dense(m, 9).reshape(-1, 3, 3)))


@F.arrow_udf(VECTOR)
def mat_to_pose(m: pa.Array) -> pa.Array:
    """4x4 to xyz and axis-angle; non-finite is NULL."""
    x = to_dense(m, 16).reshape(-1, 4, 4)
    return to_lists(np.concatenate([x[:, :3, 3], nearest_rotvec(x[:, :3, :3])], axis=1))


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(v, axis=1, keepdims=True)
    return np.divide(v, n, out=np.zeros_like(v), where=n >= 1e-8)


def _tiny(v: np.ndarray) -> np.ndarray:
    return np.linalg.norm(v, axis=1) < 1e-8


def _against(v: np.ndarray, y: np.ndarray) -> np.ndarray:
    return v - (v * y).sum(axis=1, keepdims=True) * y


def hand_frames(kp: np.ndarray, side: str) -> tuple[np.ndarray, np.ndarray]:
    """Origin ``[n, 3]`` and axes ``[n, 3, 3]`` (columns x, y, z) of the pinch frame of each hand."""
    idx = HAND_21 if kp.shape[1] >= 21 else HAND_16
    wrist, thumb, index = kp[:, idx["wrist"]], kp[:, idx["thumb"]], kp[:, idx["index"]]
    tc, ic = thumb.mean(axis=1), index.mean(axis=1)
    origin = 0.5 * (tc + ic)
    sign = 1.0 if side == "left" else -1.0
    bend = sum(np.cross(thumb[:, i] - wrist, index[:, i] - wrist) for i in range(2))
    y = _unit(sign * bend)
    x = _unit(_against(sign * (ic - tc), y))
    tip = _unit(_against(_unit(thumb[:, -1] - index[:, -1]), y))
    x = np.where(_tiny(x)[:, None], tip, x)
    z = _unit(np.cross(x, y))

    flat = _tiny(x) | _tiny(y) | _tiny(z)
    if flat.any():
        w, pinky = wrist[flat], kp[flat][:, idx["pinky"]]
        normal = _unit(np.cross(index[flat, 0] - w, pinky[:, 0] - w))
        tips = _unit(np.cross(index[flat, -1] - w, pinky[:, 1] - w))
        # an all-close test with its default tolerance of 1e-8
        normal = np.where((np.abs(normal) <= 1e-8).all(axis=1)[:, None], tips, normal)
        px = _unit(index[flat, 0] - w)
        py = _unit(np.cross(normal, px))
        pz = _unit(np.cross(px, py))
        lost = _tiny(py) | _tiny(pz)
        for axis, plan in ((x, px), (y, py), (z, pz)):
            axis[flat] = np.where(lost[:, None], np.nan, plan)
    return origin, np.stack([x, y, z], axis=2)


def eef_pose(
    flat_keypoints: Column, valid: Column, side: str, joints: int = 21, camera: Sequence[float] | None = None
) -> Column:
    """End-effector pose (xyz, axis-angle) of a hand given as flat keypoints.

    An invalid or fully degenerate hand is NULL. With ``camera`` (a 4x4 as 16
    values) the pose is in the world: ``camera @ pose``.
    """
    if joints != 16 and joints < 21:
        raise ValueError(f"hand layouts have 16 or at least 21 joints, not {joints}")
    world = None if camera is None else np.asarray(camera, dtype=float).reshape(4, 4)

    @F.arrow_udf(VECTOR)
    def run(kp: pa.Array, ok: pa.Array) -> pa.Array:
        points = to_dense(kp, joints * 3).reshape(-1, joints, 3)
        keep = pc.fill_null(ok, False).to_numpy(zero_copy_only=False)
        out = np.full((len(points), 6), np.nan)
        with np.errstate(all="ignore"):
            rows = np.flatnonzero(keep & np.isfinite(points).all(axis=(1, 2)))
            if len(rows):
                origin, axes = hand_frames(points[rows], side)
                if world is not None:
                    origin, axes = origin @ world[:3, :3].T + world[:3, 3], world[:3, :3] @ axes
                out[rows] = np.concatenate([origin, nearest_rotvec(axes)], axis=1)
        return to_lists(out)

    return run(flat_keypoints, valid)


@F.arrow_udf(T.DoubleType())
def blake_share(key: pa.Array) -> pa.Array:
    """Share in [0, 1] from the big-endian 64-bit blake2b hash of the key."""
    out = [
        None if k is None else int.from_bytes(hashlib.blake2b(k.encode(), digest_size=8).digest(), "big") / float(1 << 64)
        for k in key.to_pylist()
    ]
    return pa.array(out, pa.float64())


def sample_share(key: Column, algo: str = "md5") -> Column:
    """Deterministic share of a key: ``blake2b`` for exact parity, ``md5`` to stay in the JVM."""
    if algo == "blake2b":
        return blake_share(key)
    if algo == "md5":
        return hash_share(key)
    raise ValueError(f"unknown hash: {algo}")


def keyed_uniform(key: Column, seed: int, ranges: Sequence[tuple[float, float]]) -> Column:
    """One uniform draw per range from a PCG64 stream seeded by the key alone."""
    bounds = [(float(a), float(b)) for a, b in ranges]

    @F.arrow_udf(VECTOR)
    def run(keys: pa.Array) -> pa.Array:
        out = np.full((len(keys), len(bounds)), np.nan)
        for i, k in enumerate(keys.to_pylist()):
            if k is None:
                continue
            digest = hashlib.blake2b(f"{seed}:{k}".encode("utf-8", "ignore"), digest_size=8).digest()
            rng = np.random.default_rng(int.from_bytes(digest[:4], "little"))
            out[i] = [rng.uniform(a, b) for a, b in bounds]
        return to_lists(out)

    return run(key)
