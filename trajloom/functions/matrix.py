"""Rotations and rigid transforms as column functions on flat row-major arrays.

Each element of a product reads its operands several times. Substituted into each
other, a few such functions would grow into expressions too large to compile, so
every function binds its operands once with ``let``.
"""

from __future__ import annotations

import math

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .camera import all_finite, arr


def let(build: Callable[..., Column], *values: Column) -> Column:
    """``build(*values)`` with every value evaluated once."""
    bound = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return F.transform(F.array(bound), lambda s: build(*[s[f"v{i}"] for i in range(len(values))]))[0]


def scale_track(traj: Column, scale: Column) -> Column:
    """Scale the translation part (first three values) of a camera track row."""
    return F.transform(traj, lambda x, i: F.when(i < 3, x * scale).otherwise(x))


def quat_to_mat(q: Column) -> Column:
    """Quaternion x, y, z, w to 3x3; the norm has a floor of 1e-8."""
    n = F.greatest(F.sqrt(q[0] * q[0] + q[1] * q[1] + q[2] * q[2] + q[3] * q[3]), F.lit(1e-8))

    def build(x: Column, y: Column, z: Column, w: Column) -> Column:
        return arr(
            1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
            2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
            2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
        )

    return let(build, *[q[i] / n for i in range(4)])


def world_to_camera(p: Column, t: Column, r: Column) -> Column:
    """Point in the camera: the offset from ``t`` times R (that is, R transposed applied)."""
    d = [p[i] - t[i] for i in range(3)]
    return F.array(*[d[0] * r[j] + d[1] * r[3 + j] + d[2] * r[6 + j] for j in range(3)])


def aa_to_mat(v: Column) -> Column:
    """Axis-angle to 3x3; an angle under 1e-8 is the identity."""
    angle = F.sqrt(v[0] * v[0] + v[1] * v[1] + v[2] * v[2])

    def turned(x: Column, y: Column, z: Column, c: Column, s: Column) -> Column:
        m = 1.0 - c
        return arr(
            c + x * x * m, x * y * m - z * s, x * z * m + y * s,
            y * x * m + z * s, c + y * y * m, y * z * m - x * s,
            z * x * m - y * s, z * y * m + x * s, c + z * z * m,
        )

    def build(u: Column, a: Column) -> Column:
        same = arr(1, 0, 0, 0, 1, 0, 0, 0, 1)
        moved = let(turned, u[0] / a, u[1] / a, u[2] / a, F.cos(a), F.sin(a))
        return F.when(a < 1e-8, same).when(a.isNotNull(), moved)

    return let(build, v, angle)


def rigid(r: Column, t: Column) -> Column:
    """4x4 from a 3x3 rotation and a translation."""
    return let(
        lambda r, t: arr(r[0], r[1], r[2], t[0], r[3], r[4], r[5], t[1], r[6], r[7], r[8], t[2], 0, 0, 0, 1), r, t
    )


def pose_to_mat(pose: Column) -> Column:
    """Pose vector (xyz, axis-angle) to 4x4; a non-finite value gives NULL."""
    return F.when(all_finite(F.slice(pose, 1, 6), 6), rigid(aa_to_mat(F.slice(pose, 4, 3)), pose))


def product4(a: Column, b: Column) -> Column:
    """Product of two 4x4 matrices given as plain columns: compiled, nothing is bound."""

    def cell(i: int, j: int) -> Column:
        return sum((a[4 * i + k] * b[4 * k + j] for k in range(1, 4)), a[4 * i] * b[j])

    return F.array(*[cell(i, j) for i in range(4) for j in range(4)])


def matmul4(a: Column, b: Column) -> Column:
    """Product of two 4x4 matrices given by any expressions."""
    return let(product4, a, b)


def compose(a: Column, b: Column) -> Column:
    """``a @ b``; NULL when either has a non-finite value."""
    return let(lambda a, b: F.when(all_finite(a, 16) & all_finite(b, 16), matmul4(a, b)), a, b)


def inv_rigid(m: Column) -> Column:
    """Inverse of a rotation-and-translation matrix in closed form."""

    def build(m: Column) -> Column:
        t = [-(m[i] * m[3] + m[4 + i] * m[7] + m[8 + i] * m[11]) for i in range(3)]
        full = arr(m[0], m[4], m[8], t[0], m[1], m[5], m[9], t[1], m[2], m[6], m[10], t[2], 0, 0, 0, 1)
        return F.when(all_finite(m, 16), full)

    return let(build, m)


def in_frame(m: Column, frame: Column) -> Column:
    """Express ``m`` in a rigid frame: inverse of the frame times ``m``."""
    return compose(inv_rigid(frame), m)


def translation_frame(x: float, y: float, z: float) -> Column:
    """4x4 of a pure translation."""
    return arr(1, 0, 0, x, 0, 1, 0, y, 0, 0, 1, z, 0, 0, 0, 1)


def position(m: Column) -> Column:
    """Translation of a 4x4."""
    return let(lambda m: F.when(m.isNotNull(), F.array(m[3], m[7], m[11])), m)


def rotation(m: Column) -> Column:
    """Rotation of a 4x4 as 9 values."""
    return let(lambda m: F.when(m.isNotNull(), F.array(*[m[i] for i in (0, 1, 2, 4, 5, 6, 8, 9, 10)])), m)


def rot_err_deg(a: Column, b: Column) -> Column:
    """Geodesic angle between two 3x3 rotations in degrees."""
    trace = let(lambda a, b: sum((a[i] * b[i] for i in range(1, 9)), a[0] * b[0]), a, b)
    cosine = F.greatest(F.least((trace - 1.0) / 2.0, F.lit(1.0)), F.lit(-1.0))
    return F.degrees(F.acos(cosine))


def norm_diff(a: Column, b: Column, dim: int = 3) -> Column:
    """Euclidean distance of the first ``dim`` values."""
    return F.sqrt(sum(((a[i] - b[i]) * (a[i] - b[i]) for i in range(1, dim)), (a[0] - b[0]) * (a[0] - b[0])))


def camera_constant(elevation_deg: float = 45.0) -> list[float]:
    """World pose of the nominal camera as 16 values: yaw -90, then pitch -90 - elevation."""
    yaw, pitch = math.radians(-90.0), math.radians(-90.0 - elevation_deg)
    cy, sy, cp, sp = math.cos(yaw), math.sin(yaw), math.cos(pitch), math.sin(pitch)
    return [cy, -sy * cp, sy * sp, 0.0, sy, cy * cp, -cy * sp, 0.0, 0.0, sp, cp, 0.0, 0.0, 0.0, 0.0, 1.0]
