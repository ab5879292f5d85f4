"""Camera parameters, image sizes and projections as column functions.

Matrices are flat row-major arrays: 9 values for 3x3, 16 for 4x4.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_at(c: Column, indexes: Sequence[int]) -> Column:
    """TRUE when the array has finite values at all these places.

    Zero times a value is zero only if it is finite, so one compiled sum decides.
    """
    zeros = [F.get(c, F.lit(i)) * 0.0 for i in indexes]
    return F.coalesce(sum(zeros[1:], zeros[0]) == 0.0, F.lit(False))


def all_finite(c: Column, dim: int) -> Column:
    """TRUE when the array has ``dim`` finite values."""
    return F.coalesce(F.size(c) == dim, F.lit(False)) & finite_at(c, range(dim))


def arr(*cols) -> Column:
    return F.array(*[c if isinstance(c, Column) else F.lit(float(c)) for c in cols])


def resolve_fps(*cols: Column, default: float = 30.0) -> Column:
    """First known frame rate, else the default. Array sources give their first element."""
    return F.coalesce(*cols, F.lit(default))


def infer_image_size(cx: Column, cy: Column) -> Column:
    """Image size from the principal point, half to even: struct(h, w)."""
    return F.struct(
        F.bround(cy * 2.0, 0).cast("int").alias("h"),
        F.bround(cx * 2.0, 0).cast("int").alias("w"),
    )


def build_intrinsics(focal: Column, center: Column) -> Column:
    """3x3 intrinsics from one or two focal lengths and a centre."""
    fy = F.when(F.size(focal) > 1, focal[1]).otherwise(focal[0])
    return arr(focal[0], 0, center[0], 0, fy, center[1], 0, 0, 1)


def scale_intrinsics(k: Column, src_h: Column, src_w: Column, dst_h: Column, dst_w: Column) -> Column:
    """Rescale intrinsics to a target size, each axis on its own; a bad source size leaves them."""
    sx, sy = dst_w / src_w, dst_h / src_h
    scaled = arr(k[0] * sx, k[1], k[2] * sx, k[3], k[4] * sy, k[5] * sy, k[6], k[7], k[8])
    return F.when((src_h > 0) & (src_w > 0), scaled).otherwise(k)


def scale_points(pts: Column, src_h: Column, src_w: Column, dst_h: Column, dst_w: Column) -> Column:
    """Rescale 2-D points between image sizes; a bad source size leaves them."""
    sx, sy = dst_w / src_w, dst_h / src_h
    scaled = F.transform(pts, lambda p: F.array(p[0] * sx, p[1] * sy))
    return F.when((src_h > 0) & (src_w > 0), scaled).otherwise(pts)


def even_up(c: Column) -> Column:
    """Round half to even, raise to the next even number, at least 2."""
    n = F.bround(c, 0).cast("int")
    return F.greatest(n + F.pmod(n, F.lit(2)), F.lit(2))


def target_size(
    h: Column, w: Column, short: int = 512, fixed: tuple[int | None, int | None] = (None, None)
) -> Column:
    """Render size: the fixed one when both parts are given, else the short side scaled."""
    if fixed[0] and fixed[1]:
        th, tw = even_up(F.lit(float(fixed[0]))), even_up(F.lit(float(fixed[1])))
    else:
        ratio = F.lit(float(short)) / F.least(h, w)
        th, tw = even_up(h * ratio), even_up(w * ratio)
    return F.struct(th.alias("h"), tw.alias("w"))


def as_intrinsics(c: Column, named: Column | None = None) -> Column:
    """9 values, or a struct fx, fy, cx, cy, as 3x3; an unset corner becomes 1."""
    flat = F.when(
        F.size(c) == 9,
        F.concat(F.slice(c, 1, 8), F.array(F.when(c[8] == 0.0, 1.0).otherwise(c[8]))),
    )
    if named is None:
        return flat
    built = F.when(
        named.isNotNull(), arr(named["fx"], 0, named["cx"], 0, named["fy"], named["cy"], 0, 0, 1)
    )
    return F.coalesce(flat, built)


def as_extrinsics(c: Column, rotation: Column | None = None, translation: Column | None = None) -> Column:
    """16 values, or rotation and translation, as 4x4."""
    flat = F.when(F.size(c) == 16, c)
    if rotation is None or translation is None:
        return flat
    r, t = rotation, translation
    built = F.when(
        (F.size(r) == 9) & (F.size(t) == 3),
        arr(r[0], r[1], r[2], t[0], r[3], r[4], r[5], t[1], r[6], r[7], r[8], t[2], 0, 0, 0, 1),
    )
    return F.coalesce(flat, built)


def resolve_matrix(dim: int, *candidates: Column) -> Column:
    """First candidate of the right size; no candidate at all raises."""
    bad = F.raise_error(F.lit(f"no camera matrix with {dim} values")).cast("array<double>")
    return F.coalesce(*[F.when(F.size(c) == dim, c) for c in candidates], bad)


def resolve_image_size(frame_h: Column, frame_w: Column, meta_h: Column, meta_w: Column, img_size: Column) -> Column:
    """Image size from frame columns, metadata, then ``img_size`` (width first)."""
    h = F.coalesce(
        F.when((frame_h > 0) & (frame_w > 0), frame_h),
        F.when((meta_h > 0) & (meta_w > 0), meta_h),
        F.when(F.size(img_size) >= 2, img_size[1]),
    )
    w = F.coalesce(
        F.when((frame_h > 0) & (frame_w > 0), frame_w),
        F.when((meta_h > 0) & (meta_w > 0), meta_w),
        F.when(F.size(img_size) >= 2, img_size[0]),
    )
    return F.struct(h.cast("int").alias("h"), w.cast("int").alias("w"))


def project(p: Column, k: Column) -> Column:
    """Pinhole projection of one point: struct(u, v, visible); tiny depth divides by 1e-6."""
    z = F.when(F.abs(p[2]) <= 1e-6, F.lit(1e-6)).otherwise(p[2])
    return F.struct(
        (k[0] * p[0] / z + k[2]).alias("u"),
        (k[4] * p[1] / z + k[5]).alias("v"),
        (p[2] > 1e-6).alias("visible"),
    )


def project_world(p: Column, ext_inv: Column, k: Column) -> Column:
    """World point through the inverse extrinsics: struct(u, v); behind the camera is NULL."""
    e = ext_inv
    x = e[0] * p[0] + e[1] * p[1] + e[2] * p[2] + e[3]
    y = e[4] * p[0] + e[5] * p[1] + e[6] * p[2] + e[7]
    z = e[8] * p[0] + e[9] * p[1] + e[10] * p[2] + e[11]
    return F.when(z > 1e-6, F.struct((k[0] * x / z + k[2]).alias("u"), (k[4] * y / z + k[5]).alias("v")))


def _cross(a: Sequence[float], b: Sequence[float]) -> list[float]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def _unit(a: Sequence[float]) -> list[float]:
    n = math.sqrt(sum(x * x for x in a))
    return [x / max(n, 1e-12) for x in a]


def look_at_project(
    p: Column,
    eye: Sequence[float],
    target: Sequence[float],
    up: Sequence[float],
    fov_deg: float,
    width: int,
    height: int,
) -> Column:
    """View from ``eye`` to ``target``: struct(u, v, visible); v grows downwards."""
    forward = _unit([t - e for t, e in zip(target, eye)])
    right = _unit(_cross(forward, up))
    above = _cross(right, forward)

    def along(axis: Sequence[float]) -> Column:
        return sum((p[i] - eye[i]) * axis[i] for i in range(3))

    depth = along(forward)
    focal = 0.5 * height / math.tan(math.radians(fov_deg) * 0.5)
    z = F.when(depth > 1e-6, depth)
    return F.struct(
        (width * 0.5 + focal * along(right) / z).alias("u"),
        (height * 0.5 - focal * along(above) / z).alias("v"),
        F.coalesce(depth > 1e-6, F.lit(False)).alias("visible"),
    )
