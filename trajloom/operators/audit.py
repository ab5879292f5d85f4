"""Audits of a written trajectory table: against recomputed poses, and of the solver's own metrics.

Both measure every frame of a clip in one projection and report each measure by its
count, mean, exact 95th percentile and largest value, all measures of all clips in the
same three scans. The camera is that of a clip's first frame.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.camera import all_finite, project_world
from ..functions.cleaning import is_finite
from ..functions.matrix import compose, inv_rigid, let, norm_diff, pose_to_mat, position, rot_err_deg, rotation, translation_frame
from .blocks import KEYS
from .quality import stats_of, with_first

SIDES = ("left", "right")
Base = tuple[float, float, float]
# Base positions of the two arms.
BASES: dict[str, Base] = {"left": (0.0, 0.3, 0.0), "right": (0.0, -0.3, 0.0)}


def _errors(a: Column, b: Column) -> Column:
    """Struct (translation, rotation in degrees) between two 4x4 matrices; null where either is."""
    return let(
        lambda a, b: F.when(
            a.isNotNull() & b.isNotNull(),
            F.struct(norm_diff(position(a), position(b)).alias("t"), rot_err_deg(rotation(a), rotation(b)).alias("r")),
        ),
        a,
        b,
    )


def storage_errors(
    stored: DataFrame, recomputed: DataFrame, bases: Mapping[str, Base] = BASES, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Errors of every frame that both tables hold, one row per frame and side.

    ``stored`` has ``left_pose`` and ``right_pose`` in their base frames and
    ``camera_extrinsics``; ``recomputed`` the same poses and the world poses
    ``left_world`` and ``right_world`` as 4x4. In the camera, the stored pose goes through
    its base frame, the recomputed one comes from the world. Frames run to the shorter
    sequence; a measure is null where either side of it is not finite.
    """
    ids = [*keys, "frame_index"]
    poses = [f"{s}_pose" for s in SIDES]
    held = with_first(stored.select(*ids, *poses, "camera_extrinsics"), ["camera_extrinsics"], keys)
    other = recomputed.select(*ids, *[F.col(f"{s}_pose").alias(f"_ref_{s}") for s in SIDES], *[f"{s}_world" for s in SIDES])
    both = held.join(other, ids).withColumn("_from_world", inv_rigid(F.col("first_camera_extrinsics")))
    sides = []
    for s in SIDES:
        pose = pose_to_mat(F.col(f"{s}_pose"))
        base = _errors(pose, pose_to_mat(F.col(f"_ref_{s}")))
        seen = compose(F.col("_from_world"), compose(translation_frame(*bases[s]), pose))
        camera = _errors(seen, compose(F.col("_from_world"), F.col(f"{s}_world")))
        sides.append(F.struct(F.lit(s).alias("side"), base.alias("base"), camera.alias("camera")))
    rows = both.select(*ids, F.inline(F.array(*sides)))
    named = {f"{frame}_{name}": F.col(frame)[c] for frame in ("base", "camera") for name, c in (("translation_error", "t"), ("rotation_error_deg", "r"))}
    return rows.select(*ids, "side", *[v.alias(n) for n, v in named.items()])


def storage_report(
    stored: DataFrame, recomputed: DataFrame, bases: Mapping[str, Base] = BASES, by: Sequence[str] = KEYS, keys: Sequence[str] = KEYS
) -> DataFrame:
    """n, mean, p95 and max of the eight measures: two sides, base and camera frame, translation and rotation.

    One row for each of ``by``, side and ``stat``; ``by`` may be empty for one report of all clips.
    """
    errors = storage_errors(stored, recomputed, bases, keys)
    values = {c: F.col(c) for c in errors.columns if c.startswith(("base_", "camera_"))}
    return stats_of(errors, values, [*by, "side"])


def metric_errors(frames: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """True errors of reachable frames beside the reported ones.

    ``frames`` has a row per clip, side and frame: ``pose`` asked for and ``reached`` (xyz,
    axis-angle), the reported ``position_error`` and ``orientation_error``, ``reachable``,
    ``intrinsics`` and ``camera_extrinsics``. The pixel error is null where either point is
    not in front of the camera.
    """
    ids = [*keys, "side", "frame_index"]
    seen = with_first(frames, ["intrinsics", "camera_extrinsics"], [*keys, "side"])
    used = seen.filter(
        F.coalesce(F.col("reachable"), F.lit(False)) & all_finite(F.slice("pose", 1, 6), 6) & all_finite(F.slice("reached", 1, 6), 6)
    )
    view, k = inv_rigid(F.col("first_camera_extrinsics")), F.col("first_intrinsics")
    used = used.withColumns({"_view": view, "_off": _errors(pose_to_mat(F.col("pose")), pose_to_mat(F.col("reached")))})
    a, b = project_world(F.col("pose"), F.col("_view"), k), project_world(F.col("reached"), F.col("_view"), k)
    pixels = F.sqrt((a["u"] - b["u"]) * (a["u"] - b["u"]) + (a["v"] - b["v"]) * (a["v"] - b["v"]))
    clean = lambda c: F.when(is_finite(F.col(c)), F.col(c))
    return used.select(
        *ids,
        clean("position_error").alias("metric_position"),
        clean("orientation_error").alias("metric_orientation"),
        F.col("_off.t").alias("true_translation"),
        F.col("_off.r").alias("true_rotation_deg"),
        pixels.alias("pixel_error"),
    )


def metric_report(frames: DataFrame, by: Sequence[str] = KEYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """n, mean, p95 and max of the five measures, one row for each of ``by``, side and ``stat``."""
    errors = metric_errors(frames, keys)
    values = {c: F.col(c) for c in ("metric_position", "metric_orientation", "true_translation", "true_rotation_deg", "pixel_error")}
    return stats_of(errors, values, [*by, "side"])


def swap_hint(frames: DataFrame, by: Sequence[str] = KEYS, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean gaps between reported and true errors as they stand and exchanged, one row for each of ``by`` and side.

    The two reported components are likely swapped when exchanging them brings both closer
    to the truth. Angles are compared in radians.
    """
    e = metric_errors(frames, keys)
    mp, mo, tp, to = (F.col("metric_position"), F.col("metric_orientation"), F.col("true_translation"), F.radians("true_rotation_deg"))
    gap = lambda a, b, name: F.avg(F.abs(a - b)).alias(name)
    out = e.groupBy(*by, "side").agg(
        F.count(F.lit(1)).alias("used_frames"),
        gap(mp, tp, "direct_position_gap"),
        gap(mo, tp, "swapped_position_gap"),
        gap(mo, to, "direct_rotation_gap"),
        gap(mp, to, "swapped_rotation_gap"),
    )
    closer = lambda what: F.col(f"swapped_{what}_gap") < F.col(f"direct_{what}_gap")
    return out.withColumn("likely_swapped", closer("position") & closer("rotation"))
