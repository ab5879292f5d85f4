"""From joint transforms to hand keypoints, validity and pinch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.camera import finite_at
from ..functions.cleaning import is_finite
from ..functions.matrix import product4
from .blocks import KEYS

# The 21 hand joints in order (the source also has 4 metacarpals, which are dropped).
HAND_JOINTS = [
    "Hand",
    "ThumbKnuckle", "ThumbIntermediateBase", "ThumbIntermediateTip", "ThumbTip",
    "IndexFingerKnuckle", "IndexFingerIntermediateBase", "IndexFingerIntermediateTip", "IndexFingerTip",
    "MiddleFingerKnuckle", "MiddleFingerIntermediateBase", "MiddleFingerIntermediateTip", "MiddleFingerTip",
    "RingFingerKnuckle", "RingFingerIntermediateBase", "RingFingerIntermediateTip", "RingFingerTip",
    "LittleFingerKnuckle", "LittleFingerIntermediateBase", "LittleFingerIntermediateTip", "LittleFingerTip",
]

# Joints that decide validity unless the caller names others.
REQUIRED_JOINTS = [
    "Hand",
    "ThumbKnuckle", "ThumbIntermediateBase", "ThumbIntermediateTip", "ThumbTip",
    "IndexFingerKnuckle", "IndexFingerIntermediateBase", "IndexFingerIntermediateTip", "IndexFingerTip",
    "LittleFingerKnuckle",
]


def to_camera(joints: DataFrame, camera: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Joint transforms (``m``) in the camera (``inv``): equi-join on clip and frame.

    Adds ``cam`` (4x4, NULL unless both are finite) and ``kp``, its translation.
    """
    both = joints.join(camera.select(*keys, "frame_index", "inv"), [*keys, "frame_index"], "left")
    m, inv = F.col("m"), F.col("inv")
    ok = finite_at(m, range(12)) & finite_at(inv, range(12))
    cam = F.when(ok, product4(inv, m))
    kp = F.when(ok, F.array(*[sum((inv[4 * i + k] * m[4 * k + 3] for k in range(1, 4)), inv[4 * i] * m[3]) for i in range(3)]))
    return both.withColumns({"cam": cam, "kp": kp})


def _slots(order: Sequence[str]) -> dict[str, Column]:
    """One number per joint and axis, so that a frame's rows combine before the shuffle."""
    kp, joint = F.col("kp"), F.col("joint")
    return {f"_k{i}_{a}": F.max(F.when(joint == name, kp[a])) for i, name in enumerate(order) for a in range(3)}


def _keypoints(count: int) -> Column:
    def point(i: int) -> Column:
        axes = [F.col(f"_k{i}_{a}") for a in range(3)]
        return F.when(axes[0].isNotNull() & axes[1].isNotNull() & axes[2].isNotNull(), F.array(*axes))

    return F.array(*[point(i) for i in range(count)])


def assemble_hand(
    joints: DataFrame,
    order: Sequence[str] = HAND_JOINTS,
    keys: Sequence[str] = KEYS,
    facts: dict[str, Column] | None = None,
) -> DataFrame:
    """Long joints to one row per frame with ``keypoints`` in the wanted order; absent joints are NULL.

    ``facts`` are further aggregates per frame to compute in the same pass.
    """
    facts = facts or {}
    slots = _slots(order)
    wide = (
        joints.filter(F.col("joint").isin(*order))
        .groupBy(*keys, "frame_index")
        .agg(*[c.alias(n) for n, c in {**slots, **facts}.items()])
    )
    return wide.select(*keys, "frame_index", _keypoints(len(order)).alias("keypoints"), *facts)


def mask_invalid(df: DataFrame, keypoints: str, predicted: str) -> DataFrame:
    """Validity from the prediction flag (absent past its end); invalid keypoints become NULL."""
    valid = F.coalesce(F.col(predicted).cast("double") > 0.5, F.lit(False))
    return df.withColumn("valid", valid).withColumn(keypoints, F.when(F.col("valid"), F.col(keypoints)))


def confidence_rule(
    required: Sequence[str] | None = None,
    threshold: float | None = None,
    min_required: int | None = None,
    order: Sequence[str] = HAND_JOINTS,
) -> Column:
    """Aggregate over a frame's joints: is the hand valid?

    Every required joint must be finite and enough of them confident; without a
    threshold only the finite rule applies. Unknown names are ignored; an empty
    list means the defaults.
    """
    names = [n for n in (required or []) if n] or list(REQUIRED_JOINTS)
    needed = [n for n in names if n in order] or list(order)
    known = finite_at(F.col("kp"), range(3))
    counted = F.col("joint").isin(*[n for n in names if n in order] or [""])
    sure = counted & is_finite(F.col("confidence"))
    valid = F.count_if(F.col("joint").isin(*needed) & known) >= len(needed)
    if threshold is None:
        return valid
    least = len(names) if min_required is None else max(0, int(min_required))
    return valid & (F.count_if(sure & (F.col("confidence") >= threshold)) >= F.least(F.count_if(sure), F.lit(least)))


def valid_by_confidence(
    joints: DataFrame,
    required: Sequence[str] | None = None,
    threshold: float | None = None,
    min_required: int | None = None,
    order: Sequence[str] = HAND_JOINTS,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Frame validity by the confidence rule."""
    rule = confidence_rule(required, threshold, min_required, order)
    return joints.groupBy(*keys, "frame_index").agg(rule.alias("valid"))


def align_frames(df: DataFrame, spine: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Cut and NULL-pad a sequence to the frames of ``spine``."""
    return spine.select(*keys, "frame_index").join(df, [*keys, "frame_index"], "left")


def frame_spine(first: DataFrame, fallback: DataFrame | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """Frames of the camera track, or of the first other sequence for clips without one."""
    spine = first.select(*keys, "frame_index")
    if fallback is None:
        return spine
    have = first.select(*keys).distinct()
    rest = fallback.select(*keys, "frame_index").join(have, list(keys), "left_anti").distinct()
    return spine.unionByName(rest)


def _mean(points: Column, which: Sequence[int], axis: int) -> Column:
    return sum((points[i][axis] for i in which[1:]), points[which[0]][axis]) / len(which)


def finger_groups(joints: int) -> tuple[list[int], list[int]]:
    """Thumb and index joint positions of a hand layout."""
    if joints >= 21:
        return [1, 2, 3, 4], [5, 6, 7, 8]
    if joints == 16:
        return [13, 14, 15], [1, 2, 3]
    raise ValueError(f"hand layouts have 16 or at least 21 joints, not {joints}")


def pinch(points: Column, valid: Column, frames: Column | None = None, joints: int = 21) -> Column:
    """Pinch openness in [0, 1]: thumb-index distance from 0.05 m (closed) to 0.10 m, square root.

    Invalid frames are 0, and so is every frame of a clip with fewer than 2 frames.
    """
    thumb, index = finger_groups(joints)
    gaps = [_mean(points, thumb, a) - _mean(points, index, a) for a in range(3)]
    d = F.sqrt(gaps[0] * gaps[0] + gaps[1] * gaps[1] + gaps[2] * gaps[2])
    d = F.when(is_finite(d), d).otherwise(0.0)
    opened = F.sqrt(F.least(F.greatest((d - 0.05) / (0.10 - 0.05), F.lit(0.0)), F.lit(1.0)))
    value = F.when(F.coalesce(valid, F.lit(False)), opened).otherwise(0.0)
    return value if frames is None else F.when(frames >= 2, value).otherwise(0.0)


def align_workspace(
    df: DataFrame,
    sides: Sequence[str],
    camera: str | None,
    center: Sequence[float],
    facts: dict[str, Column] | None = None,
    at: tuple[int, int, int] = (3, 7, 11),
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Move each clip so that the box around all its poses is centred at ``center``.

    ``sides`` are the pose columns of both hands, with their position at the
    indexes ``at`` (4x4 by default, ``(0, 1, 2)`` for pose vectors); ``camera`` is a
    4x4. The height (y) is not moved. The box is a map-side combined aggregate of
    four numbers per clip, joined back; ``facts`` are further aggregates to carry
    along.
    """
    px, _, pz = at
    ok = {s: finite_at(F.col(s), at) for s in sides}
    box = {}
    for axis, i in (("x", px), ("z", pz)):
        vals = [F.when(ok[s], F.col(s)[i]) for s in sides]
        box[f"_lo_{axis}"] = F.min(F.least(*vals)) if len(vals) > 1 else F.min(vals[0])
        box[f"_hi_{axis}"] = F.max(F.greatest(*vals)) if len(vals) > 1 else F.max(vals[0])
    facts = facts or {}
    slim = df.groupBy(*keys).agg(*[c.alias(n) for n, c in {**box, **facts}.items()])
    slim = slim.select(
        *keys,
        *facts,
        F.coalesce(F.lit(float(center[0])) - (F.col("_lo_x") + F.col("_hi_x")) * 0.5, F.lit(0.0)).alias("_sx"),
        F.coalesce(F.lit(float(center[2])) - (F.col("_lo_z") + F.col("_hi_z")) * 0.5, F.lit(0.0)).alias("_sz"),
    )
    moved = df.join(slim, list(keys))

    def shift(c: Column, x: int, z: int) -> Column:
        return F.transform(
            c, lambda v, i: F.when(i == x, v + F.col("_sx")).when(i == z, v + F.col("_sz")).otherwise(v)
        )

    cols = {s: F.when(ok[s], shift(F.col(s), px, pz)).otherwise(F.col(s)) for s in sides}
    if camera:
        cols[camera] = shift(F.col(camera), 3, 11)
    return moved.withColumns(cols).drop("_sx", "_sz")
