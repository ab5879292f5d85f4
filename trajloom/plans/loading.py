"""From decoded recordings to per-frame hand keypoints in the camera."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.camera import build_intrinsics, infer_image_size, resolve_fps
from ..functions.matrix import let, quat_to_mat, scale_track, world_to_camera
from ..functions.vectorized import inv_transform
from ..operators.hands import HAND_JOINTS, assemble_hand, confidence_rule, to_camera

SIDES = ("left", "right")


def load_joint_transforms(
    joints: DataFrame,
    camera: DataFrame,
    required: Sequence[str] | None = None,
    threshold: float | None = None,
    min_required: int | None = None,
) -> DataFrame:
    """Joint transforms of both hands to wide frames.

    ``joints``: ``sample_id, frame_index, joint`` (side and name, like
    ``leftThumbTip``), ``m``, ``confidence``. ``camera``: ``sample_id, frame_index,
    m``; its frames are the clip's frames. Side and joint name are split once and the
    side joins the key, so both hands share each shuffle.
    """
    side = F.when(F.col("joint").startswith("left"), "left").when(F.col("joint").startswith("right"), "right")
    rows = joints.withColumn("side", side).filter(F.col("side").isNotNull())
    rows = rows.withColumn("joint", F.regexp_replace("joint", "^(left|right)", ""))
    # the four metacarpals go before the join, not after it
    rows = rows.filter(F.col("joint").isin(*HAND_JOINTS))
    inverse = camera.select("sample_id", "frame_index", inv_transform("m").alias("inv"))
    placed = to_camera(rows, inverse)
    keys = ("sample_id", "side")
    valid = confidence_rule(required, threshold, min_required)
    hands = assemble_hand(placed, keys=keys, facts={"valid": valid})
    one = F.struct(F.when(F.col("valid"), F.col("keypoints")).alias("k"), F.col("valid").alias("v"))
    wide = hands.groupBy("sample_id", "frame_index").agg(
        *[F.first(F.when(F.col("side") == s, one), ignorenulls=True).alias(s) for s in SIDES]
    )
    spine = camera.select("sample_id", "frame_index")
    out = spine.join(wide, ["sample_id", "frame_index"], "left")
    cols = {f"{s}_keypoints": F.col(s)["k"] for s in SIDES}
    cols |= {f"{s}_valid": F.coalesce(F.col(s)["v"], F.lit(False)) for s in SIDES}
    return out.withColumns(cols).drop(*SIDES)


def load_world_hands(hands: DataFrame, track: DataFrame) -> DataFrame:
    """World keypoints and a scaled camera track to wide frames with camera parameters.

    ``hands``: ``sample_id, frame_index, side, keypoints, valid``. ``track``: see the
    camera track of the data model. Frames run to the shorter of both.
    """
    cam = track.withColumn("_t", scale_track(F.col("traj"), F.coalesce("scale", F.lit(1.0))))
    cam = cam.withColumn("_r", quat_to_mat(F.slice("_t", 4, 4)))
    size = infer_image_size(F.col("img_center")[0], F.col("img_center")[1])
    cam = cam.select(
        "sample_id",
        "frame_index",
        "_t",
        "_r",
        build_intrinsics(F.col("img_focal"), F.col("img_center")).alias("intrinsics"),
        size["h"].alias("image_height"),
        size["w"].alias("image_width"),
        resolve_fps(F.col("fps")).alias("fps"),
    )
    one = F.struct(F.col("keypoints").alias("k"), F.coalesce("valid", F.lit(False)).alias("v"))
    wide = hands.groupBy("sample_id", "frame_index").agg(
        *[F.first(F.when(F.col("side") == s, one), ignorenulls=True).alias(s) for s in SIDES]
    )
    out = cam.join(wide, ["sample_id", "frame_index"])

    def seen(s: str):
        pts = F.col(s)["k"]
        turn = lambda k, t, r: F.transform(k, lambda p: world_to_camera(p, t, r))
        return F.when(F.col(s)["v"], let(turn, pts, F.col("_t"), F.col("_r")))

    cols = {f"{s}_keypoints": seen(s) for s in SIDES}
    cols |= {f"{s}_valid": F.coalesce(F.col(s)["v"], F.lit(False)) for s in SIDES}
    return out.withColumns(cols).drop(*SIDES, "_t", "_r")
