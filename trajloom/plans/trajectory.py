"""The data flow from hand keypoints to trajectories, and the sweep over it.

Both hands are rows of one long table (key: clip and side), so each stateful
stage is one shuffle for both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import gripper_targets
from ..functions.matrix import camera_constant, compose, inv_rigid, translation_frame
from ..functions.vectorized import eef_pose
from ..operators.arm import Chain, Solver, solve_ik
from ..operators.hands import align_workspace, pinch
from ..operators.quality import reachable_ratio
from ..operators.smoothing import GripperFilter, PoseFilter, smooth_hand
from ..operators.sweep import point_summary, with_grid

SIDES = ("left", "right")
LONG_KEYS = ("sample_id", "side")
#: Columns of one side, and those a clip's frames share.
SIDE_VALUES = ("pose", "joint_position", "reachable", "collision", "position_error", "orientation_error", "gripper_signal")
CLIP_VALUES = ("fps", "image_height", "image_width", "intrinsics", "camera_extrinsics")


@dataclass(frozen=True)
class Retarget:
    """Settings of the retargeting chain."""

    camera_elevation_deg: float = 45.0
    center: tuple[float, float, float] = (0.35, 0.0, 0.1)
    smooth: bool = True
    pose_filter: PoseFilter = PoseFilter()
    gripper: GripperFilter = GripperFilter()
    bases: dict[str, tuple[float, float, float]] = field(
        default_factory=lambda: {"left": (0.0, 0.3, 0.0), "right": (0.0, -0.3, 0.0)}
    )
    joints: int = 21


def world_poses(frames: DataFrame, cfg: Retarget = Retarget()) -> DataFrame:
    """Wide keypoints (``left_keypoints``, ``left_valid``, ...) to world poses under the nominal camera."""
    cam = camera_constant(cfg.camera_elevation_deg)
    df = frames.withColumn("camera_extrinsics", F.array(*[F.lit(v) for v in cam]))
    for s in SIDES:
        flat = F.flatten(F.col(f"{s}_keypoints"))
        df = df.withColumn(f"{s}_world", eef_pose(flat, F.col(f"{s}_valid"), s, cfg.joints, cam))
    return df


def retarget(frames: DataFrame, cfg: Retarget = Retarget(), fps: str | None = None) -> DataFrame:
    """Hand keypoints to base-frame poses and gripper signals, one row per clip, side and frame."""
    df = align_workspace(
        world_poses(frames, cfg), ["left_world", "right_world"], "camera_extrinsics", cfg.center,
        {"_n": F.count(F.lit(1))}, at=(0, 1, 2),
    )
    sides = []
    for s in SIDES:
        # an invalid or degenerate hand has neither pose nor opening
        opened = F.when(
            F.col(f"{s}_world").isNotNull(),
            pinch(F.col(f"{s}_keypoints"), F.col(f"{s}_valid"), F.col("_n"), cfg.joints),
        )
        sides.append(
            F.struct(F.lit(s).alias("side"), F.col(f"{s}_world").alias("pose"), opened.alias("gripper_signal"))
        )
    keep = ["sample_id", "frame_index", *dict.fromkeys([*(v for v in CLIP_VALUES if v in df.columns), *([fps] if fps else [])])]
    rows = df.select(*keep, F.explode(F.array(*sides)).alias("_s")).select(*keep, "_s.*")
    rows = smooth_hand(
        rows, "pose", "gripper_signal", cfg.pose_filter, cfg.gripper, cfg.smooth, fps, LONG_KEYS
    )
    # base frames are pure translations: the rotation stays, the position moves
    shift = {s: F.array(*[F.lit(float(v)) for v in (*cfg.bases[s], 0, 0, 0)]) for s in SIDES}
    base = F.when(F.col("side") == "left", shift["left"]).otherwise(shift["right"])
    return rows.withColumn("pose", F.zip_with("pose", base, lambda p, b: p - b))


def base_to_camera(pose_mat: str, side: str, extrinsics: str, df: DataFrame, bases=None, out: str = "camera_m") -> DataFrame:
    """Base-frame pose back to the camera: inverse extrinsics times base frame times pose."""
    bases = bases or Retarget().bases
    return (
        df.withColumn("_base", translation_frame(*bases[side]))
        .withColumn("_inv", inv_rigid(F.col(extrinsics)))
        .withColumn("_world", compose(F.col("_base"), F.col(pose_mat)))
        .withColumn(out, compose(F.col("_inv"), F.col("_world")))
        .drop("_base", "_inv", "_world")
    )


def solve_trajectories(poses: DataFrame, chain: Chain, cfg: Solver = Solver()) -> DataFrame:
    """Joint trajectories of both sides of a retargeted table."""
    return solve_ik(poses, chain, "pose", cfg, keys=LONG_KEYS)


def to_wide(long_rows: DataFrame) -> DataFrame:
    """Long sides to trajectory columns ``left_*`` and ``right_*``, one row per frame.

    Frame rate, image size, intrinsics and extrinsics come along where the table has them;
    ``left_own`` and ``right_own`` tell which sides have the frame at all. A frame has two
    rows at most, which one ordered collect brings together.
    """
    have = [v for v in SIDE_VALUES if v in long_rows.columns]
    shared = [v for v in CLIP_VALUES if v in long_rows.columns]
    rows = F.sort_array(F.collect_list(F.struct("side", F.struct(*have, *shared).alias("row"))))
    wide = long_rows.groupBy("sample_id", "frame_index").agg(rows.alias("_rows"))
    for s in SIDES:
        wide = wide.withColumn(s, F.get(_side("_rows", s), F.lit(0))["row"])
    return wide.select(
        "sample_id",
        "frame_index",
        *[F.coalesce(*[F.col(s)[v] for s in SIDES]).alias(v) for v in shared],
        *[F.col(s)[v].alias(f"{s}_{v}") for s in SIDES for v in have],
        *[F.col(s).isNotNull().alias(f"{s}_own") for s in SIDES],
    )


def _side(rows: str, side: str) -> Column:
    return F.filter(rows, lambda r: r["side"] == side)


def with_fingers(wide: DataFrame, closed: Sequence[float], opened: Sequence[float]) -> DataFrame:
    """Appends a target per finger, from the gripper signal, to the arm joints of both sides.

    A side whose signal is missing in a frame has missing fingers, not fewer joints.
    """
    none = F.array(*[F.lit(None).cast("double") for _ in closed])
    out = {}
    for s in SIDES:
        fingers = F.coalesce(gripper_targets(F.col(f"{s}_gripper_signal"), closed, opened), none)
        arm = F.col(f"{s}_joint_position").cast("array<double>")
        out[f"{s}_joint_position"] = F.when(arm.isNotNull(), F.concat(arm, fingers))
    return wide.withColumns(out)


def with_collisions(wide: DataFrame, flags: DataFrame) -> DataFrame:
    """Adds the collision flags of the joint state (``sample_id, frame_index, collision``) to both sides.

    The joint state runs to the longer side; a side keeps the flags of its own frames. A
    frame that the flags do not hold has none.
    """
    both = wide.join(flags.select("sample_id", "frame_index", F.col("collision").alias("_hit")), ["sample_id", "frame_index"], "left")
    return both.withColumns({f"{s}_collision": F.when(F.col(f"{s}_own"), F.col("_hit")) for s in SIDES}).drop("_hit")


def sweep(
    frames: DataFrame,
    xs: Sequence[float],
    zs: Sequence[float],
    chain: Chain,
    kind: str = "mean",
    threshold: float = 0.95,
    cfg: Retarget = Retarget(),
    solver: Solver = Solver(),
) -> DataFrame:
    """Reachability of every grid point over all clips, one row per point.

    Moving the workspace adds a constant to every position, which the pose
    smoother carries through unchanged. So clips are retargeted and smoothed once,
    and only the arm solver runs per point, grouped by (point, clip, side).
    """
    from dataclasses import replace

    poses = retarget(frames, replace(cfg, center=(0.0, 0.0, 0.0))).select(*LONG_KEYS, "frame_index", "pose")
    grid = with_grid(poses, xs, zs)
    move = F.array(F.col("point")["x"], F.lit(0.0), F.col("point")["z"], F.lit(0.0), F.lit(0.0), F.lit(0.0))
    placed = grid.withColumn("pose", F.zip_with("pose", move, lambda p, m: p + m)).withColumn("_ord", F.col("point")["ord"])
    solved = solve_ik(placed, chain, "pose", solver, keys=("_ord", *LONG_KEYS))
    per_clip = solved.groupBy("point", "sample_id").agg(
        *[
            reachable_ratio(
                F.when(F.col("side") == s, F.col("reachable")),
                F.when(F.col("side") == s, F.col("position_error")),
                F.when(F.col("side") == s, F.col("orientation_error")),
            ).alias(f"{s}_ratio")
            for s in SIDES
        ]
    )
    return point_summary(per_clip, kind, threshold)
