"""Queries on per-frame geometry, cameras and hands."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import camera as cam
from ..functions import matrix as mx
from ..functions.vectorized import eef_pose, inv_transform, mat_to_aa, mat_to_pose
from ..operators import hands
from ..plans.loading import load_joint_transforms, load_world_hands
from ..plans.trajectory import base_to_camera
from .base import given, q6, query, s6, spread, sql_spread

KEYS = ["sample_id", "frame_index"]
XYZ = ["x", "y", "z"]
R9 = [f"r{i}" for i in range(9)]
M16 = [f"m{i}" for i in range(16)]


def kp(n: int) -> list[str]:
    """SQL for the three coordinates of keypoint ``n``."""
    return [f"flat[{3 * n + i + 1}]" for i in range(3)]


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {sql_spread(["flat[1]*2.5", "flat[2]*2.5", "flat[3]*2.5", "flat[4]"], ["a", "b", "c", "d"])}
from fx_keypoints"""))  # fmt: skip
def track_scaling(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumn("s", mx.scale_track(F.slice("flat", 1, 7), F.lit(2.5)))
    return df.select(*KEYS, *spread(F.col("s"), ["a", "b", "c", "d"]))


QUAT = [
    "1-2*(y*y+z*z)", "2*(x*y-z*w)", "2*(x*z+y*w)", "2*(x*y+z*w)", "1-2*(x*x+z*z)", "2*(y*z-x*w)",
    "2*(x*z-y*w)", "2*(y*z+x*w)", "1-2*(x*x+y*y)",
]


@query(given(fx.KEYPOINTS, f""",
fx_n as (select *, greatest(sqrt(flat[4]**2+flat[5]**2+flat[6]**2+flat[7]**2), 1e-8) as n from fx_keypoints),
fx_q as (select sample_id, frame_index, flat[4]/n as x, flat[5]/n as y, flat[6]/n as z, flat[7]/n as w from fx_n)
select sample_id, frame_index, {sql_spread(QUAT, R9)} from fx_q"""))  # fmt: skip
def quaternion_to_matrix(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumn("q", F.slice("flat", 4, 4)).withColumn("r", mx.quat_to_mat(F.col("q")))
    return df.select(*KEYS, *spread(F.col("r"), R9))


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {sql_spread(
    ["cos(a)*(flat[1]-0.1)+sin(a)*flat[2]", "-sin(a)*(flat[1]-0.1)+cos(a)*flat[2]", "flat[3]"], XYZ)}
from (select *, frame_index*0.01 as a from fx_keypoints)"""))  # fmt: skip
def world_to_camera_points(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).join(fx.camera(spark, sf), KEYS)
    df = df.withColumns({"t": mx.position(F.col("camera")), "r": mx.rotation(F.col("camera"))})
    df = df.withColumn("p", mx.world_to_camera(F.col("flat"), F.col("t"), F.col("r")))
    return df.select(*KEYS, *spread(F.col("p"), XYZ))


INV = ["cos(a)", "sin(a)", "0", "-0.1*cos(a)", "-sin(a)", "cos(a)", "0", "0.1*sin(a)", "0", "0", "1", "0", "0", "0", "0", "1"]


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {sql_spread(INV, M16)} from (select *, frame_index*0.01 as a from fx_keypoints)"""))  # fmt: skip
def camera_inverse_rigid(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.camera(spark, sf).withColumn("inv", mx.inv_rigid(F.col("camera")))
    # adding 0.0 turns a negative zero into zero
    return df.select(*KEYS, *[(q6(F.col("inv")[i]) + 0.0).alias(n) for i, n in enumerate(M16)])


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {sql_spread(INV, M16)} from (select *, frame_index*0.01 as a from fx_keypoints)"""))  # fmt: skip
def camera_inverse_general(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.camera(spark, sf).withColumn("inv", inv_transform("camera"))
    return df.select(*KEYS, *[(q6(F.col("inv")[i]) + 0.0).alias(n) for i, n in enumerate(M16)])


IN_CAMERA = """,
fx_cam as (
  select *, cos(frame_index*0.01)*(x-0.1)+sin(frame_index*0.01)*y as cx,
         -sin(frame_index*0.01)*(x-0.1)+cos(frame_index*0.01)*y as cy, z as cz from fx_joints)"""


def camera_joints(spark: SparkSession, sf: str) -> DataFrame:
    inverse = fx.camera(spark, sf).select(*KEYS, mx.inv_rigid(F.col("camera")).alias("inv"))
    return hands.to_camera(fx.joints(spark, sf), inverse)


@query(given(fx.JOINTS, IN_CAMERA + f" select sample_id, frame_index, joint, {sql_spread(['cx', 'cy', 'cz'], XYZ)} from fx_cam"))
def joints_to_camera(spark: SparkSession, sf: str) -> DataFrame:
    return camera_joints(spark, sf).select(*KEYS, "joint", *spread(F.col("kp"), XYZ))


@query(given(fx.JOINTS, IN_CAMERA + f""",
fx_order as (select unnest([{", ".join(f"'{j}'" for j in hands.HAND_JOINTS)}]) as joint, unnest(range(21)) as pos)
select sample_id, frame_index, cast(pos as integer) as pos, {sql_spread(['cx', 'cy', 'cz'], XYZ)} from fx_cam join fx_order using (joint)"""))  # fmt: skip
def hand_assembly(spark: SparkSession, sf: str) -> DataFrame:
    wide = hands.assemble_hand(camera_joints(spark, sf))
    long = wide.select(*KEYS, F.posexplode("keypoints").alias("pos", "p"))
    return long.select(*KEYS, "pos", *spread(F.col("p"), XYZ))


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, valid, {sql_spread([f"case when valid then {e} end" for e in kp(4)], XYZ)} from fx_keypoints"""))  # fmt: skip
def keypoint_masking(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumn("pred", F.col("valid").cast("double")).drop("valid")
    df = hands.mask_invalid(df, "keypoints", "pred")
    return df.select(*KEYS, "valid", *spread(F.col("keypoints")[4], XYZ))


@query(given(fx.JOINTS, f""",
fx_c as (
  select sample_id, frame_index, count(*) filter (where confidence >= 0.2) as sure, count(confidence) as avail
  from fx_joints where joint in ({", ".join(f"'{j}'" for j in hands.REQUIRED_JOINTS)}) group by 1, 2)
select sample_id, frame_index, sure >= least(avail, 6) as valid from fx_c"""))  # fmt: skip
def confidence_validity(spark: SparkSession, sf: str) -> DataFrame:
    return hands.valid_by_confidence(camera_joints(spark, sf), threshold=0.2, min_required=6)


@query(given(fx.KEYPOINTS, f""",
fx_part as (select sample_id, frame_index, flat[1] as v from fx_keypoints where valid)
select k.sample_id, k.frame_index, {s6('v')} as v from fx_keypoints k left join fx_part p on p.sample_id = k.sample_id and p.frame_index = k.frame_index"""))  # fmt: skip
def frame_alignment(spark: SparkSession, sf: str) -> DataFrame:
    part = fx.keypoints(spark, sf).filter("valid").select(*KEYS, F.col("flat")[0].alias("v"))
    spine = hands.frame_spine(fx.camera(spark, sf), part)
    return hands.align_frames(part, spine).select(*KEYS, q6(F.col("v")).alias("v"))


RIGHT = """,
fx_two as (
  select sample_id, frame_index, joint, 'left' as side, cx, cy, cz, confidence from fx_cam where joint not like '%Metacarpal'
  union all select sample_id, frame_index, joint, 'right', cx, cy, cz, confidence from fx_cam where joint not like '%Metacarpal' and cz > -0.3),
fx_ok as (
  select sample_id, frame_index, side, count(*) filter (where joint in ({req})) = {n}
    and count(*) filter (where joint in ({req}) and confidence >= 0.2) >= least(count(*) filter (where joint in ({req})), 6) as ok
  from fx_two group by 1, 2, 3),
fx_tip as (select sample_id, frame_index, side, cx, cy from fx_two where joint = 'IndexFingerTip')""".format(
    req=", ".join(f"'{j}'" for j in hands.REQUIRED_JOINTS), n=len(hands.REQUIRED_JOINTS)
)


def _side(s: str) -> str:
    return f"""coalesce((select ok from fx_ok o where o.sample_id = k.sample_id and o.frame_index = k.frame_index and side = '{s}'), false) as {s}_valid,
  (select {s6("cx")} from fx_tip t join fx_ok o using (sample_id, frame_index, side)
   where ok and t.sample_id = k.sample_id and t.frame_index = k.frame_index and side = '{s}') as {s}_tip"""


@query(given(fx.JOINTS, IN_CAMERA + RIGHT + f" select sample_id, frame_index, {_side('left')}, {_side('right')} from fx_keypoints k"))
def hand_loading(spark: SparkSession, sf: str) -> DataFrame:
    """Joint transforms of both hands to masked keypoints; the right hand lacks some joints."""
    j = fx.joints(spark, sf)
    left = j.withColumn("joint", F.concat(F.lit("left"), "joint"))
    right = j.filter(F.col("m")[11] > -0.3).withColumn("joint", F.concat(F.lit("right"), "joint"))
    camera = fx.camera(spark, sf).withColumnRenamed("camera", "m")
    out = load_joint_transforms(left.unionByName(right), camera, threshold=0.2, min_required=6)
    tip = hands.HAND_JOINTS.index("IndexFingerTip")
    return out.select(
        *KEYS, "left_valid", q6(F.col("left_keypoints")[tip][0]).alias("left_tip"),
        "right_valid", q6(F.col("right_keypoints")[tip][0]).alias("right_tip"),
    )


@query(given(fx.KEYPOINTS, f""",
fx_n as (select *, greatest(sqrt(flat[4]**2+flat[5]**2+flat[6]**2+flat[7]**2), 1e-8) as n from fx_keypoints),
fx_q as (select *, flat[4]/n as x, flat[5]/n as y, flat[6]/n as z, flat[7]/n as w from fx_n),
fx_r as (select *, {", ".join(f"{e} as {n}" for e, n in zip(QUAT, R9))},
         flat[13]-2*flat[1] as dx, flat[14]-2*flat[2] as dy, flat[15]-2*flat[3] as dz from fx_q)
select sample_id, frame_index, valid as left_valid, {sql_spread([f"case when valid then dx*r{c}+dy*r{c+3}+dz*r{c+6} end" for c in range(3)], XYZ)},
       480 as image_height from fx_r"""))  # fmt: skip
def world_hand_loading(spark: SparkSession, sf: str) -> DataFrame:
    """World keypoints under a scaled camera track to camera keypoints."""
    k = fx.keypoints(spark, sf)
    track = k.select(
        *KEYS, F.slice("flat", 1, 7).alias("traj"), F.lit(2.0).alias("scale"), F.array(F.lit(500.0)).alias("img_focal"),
        F.array(F.lit(320.0), F.lit(240.0)).alias("img_center"), F.lit(None).cast("double").alias("fps"),
    )
    out = load_world_hands(k.select(*KEYS, F.lit("left").alias("side"), "keypoints", "valid"), track)
    return out.select(*KEYS, "left_valid", *spread(F.col("left_keypoints")[4], XYZ), "image_height")


AA = """,
fx_v as (select sample_id, frame_index, valid, flat, flat[4]*8 as a, flat[5]*8 as b, flat[6]*8 as c from fx_keypoints),
fx_w as (select *, sqrt(a*a+b*b+c*c) as t from fx_v),
fx_u as (select *, a/t as x, b/t as y, c/t as z, cos(t) as co, sin(t) as si, 1-cos(t) as m from fx_w)"""
AA9 = [
    "co+x*x*m", "x*y*m-z*si", "x*z*m+y*si", "y*x*m+z*si", "co+y*y*m", "y*z*m-x*si", "z*x*m-y*si", "z*y*m+x*si", "co+z*z*m",
]


def rotated(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumn("v", F.transform(F.slice("flat", 4, 3), lambda x: x * 8))
    return df.withColumn("r", mx.aa_to_mat(F.col("v")))


@query(given(fx.KEYPOINTS, AA + f" select sample_id, frame_index, {sql_spread(AA9, R9)} from fx_u"))
def axis_angle_to_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return rotated(spark, sf).select(*KEYS, *spread(F.col("r"), R9))


@query(given(fx.KEYPOINTS, AA + f""",
fx_p as (select *, t - floor(t / (2*pi())) * 2*pi() as mo from fx_u),
fx_k as (select *, case when mo > pi() then mo - 2*pi() else mo end as s from fx_p)
select sample_id, frame_index, {sql_spread(["x*s", "y*s", "z*s"], XYZ)} from fx_k"""))  # fmt: skip
def matrix_to_axis_angle(spark: SparkSession, sf: str) -> DataFrame:
    return rotated(spark, sf).withColumn("aa", mat_to_aa("r")).select(*KEYS, *spread(F.col("aa"), XYZ))


K_SQL = dict(fx=500.0, fy=520.0, cx=320.0, cy=240.0)


def intrinsics():
    return cam.build_intrinsics(F.array(F.lit(500.0), F.lit(520.0)), F.array(F.lit(320.0), F.lit(240.0)))


@query(given(fx.KEYPOINTS, f""",
fx_c as (select sample_id, frame_index, cos(frame_index*0.01)*(flat[1]-0.1)+sin(frame_index*0.01)*flat[2] as x,
         -sin(frame_index*0.01)*(flat[1]-0.1)+cos(frame_index*0.01)*flat[2] as y, flat[3] as z from fx_keypoints)
select sample_id, frame_index, case when z > 1e-6 then {s6("500*x/z+320")} end as u, case when z > 1e-6 then {s6("520*y/z+240")} end as v
from fx_c"""))  # fmt: skip
def world_projection(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).join(fx.camera(spark, sf), KEYS)
    df = df.withColumns({"inv": mx.inv_rigid(F.col("camera")), "k": intrinsics()})
    df = df.withColumn("uv", cam.project_world(F.col("flat"), F.col("inv"), F.col("k")))
    return df.select(*KEYS, q6(F.col("uv.u")).alias("u"), q6(F.col("uv.v")).alias("v"))


@query(given(fx.KEYPOINTS, f""",
fx_z as (select *, case when abs(flat[3]) <= 1e-6 then 1e-6 else flat[3] end as z from fx_keypoints)
select sample_id, frame_index, {s6("500*flat[1]/z+320")} as u, {s6("520*flat[2]/z+240")} as v, flat[3] > 1e-6 as visible from fx_z"""))  # fmt: skip
def pinhole_projection(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumn("k", intrinsics()).withColumn("p", cam.project(F.col("flat"), F.col("k")))
    return df.select(*KEYS, q6(F.col("p.u")).alias("u"), q6(F.col("p.v")).alias("v"), F.col("p.visible").alias("visible"))


# view from (0, 0, -2) to the origin with y up: right = (-1, 0, 0), above = (0, 1, 0), depth = z + 2
FOCAL = 0.5 * 480 / math.tan(math.radians(60.0) * 0.5)


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {s6(f"320 - {FOCAL!r}*flat[1]/(flat[3]+2)")} as u, {s6(f"240 - {FOCAL!r}*flat[2]/(flat[3]+2)")} as v,
       flat[3]+2 > 1e-6 as visible from fx_keypoints"""))  # fmt: skip
def look_at_projection(spark: SparkSession, sf: str) -> DataFrame:
    p = cam.look_at_project(F.col("flat"), (0.0, 0.0, -2.0), (0.0, 0.0, 0.0), (0.0, 1.0, 0.0), 60.0, 640, 480)
    df = fx.keypoints(spark, sf).withColumn("p", p)
    return df.select(*KEYS, q6(F.col("p.u")).alias("u"), q6(F.col("p.v")).alias("v"), F.col("p.visible").alias("visible"))


def mean4(first: int, axis: int) -> str:
    return "(" + "+".join(f"flat[{3 * n + axis + 1}]" for n in range(first, first + 4)) + ")/4"


GAP = [f"({mean4(1, a)} - {mean4(5, a)})" for a in range(3)]


@query(given(fx.KEYPOINTS, f""",
fx_d as (select *, sqrt({"+".join(f"{g}*{g}" for g in GAP)}) as d from fx_keypoints)
select sample_id, frame_index, case when valid and count(*) over (partition by sample_id) >= 2 then {s6("sqrt(least(greatest((d-0.05)/0.05, 0), 1))")} else 0.0 end as pinch from fx_d"""))  # fmt: skip
def pinch_openness(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf)
    sizes = df.groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))
    df = df.join(sizes, "sample_id")
    value = hands.pinch(F.col("keypoints"), F.col("valid"), F.col("n"))
    return df.select(*KEYS, q6(value).alias("pinch"))


def _d(n: int, a: int) -> str:
    return f"(flat[{3 * n + a + 1}]-flat[{a + 1}])"


def _cross(p: int, q: int, a: int) -> str:
    j, k = (a + 1) % 3, (a + 2) % 3
    return f"({_d(p, j)}*{_d(q, k)}-{_d(p, k)}*{_d(q, j)})"


YSUM = [f"({_cross(1, 5, a)}+{_cross(2, 6, a)})" for a in range(3)]


@query(given(fx.KEYPOINTS, f""",
fx_y as (select *, {", ".join(f"{e} as y{a}" for a, e in enumerate(YSUM))},
         {", ".join(f"({mean4(1, a)}+{mean4(5, a)})/2 as o{a}" for a in range(3))} from fx_keypoints),
fx_l as (select *, sqrt(y0*y0+y1*y1+y2*y2) as l from fx_y)
select sample_id, frame_index, {sql_spread([f"case when valid then o{a} end" for a in range(3)] + [f"case when valid then y{a}/l end" for a in range(3)],
 ["ox", "oy", "oz", "yx", "yy", "yz"])} from fx_l"""))  # fmt: skip
def end_effector_frame(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf)
    df = df.withColumn("pose", eef_pose(F.col("flat"), F.col("valid"), "left")).withColumn("m", mx.pose_to_mat(F.col("pose")))
    parts = [q6(F.col("pose")[i]).alias(n) for i, n in enumerate(["ox", "oy", "oz"])]
    parts += [q6(F.col("m")[i]).alias(n) for i, n in ((1, "yx"), (5, "yy"), (9, "yz"))]
    return df.select(*KEYS, *parts)


PLACED = AA + f""",
fx_m as (select sample_id, frame_index, valid, flat, {", ".join(f"{e} as {n}" for e, n in zip(AA9, R9))},
         cos(frame_index*0.01) as ca, sin(frame_index*0.01) as sa from fx_u)"""
# camera @ pose, camera = rotation about z plus 0.1 along x
COMPOSED = [
    "ca*r0-sa*r3", "ca*r1-sa*r4", "ca*r2-sa*r5", "ca*flat[1]-sa*flat[2]+0.1",
    "sa*r0+ca*r3", "sa*r1+ca*r4", "sa*r2+ca*r5", "sa*flat[1]+ca*flat[2]", "r6", "r7", "r8", "flat[3]",
]


def posed(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumn(
        "pose", F.concat(F.slice("flat", 1, 3), F.transform(F.slice("flat", 4, 3), lambda x: x * 8))
    )
    df = df.withColumn("m", mx.pose_to_mat(F.col("pose"))).join(fx.camera(spark, sf), KEYS)
    return df.withColumn("world", mx.compose(F.col("camera"), F.col("m")))


@query(given(fx.KEYPOINTS, PLACED + f" select sample_id, frame_index, {sql_spread(COMPOSED, M16[:12])} from fx_m"))
def pose_composition(spark: SparkSession, sf: str) -> DataFrame:
    return posed(spark, sf).select(*KEYS, *spread(F.col("world"), M16[:12]))


@query(given(fx.KEYPOINTS, AA + f""",
fx_p as (select *, t - floor(t / (2*pi())) * 2*pi() as mo from fx_u),
fx_k as (select *, case when mo > pi() then mo - 2*pi() else mo end as s from fx_p)
select sample_id, frame_index, {sql_spread(["flat[1]", "flat[2]", "flat[3]", "x*s", "y*s", "z*s"], ["px", "py", "pz", "ax", "ay", "az"])} from fx_k"""))  # fmt: skip
def pose_vector_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    df = posed(spark, sf).withColumn("v", mat_to_pose("m"))
    return df.select(*KEYS, *spread(F.col("v"), ["px", "py", "pz", "ax", "ay", "az"]))


IN_FRAME = [
    "ca*r0+sa*r3", "ca*r1+sa*r4", "ca*r2+sa*r5", "ca*(flat[1]-0.1)+sa*flat[2]",
    "-sa*r0+ca*r3", "-sa*r1+ca*r4", "-sa*r2+ca*r5", "-sa*(flat[1]-0.1)+ca*flat[2]", "r6", "r7", "r8", "flat[3]",
]


@query(given(fx.KEYPOINTS, PLACED + f" select sample_id, frame_index, {sql_spread(IN_FRAME, M16[:12])} from fx_m"))
def pose_in_frame(spark: SparkSession, sf: str) -> DataFrame:
    df = posed(spark, sf).withColumn("f", mx.in_frame(F.col("m"), F.col("camera")))
    return df.select(*KEYS, *spread(F.col("f"), M16[:12]))


BASE_CAMERA = [e.replace("flat[2]", "(flat[2]+0.3)") for e in IN_FRAME]


@query(given(fx.KEYPOINTS, PLACED + f" select sample_id, frame_index, {sql_spread(BASE_CAMERA, M16[:12])} from fx_m"))
def base_pose_to_camera(spark: SparkSession, sf: str) -> DataFrame:
    df = base_to_camera("m", "left", "camera", posed(spark, sf))
    return df.select(*KEYS, *spread(F.col("camera_m"), M16[:12]))


@query(given(fx.KEYPOINTS, f""",
fx_both as (select *, case when valid then flat[1] end as lx, case when valid then flat[3] end as lz,
            case when flat[7] > -0.1 then flat[4] end as rx, case when flat[7] > -0.1 then flat[6] end as rz from fx_keypoints),
fx_box as (select sample_id, least(min(lx), min(rx)) as x0, greatest(max(lx), max(rx)) as x1,
           least(min(lz), min(rz)) as z0, greatest(max(lz), max(rz)) as z1 from fx_both group by 1)
select sample_id, frame_index, {sql_spread(["lx + 0.25 - (x0+x1)/2", "case when valid then flat[2] end", "lz + 0.1 - (z0+z1)/2",
  "rx + 0.25 - (x0+x1)/2", "rz + 0.1 - (z0+z1)/2", "0.25 - (x0+x1)/2"], ["lx", "ly", "lz", "rx", "rz", "cx"])}
from fx_both join fx_box using (sample_id)"""))  # fmt: skip
def workspace_alignment(spark: SparkSession, sf: str) -> DataFrame:
    o, i = F.lit(0.0), F.lit(1.0)

    def at(n: int):
        f = F.col("flat")
        return F.array(i, o, o, f[3 * n], o, i, o, f[3 * n + 1], o, o, i, f[3 * n + 2], o, o, o, i)

    df = fx.keypoints(spark, sf).withColumns(
        {
            "l": F.when(F.col("valid"), at(0)),
            "r": F.when(F.col("flat")[6] > -0.1, at(1)),
            "cam": mx.translation_frame(0.0, 0.0, 0.0),
        }
    )
    df = hands.align_workspace(df, ["l", "r"], "cam", (0.25, 0.0, 0.1))
    picks = {"lx": ("l", 3), "ly": ("l", 7), "lz": ("l", 11), "rx": ("r", 3), "rz": ("r", 11), "cx": ("cam", 3)}
    return df.select(*KEYS, *[q6(F.col(c)[k]).alias(n) for n, (c, k) in picks.items()])


@query(given(fx.KEYPOINTS, AA + f""",
fx_e as (select *, t - floor(t / (2*pi())) * 2*pi() as mo from fx_u)
select sample_id, frame_index, floor(degrees(least(mo, 2*pi()-mo)) * 1e4 + 0.5) / 1e4 as angle_deg from fx_e"""))  # fmt: skip
def rotation_error(spark: SparkSession, sf: str) -> DataFrame:
    df = rotated(spark, sf).withColumn("same", cam.arr(1, 0, 0, 0, 1, 0, 0, 0, 1))
    angle = mx.rot_err_deg(F.col("r"), F.col("same"))
    return df.select(*KEYS, (F.floor(angle * 1e4 + 0.5) / 1e4).alias("angle_deg"))


# ---------------------------------------------------------------- camera parameters

PARTS = """
fx_cam as (select p_partkey, cast(p_size as double) as s, p_retailprice as r, p_size * 16 as h, p_size * 20 + 7 as w from part)"""


def parts(spark: SparkSession, sf: str) -> DataFrame:
    p = fx.table(spark, sf, "part")
    return p.select(
        "p_partkey",
        F.col("p_size").cast("double").alias("s"),
        F.col("p_retailprice").alias("r"),
        (F.col("p_size") * 16).alias("h"),
        (F.col("p_size") * 20 + 7).alias("w"),
    )


@query(given(PARTS, """
select p_partkey, cast(round_even(2*s*1.25, 0) as integer) as w, cast(round_even(2*s*0.75, 0) as integer) as h from fx_cam"""))  # fmt: skip
def image_size_from_center(spark: SparkSession, sf: str) -> DataFrame:
    size = cam.infer_image_size(F.col("s") * 1.25, F.col("s") * 0.75)
    return parts(spark, sf).select("p_partkey", size["w"].alias("w"), size["h"].alias("h"))


@query(given(PARTS, f"""
select p_partkey, {sql_spread(["r", "case when p_partkey % 2 = 0 then r else s end", "s*2", "s*3"], ["fx", "fy", "cx", "cy"])} from fx_cam"""))  # fmt: skip
def intrinsics_building(spark: SparkSession, sf: str) -> DataFrame:
    focal = F.when(F.col("p_partkey") % 2 == 0, F.array("r")).otherwise(F.array("r", "s"))
    df = parts(spark, sf).withColumns({"f": focal, "c": F.array(F.col("s") * 2, F.col("s") * 3)})
    df = df.withColumn("k", cam.build_intrinsics(F.col("f"), F.col("c")))
    return df.select("p_partkey", *[q6(F.col("k")[i]).alias(n) for i, n in ((0, "fx"), (4, "fy"), (2, "cx"), (5, "cy"))])


@query(given(PARTS, f"""
select p_partkey, {sql_spread(["r*w/(2.0*w)", "s*h/(3.0*h)", "w*0.25", "h/6.0"], ["fx", "fy", "cx", "cy"])} from fx_cam"""))  # fmt: skip
def intrinsics_scaling(spark: SparkSession, sf: str) -> DataFrame:
    k = cam.arr(F.col("r"), 0, F.col("w") / 2, 0, F.col("s"), F.col("h") / 2, 0, 0, 1)
    df = parts(spark, sf).withColumn("k", k)
    out = cam.scale_intrinsics(F.col("k"), F.col("h") * 3, F.col("w") * 2, F.col("h"), F.col("w"))
    df = df.withColumn("o", out)
    return df.select("p_partkey", *[q6(F.col("o")[i]).alias(n) for i, n in ((0, "fx"), (4, "fy"), (2, "cx"), (5, "cy"))])


SHORT = """,
fx_r as (select p_partkey, cast(round_even(h * 512.0 / least(h, w), 0) as integer) as a, cast(round_even(w * 512.0 / least(h, w), 0) as integer) as b from fx_cam)"""


@query(given(PARTS, SHORT + " select p_partkey, greatest(a + a % 2, 2) as h, greatest(b + b % 2, 2) as w from fx_r"))
def render_target_size(spark: SparkSession, sf: str) -> DataFrame:
    size = cam.target_size(F.col("h"), F.col("w"))
    return parts(spark, sf).select("p_partkey", size["h"].alias("h"), size["w"].alias("w"))


@query(given(PARTS, f"select p_partkey, {sql_spread(['s*w/(2.0*w)', 'r*h/(4.0*h)'], ['x', 'y'])} from fx_cam"))
def point_rescaling(spark: SparkSession, sf: str) -> DataFrame:
    pts = cam.scale_points(F.array(F.array("s", "r")), F.col("h") * 4, F.col("w") * 2, F.col("h"), F.col("w"))
    df = parts(spark, sf).withColumn("p", pts)
    return df.select("p_partkey", q6(F.col("p")[0][0]).alias("x"), q6(F.col("p")[0][1]).alias("y"))


@query(given(PARTS, f"""
select p_partkey, {s6("case when p_partkey % 3 = 0 then s when p_partkey % 3 = 1 then r else 30 end")} as fps from fx_cam"""))  # fmt: skip
def frame_rate_fallback(spark: SparkSession, sf: str) -> DataFrame:
    third = F.pmod("p_partkey", F.lit(3))
    a, b = F.when(third == 0, F.col("s")), F.when(third == 1, F.col("r"))
    return parts(spark, sf).select("p_partkey", q6(cam.resolve_fps(a, b)).alias("fps"))


@query(given(PARTS, f"""
select p_partkey, {sql_spread(["case when p_partkey % 2 = 0 then s else r end", "case when p_partkey % 2 = 0 then 1 else 1 end",
 "case when p_partkey % 2 = 0 then 8 * s else r / 2 end"], ["fx", "corner", "cx"])} from fx_cam"""))  # fmt: skip
def intrinsics_reshaping(spark: SparkSession, sf: str) -> DataFrame:
    even = F.col("p_partkey") % 2 == 0
    s = F.col("s")
    flat = F.when(even, cam.arr(s, 0, s * 8, 0, s, s * 8, 0, 0, 0))
    named = F.when(~even, F.struct(F.col("r").alias("fx"), s.alias("fy"), (F.col("r") / 2).alias("cx"), s.alias("cy")))
    df = parts(spark, sf).withColumns({"flat": flat, "named": named})
    df = df.withColumn("k", cam.as_intrinsics(F.col("flat"), F.col("named")))
    return df.select("p_partkey", *[q6(F.col("k")[i]).alias(n) for i, n in ((0, "fx"), (8, "corner"), (2, "cx"))])


@query(given(PARTS, f"""
select p_partkey, {sql_spread(["case when p_partkey % 2 = 0 then s else r end", "case when p_partkey % 2 = 0 then 7 else s end"], ["m0", "m3"])} from fx_cam"""))  # fmt: skip
def extrinsics_reshaping(spark: SparkSession, sf: str) -> DataFrame:
    even, s, r = F.col("p_partkey") % 2 == 0, F.col("s"), F.col("r")
    df = parts(spark, sf).withColumns(
        {
            "flat": F.when(even, cam.arr(s, 0, 0, 7, 0, 1, 0, 0, 0, 0, 1, 0, 0, 0, 0, 1)),
            "rot": F.when(~even, cam.arr(r, 0, 0, 0, 1, 0, 0, 0, 1)),
            "tr": F.when(~even, cam.arr(s, 1, 2)),
        }
    )
    df = df.withColumn("m", cam.as_extrinsics(F.col("flat"), F.col("rot"), F.col("tr")))
    return df.select("p_partkey", q6(F.col("m")[0]).alias("m0"), q6(F.col("m")[3]).alias("m3"))


@query(given(PARTS, f"""
select p_partkey, {s6("case p_partkey % 3 when 0 then s when 1 then r else s + r end")} as fx,
       cast(case p_partkey % 3 when 0 then h when 1 then h + 1 else w end as integer) as h,
       cast(case p_partkey % 3 when 0 then w when 1 then w + 1 else h end as integer) as w from fx_cam"""))  # fmt: skip
def camera_parameter_fallback(spark: SparkSession, sf: str) -> DataFrame:
    third, s, r = F.pmod("p_partkey", F.lit(3)), F.col("s"), F.col("r")
    k = lambda c: cam.arr(c, 0, 0, 0, 1, 0, 0, 0, 1)
    df = parts(spark, sf).withColumns(
        {
            "own": F.when(third == 0, k(s)).otherwise(F.array(s)),  # wrong size: skipped
            "meta": F.when(third == 1, k(r)),
            "last": k(s + r),
        }
    )
    size = cam.resolve_image_size(
        F.when(third == 0, F.col("h")), F.when(third == 0, F.col("w")),
        F.when(third == 1, F.col("h") + 1), F.when(third == 1, F.col("w") + 1),
        F.array(F.col("h"), F.col("w")),
    )
    df = df.withColumns({"k": cam.resolve_matrix(9, F.col("own"), F.col("meta"), F.col("last")), "size": size})
    return df.select("p_partkey", q6(F.col("k")[0]).alias("fx"), F.col("size.h").alias("h"), F.col("size.w").alias("w"))
