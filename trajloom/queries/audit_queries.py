"""Queries of the audits over poses derived from the vectors of the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.camera import arr
from ..functions.matrix import compose, pose_to_mat, translation_frame
from ..operators import audit
from .base import given, q6, query, s6

KEYS = ["sample_id", "frame_index"]
#: Where a side's pose begins in the flat vector (0-based).
AT = {"left": 0, "right": 6}
BASES = {"left": (0.0, 0.3, 0.0), "right": (0.0, -0.3, 0.0)}
K = (800.0, 0.0, 320.0, 0.0, 810.0, 240.0, 0.0, 0.0, 1.0)


def _pose(at: int, move: float = 0.0, turn: float = 1.0) -> Column:
    f = F.col("flat")
    return F.array(*[f[at + i] + move * (i + 1) for i in range(3)], *[f[at + i] * 8.0 * turn for i in range(3, 6)])


def wide(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Stored poses under the camera of each frame, and recomputed ones with two frames less."""
    k = fx.keypoints(spark, sf)
    stored = k.join(fx.camera(spark, sf).withColumnRenamed("camera", "camera_extrinsics"), KEYS).select(
        *KEYS, "camera_extrinsics", *[F.when(F.col("frame_index") % 7 != 3, _pose(AT[s])).alias(f"{s}_pose") for s in AT]
    )
    ref = {s: _pose(AT[s], 0.01, 1.02) for s in AT}
    world = {s: compose(translation_frame(BASES[s][0] + 0.003, BASES[s][1], BASES[s][2] - 0.001), pose_to_mat(_pose(AT[s], 0.01, 1.05))) for s in AT}
    again = k.filter("frame_index < 48").select(
        *KEYS,
        *[F.when(F.col("valid"), ref[s]).alias(f"{s}_pose") for s in AT],
        *[F.when(F.col("frame_index") % 5 != 2, world[s]).alias(f"{s}_world") for s in AT],
    )
    return stored, again


def _list(exprs) -> str:
    return "[" + ", ".join(exprs) + "]"


def _sql_pose(at: int, move: float = 0.0, turn: float = 1.0) -> str:
    return _list([*(f"flat[{at + i + 1}] + {move * (i + 1)}" for i in range(3)), *(f"flat[{at + i + 1}] * 8.0 * {turn}" for i in range(3, 6))])


def _matrix(v: str) -> str:
    """Rotation of the axis-angle list ``v``, by the formula of Rodrigues."""
    t = f"sqrt({v}[4]**2 + {v}[5]**2 + {v}[6]**2)"
    n = {"x": f"({v}[4]/{t})", "y": f"({v}[5]/{t})", "z": f"({v}[6]/{t})"}
    c, si = f"cos({t})", f"sin({t})"
    skew = {("x", "y"): f"-{n['z']}", ("x", "z"): n["y"], ("y", "x"): n["z"], ("y", "z"): f"-{n['x']}", ("z", "x"): f"-{n['y']}", ("z", "y"): n["x"]}
    cell = lambda i, j: f"{n[i]}*{n[j]}*(1-{c})" + (f" + {c}" if i == j else f" + {si}*({skew[i, j]})")
    return _list(cell(i, j) for i in "xyz" for j in "xyz")


def _angle(a: str, b: str) -> str:
    trace = " + ".join(f"{a}[{i}] * {b}[{i}]" for i in range(1, 10))
    return f"degrees(acos(case when {a}[1] * {b}[1] is not null then greatest(least(({trace} - 1) / 2, 1.0), -1.0) end))"


def _distance(a: str, b: str, shift=(0.0, 0.0, 0.0)) -> str:
    return "sqrt(" + " + ".join(f"({a}[{i + 1}] - {b}[{i + 1}] + {shift[i]})**2" for i in range(3)) + ")"


def _stats(value: str, name: str, source: str) -> str:
    return f"""select sample_id, side, '{name}' as stat, count({value}) as n, {s6(f"avg({value})")} as mean,
      {s6(f"quantile_cont({value}, 0.95)")} as p95, {s6(f"max({value})")} as max from {source} group by 1, 2"""


SIDED = ", ".join(
    f"{{side: '{s}', st: case when frame_index % 7 <> 3 then {_sql_pose(at)} end, re: case when valid then {_sql_pose(at, 0.01, 1.02)} end, "
    f"wo: case when frame_index % 5 <> 2 then {_sql_pose(at, 0.01, 1.05)} end}}"
    for s, at in AT.items()
)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: q6(F.col(c)) for c in ("mean", "p95", "max")})


@query(given(fx.KEYPOINTS, f""",
fx_s as (select sample_id, frame_index, unnest([{SIDED}]) as p from fx_keypoints where frame_index < 48),
fx_p as (select sample_id, p.side, p.st, p.re, p.wo from fx_s),
fx_m as (
  select *, case when st is not null then {_matrix("st")} end as ms, case when re is not null then {_matrix("re")} end as mr,
         case when wo is not null then {_matrix("wo")} end as mw from fx_p),
fx_e as (
  select sample_id, side, {_distance("st", "re")} as bt, {_angle("ms", "mr")} as br,
         {_distance("st", "wo", (-0.003, 0.0, 0.001))} as ct, {_angle("ms", "mw")} as cr from fx_m)
{_stats("bt", "base_translation_error", "fx_e")} union all {_stats("br", "base_rotation_error_deg", "fx_e")}
union all {_stats("ct", "camera_translation_error", "fx_e")} union all {_stats("cr", "camera_rotation_error_deg", "fx_e")}"""))  # fmt: skip
def storage_consistency(spark: SparkSession, sf: str) -> DataFrame:
    """Stored against recomputed poses: two sides, two frames of reference, translation and rotation."""
    return _rounded(audit.storage_report(*wide(spark, sf), BASES))


def solved(spark: SparkSession, sf: str) -> DataFrame:
    """Poses asked for and reached, with the errors reported for them, one row per side."""
    k = fx.keypoints(spark, sf)
    x = fx.camera(spark, sf).withColumnRenamed("camera", "camera_extrinsics")
    f = F.col("flat")
    sides = [
        F.struct(
            F.lit(s).alias("side"),
            _pose(at).alias("pose"),
            F.when(F.col("frame_index") % 11 != 4, _pose(at, 0.004, 1.01)).alias("reached"),
            F.abs(f[at + 12]).alias("position_error"),
            F.when(F.col("frame_index") % 13 != 5, F.abs(f[at + 13])).alias("orientation_error"),
        )
        for s, at in AT.items()
    ]
    rows = k.join(x, KEYS).select(
        *KEYS, "camera_extrinsics", arr(*K).alias("intrinsics"), (F.col("valid") & (F.col("frame_index") % 6 != 1)).alias("reachable"),
        F.inline(F.array(*sides)),
    )
    return rows


SOLVED = f""",
fx_s as (
  select sample_id, frame_index, unnest([{", ".join(
    f"{{side: '{s}', a: {_sql_pose(at)}, b: case when frame_index % 11 <> 4 then {_sql_pose(at, 0.004, 1.01)} end, "
    f"mp: abs(flat[{at + 13}]), mo: case when frame_index % 13 <> 5 then abs(flat[{at + 14}]) end}}" for s, at in AT.items())}]) as p
  from fx_keypoints where valid and frame_index % 6 <> 1),
fx_first as (select sample_id, min(frame_index) * 0.01 as w from fx_keypoints group by 1),
fx_p as (select sample_id, p.side, p.a, p.b, p.mp, p.mo, w from fx_s join fx_first using (sample_id) where p.b is not null),
fx_c as (
  select *, [cos(w)*(a[1]-0.1) + sin(w)*a[2], cos(w)*a[2] - sin(w)*(a[1]-0.1), a[3]] as ca,
         [cos(w)*(b[1]-0.1) + sin(w)*b[2], cos(w)*b[2] - sin(w)*(b[1]-0.1), b[3]] as cb from fx_p),
fx_m as (select *, {_matrix("a")} as ma, {_matrix("b")} as mb from fx_c),
fx_e as (
  select sample_id, side, mp, mo, {_distance("a", "b")} as tt, {_angle("ma", "mb")} as tr,
         case when ca[3] > 1e-6 and cb[3] > 1e-6
              then sqrt((800*(ca[1]/ca[3] - cb[1]/cb[3]))**2 + (810*(ca[2]/ca[3] - cb[2]/cb[3]))**2) end as px from fx_m)"""


@query(given(fx.KEYPOINTS, SOLVED + "\n" + "\nunion all ".join(
    _stats(c, n, "fx_e") for c, n in (
        ("mp", "metric_position"), ("mo", "metric_orientation"), ("tt", "true_translation"), ("tr", "true_rotation_deg"), ("px", "pixel_error")))))
def solver_metric_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Reported and true errors of reachable frames, and what they are in pixels."""
    return _rounded(audit.metric_report(solved(spark, sf)))


@query(given(fx.KEYPOINTS, SOLVED + f""",
fx_g as (
  select sample_id, side, count(*) as used_frames, avg(abs(mp - tt)) as dp, avg(abs(mo - tt)) as sp,
         avg(abs(mo - radians(tr))) as dr, avg(abs(mp - radians(tr))) as sr from fx_e group by 1, 2)
select sample_id, side, used_frames, {s6("dp")} as direct_position_gap, {s6("sp")} as swapped_position_gap,
       {s6("dr")} as direct_rotation_gap, {s6("sr")} as swapped_rotation_gap, sp < dp and sr < dr as likely_swapped from fx_g"""))  # fmt: skip
def solver_metric_swap(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the reported position and orientation errors look exchanged."""
    out = audit.swap_hint(solved(spark, sf))
    return out.withColumns({c: q6(F.col(c)) for c in out.columns if c.endswith("_gap")})
