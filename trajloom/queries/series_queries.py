"""Queries on ordered time series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.cleaning import clean_signal, clip_bounds, gripper_targets, is_finite
from ..operators import series, smoothing
from ..plans.trajectory import Retarget, retarget
from .base import given, q6, query, s6

KEYS = ["sample_id", "frame_index"]


@query(
    given(
        fx.SIGNAL,
        f"""
select sample_id, frame_index, {s6("least(greatest(coalesce(signal, 0), 0), 1)")} as value, signal is not null as finite
from fx_signal""",
    )
)
def signal_clean(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf)
    return df.select(*KEYS, q6(clean_signal(F.col("signal"))).alias("value"), is_finite(F.col("signal")).alias("finite"))


INTERP = """,
fx_near as (
  select *, last_value(case when signal is not null then frame_index end ignore nulls) over w as f0,
         last_value(signal ignore nulls) over w as v0,
         first_value(case when signal is not null then frame_index end ignore nulls) over u as f1,
         first_value(signal ignore nulls) over u as v1
  from fx_signal
  window w as (partition by sample_id order by frame_index rows between unbounded preceding and current row),
         u as (partition by sample_id order by frame_index rows between current row and unbounded following)),
fx_filled as (
  select sample_id, frame_index, case when signal is not null then signal when f0 is null and f1 is null then 0.0
         when f0 is null then v1 when f1 is null then v0
         else (v1 - v0) / (f1 - f0) * (frame_index - f0) + v0 end as filled
  from fx_near)"""


def filled(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, "signal").withColumn("ok", F.col("signal").isNotNull())
    return series.interp_gaps(df, "signal", "ok", out="filled")


@query(given(fx.SIGNAL, INTERP + f" select sample_id, frame_index, {s6('filled')} as filled from fx_filled"))
def signal_interp_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return filled(spark, sf).select(*KEYS, q6(F.col("filled")).alias("filled"))


MEDIAN = """,
fx_ends as (select sample_id, max(frame_index) as top from fx_filled group by 1),
fx_wide as (
  select f.sample_id, f.frame_index, g.filled
  from (select s.sample_id, s.frame_index, unnest([-2, -1, 0, 1, 2]) as d, e.top from fx_filled s join fx_ends e using (sample_id)) f
  join fx_filled g on g.sample_id = f.sample_id and g.frame_index = least(greatest(f.frame_index + f.d, 0), f.top)),
fx_median as (select sample_id, frame_index, median(filled) as m from fx_wide group by 1, 2)"""


@query(given(fx.SIGNAL, INTERP + MEDIAN + f" select sample_id, frame_index, {s6('m')} as med from fx_median"))
def signal_moving_median(spark: SparkSession, sf: str) -> DataFrame:
    df = series.moving_median(filled(spark, sf), "filled", 4, out="med")
    return df.select(*KEYS, q6(F.col("med")).alias("med"))


EMA = """,
fx_last as (select sample_id, max(frame_index) as top from {src} group by 1),
fx_fwd as (
  select sample_id, frame_index, {val} as y from {src} where frame_index = 0
  union all
  select s.sample_id, s.frame_index, 0.35 * s.{val} + 0.65 * p.y from fx_fwd p
  join {src} s on s.sample_id = p.sample_id and s.frame_index = p.frame_index + 1),
fx_bwd as (
  select f.sample_id, f.frame_index, f.y from fx_fwd f join fx_last l on f.sample_id = l.sample_id and f.frame_index = l.top
  union all
  select f.sample_id, f.frame_index, 0.35 * f.y + 0.65 * b.y from fx_bwd b
  join fx_fwd f on f.sample_id = b.sample_id and f.frame_index = b.frame_index - 1)"""


@query(
    given(
        fx.SIGNAL,
        INTERP
        + EMA.format(src="fx_filled", val="filled")
        + f" select sample_id, frame_index, {s6('y')} as smooth from fx_bwd",
        recursive=True,
    )
)
def signal_ema_bidirectional(spark: SparkSession, sf: str) -> DataFrame:
    df = smoothing.ema_bidir(filled(spark, sf).drop("signal", "ok"), "filled", 0.35, 1, out="smooth")
    return df.select(*KEYS, q6(F.col("smooth")).alias("smooth"))


MEDIAN3 = MEDIAN.replace("[-2, -1, 0, 1, 2]", "[-1, 0, 1]")


@query(
    given(
        fx.SIGNAL,
        INTERP
        + MEDIAN3
        + EMA.format(src="fx_median", val="m")
        + f" select sample_id, frame_index, {s6('least(greatest(y, 0), 1)')} as smooth from fx_bwd",
        recursive=True,
    )
)
def gripper_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, "signal")
    return smoothing.smooth_gripper(df, "signal", out="smooth").select(*KEYS, q6(F.col("smooth")).alias("smooth"))


@query(
    given(
        fx.SIGNAL,
        f""",
fx_any as (select sample_id, count(signal) as n from fx_signal group by 1)
select s.sample_id, s.frame_index, case when n > 0 then {s6('''least(greatest(coalesce(last_value(signal ignore nulls)
  over (partition by s.sample_id order by frame_index rows between unbounded preceding and current row), 0), 0), 1)''')} end as held
from fx_signal s join fx_any a using (sample_id)""",
    )
)
def signal_forward_fill(spark: SparkSession, sf: str) -> DataFrame:
    df = series.ffill_signal(fx.signal(spark, sf), "signal", out="held")
    return df.select(*KEYS, q6(F.col("held")).alias("held"))


@query(
    given(
        fx.SIGNAL,
        f""",
fx_len as (select sample_id, max(frame_index) + 1 + length(sample_id) * 3 as n, max_by(value, frame_index) as v, max(frame_index) as top
           from fx_signal group by 1)
select sample_id, frame_index, {s6('value')} as value from fx_signal
union all
select sample_id, cast(unnest(range(top + 1, n)) as integer) as frame_index, {s6('v')} from fx_len""",
    )
)
def signal_extend_tail(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, "value")
    lengths = df.groupBy("sample_id").agg(
        (F.max("frame_index") + 1 + F.length(F.first("sample_id")) * 3).cast("int").alias("n")
    )
    out = series.extend_tail(df, lengths, ["value"], {"value": F.lit(0.0)})
    return out.select(*KEYS, q6(F.col("value")).alias("value"))


@query(
    given(
        fx.SIGNAL,
        f""",
fx_d as (
  select sample_id, abs(signal - lag(signal) over w) as a, abs(value / 50 - lag(value / 50) over w) as b
  from fx_signal window w as (partition by sample_id order by frame_index)),
fx_all as (select sample_id, a as d from fx_d union all select sample_id, b from fx_d)
select sample_id, {s6('max(d)')} as max_abs_delta, {s6('avg(d)')} as mean_abs_delta from fx_all group by 1""",
    )
)
def trajectory_continuity(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, F.array(F.col("signal"), F.col("value") / 50).alias("q"))
    out = series.continuity(df, "q")
    return out.select("sample_id", *[q6(F.col(c)).alias(c) for c in ("max_abs_delta", "mean_abs_delta")])


@query(
    given(
        fx.SIGNAL,
        """
select sample_id, cast(count(*) filter (where signal < 0.1 - 1e-8 or signal > 0.9 + 1e-8)
       + count(*) filter (where value < 5 - 1e-8 or value > 80 + 1e-8) as bigint) as limit_violation_count
from fx_signal group by 1""",
    )
)
def joint_limit_violations(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, F.array("signal", "value").alias("q"))
    return series.limit_violations(df, "q", [0.1, 5.0], [0.9, 80.0])


@query(
    given(
        fx.SIGNAL,
        f"""
select sample_id, frame_index, {s6("least(greatest(value / 100, 0.2), 0.7)")} as a, {s6("greatest(signal, 0.3)")} as b
from fx_signal""".replace("greatest(signal, 0.3)", "case when signal is not null then greatest(signal, 0.3) end"),
    )
)
def joint_clip_bounds(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, F.array(F.col("value") / 100, F.col("signal")).alias("q"))
    v = clip_bounds(F.col("q"), [0.2, 0.3], [0.7, float("inf")])
    return df.withColumn("c", v).select(*KEYS, q6(F.col("c")[0]).alias("a"), q6(F.col("c")[1]).alias("b"))


@query(
    given(
        fx.SIGNAL,
        f""",
fx_lim as (
  select sample_id, frame_index, value / 100 as y from fx_signal where frame_index = 0
  union all
  select s.sample_id, s.frame_index, p.y + least(greatest(s.value / 100 - p.y, -0.05), 0.05) from fx_lim p
  join fx_signal s on s.sample_id = p.sample_id and s.frame_index = p.frame_index + 1)
select sample_id, frame_index, {s6('y')} as limited from fx_lim""",
        recursive=True,
    )
)
def joint_rate_limit(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, (F.col("value") / 100).alias("v"))
    return smoothing.rate_limit(df, "v", 1, 0.05, out="limited").select(*KEYS, q6(F.col("limited")).alias("limited"))


@query(
    given(
        fx.QUALITY,
        """,
fx_hit as (select sample_id, frame_index as f from fx_quality where left_reachable),
fx_dist as (
  select q.sample_id, q.frame_index, min(abs(h.f - q.frame_index) * 1000000 + h.f) as best
  from fx_quality q left join fx_hit h using (sample_id) group by 1, 2)
select sample_id, frame_index, cast(best % 1000000 as integer) as nearest_frame from fx_dist""",
    )
)
def nearest_reachable_frame(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.quality(spark, sf)
    return series.nearest_flagged(df, "left_reachable").select(*KEYS, "nearest_frame")


@query(
    given(
        fx.SIGNAL,
        f"""
select sample_id, {s6('arg_min(signal, frame_index)')} as signal from fx_signal where signal is not null group by 1""",
    )
)
def first_valid_entry(spark: SparkSession, sf: str) -> DataFrame:
    return series.first_valid(fx.signal(spark, sf), "signal").select("sample_id", q6(F.col("signal")).alias("signal"))


@query(
    given(
        fx.SIGNAL,
        f"""
select sample_id, frame_index, {s6("0.01 + signal * (0.04 - 0.01)")} as a, {s6("signal * -0.04")} as b from fx_signal""",
    )
)
def gripper_joint_targets(spark: SparkSession, sf: str) -> DataFrame:
    t = gripper_targets(F.col("signal"), [0.01, 0.0], [0.04, -0.04])
    df = fx.signal(spark, sf).withColumn("t", t)
    return df.select(*KEYS, q6(F.col("t")[0]).alias("a"), q6(F.col("t")[1]).alias("b"))


def kalman_sql(lo: str, hi: str) -> str:
    """Forward filter and backward smoother of ``fx_obs(sample_id, j, frame_index, z)``, frame by frame."""
    return f""",
fx_start as (
  select o.sample_id, o.j, o.z as q, coalesce(n.z - o.z, 0) as v from fx_obs o
  left join fx_obs n on n.sample_id = o.sample_id and n.j = o.j and n.frame_index = 1 where o.frame_index = 0),
fx_kf as (
  select sample_id, j, cast(-1 as integer) as frame_index, q::double as q, v::double as v, 2e-4::double as a, 0::double as b, 2e-2::double as c from fx_start
  union all
  select sample_id, j, frame_index, pq + k1 * (z - pq), v + k2 * (z - pq), (1 - k1) * (1 - k1) * pa + k1 * k1 * 8e-3,
         (1 - k1) * (pb - k2 * pa) + k1 * k2 * 8e-3, pc - 2 * k2 * pb + k2 * k2 * pa + k2 * k2 * 8e-3
  from (select *, pa / (pa + 8e-3) as k1, pb / (pa + 8e-3) as k2 from (
    select o.sample_id, o.j, o.frame_index, o.z, p.q + p.v as pq, p.v, p.a + 2 * p.b + p.c + 5e-5 as pa, p.b + p.c as pb, p.c + 1.5e-3 as pc
    from fx_kf p join fx_obs o on o.sample_id = p.sample_id and o.j = p.j and o.frame_index = p.frame_index + 1))),
fx_top as (select sample_id, max(frame_index) as top from fx_obs group by 1),
fx_ks as (
  select k.sample_id, k.j, k.frame_index, k.q, k.v from fx_kf k join fx_top t on k.sample_id = t.sample_id and k.frame_index = t.top
  union all
  select sample_id, j, frame_index, q + (m11 * pc - m12 * pb) / det * dq + (m12 * pa - m11 * pb) / det * dv,
         v + (m21 * pc - m22 * pb) / det * dq + (m22 * pa - m21 * pb) / det * dv
  from (select *, pa * pc - pb * pb as det from (
    select k.sample_id, k.j, k.frame_index, k.q, k.v, s.q - (k.q + k.v) as dq, s.v - k.v as dv, k.a + 2 * k.b + k.c + 5e-5 as pa, k.b + k.c as pb,
           k.c + 1.5e-3 as pc, k.a + k.b as m11, k.b as m12, k.b + k.c as m21, k.c as m22
    from fx_ks s join fx_kf k on k.sample_id = s.sample_id and k.j = s.j and k.frame_index = s.frame_index - 1 where s.frame_index > 0)))
select sample_id, frame_index, j, {s6(f"least(greatest(q, {lo}), {hi})")} as smooth from fx_ks"""


def per_joint(df: DataFrame) -> DataFrame:
    return df.select(*KEYS, F.posexplode("smooth").alias("j", "s")).select(*KEYS, "j", q6(F.col("s")).alias("smooth"))


@query(
    given(
        fx.SIGNAL,
        """,
fx_obs as (select sample_id, frame_index, cast(unnest([0, 1]) as integer) as j, unnest([0.04, -0.04]) * coalesce(signal, 0) as z from fx_signal)"""
        + kalman_sql("case when j = 0 then 0 else -0.04 end", "case when j = 0 then 0.04 else 0 end"),
        recursive=True,
    )
)
def gripper_joint_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.signal(spark, sf).select(*KEYS, F.coalesce("signal", F.lit(0.0)).alias("signal"))
    df = df.withColumn("q", gripper_targets(F.col("signal"), [0.0, 0.0], [0.04, -0.04]))
    return per_joint(smoothing.smooth_gripper_joints(df, "q", [0.0, 0.0], [0.04, -0.04], out="smooth"))


def both_hands(spark: SparkSession, sf: str) -> DataFrame:
    """Left hand as given, right hand mirrored."""
    k = fx.keypoints(spark, sf)
    mirror = F.transform("keypoints", lambda p: F.array(p[0], -p[1], p[2]))
    return k.select(
        *KEYS,
        F.col("keypoints").alias("left_keypoints"),
        F.col("valid").alias("left_valid"),
        mirror.alias("right_keypoints"),
        F.col("valid").alias("right_valid"),
        F.lit(30.0).alias("fps"),
    )


@query()
def retarget_chain(spark: SparkSession, sf: str) -> DataFrame:
    return retarget(both_hands(spark, sf), Retarget(center=(0.25, 0.0, 0.1)), fps="fps")


@query()
def pose_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.vectorized import eef_pose

    k = fx.keypoints(spark, sf)
    df = k.select(*KEYS, eef_pose(F.col("flat"), F.col("valid"), "left").alias("pose"))
    return smoothing.smooth_pose(df, "pose", out="smooth")


TURNS = """,
fx_ok as (
  select *, row_number() over (partition by sample_id order by frame_index) as rn, sqrt(a*a + b*b + c*c) as t
  from (select sample_id, frame_index, flat[1]*20 as a, flat[2]*20 as b, flat[3]*20 as c from fx_keypoints where valid)),
fx_un as (
  select sample_id, frame_index, rn, a, b, c from fx_ok where rn = 1
  union all
  select sample_id, frame_index, rn, a/t*s, b/t*s, c/t*s from (
    select o.*, list_min(list_transform(range(-3, 3), lambda k: {'d': (o.a/o.t*(o.t+2*pi()*k) - p.a)**2 + (o.b/o.t*(o.t+2*pi()*k) - p.b)**2
             + (o.c/o.t*(o.t+2*pi()*k) - p.c)**2, 's': o.t + 2*pi()*k})).s as s
    from fx_un p join fx_ok o on o.sample_id = p.sample_id and o.rn = p.rn + 1))"""


@query(
    given(
        fx.KEYPOINTS,
        TURNS
        + f""" select k.sample_id, k.frame_index, {s6("a")} as x, {s6("b")} as y, {s6("c")} as z
from fx_keypoints k left join fx_un u on u.sample_id = k.sample_id and u.frame_index = k.frame_index""",
        recursive=True,
    )
)
def rotation_unwrapping(spark: SparkSession, sf: str) -> DataFrame:
    k = fx.keypoints(spark, sf)
    df = k.select(*KEYS, F.when(F.col("valid"), F.transform(F.slice("flat", 1, 3), lambda x: x * 20.0)).alias("rotvec"))
    out = smoothing.unwrap_rotvec(df, "rotvec", out="u")
    return out.select(*KEYS, *[q6(F.col("u")[i]).alias(n) for i, n in enumerate("xyz")])


@query(
    given(
        fx.KEYPOINTS,
        """,
fx_obs as (select sample_id, frame_index, cast(unnest(range(6)) as integer) as j, unnest(flat[1:6]) as z from fx_keypoints)"""
        + kalman_sql("-3", "3"),
        recursive=True,
    )
)
def joint_smoothing(spark: SparkSession, sf: str) -> DataFrame:
    k = fx.keypoints(spark, sf)
    df = k.select(*KEYS, F.slice("flat", 1, 6).alias("q"))
    return per_joint(smoothing.smooth_joints(df, "q", [-3.0] * 6, [3.0] * 6, out="smooth"))
