"""Queries on quality measures, acceptance, consistency, arms and sweeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions.camera import arr
from ..operators import arm, clearance, quality, sweep
from ..plans.registry import isolate, when_passed
from ..plans.trajectory import Retarget, retarget, solve_trajectories, to_wide, with_collisions, with_fingers
from ..plans.trajectory import sweep as sweep_workspace
from ..sinks.writers import to_trajectory_schema
from .base import given, q6, query, s6, sql_spread
from .series_queries import both_hands

KEYS = ["sample_id", "frame_index"]
SIDES = ("left", "right")


@query(given(fx.SIGNAL, f"select sample_id, {s6('avg(signal)')} as mean from fx_signal group by 1"))
def finite_means(spark: SparkSession, sf: str) -> DataFrame:
    return fx.signal(spark, sf).groupBy("sample_id").agg(q6(quality.finite_mean(F.col("signal"))).alias("mean"))


@query(given(fx.META, f"select sample_id, {s6('left_reachable_ratio')} as l, {s6('right_reachable_ratio')} as r from fx_meta"))
def reachable_ratios(spark: SparkSession, sf: str) -> DataFrame:
    cols = [
        quality.reachable_ratio(F.col(f"{s}_reachable"), F.col(f"{s}_position_error"), F.col(f"{s}_orientation_error"))
        for s in SIDES
    ]
    return fx.quality(spark, sf).groupBy("sample_id").agg(q6(cols[0]).alias("l"), q6(cols[1]).alias("r"))


@query(given(fx.QUALITY, f"""
select sample_id, case when count(left_collision) > 0 then count(*) filter (where left_collision) end as n,
       {s6("count(*) filter (where left_collision) / nullif(count(left_collision), 0)")} as ratio
from fx_quality group by 1"""))  # fmt: skip
def collision_summary(spark: SparkSession, sf: str) -> DataFrame:
    hit = F.col("left_collision")
    return fx.quality(spark, sf).groupBy("sample_id").agg(
        quality.collision_count(hit).alias("n"), q6(quality.collision_ratio(hit)).alias("ratio")
    )


@query(given(fx.QUALITY, """
select sample_id, count(left_position_error) as valid, count(*) - count(left_position_error) as invalid from fx_quality group by 1"""))  # fmt: skip
def error_frame_counts(spark: SparkSession, sf: str) -> DataFrame:
    seen, lost = quality.error_counts(F.col("left_position_error"), F.col("left_orientation_error"))
    return fx.quality(spark, sf).groupBy("sample_id").agg(seen.alias("valid"), lost.alias("invalid"))


def _side_sql(s: str) -> str:
    e = f"{s}_position_error"
    return f"""
 {s6(f"avg(case when {e} is not null then case when {s}_reachable then 1.0 else 0.0 end end)")} as {s}_reachable_ratio,
 {s6(f"avg({e})")} as {s}_mean_position_error, {s6(f"avg({s}_orientation_error)")} as {s}_mean_orientation_error,
 count({e}) as {s}_valid_error_frame_count, count(*) - count({e}) as {s}_invalid_error_frame_count,
 case when count({s}_collision) > 0 then count(*) filter (where {s}_collision) end as {s}_collision_count,
 {s6(f"count(*) filter (where {s}_collision) / nullif(count({s}_collision), 0)")} as {s}_collision_ratio,
 cast(count(*) filter (where {s}_q > 80.00000001) as bigint) as {s}_limit_violation_count,
 {s6(f"max(abs({s}_q - {s}_p))")} as {s}_continuity_max_abs_delta, {s6(f"avg(abs({s}_q - {s}_p))")} as {s}_continuity_mean_abs_delta"""


@query(given(fx.QUALITY, f""",
fx_q as (select *, value as left_q, value * 1.5 as right_q, lag(value) over w as left_p, lag(value * 1.5) over w as right_p
         from fx_quality window w as (partition by sample_id order by frame_index))
select sample_id, count(*) as frame_count, {_side_sql("left")}, {_side_sql("right")} from fx_q group by 1"""))  # fmt: skip
def clip_metadata(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.quality(spark, sf).withColumns(
        {"left_joint_position": F.array("value"), "right_joint_position": F.array(F.col("value") * 1.5)}
    )
    out = quality.clip_summary(df, limits=([0.0], [80.0]))
    return out.select(
        *[q6(F.col(f.name)).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name) for f in out.schema.fields]
    )


FILTERED = """,
fx_pass as (
  select *, coalesce(left_reachable_ratio, case when right_reachable_ratio is not null then 1.0 end) as lr,
         coalesce(right_reachable_ratio, case when left_reachable_ratio is not null then 1.0 end) as rr from fx_meta),
fx_flag as (
  select *, coalesce(lr > 0.9 and rr > 0.9 and left_collision_ratio < 0.05 and right_collision_ratio < 0.05, false) as passed from fx_pass)"""


@query(given(fx.META, FILTERED + f""" select sample_id, passed, {s6('lr')} as l, {s6('rr')} as r, {s6('lr')} as filled, 0.9 as threshold, 0.05 as collision_threshold,
 {s6('left_collision_ratio')} as lc from fx_flag"""))  # fmt: skip
def quality_filter_clips(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.quality_filter(fx.meta(spark, sf))
    return df.select(
        "sample_id",
        F.col("render_filter_passed").alias("passed"),
        q6(F.col("render_filter_left_ratio")).alias("l"),
        q6(F.col("render_filter_right_ratio")).alias("r"),
        q6(F.col("left_reachable_ratio")).alias("filled"),
        F.col("render_filter_threshold").alias("threshold"),
        F.col("render_filter_collision_threshold").alias("collision_threshold"),
        q6(F.col("render_filter_left_collision_ratio")).alias("lc"),
    )


@query(given(fx.META, FILTERED + f"""
select sample_id, passed, not passed as skipped, case when not passed then 'render/' || sample_id end as stale_output,
       case when passed then {s6('lr + rr')} end as score from fx_flag"""))  # fmt: skip
def conditional_step(spark: SparkSession, sf: str) -> DataFrame:
    df = quality.quality_filter(fx.meta(spark, sf)).select(
        "sample_id",
        F.col("render_filter_passed").alias("passed"),
        F.col("render_filter_left_ratio").alias("l"),
        F.col("render_filter_right_ratio").alias("r"),
        F.concat(F.lit("render/"), "sample_id").alias("key"),
    )
    out = when_passed(df, "passed", lambda d: d.withColumn("score", q6(F.col("l") + F.col("r"))), stale="key")
    return out.drop("l", "r", "key")


@query(given(fx.META, FILTERED + " select sample_id, passed, 'r1' as run, 'render_filter' as last_process from fx_flag"))
def configured_steps(spark: SparkSession, sf: str) -> DataFrame:
    """Named steps from a config, one of them switched off."""
    from ..plans import builtin  # noqa: F401
    from ..plans.registry import build_steps

    steps = build_steps(
        [
            {"type": "add_fields", "params": {"fields": {"run": "r1"}}},
            {"type": "add_fields", "enabled": False, "params": {"fields": {"run": "r2"}}},
            {"type": "render_filter"},
        ]
    )
    return steps(fx.meta(spark, sf)).select("sample_id", F.col("render_filter_passed").alias("passed"), "run", "last_process")


@query(given(fx.SIGNAL, f"""
select sample_id, max(value) > 99.5 as failed, case when max(value) > 99.5 then 'demo' end as last_process,
       case when max(value) <= 99.5 then count(*) end as frames, case when max(value) <= 99.5 then {s6("sum(value)")} end as total
from fx_signal group by 1"""))  # fmt: skip
def isolated_step(spark: SparkSession, sf: str) -> DataFrame:
    """Clips whose step fails become error rows, the others complete."""
    df = fx.signal(spark, sf).select(*KEYS, "value")

    def step(pdf):
        if (pdf["value"] > 99.5).any():
            raise ValueError("value out of range")
        return pdf

    ok, failed = isolate(df, step, df.schema, "demo", "clip")
    good = ok.groupBy("sample_id").agg(F.count(F.lit(1)).alias("frames"), q6(F.sum("value")).alias("total"))
    none = F.lit(None).cast("string")
    return good.withColumns({"failed": F.lit(False), "last_process": none}).unionByName(
        failed.select("sample_id", F.lit(True).alias("failed"), "last_process"), allowMissingColumns=True
    )


@query(given(fx.QUALITY, f"""
select sample_id, frame_index, {s6("left_position_error::float::double")} as l, {s6("right_position_error::float::double")} as r,
       left_reachable, right_collision, null::integer as image_height, {s6("(value / 7)::float::double")} as q from fx_quality"""))  # fmt: skip
def trajectory_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Rows in the fixed schema: floats, NULL for what is missing."""
    nan = F.lit(float("nan"))
    df = fx.quality(spark, sf).withColumns(
        {
            "left_position_error": F.coalesce("left_position_error", nan),
            "left_joint_position": F.array(F.col("value") / 7, nan),
        }
    )
    out = to_trajectory_schema(df)
    return out.select(
        *KEYS,
        q6(F.col("left_position_error").cast("double")).alias("l"),
        q6(F.col("right_position_error").cast("double")).alias("r"),
        "left_reachable",
        "right_collision",
        "image_height",
        q6(F.col("left_joint_position")[0].cast("double")).alias("q"),
    )


def solved(spark: SparkSession, sf: str) -> DataFrame:
    """Solved sides as long rows; the right one ends after 40 frames."""
    q = fx.quality(spark, sf)
    v = F.col("value")
    sides = []
    for s, k in (("left", 1.0), ("right", 1.5)):
        sides.append(
            F.struct(
                F.lit(s).alias("side"),
                F.array(*[v * k * (i + 1) / 10 for i in range(6)]).alias("pose"),
                F.array(*[v * k * (i + 1) / 1000 for i in range(6)]).alias("joint_position"),
                *[F.col(f"{s}_{n}").alias(n) for n in ("reachable", "position_error", "orientation_error")],
                (F.col("signal") / k).alias("gripper_signal"),
            )
        )
    rows = q.select(*KEYS, F.explode(F.when(F.col("frame_index") < 40, F.array(*sides)).otherwise(F.array(sides[0]))).alias("_s"))
    size = {"fps": F.lit(30.0), "image_height": F.lit(720), "image_width": F.lit(1280)}
    camera = {"intrinsics": arr(600, 0, 640, 0, 600, 360, 0, 0, 1), "camera_extrinsics": F.array(*[F.lit(float(i)) for i in range(16)])}
    return rows.select(*KEYS, "_s.*").withColumns({**size, **camera})


def complete(spark: SparkSession, sf: str) -> DataFrame:
    """Wide rows with fingers and the collisions of the joint state, which some clips have not."""
    flags = fx.quality(spark, sf).filter("left_collision is not null").select(*KEYS, F.col("left_collision").alias("collision"))
    return with_collisions(with_fingers(to_wide(solved(spark, sf)), [0.0, 0.01], [0.05, -0.05]), flags)


def _solved_sql(s: str, k: float) -> str:
    own = "true" if s == "left" else "frame_index < 40"
    arm = ", ".join(f"value * {k} * {i + 1} / 1000" for i in range(6))
    fingers = f"signal / {k} * 0.05, 0.01 + signal / {k} * -0.06"
    pose = ", ".join(f"value * {k} * {i + 1} / 10" for i in range(6))
    f = lambda e: s6(f"({e})::float::double")
    return f"""
 case when {own} then list_transform([{pose}], lambda x: {f("x")}) end as {s}_pose,
 case when {own} then list_transform([{arm}, {fingers}], lambda x: {f("x")}) end as {s}_joint_position,
 case when {own} then {s}_reachable end as {s}_reachable, case when {own} then left_collision end as {s}_collision,
 case when {own} then {f(f"{s}_position_error")} end as {s}_position_error,
 case when {own} then {f(f"{s}_orientation_error")} end as {s}_orientation_error,
 case when {own} then {f(f"signal / {k}")} end as {s}_gripper_signal"""


ROWS = f""",
fx_rows as (
  select sample_id, frame_index, 30.0::double as fps, 720 as image_height, 1280 as image_width,
         [600.0::double, 0, 640, 0, 600, 360, 0, 0, 1] as intrinsics, [x::double for x in range(16)] as camera_extrinsics,
         {_solved_sql("left", 1.0)}, {_solved_sql("right", 1.5)}
  from fx_quality)"""


@query(given(fx.QUALITY, ROWS + " select * from fx_rows"))
def trajectory_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All 21 columns of the trajectory table, from solved sides of unequal length."""
    out = to_trajectory_schema(complete(spark, sf))
    cols = []
    for f in out.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() == "float":
            c = q6(c.cast("double"))
        elif f.dataType.typeName() == "array":
            c = F.transform(c, lambda x: q6(x.cast("double")))
        cols.append(c.alias(f.name))
    return out.select(*cols)


def _accepted_sql(s: str) -> str:
    e, own = f"{s}_position_error", f"{s}_pose is not null"
    return f"""
 avg(case when {e} is not null then case when {s}_reachable then 1.0 else 0.0 end end) as {s}_r,
 count(*) filter (where {s}_collision) / nullif(count({s}_collision), 0) as {s}_c,
 case when count({s}_pose) > 0 then count(*) filter (where {own} and {e} is not null) end as {s}_valid,
 case when count({s}_pose) > 0 then count(*) filter (where {own} and {e} is null) end as {s}_invalid"""


@query(given(fx.QUALITY, ROWS + f""",
fx_m as (select sample_id, count(*) as frame_count, {_accepted_sql("left")}, {_accepted_sql("right")} from fx_rows group by 1),
fx_f as (select *, coalesce(left_r, case when right_r is not null then 1.0 end) as l, coalesce(right_r, case when left_r is not null then 1.0 end) as r from fx_m)
select sample_id, frame_count, coalesce(l > 0.9 and r > 0.9 and left_c < 0.05 and right_c < 0.05, false) as passed,
       {s6("l")} as l, {s6("r")} as r, {s6("left_c")} as lc, {s6("right_c")} as rc, left_valid, left_invalid, right_valid, right_invalid,
       ['j1'] as names, 12 as active, 'combined' as mode from fx_f"""))  # fmt: skip
def trajectory_acceptance(spark: SparkSession, sf: str) -> DataFrame:
    """The filter on the summary of complete rows: clips pass, fail, and miss collisions."""
    meta = quality.clip_summary(complete(spark, sf))
    settings = {"left": {"enabled": True, "pair_count_active": 12}}
    meta = quality.with_solver_fields(meta, {"left": ["j1"]}, settings, {"mode": "combined"})
    out = quality.quality_filter(meta)
    ratios = [("left_reachable_ratio", "l"), ("right_reachable_ratio", "r"), ("left_collision_ratio", "lc"), ("right_collision_ratio", "rc")]
    return out.select(
        "sample_id", "frame_count", F.col("render_filter_passed").alias("passed"), *[q6(F.col(c)).alias(n) for c, n in ratios],
        *[F.col(f"{s}_{n}_error_frame_count").alias(f"{s}_{n}") for s in SIDES for n in ("valid", "invalid")],
        F.col("left_joint_names").alias("names"), F.col("left_solver_collision_pair_count_active").cast("int").alias("active"),
        F.col("ik_collision_mode").alias("mode"),
    )


STRICT = """,
fx_strict as (
  select *, left_reachable_ratio is null or right_reachable_ratio is null as miss,
         left_reachable_ratio is not null and right_reachable_ratio is not null
         and (left_collision_ratio is null or right_collision_ratio is null) as no_hit,
         coalesce(left_reachable_ratio > 0.9 and right_reachable_ratio > 0.9 and left_collision_ratio < 0.05
                  and right_collision_ratio < 0.05, false) as ok from fx_meta)"""


@query(given(fx.META, STRICT + f""",
fx_n as (select count(*) as total, count(*) filter (where not miss and not no_hit) as valid, count(*) filter (where miss) as missing_ratio,
         count(*) filter (where no_hit) as missing_collision_ratio, count(*) filter (where ok) as pass_count from fx_strict)
select *, valid - pass_count as fail_count, {s6("pass_count / valid")} as pass_rate from fx_n"""))  # fmt: skip
def pass_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.pass_report(fx.meta(spark, sf), 0.9, 0.05).withColumn("pass_rate", q6(F.col("pass_rate")))


@query(given(fx.META, STRICT + " select sample_id from fx_strict where ok"))
def passing_clip_ids(spark: SparkSession, sf: str) -> DataFrame:
    return quality.passing_ids(fx.meta(spark, sf), 0.9, 0.05)


FLAGS = """,
fx_f as (select vec_id, label, vec_id // 50 as c, list_transform(embedding[1:8], lambda x: case when x > 0.15 then null when x > 0 then 1.0 else 0.0 end) as flags
         from embeddings)"""


@query(
    "with "
    + FLAGS[1:].strip()
    + " select vec_id, "
    + s6(
        """case when label % 3 = 0 then vec_id / 100.0 when label % 3 = 1 then label / 10.0
  else len(list_filter(flags, lambda f: f > 0.5)) / nullif(len(list_filter(flags, lambda f: f is not null)), 0) end"""
    )
    + " as ratio from fx_f"
)
def ratio_fallback(spark: SparkSession, sf: str) -> DataFrame:
    flags = F.transform(
        F.slice("embedding", 1, 8),
        lambda x: F.when(x > 0.15, F.lit(float("nan"))).when(x > 0, 1.0).otherwise(0.0),
    )
    third = F.pmod("label", F.lit(3))
    df = fx.table(spark, sf, "embeddings").select(
        "vec_id",
        F.when(third == 0, (F.col("vec_id") / 100.0).cast("string")).otherwise("n/a").alias("a"),
        F.when(third == 1, F.col("label") / 10.0).alias("b"),
        flags.alias("flags"),
    )
    ratio = quality.ratio_with_fallback(F.col("a"), F.col("b"), F.col("flags"))
    return df.select("vec_id", q6(ratio).alias("ratio"))


@query("""
select count(*) as indexed, count(*) filter (where o_totalprice > 100000) as rendered,
       """ + s6("count(*) filter (where o_totalprice > 100000) / count(*)") + """ as success_ratio
from orders where o_orderstatus = 'F'""")  # fmt: skip
def render_success_ratio(spark: SparkSession, sf: str) -> DataFrame:
    done = fx.table(spark, sf, "orders").filter("o_orderstatus = 'F'")
    out = quality.success_ratio(done, done.filter("o_totalprice > 100000"))
    return out.withColumn("success_ratio", q6(F.col("success_ratio")))


STATS = ", ".join(
    f"{e} as {n}"
    for e, n in (
        ("count(v)", "n"),
        (s6("avg(v)"), "mean"),
        (s6("quantile_cont(v, 0.95)"), "p95"),
        (s6("max(v)"), "max"),
    )
)


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: q6(F.col(c)) for c in ("mean", "p95", "max")})


@query(f"select event_type, {STATS} from (select event_type, case when event_type = 'error' and value > 50 then null else value end as v from events) group by 1")
def robust_statistics_by_group(spark: SparkSession, sf: str) -> DataFrame:
    e = fx.table(spark, sf, "events")
    v = F.when((F.col("event_type") == "error") & (F.col("value") > 50), F.lit(float("nan"))).otherwise(F.col("value"))
    return _rounded(quality.safe_stats(e.withColumn("v", v), "v", ["event_type"]))


@query(f"select {STATS} from (select l_extendedprice as v from lineitem)")
def robust_statistics_overall(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(quality.safe_stats(fx.table(spark, sf, "lineitem"), "l_extendedprice"))


@query(given(fx.KEYPOINTS, f""",
fx_pc as (select *, 0.2 * abs(flat[1]) as t from fx_keypoints where valid)
select sample_id, frame_index, {s6("sqrt(flat[1]*flat[1]*0.01 + 0.0004)")} as translation_error,
       floor(degrees(t)*1e3+0.5)/1e3 as rotation_error_deg from fx_pc"""))  # fmt: skip
def pose_consistency(spark: SparkSession, sf: str) -> DataFrame:
    k = fx.keypoints(spark, sf)
    f = F.col("flat")
    a, o = f[0] * 0.2, F.lit(0.0)
    stored = k.filter("valid").select(*KEYS, F.slice("flat", 1, 3).alias("t"), arr(1, 0, 0, 0, 1, 0, 0, 0, 1).alias("r"))
    turned = F.array(F.cos(a), -F.sin(a), o, F.sin(a), F.cos(a), o, o, o, F.lit(1.0))
    again = k.select(*KEYS, F.array(f[0] * 1.1, f[1] + 0.02, f[2]).alias("t"), turned.alias("r"))
    out = quality.pose_consistency(stored, again)
    return out.select(
        *KEYS,
        q6(F.col("translation_error")).alias("translation_error"),
        (F.floor(F.col("rotation_error_deg") * 1e3 + 0.5) / 1e3).alias("rotation_error_deg"),
    )


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {s6("greatest(abs(flat[1]-flat[4]), abs(flat[2]-flat[5]), abs(flat[3]-flat[6]))")} as max_abs from fx_keypoints"""))  # fmt: skip
def camera_parameter_consistency(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).withColumns({"a": F.slice("flat", 1, 3), "b": F.slice("flat", 4, 3)})
    return df.select(*KEYS, q6(quality.param_consistency(F.col("a"), F.col("b"))).alias("max_abs"))


@query(given(fx.QUALITY, f""",
fx_a as (select sample_id, avg(abs(right_position_error - left_position_error)) as dp, avg(abs(right_orientation_error - left_position_error)) as sp,
         avg(abs(right_orientation_error - left_orientation_error)) as dr, avg(abs(right_position_error - left_orientation_error)) as sr, count(*) as used_frames
         from fx_quality where left_reachable and left_position_error is not null and right_position_error is not null group by 1)
select sample_id, used_frames, {sql_spread(["dp", "sp", "dr", "sr"], ["direct_position_gap", "swapped_position_gap", "direct_rotation_gap", "swapped_rotation_gap"])},
       sp < dp and sr < dr as likely_swapped from fx_a"""))  # fmt: skip
def solver_metric_audit(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.metric_audit(
        fx.quality(spark, sf), "right_position_error", "right_orientation_error",
        "left_position_error", "left_orientation_error", "left_reachable", ["sample_id"],
    )
    gaps = ["direct_position_gap", "swapped_position_gap", "direct_rotation_gap", "swapped_rotation_gap"]
    return out.withColumns({c: q6(F.col(c)) for c in gaps})


# ---------------------------------------------------------------- arms and links


@query(given(fx.LINK_PAIRS, """,
fx_adj as (select link_a, link_b from fx_pairs where cast(link_b[5:] as integer) - cast(link_a[5:] as integer) = 1),
fx_active as (
  select link_a, link_b from fx_pairs p
  where link_a <> 'link00' and link_b <> 'link00' and distance > 0.001
    and not exists (select 1 from fx_adj a where a.link_a = p.link_a and a.link_b = p.link_b)
  union select link_a, link_b from fx_adj where link_a = 'link03')
select link_a, link_b from fx_active"""))  # fmt: skip
def active_link_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _active(spark, sf)


def _active(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fx.link_pairs(spark, sf)
    at = lambda c: F.substring(c, 5, 2).cast("int")
    adjacent = pairs.filter(at("link_b") - at("link_a") == 1)
    forced = adjacent.filter("link_a = 'link03'")
    return clearance.active_pairs(pairs, adjacent, pairs, ["link00"], forced, tolerance=0.001)


@query(given(fx.LINK_PAIRS, """
select count(*) as pair_count_total, count(*) filter (where distance > 0.001) as pair_count_active,
       count(*) filter (where not distance > 0.001) as pair_count_filtered from fx_pairs"""))  # fmt: skip
def link_pair_counts(spark: SparkSession, sf: str) -> DataFrame:
    pairs = fx.link_pairs(spark, sf)
    none = pairs.filter("false")
    return clearance.pair_counts(pairs, clearance.active_pairs(pairs, none, pairs, tolerance=0.001))


@query(given(fx.CLEARANCE, f"""
select sample_id, frame_index, bool_or(distance < 0.002) as collision,
       floor(sum(case when distance < 0.002 then (0.002 - distance) ** 2 else 0 end) * 1e12 + 0.5) / 1e12 as penalty
from fx_clearance where link_a <> 'link01' group by 1, 2"""))  # fmt: skip
def collision_flags(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.clearance(spark, sf)
    active = fx.link_distances(spark, sf).select("link_a", "link_b").distinct().filter("link_a <> 'link01'")
    out = clearance.collision_flags(c, active, 0.002)
    return out.withColumn("penalty", F.floor(F.col("penalty") * 1e12 + 0.5) / 1e12)


@query(given(fx.SIGNAL, f""",
fx_l as (select sample_id, frame_index, value as v from fx_signal where user_id % 5 <> 0),
fx_r as (select sample_id, frame_index, value * 2 as v from fx_signal where frame_index < 30 + user_id % 7),
fx_len as (select sample_id, max(l) as l, max(r) as r, greatest(max(l), max(r)) as n from (
   select sample_id, max(frame_index) + 1 as l, 0 as r from fx_l group by 1
   union all select sample_id, 0, max(frame_index) + 1 from fx_r group by 1) group by 1),
fx_s as (select sample_id, l, r, cast(unnest(range(n)) as integer) as frame_index from fx_len)
select s.sample_id, s.frame_index, {s6("coalesce(a.v, 0.0)")} as left_q, {s6("coalesce(b.v, 0.0)")} as right_q,
       s.frame_index < l as left_own, s.frame_index < r as right_own
from fx_s s left join fx_l a on a.sample_id = s.sample_id and a.frame_index = least(s.frame_index, l - 1)
left join fx_r b on b.sample_id = s.sample_id and b.frame_index = least(s.frame_index, r - 1)"""))  # fmt: skip
def combined_arm_state(spark: SparkSession, sf: str) -> DataFrame:
    s = fx.signal(spark, sf)
    left = s.filter(F.pmod("user_id", F.lit(5)) != 0).select(*KEYS, F.array("value").alias("joints"))
    right = s.filter(F.col("frame_index") < 30 + F.pmod("user_id", F.lit(7))).select(
        *KEYS, F.array(F.col("value") * 2).alias("joints")
    )
    out = clearance.combine_sides(left, right, F.array(F.lit(0.0)))
    return out.select(
        *KEYS,
        q6(F.col("left_joints")[0]).alias("left_q"),
        q6(F.col("right_joints")[0]).alias("right_q"),
        "left_own",
        "right_own",
    )


@query()
def forward_kinematics_errors(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).select(
        *KEYS,
        F.when(F.col("valid"), F.slice("flat", 1, 6)).alias("pose"),
        F.transform(F.slice("flat", 7, 6), lambda v: v * 4).alias("q"),
    )
    return arm.fk_errors(df, arm.Chain.of(arm.ARM_JOINTS), "pose", "q")


@query()
def arm_trajectories(spark: SparkSession, sf: str) -> DataFrame:
    poses = retarget(both_hands(spark, sf), Retarget(center=(0.25, 0.0, 0.1)), fps="fps")
    return solve_trajectories(poses, arm.Chain.of(arm.ARM_JOINTS))


@query()
def trajectory_table(spark: SparkSession, sf: str) -> DataFrame:
    """The fixed 21 columns at the end of the whole chain, built from a config."""
    from ..plans import builtin  # noqa: F401
    from ..plans.registry import build_steps

    steps = build_steps(
        [
            {"type": "retarget", "params": {"fps": "fps", "center": (0.25, 0.0, 0.1)}},
            {"type": "inverse_kinematics"},
            {"type": "write_data"},
        ]
    )
    return steps(both_hands(spark, sf)).drop("last_process")


# ---------------------------------------------------------------- sweeps

XS, ZS = sweep.axis_grid(0.15, 0.35, 0.05), sweep.axis_grid(0.0, 0.2, 0.05)
GRID = f"""
fx_x as (select unnest({XS}::double[]) as x, unnest(range({len(XS)})) as ix), fx_z as (select unnest({ZS}::double[]) as z, unnest(range({len(ZS)})) as iz),
fx_grid as (select x, z, cast(ix * {len(ZS)} + iz as integer) as ord from fx_x cross join fx_z),"""
PER_CLIP = """,
fx_pt as (
  select g.ord, g.x, g.z, q.sample_id,
    avg(case when left_position_error is not null then case when left_position_error * (1 + abs(x - 0.25)) <= 0.0095 then 1.0 else 0.0 end end) as lr,
    avg(case when right_position_error is not null then case when right_position_error * (1 + z) <= 0.0075 then 1.0 else 0.0 end end) as rr
  from fx_quality q cross join fx_grid g group by 1, 2, 3, 4)"""


def per_point(spark: SparkSession, sf: str) -> DataFrame:
    """Reachable ratios per grid point and clip: the errors grow with the distance from a centre."""
    df = sweep.with_grid(fx.quality(spark, sf), XS, ZS)
    x, z = F.col("point")["x"], F.col("point")["z"]
    left = F.col("left_position_error") * (1 + F.abs(x - 0.25)) <= 0.0095
    right = F.col("right_position_error") * (1 + z) <= 0.0075
    return df.groupBy("point", "sample_id").agg(
        quality.reachable_ratio(left, F.col("left_position_error"), F.col("left_orientation_error")).alias("left_ratio"),
        quality.reachable_ratio(right, F.col("right_position_error"), F.col("right_orientation_error")).alias("right_ratio"),
    )


@query(given(GRID + fx.QUALITY, PER_CLIP + f" select ord, sample_id, {s6('lr')} as l, {s6('rr')} as r from fx_pt"))
def grid_sweep_ratios(spark: SparkSession, sf: str) -> DataFrame:
    return per_point(spark, sf).select(
        F.col("point")["ord"].alias("ord"), "sample_id", q6(F.col("left_ratio")).alias("l"), q6(F.col("right_ratio")).alias("r")
    )


KINDS = {
    "left": "lr", "right": "rr", "mean": "(lr + rr) / 2", "min": "case when lr is not null and rr is not null then least(lr, rr) end",
    "pass_ratio": "case when coalesce(lr > 0.8 and rr > 0.8, false) then 1.0 else 0.0 end",
}


@query(given(GRID + fx.QUALITY, PER_CLIP + " select ord, sample_id, " + ", ".join(f"{s6(e)} as {k}" for k, e in KINDS.items()).replace(" as left", " as o_left").replace(" as right", " as o_right") + " from fx_pt"))
def sweep_objectives(spark: SparkSession, sf: str) -> DataFrame:
    name = {"left": "o_left", "right": "o_right"}
    cols = [
        q6(sweep.objective(F.col("left_ratio"), F.col("right_ratio"), k, 0.8)).alias(name.get(k, k)) for k in KINDS
    ]
    return per_point(spark, sf).select(F.col("point")["ord"].alias("ord"), "sample_id", *cols)


@query(given(GRID + fx.QUALITY, PER_CLIP + f""",
fx_sum as (
  select ord, x, z, avg({KINDS["min"]}) as objective, count({KINDS["min"]}) as valid_sample_count, count(*) as sample_count,
         count(*) filter (where lr > 0.8 and rr > 0.8) as pass_count from fx_pt group by 1, 2, 3)
select ord, x, z, {s6("objective")} as objective, valid_sample_count, sample_count, pass_count, {s6("pass_count / sample_count")} as pass_ratio
from fx_sum where objective is not null order by round(fx_sum.objective, 9) desc, ord limit 7"""))  # fmt: skip
def sweep_ranking(spark: SparkSession, sf: str) -> DataFrame:
    points = sweep.point_summary(per_point(spark, sf), "min", 0.8)
    top = sweep.rank_points(points, 7)
    return top.select(
        F.col("point")["ord"].alias("ord"),
        F.col("point")["x"].alias("x"),
        F.col("point")["z"].alias("z"),
        q6(F.col("objective")).alias("objective"),
        "valid_sample_count",
        "sample_count",
        "pass_count",
        q6(F.col("pass_ratio")).alias("pass_ratio"),
    )


@query()
def workspace_sweep(spark: SparkSession, sf: str) -> DataFrame:
    """The whole chain per grid point: retarget once, solve the arms at every point."""
    chain = arm.Chain.of(arm.ARM_JOINTS)
    return sweep_workspace(both_hands(spark, sf), XS, ZS, chain)

