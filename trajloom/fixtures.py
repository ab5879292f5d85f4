"""Tables of the data model derived from the given test tables.

Each fixture is declared twice, in DataFrame operations and in SQL, so that the
queries and their checks start from the same rows. Every fixture reads its whole
source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.cleaning import finite
from .operators.blocks import bounded_parts, number_frames
from .operators.hands import HAND_JOINTS

METACARPALS = ["IndexFingerMetacarpal", "MiddleFingerMetacarpal", "RingFingerMetacarpal", "LittleFingerMetacarpal"]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def signal(spark: SparkSession, sf: str) -> DataFrame:
    """One clip per user: the ordered event values, unknown on errors."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    ranked = number_frames(events, ["user_id"], [F.col("ts"), F.col("event_id")], F.date_trunc("day", "ts"))
    known = F.when(F.col("event_type") != "error", F.least(F.col("value") / 100.0, F.lit(1.0)))
    return ranked.select(
        F.col("user_id").cast("string").alias("sample_id"), "user_id", "frame_index", known.alias("signal"), "event_type", "value"
    )


SIGNAL = """
fx_signal as (
  select cast(user_id as varchar) as sample_id, user_id,
         cast(row_number() over (partition by user_id order by ts, event_id) - 1 as integer) as frame_index,
         case when event_type <> 'error' then least(value / 100.0, 1.0) end as signal, event_type, value
  from events)"""


def quality(spark: SparkSession, sf: str) -> DataFrame:
    """Errors, reachability and collisions of both sides per frame."""
    ok = F.col("event_type") != "error"
    user = F.col("user_id")
    left = F.when(ok & (F.pmod(user, F.lit(10)) != 0) & (F.pmod(user, F.lit(17)) != 0), F.col("value") / 11000.0)
    right = F.when(ok & (F.pmod(user, F.lit(17)) != 0), F.col("value") / 13000.0)
    return signal(spark, sf).withColumns(
        {
            "left_position_error": left,
            "right_position_error": right,
            "left_orientation_error": left * 2.0,
            "right_orientation_error": right * 3.0,
            "left_reachable": F.coalesce(left <= 0.01, F.lit(False)),
            "right_reachable": F.coalesce(right <= 0.01, F.lit(False)),
            "left_collision": F.when(F.pmod(user, F.lit(7)) != 0, (F.col("event_type") == "signup") & (F.col("value") > 90)),
            "right_collision": (F.col("event_type") == "click") & (F.col("value") > 90),
        }
    )


QUALITY = (
    SIGNAL
    + """,
fx_err as (
  select *, case when event_type <> 'error' and user_id % 10 <> 0 and user_id % 17 <> 0 then value / 11000.0 end as left_position_error,
         case when event_type <> 'error' and user_id % 17 <> 0 then value / 13000.0 end as right_position_error
  from fx_signal),
fx_quality as (
  select *, left_position_error * 2.0 as left_orientation_error, right_position_error * 3.0 as right_orientation_error,
         coalesce(left_position_error <= 0.01, false) as left_reachable,
         coalesce(right_position_error <= 0.01, false) as right_reachable,
         case when user_id % 7 <> 0 then event_type = 'signup' and value > 90 end as left_collision,
         (event_type = 'click' and value > 90) as right_collision
  from fx_err)"""
)

# Clip metadata as the quality fixture implies it; the ratios follow the definitions, written out in SQL.
META = (
    QUALITY
    + """,
fx_meta as (
  select sample_id, min(user_id) as user_id, count(*) as frames,
         avg(case when left_position_error is not null then case when left_reachable then 1.0 else 0.0 end end) as left_reachable_ratio,
         avg(case when right_position_error is not null then case when right_reachable then 1.0 else 0.0 end end) as right_reachable_ratio,
         count(*) filter (where left_collision) / nullif(count(left_collision), 0) as left_collision_ratio,
         count(*) filter (where right_collision) / count(*) as right_collision_ratio
  from fx_quality group by sample_id)"""
)


def meta(spark: SparkSession, sf: str) -> DataFrame:
    """One row of ratios per clip."""
    from .operators.quality import clip_summary

    return clip_summary(quality(spark, sf)).select(
        "sample_id", "left_reachable_ratio", "right_reachable_ratio", "left_collision_ratio", "right_collision_ratio"
    )


def keypoints(spark: SparkSession, sf: str) -> DataFrame:
    """Hand keypoints from embeddings: 50 frames per clip, label 0 invalid."""
    e = table(spark, sf, "embeddings")
    flat = F.transform(F.slice("embedding", 1, 63), lambda x: x.cast("double") * 0.5)
    rows = F.sequence(F.lit(0), F.lit(20))
    return (
        e.withColumn("_flat", flat)
        .select(
            F.expr("cast(vec_id div 50 as string)").alias("sample_id"),
            F.expr("cast(vec_id % 50 as int)").alias("frame_index"),
            F.transform(rows, lambda i: F.slice("_flat", i * 3 + 1, 3)).alias("keypoints"),
            F.col("_flat").alias("flat"),
            (F.col("label") != 0).alias("valid"),
        )
    )


KEYPOINTS = """
fx_keypoints as (
  select cast(vec_id // 50 as varchar) as sample_id, cast(vec_id % 50 as integer) as frame_index,
         list_transform(embedding[1:63], lambda x: cast(x as double) * 0.5) as flat, label <> 0 as valid
  from embeddings)"""


def joints(spark: SparkSession, sf: str) -> DataFrame:
    """One row per joint: identity rotation, translation and confidence from the keypoint; metacarpals copy the wrist."""
    k = keypoints(spark, sf)
    names = [*HAND_JOINTS, *METACARPALS]
    pairs = F.array(*[F.struct(F.lit(n).alias("joint"), F.lit(i if i < 21 else 0).alias("i")) for i, n in enumerate(names)])
    rows = k.withColumn("_j", F.explode(pairs)).withColumn("_p", F.col("keypoints")[F.col("_j")["i"]])
    p = F.col("_p")
    one, zero = F.lit(1.0), F.lit(0.0)
    return rows.select(
        "sample_id",
        "frame_index",
        F.col("_j")["joint"].alias("joint"),
        F.array(one, zero, zero, p[0], zero, one, zero, p[1], zero, zero, one, p[2], zero, zero, zero, one).alias("m"),
        finite(F.abs(p[0]) * 4.0).alias("confidence"),
    )


JOINTS = KEYPOINTS + """,
fx_names as (select unnest([{names}]) as joint, unnest([{at}]) as i),
fx_joints as (
  select sample_id, frame_index, joint, flat[3 * i + 1] as x, flat[3 * i + 2] as y, flat[3 * i + 3] as z,
         abs(flat[3 * i + 1]) * 4.0 as confidence
  from fx_keypoints cross join fx_names)""".format(
    names=", ".join(f"'{n}'" for n in [*HAND_JOINTS, *METACARPALS]),
    at=", ".join(str(i if i < 21 else 0) for i in range(25)),
)


def camera(spark: SparkSession, sf: str) -> DataFrame:
    """Camera per frame: rotation about z by 0.01 rad per frame, 0.1 m along x."""
    k = keypoints(spark, sf).select("sample_id", "frame_index")
    a = F.col("frame_index") * F.lit(0.01)
    c, s, o, i = F.cos(a), F.sin(a), F.lit(0.0), F.lit(1.0)
    m = F.array(c, -s, o, F.lit(0.1), s, c, o, o, o, o, i, o, o, o, o, i)
    return k.withColumn("camera", m)


def paths(spark: SparkSession, sf: str) -> DataFrame:
    """Page paths without query and fragment."""
    return table(spark, sf, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("path"))


PATHS = """
fx_paths as (select page_id, regexp_replace(url, '[?#].*$', '') as path from pages)"""


def catalog(spark: SparkSession, sf: str) -> DataFrame:
    """Clip catalog: pages, with the fields of their labels where they have some."""
    labels = table(spark, sf, "labels")
    p = paths(spark, sf)
    return p.join(labels, p.page_id == labels.doc_id, "left").select(
        F.concat("path", F.lit("/"), F.col("page_id").cast("string"), F.lit(".mp4")).alias("path"),
        F.concat(F.lit("d"), F.pmod("page_id", F.lit(3)).cast("string")).alias("dataset_name"),
        F.col("quality").alias("required"),
        (F.col("toxic") == 1).alias("multi_hand_flag"),
        F.when(F.pmod("page_id", F.lit(4)) == 0, F.concat(F.lit("/poses/"), F.col("page_id").cast("string"))).alias(
            "pose3d_hand_path"
        ),
        F.lit(False).alias("has_ik_result"),
        F.lit(False).alias("rendered"),
        "page_id",
    )


CATALOG = (
    PATHS
    + """,
fx_catalog as (
  select p.path || '/' || p.page_id || '.mp4' as path, 'd' || (p.page_id % 3) as dataset_name, l.quality as required,
         (l.toxic = 1) as multi_hand_flag, case when p.page_id % 4 = 0 then '/poses/' || p.page_id end as pose3d_hand_path,
         false as has_ik_result, false as rendered, p.page_id
  from fx_paths p left join labels l on p.page_id = l.doc_id)"""
)


def tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Task ledger from orders."""
    o = table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string")
    status = (
        F.when(F.col("o_orderstatus") == "P", "pending").when(F.col("o_orderstatus") == "O", "in_progress").otherwise("completed")
    )
    return o.select(
        key.alias("sample_id"),
        status.alias("status"),
        F.concat(F.lit('{"sample_id":"'), key, F.lit('","visualize":'), (F.col("o_totalprice") > 200000).cast("string"), F.lit("}")).alias(
            "payload"
        ),
        F.array(F.concat(F.lit("a"), key), F.lit("shared")).alias("artifacts"),
        F.array(F.concat(F.lit("t"), key)).alias("temp_artifacts"),
        F.pmod("o_orderkey", F.lit(4)).cast("int").alias("attempts"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderdate").alias("updated_at"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "boom").alias("last_error"),
        F.when(status == "in_progress", "w1").alias("worker"),
        F.when(status != "pending", F.col("o_orderdate")).alias("started_at"),
        F.when(status == "completed", F.col("o_orderdate")).alias("completed_at"),
        F.when(status == "completed", "ok").alias("summary"),
        F.pmod("o_custkey", F.lit(3)).cast("int").alias("ledger"),
        "o_orderpriority",
        "o_custkey",
    )


TASKS = """
fx_status as (
  select *, cast(o_orderkey as varchar) as sample_id,
         case o_orderstatus when 'P' then 'pending' when 'O' then 'in_progress' else 'completed' end as status
  from orders),
fx_tasks as (
  select sample_id, status,
         '{"sample_id":"' || sample_id || '","visualize":' || (o_totalprice > 200000)::varchar || '}' as payload,
         ['a' || sample_id, 'shared'] as artifacts, ['t' || sample_id] as temp_artifacts,
         cast(o_orderkey % 4 as integer) as attempts, o_orderdate as created_at, o_orderdate as updated_at,
         case when o_orderpriority = '1-URGENT' then 'boom' end as last_error,
         case when status = 'in_progress' then 'w1' end as worker,
         case when status <> 'pending' then o_orderdate end as started_at,
         case when status = 'completed' then o_orderdate end as completed_at,
         case when status = 'completed' then 'ok' end as summary,
         cast(o_custkey % 3 as integer) as ledger, o_orderpriority, o_custkey
  from fx_status)"""


def link_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Distances between links, from line items; the two links always differ, a pair may repeat in a frame."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_discount")
    a = F.pmod("l_suppkey", F.lit(25))
    b = F.pmod(a + 1 + F.pmod("l_partkey", F.lit(24)), F.lit(25))
    name = lambda c: F.concat(F.lit("link"), F.lpad(c.cast("string"), 2, "0"))
    return li.select(
        F.col("l_orderkey").cast("string").alias("sample_id"),
        F.col("l_linenumber").alias("frame_index"),
        F.least(name(a), name(b)).alias("link_a"),
        F.greatest(name(a), name(b)).alias("link_b"),
        (F.col("l_discount") / 10.0).alias("d"),
    )


def clearance(spark: SparkSession, sf: str) -> DataFrame:
    """Smallest distance of each link pair per frame.

    Pairs hardly repeat, so grouping before the shuffle would hold a task's whole input and
    save nothing: rows are dealt by frame first, which is also what work per frame needs.
    """
    parts = bounded_parts(spark, table(spark, sf, "lineitem").count())
    rows = link_distances(spark, sf).repartition(parts, "sample_id", "frame_index")
    return _smallest(rows)


def _smallest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sample_id", "frame_index", "link_a", "link_b").agg(F.min("d").alias("distance"))


CLEARANCE = """
fx_ab as (
  select cast(l_orderkey as varchar) as sample_id, l_linenumber as frame_index, l_suppkey % 25 as a,
         (l_suppkey % 25 + 1 + l_partkey % 24) % 25 as b, l_discount / 10.0 as d
  from lineitem),
fx_clearance as (
  select sample_id, frame_index, 'link' || lpad(least(a, b)::varchar, 2, '0') as link_a,
         'link' || lpad(greatest(a, b)::varchar, 2, '0') as link_b, min(d) as distance
  from fx_ab group by all)"""


def link_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Link pairs that occur in the clearance table, with a rest distance; one in eleven touches at rest."""
    # not dealt by frame: where the count is not read, Spark drops the grouping by frame
    pairs = _smallest(link_distances(spark, sf)).groupBy("link_a", "link_b").agg(F.count("*").alias("n"))
    number = lambda c: F.substring(c, 5, 2).cast("int")
    return pairs.withColumn("distance", F.pmod(number("link_a") * 7 + number("link_b") * 3, F.lit(11)) / 100.0)


LINK_PAIRS = (
    CLEARANCE
    + """,
fx_pairs as (
  select link_a, link_b, (cast(link_a[5:] as integer) * 7 + cast(link_b[5:] as integer) * 3) % 11 / 100.0 as distance, count(*) as n
  from fx_clearance group by all)"""
)
