"""Queries on keys, paths, cleaning and array functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..functions import cleaning as cl
from ..functions import keys
from ..functions.vectorized import keyed_uniform
from ..operators import sampling
from .base import given, q6, query, s6

KEYS = ["sample_id", "frame_index"]

NAMED = """,
fx_parts as (select page_id, path, list_filter(string_split(path, '/'), lambda p: p not in ('', '.', '..')) as parts from fx_paths),
fx_named as (select *, list_transform(parts, lambda p, i: case when i = len(parts) then regexp_replace(p, '([^/])\\.[^./]+$', '\\1') else p end) as named from fx_parts)"""


@query(given(fx.PATHS, NAMED + " select page_id, array_to_string(named[-3:], '_') as tail3, array_to_string(named, '_') as whole from fx_named"))
def path_sample_ids(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("path")
    return fx.paths(spark, sf).select("page_id", keys.sample_id(p, 3).alias("tail3"), keys.sample_id(p).alias("whole"))


@query(given(fx.PATHS, """,
fx_rel as (select page_id, case when starts_with(path, 'https://') then path[9:] else path end as rel from fx_paths),
fx_p as (select page_id, list_filter(string_split(rel, '/'), lambda p: p not in ('', '.', '..')) as parts from fx_rel),
fx_n as (select *, list_transform(parts, lambda p, i: case when i = len(parts) then regexp_replace(p, '([^/])\\.[^./]+$', '\\1') else p end) as named from fx_p)
select page_id, array_to_string(named, '_') as sample_id from fx_n"""))  # fmt: skip
def relative_sample_ids(spark: SparkSession, sf: str) -> DataFrame:
    return fx.paths(spark, sf).select("page_id", keys.sample_id_rel(F.col("path"), "https://").alias("sample_id"))


@query("""
select o_orderkey, coalesce(nullif(trim(case when o_orderstatus = 'F' then '  ' else o_orderpriority end), ''),
  nullif(trim(case when o_custkey % 2 = 0 then '' else 'c' || o_custkey end), ''), 'clip') as key from orders""")  # fmt: skip
def key_fallback(spark: SparkSession, sf: str) -> DataFrame:
    a = F.when(F.col("o_orderstatus") == "F", "  ").otherwise(F.col("o_orderpriority"))
    b = F.when(F.col("o_custkey") % 2 == 0, "").otherwise(F.concat(F.lit("c"), F.col("o_custkey").cast("string")))
    return fx.table(spark, sf, "orders").select("o_orderkey", cl.first_nonempty(a, b, default="clip").alias("key"))


@query("""
select cast(o_orderkey as varchar) as sample_id from orders
where ('0x' || md5(cast(o_orderkey as varchar))[1:13])::bigint / 4503599627370496.0 < 0.25""")  # fmt: skip
def hash_sampling_md5(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    return sampling.hash_sample(o, "sample_id", 0.25, "md5")


@query()
def hash_sampling_blake2b(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    return sampling.hash_sample(o, "sample_id", 0.25, "blake2b")


@query()
def keyed_light_draws(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("sample_id"))
    ranges = [(-0.3, 0.3), (-0.2, 0.2), (0.5, 1.0), (2.0, 8.0)]
    return o.withColumn("light", keyed_uniform(F.col("sample_id"), 7, ranges))


@query("""
select sample_id from (select cast(o_orderkey as varchar) as sample_id, row_number() over (order by cast(o_orderkey as varchar)) - 1 as r from orders)
where r % 8 = 5""")  # fmt: skip
def clip_shard(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("sample_id"))
    return sampling.shard(o, "sample_id", 8, 5)


REMOTE = """
fx_r as (select page_id, case when page_id % 2 = 0 then 'oss://bucket/' || page_id || '/a.b.mp4' else '/mnt/data/' || page_id || '/a.mp4.mp4' end as p from pages)"""


def remote(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id").cast("string")
    even = F.concat(F.lit("oss://bucket/"), i, F.lit("/a.b.mp4"))
    odd = F.concat(F.lit("/mnt/data/"), i, F.lit("/a.mp4.mp4"))
    return fx.table(spark, sf, "pages").select("page_id", F.when(F.col("page_id") % 2 == 0, even).otherwise(odd).alias("p"))


@query(given(REMOTE, """
select page_id, case when page_id % 2 = 0 then '/mnt/data/' || p[14:] else p end as loc,
       case when page_id % 2 = 0 then p else 'oss://bucket/' || p[11:] end as rem from fx_r"""))  # fmt: skip
def path_mapping(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p")
    return remote(spark, sf).select(
        "page_id",
        keys.to_local(p, "/mnt/data/", "oss://bucket").alias("loc"),
        keys.to_remote(p, "/mnt/data", "oss://bucket/").alias("rem"),
    )


@query(given(REMOTE, """
select page_id, replace(p, '.mp4', '.pose3d_hand') as sib, p[1:length(p) - 4] || '.json' as swap from fx_r"""))  # fmt: skip
def sibling_paths(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p")
    return remote(spark, sf).select(
        "page_id", keys.sibling(p, ".mp4", ".pose3d_hand").alias("sib"), keys.swap_extension(p, "json").alias("swap")
    )


@query("""
select n_nationkey, n_name, c_custkey, case when n_regionkey = 0 then 'oss://' || c_name when n_regionkey = 1 then 'oss://b/' || c_name else '/r/' || c_name end as joined
from customer join nation on c_nationkey = n_nationkey""")  # fmt: skip
def root_joining(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.table(spark, sf, "customer").join(fx.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    root = F.when(F.col("n_regionkey") == 0, "oss://").when(F.col("n_regionkey") == 1, "oss://b/").otherwise("/r//")
    rel = F.concat(F.lit("/"), "c_name")
    return df.select("n_nationkey", "n_name", "c_custkey", keys.join_root(root, rel).alias("joined"))


@query(given(fx.PATHS, """
select page_id, 'data/v' || page_id || '_ik.parquet' as k1, 'v.' || (page_id % 10) || '.json' as k2 from fx_paths"""))  # fmt: skip
def output_keys(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("page_id").cast("string")
    dotted = F.concat(F.lit("v."), F.pmod("page_id", F.lit(10)).cast("string"), F.lit("."), i)
    a = keys.output_key(F.concat(F.lit("data/v"), i), "parquet", "_ik")
    return fx.paths(spark, sf).select("page_id", a.alias("k1"), keys.output_key(dotted, ".json").alias("k2"))


@query("select s_suppkey, 'Link_x' as a, s_name as b from supplier")
def geometry_link_names(spark: SparkSession, sf: str) -> DataFrame:
    s = fx.table(spark, sf, "supplier")
    a = keys.link_name(F.concat(F.lit("Link_x_"), F.col("s_suppkey").cast("string")))
    b = keys.link_name(F.concat("s_name", F.lit("_"), F.col("s_suppkey").cast("string")))
    return s.select("s_suppkey", a.alias("a"), b.alias("b"))


# ---------------------------------------------------------------- cleaning


@query("select o_orderkey, 'run1' as run, 7 as version, 'x' as o_orderstatus from orders")
def constant_fields(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return cl.add_fields(o, {"run": "run1", "version": 7, "o_orderstatus": "x"})


@query(given(fx.KEYPOINTS, """
select sample_id, frame_index, list_transform(range(21), lambda i: list_transform(flat[3*i+1:3*i+3], lambda x: round_even(x, 2) + 0.0)) as k, 0.12::double as c
from fx_keypoints"""))  # fmt: skip
def nested_rounding(spark: SparkSession, sf: str) -> DataFrame:
    k = fx.keypoints(spark, sf).select(*KEYS, F.struct(F.col("keypoints").alias("k"), F.lit(0.125).alias("c")).alias("s"))
    out = cl.round_nested(k, 2)
    # adding 0.0 turns a negative zero into zero
    return out.select(*KEYS, F.transform("s.k", lambda p: F.transform(p, lambda x: x + 0.0)).alias("k"), F.col("s.c").alias("c"))


NUMBERS = """
fx_t as (select o_orderkey, case o_orderstatus when 'F' then cast(o_custkey as varchar) when 'O' then ' ' || o_custkey || '.5 '
  else case when o_custkey % 3 = 0 then 'nan' when o_custkey % 3 = 1 then '-' || o_custkey else 'x1' end end as t from orders)"""


@query(given(NUMBERS, f"""
select o_orderkey, {s6("case when isfinite(try_cast(trim(t) as double)) then try_cast(trim(t) as double) end")} as f,
       case when regexp_full_match(t, '[+-]?[0-9]+') then t::bigint end as i,
       case when regexp_full_match(t, '[+-]?[0-9]+') and t::bigint > 0 then t::bigint end as p from fx_t"""))  # fmt: skip
def safe_numbers(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("o_custkey").cast("string")
    third = F.pmod("o_custkey", F.lit(3))
    text = (
        F.when(F.col("o_orderstatus") == "F", c)
        .when(F.col("o_orderstatus") == "O", F.concat(F.lit(" "), c, F.lit(".5 ")))
        .otherwise(F.when(third == 0, "nan").when(third == 1, F.concat(F.lit("-"), c)).otherwise("x1"))
    )
    t = F.col("t")
    df = fx.table(spark, sf, "orders").select("o_orderkey", text.alias("t"))
    return df.select(
        "o_orderkey", q6(cl.safe_float(t)).alias("f"), cl.safe_int(t).alias("i"), cl.safe_int(t, positive=True).alias("p")
    )


HOLED = """,
fx_h as (select sample_id, frame_index, valid, list_transform(flat[1:6], lambda x: case when x > 0.1 then null else x end) as h from fx_keypoints)"""


def holed(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors with NaN where a value exceeds 0.1."""
    nan = F.lit(float("nan"))
    h = F.transform(F.slice("flat", 1, 6), lambda x: F.when(x > 0.1, nan).otherwise(x))
    return fx.keypoints(spark, sf).select(*KEYS, "valid", h.alias("h"))


def _list_sql(e: str) -> str:
    return f"list_transform({e}, lambda x: {s6('x')})"


def _rounded(c):
    return F.transform(c, q6)


@query(given(fx.KEYPOINTS, HOLED + f" select sample_id, frame_index, case when valid then {_list_sql('h')} end as flat from fx_h"))
def flattened_vectors(spark: SparkSession, sf: str) -> DataFrame:
    h = F.col("h")
    matrix = F.when(F.col("valid"), F.array(F.slice(h, 1, 3), F.slice(h, 4, 3))).otherwise(F.array(F.slice(h, 1, 3)))
    return holed(spark, sf).withColumn("v", cl.flat_vec(matrix, 6)).select(*KEYS, _rounded(F.col("v")).alias("flat"))


@query(given(fx.KEYPOINTS, HOLED + f"""
select sample_id, frame_index, case when len(list_filter(h[1:2], lambda x: x is not null)) > 0 then {_list_sql('h[1:2]')} end as vec,
       {_list_sql('h')} as seq from fx_h"""))  # fmt: skip
def normalised_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return holed(spark, sf).select(
        *KEYS,
        _rounded(cl.norm_vec(F.slice("h", 1, 2))).alias("vec"),
        _rounded(cl.norm_seq(F.col("h"))).alias("seq"),
    )


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, {_list_sql("flat[1:6]")} as a,
  case when frame_index % 3 = 0 then list_transform(range(6), lambda i: null::double)
       else {_list_sql("flat[1:2]")} || list_transform(range(4), lambda i: null::double) end as b from fx_keypoints"""))  # fmt: skip
def padded_sequences(spark: SparkSession, sf: str) -> DataFrame:
    df = fx.keypoints(spark, sf).select(
        *KEYS, F.slice("flat", 1, 6).alias("a"), F.when(F.col("frame_index") % 3 != 0, F.slice("flat", 1, 2)).alias("b")
    )
    return cl.pad_to_longest(df, ["a", "b"]).select(*KEYS, _rounded(F.col("a")).alias("a"), _rounded(F.col("b")).alias("b"))


@query(given(fx.SIGNAL, f"select sample_id, frame_index, {s6('signal')} as signal, {s6('value')} as value from fx_signal"))
def frame_explosion(spark: SparkSession, sf: str) -> DataFrame:
    """Clip arrays to one row per frame, from the blocks of ``clip_arrays``."""
    from ..operators.frames import to_clips, to_frames

    clips = to_clips(fx.signal(spark, sf), ["signal", "value"], block=32)
    return to_frames(clips, ["signal", "value"]).select(
        *KEYS, q6(F.col("signal")).alias("signal"), q6(F.col("value")).alias("value")
    )


@query(given(fx.SIGNAL, f"""
select sample_id, cast(0 as bigint) as block, cast(0 as integer) as first_frame, list({s6('value')} order by frame_index) as value from fx_signal group by 1
union all
select sample_id, frame_index // 20, min(frame_index), list({s6('value')} order by frame_index) from fx_signal where frame_index >= 20 group by 1, 2"""))  # fmt: skip
def clip_arrays(spark: SparkSession, sf: str) -> DataFrame:
    from ..operators.frames import to_clips

    frames = fx.signal(spark, sf)
    out = to_clips(frames, ["value"]).unionByName(to_clips(frames, ["value"], block=20).filter("block > 0"))
    return out.select("sample_id", "block", "first_frame", _rounded(F.col("value")).alias("value"))


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, case when valid then {_list_sql("flat[1:4]")} else [0.0, 0.0, 0.0, 0.0] end as cut,
       {_list_sql("flat[1:2] || [0.0, 0.0]")} as pad from fx_keypoints"""))  # fmt: skip
def fitted_vectors(spark: SparkSession, sf: str) -> DataFrame:
    cut = cl.fit_vec(F.when(F.col("valid"), F.slice("flat", 1, 9)), 4)
    pad = cl.fit_vec(F.slice("flat", 1, 2), 4)
    return fx.keypoints(spark, sf).select(*KEYS, _rounded(cut).alias("cut"), _rounded(pad).alias("pad"))


@query(given(fx.KEYPOINTS, f"""
select sample_id, frame_index, list_transform(flat[1:4] || [0.0, 0.0], lambda x: {s6("least(greatest(x, 0), 1)")}) as fit from fx_keypoints"""))  # fmt: skip
def fitted_samples(spark: SparkSession, sf: str) -> DataFrame:
    fit = cl.fit_samples(F.slice("flat", 1, 4), F.lit(6))
    return fx.keypoints(spark, sf).select(*KEYS, _rounded(fit).alias("fit"))


@query("""
select o_orderkey, case when o_orderstatus = 'P' then [] else ['a', 'j2', case when o_orderpriority = '1-URGENT' then 'j3' else o_orderpriority end] end as names from orders""")  # fmt: skip
def joint_name_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    third = F.when(F.col("o_orderpriority") == "1-URGENT", F.lit(None)).otherwise(F.col("o_orderpriority"))
    names = F.when(F.col("o_orderstatus") != "P", F.array(F.lit("a"), F.lit("  "), third))
    return fx.table(spark, sf, "orders").select("o_orderkey", cl.joint_names(names, "j").alias("names"))
