"""Queries on the task ledger, publish jobs and discovery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as fx
from ..operators import events, ledger, sampling
from ..sinks import writers
from ..sources import readers
from .base import given, q6, query, s6, shared_path

NOW = "2025-01-02 03:04:05"
STATE = [
    "sample_id", "status", "payload", "artifacts", "temp_artifacts", "attempts", "created_at", "updated_at",
    "last_error", "worker", "started_at", "completed_at", "summary",
]
LISTS = ("artifacts", "temp_artifacts")
TIMES = ("created_at", "updated_at", "started_at", "completed_at")


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def flat(df: DataFrame) -> DataFrame:
    """Ledger rows with lists and times as text."""
    cols = []
    for c in STATE:
        if c in LISTS:
            cols.append(F.array_join(c, ",").alias(c))
        elif c in TIMES:
            cols.append(F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c))
        else:
            cols.append(F.col(c))
    return df.select(*cols)


def changed(where: str, **values: str) -> str:
    """SQL ledger in which the rows of ``where`` take new values."""
    out = []
    for c in STATE:
        e = f"case when {where} then {values[c]} else {c} end" if c in values else c
        if c in LISTS:
            e = f"array_to_string({e}, ',')"
        if c in TIMES:
            e = f"strftime({e}, '%Y-%m-%d %H:%M:%S')"
        out.append(f"{e} as {c}")
    return " select " + ", ".join(out) + " from fx_tasks"


STAMP = f"timestamp '{NOW}'"
EMPTY = "[]::varchar[]"
PENDING = dict(status="'pending'", worker="null", artifacts=EMPTY, temp_artifacts=EMPTY, updated_at=STAMP)


def ids(df: DataFrame, condition: str) -> DataFrame:
    return df.filter(condition).select("sample_id")


@query(given(fx.TASKS, changed(
    "o_orderpriority = '2-HIGH' and status = 'pending'", status="'in_progress'", worker="'w9'", started_at=STAMP, updated_at=STAMP,
    last_error="null", attempts="attempts + 1")))
def ledger_claim(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    return flat(ledger.claim(t, ids(t, "o_orderpriority = '2-HIGH'"), F.lit("w9"), now()))


@query(given(fx.TASKS, changed(
    "o_orderpriority = '2-HIGH'", status="'completed'", worker="null", completed_at=STAMP, updated_at=STAMP, last_error="null",
    summary="'frames ' || sample_id")))
def ledger_complete(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    done = ids(t, "o_orderpriority = '2-HIGH'").withColumn("result", F.concat(F.lit("frames "), "sample_id"))
    return flat(ledger.complete(t, done, now()))


@query(given(fx.TASKS, changed("o_orderpriority = '2-HIGH'", last_error="'bad ' || sample_id", **PENDING)))
def ledger_fail(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    bad = ids(t, "o_orderpriority = '2-HIGH'").withColumn("error", F.concat(F.lit("bad "), "sample_id"))
    return flat(ledger.fail(t, bad, now()))


@query(given(fx.TASKS, changed(
    "o_orderpriority = '2-HIGH'", last_error="null", attempts="0", started_at="null", completed_at="null", summary="null", **PENDING)))
def ledger_reset(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    return flat(ledger.reset(t, ids(t, "o_orderpriority = '2-HIGH'"), now()))


@query(given(fx.TASKS, """
select distinct unnest(artifacts || temp_artifacts) as path from fx_tasks where o_orderpriority = '2-HIGH'"""))  # fmt: skip
def ledger_reset_paths(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    return ledger.artifact_paths(t, ids(t, "o_orderpriority = '2-HIGH'"))


@query(given(fx.TASKS, changed("status = 'in_progress'", last_error=f"'{ledger.RECOVERED}'", **PENDING)))
def ledger_recover(spark: SparkSession, sf: str) -> DataFrame:
    return flat(ledger.recover(fx.tasks(spark, sf), now()))


@query(given(fx.TASKS, """
select sample_id, array_to_string(artifacts, ',') as artifacts, array_to_string(temp_artifacts, ',') as temp_artifacts
from fx_tasks where status = 'in_progress'"""))  # fmt: skip
def ledger_recovered_ids(spark: SparkSession, sf: str) -> DataFrame:
    out = ledger.recovered(fx.tasks(spark, sf))
    return out.select("sample_id", *[F.array_join(c, ",").alias(c) for c in LISTS])


def discovered(spark: SparkSession, sf: str) -> DataFrame:
    """Line item orders and, for returned items, further ids the ledger does not know."""
    li = fx.table(spark, sf, "lineitem")
    key = F.col("l_orderkey").cast("string")
    known = li.filter("l_linestatus = 'F'").select(key.alias("sample_id"))
    fresh = li.filter("l_returnflag = 'R'").select(F.concat(F.lit("n"), key).alias("sample_id"))
    return known.unionByName(fresh).distinct()


FOUND = """,
fx_found as (
  select distinct sample_id from (
    select cast(l_orderkey as varchar) as sample_id from lineitem where l_linestatus = 'F'
    union all select 'n' || l_orderkey from lineitem where l_returnflag = 'R'))"""


@query(given(fx.TASKS, FOUND + f"""
select coalesce(t.sample_id, f.sample_id) as sample_id, coalesce(t.status, 'pending') as status,
       case when f.sample_id is not null then 'p' || f.sample_id else t.payload end as payload,
       array_to_string(coalesce(t.artifacts, []), ',') as artifacts, array_to_string(coalesce(t.temp_artifacts, []), ',') as temp_artifacts,
       coalesce(t.attempts, 0) as attempts,
       strftime(coalesce(t.created_at, {STAMP}), '%Y-%m-%d %H:%M:%S') as created_at,
       strftime(case when f.sample_id is not null then {STAMP} else t.updated_at end, '%Y-%m-%d %H:%M:%S') as updated_at,
       last_error, worker, strftime(started_at, '%Y-%m-%d %H:%M:%S') as started_at,
       strftime(completed_at, '%Y-%m-%d %H:%M:%S') as completed_at, summary
from fx_tasks t full join fx_found f on t.sample_id = f.sample_id"""))  # fmt: skip
def ledger_sync(spark: SparkSession, sf: str) -> DataFrame:
    clips = discovered(spark, sf).withColumn("payload", F.concat(F.lit("p"), "sample_id"))
    return flat(ledger.sync(fx.tasks(spark, sf), clips, now()))


@query(given(fx.TASKS, FOUND + """
select count(*) filter (where t.sample_id is null) as new, count(*) filter (where t.sample_id is not null) as refreshed
from fx_found f left join fx_tasks t on t.sample_id = f.sample_id"""))  # fmt: skip
def ledger_sync_counts(spark: SparkSession, sf: str) -> DataFrame:
    clips = discovered(spark, sf).withColumn("payload", F.lit("{}"))
    return ledger.sync_counts(ledger.sync(fx.tasks(spark, sf), clips, now()))


@query(given(fx.TASKS, FOUND + """
select sample_id, payload from fx_tasks where status = 'pending' and sample_id in (select sample_id from fx_found)
order by sample_id limit 40"""))  # fmt: skip
def ledger_pending(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.pending(fx.tasks(spark, sf), discovered(spark, sf), 40).select("sample_id", "payload")


@query(given(fx.TASKS, FOUND + " select sample_id, payload from fx_tasks where sample_id in (select sample_id from fx_found)"))
def ledger_payloads(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.payloads(fx.tasks(spark, sf), discovered(spark, sf))


@query(given(fx.TASKS, " select sample_id from fx_tasks where status = 'completed'"))
def ledger_completed_ids(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.completed_ids(fx.tasks(spark, sf))


@query(given(fx.TASKS, """
select s.status, count(t.status) as n from (select unnest(['pending', 'in_progress', 'completed']) as status) s
left join (select * from fx_tasks where status <> 'in_progress') t on t.status = s.status group by 1"""))  # fmt: skip
def ledger_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.summary(fx.tasks(spark, sf).filter("status <> 'in_progress'"))


@query(given(fx.TASKS, changed(
    "o_orderpriority = '3-MEDIUM'", artifacts="list_concat(artifacts, ['z' || sample_id])", updated_at=STAMP)))
def ledger_artifacts_add(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    paths = ids(t, "o_orderpriority = '3-MEDIUM'").withColumn(
        "paths", F.array(F.lit("shared"), F.concat(F.lit("z"), "sample_id"))
    )
    return flat(ledger.artifacts_add(t, paths, now()))


@query(given(fx.TASKS, changed(
    "o_orderpriority = '3-MEDIUM'", artifacts="list_filter(artifacts, lambda x: x <> 'shared')", temp_artifacts=EMPTY, updated_at=STAMP)))
def ledger_artifacts_discard(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    paths = ids(t, "o_orderpriority = '3-MEDIUM'").withColumn(
        "paths", F.array(F.lit("shared"), F.concat(F.lit("t"), "sample_id"))
    )
    return flat(ledger.artifacts_discard(t, paths, now()))


@query(given(fx.TASKS, changed("o_orderpriority = '3-MEDIUM'", temp_artifacts=EMPTY, updated_at=STAMP)))
def ledger_artifacts_remove(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    paths = ids(t, "o_orderpriority = '3-MEDIUM'").withColumn("paths", F.array(F.concat(F.lit("t"), "sample_id")))
    return flat(ledger.artifacts_remove(t, paths, now()))


def _clips(spark: SparkSession, sf: str) -> DataFrame:
    return discovered(spark, sf).select(
        "sample_id",
        F.concat(F.lit("/v/"), "sample_id").alias("video_path"),
        F.concat(F.lit("/d/"), "sample_id").alias("data_path"),
        F.lit(False).alias("visualize"),
    )


RUN_PAYLOAD = """'{"sample_id":"' || f.sample_id || '","video_path":"/v/' || f.sample_id || '","data_path":"/d/' || f.sample_id ||
       '","visualize":' || """


@query(given(fx.TASKS, FOUND + f"""
select f.sample_id, {RUN_PAYLOAD} case when contains(coalesce(t.payload, ''), 'true') then 'true' else 'false' end || '}}' as payload
from fx_found f left join fx_tasks t on t.sample_id = f.sample_id where coalesce(t.status, 'pending') <> 'completed'
order by f.sample_id limit 60"""))  # fmt: skip
def run_preparation_resume(spark: SparkSession, sf: str) -> DataFrame:
    _, work = ledger.prepare(fx.tasks(spark, sf), _clips(spark, sf), now(), resume=True, limit=60)
    return work.select("sample_id", "payload")


@query(given(fx.TASKS, FOUND + f"""
select f.sample_id, {RUN_PAYLOAD} 'false}}' as payload from fx_found f"""))  # fmt: skip
def run_preparation_fresh(spark: SparkSession, sf: str) -> DataFrame:
    _, work = ledger.prepare(fx.tasks(spark, sf), _clips(spark, sf), now(), resume=False)
    return work.select("sample_id", "payload")


@query("""
select count(*) filter (where o_orderstatus = 'F') as completed, count(*) filter (where o_orderstatus = 'P') as failed,
       count(*) filter (where o_orderstatus = 'O') as skipped from orders""")  # fmt: skip
def run_outcome_summary(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("o_orderstatus")
    outcome = F.when(o == "F", "completed").when(o == "P", "failed").otherwise("skipped")
    return ledger.run_summary(fx.table(spark, sf, "orders").select(outcome.alias("outcome")))


REPORT = """
count(*) as total, count(*) filter (where status = 'pending') as pending, count(*) filter (where status = 'in_progress') as in_progress,
count(*) filter (where status = 'completed') as completed, floor(count(*) filter (where status = 'completed') / count(*) * 1e6 + 0.5) / 1e6 as completion_ratio,
count(*) filter (where status = 'completed') = count(*) as complete"""


@query(given(fx.TASKS, f" select ledger, {REPORT} from fx_tasks group by 1"))
def status_report_per_ledger(spark: SparkSession, sf: str) -> DataFrame:
    out = ledger.status_report(fx.tasks(spark, sf))
    return out.withColumn("completion_ratio", q6(F.col("completion_ratio")))


@query(given(fx.TASKS, f"""
select ledger, false as is_total, {REPORT} from fx_tasks group by 1
union all select null, true, {REPORT} from fx_tasks"""))  # fmt: skip
def status_report_with_total(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.tasks(spark, sf)
    out = ledger.status_report(t.unionByName(t), total=True)  # a ledger listed twice counts once
    return out.withColumn("completion_ratio", q6(F.col("completion_ratio")))


@query(given(fx.TASKS, """,
fx_rank as (select status, sample_id, cast(row_number() over (partition by status order by sample_id) as integer) as rank,
            count(*) over (partition by status) as n from fx_tasks where status <> 'completed')
select status, sample_id, rank, greatest(n - 20, 0) as remaining from fx_rank where rank <= 20"""))  # fmt: skip
def status_sample_ids(spark: SparkSession, sf: str) -> DataFrame:
    return ledger.status_samples(fx.tasks(spark, sf), 20)


# ---------------------------------------------------------------- publish jobs

OUTPUTS = """,
fx_traj as (select distinct cast(l_orderkey as varchar) as sample_id from lineitem where l_discount < 0.05),
fx_m as (select sample_id from fx_tasks where o_orderpriority <> '5-LOW')"""


def outputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = fx.tasks(spark, sf)
    traj = fx.table(spark, sf, "lineitem").filter("l_discount < 0.05").select(F.col("l_orderkey").cast("string").alias("sample_id"))
    return t, traj, ids(t, "o_orderpriority <> '5-LOW'")


@query(given(fx.TASKS, OUTPUTS + """
select sample_id, '/out' as output_dir from fx_tasks where status = 'completed'
and sample_id in (select sample_id from fx_traj) and sample_id in (select sample_id from fx_m)"""))  # fmt: skip
def publish_data_index(spark: SparkSession, sf: str) -> DataFrame:
    return writers.publish_index(*outputs(spark, sf), "/out")


@query(given(fx.TASKS, OUTPUTS + """
select count(*) as n, 1 as longest_ok, cast(count(*) as bigint) as distinct_ids from fx_tasks where status = 'completed'
and sample_id in (select sample_id from fx_traj) and sample_id in (select sample_id from fx_m)"""))  # fmt: skip
def publish_index_entries(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded index entries hold every id once."""
    entries = writers.index_entries(writers.publish_index(*outputs(spark, sf), "/out"), per_entry=100)
    one = entries.select((F.size("sample_ids") <= 100).cast("int").alias("ok"), F.explode("sample_ids").alias("s"))
    per_id = one.groupBy("s").agg(F.count(F.lit(1)).alias("c"), F.min("ok").alias("ok"))
    return per_id.agg(
        F.sum("c").alias("n"), F.min("ok").alias("longest_ok"), F.count(F.lit(1)).alias("distinct_ids")
    )


@query(given(fx.TASKS, OUTPUTS + " select sample_id from fx_tasks where status = 'completed' and sample_id in (select sample_id from fx_traj)"))
def publish_render_index(spark: SparkSession, sf: str) -> DataFrame:
    t, traj, _ = outputs(spark, sf)
    return writers.publish_render_index(t, traj)


@query(given(fx.CATALOG, """,
fx_i as (select page_id from fx_catalog where dataset_name <> 'd2'),
fx_ri as (select page_id from fx_catalog where dataset_name = 'd1')
select path, page_id in (select page_id from fx_i) as has_ik_result, page_id in (select page_id from fx_ri) as rendered, page_id from fx_catalog"""))  # fmt: skip
def catalog_feedback(spark: SparkSession, sf: str) -> DataFrame:
    c = fx.catalog(spark, sf)
    key = F.col("page_id").cast("string").alias("sample_id")
    meta = c.select(key, F.col("path").alias("video_path"))
    out = writers.update_catalog(
        c, c.filter("dataset_name <> 'd2'").select(key), meta, c.filter("dataset_name = 'd1'").select(key)
    )
    return out.select("path", "has_ik_result", "rendered", "page_id")


@query("""
select o_orderkey, '{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '","missing":null}' as value from orders""")  # fmt: skip
def json_output(spark: SparkSession, sf: str) -> DataFrame:
    o = fx.table(spark, sf, "orders")
    text = F.col("value")
    out = writers.as_json(o, ["o_orderkey", "o_orderstatus", "missing"])
    return out.select(F.get_json_object(text, "$.o_orderkey").cast("bigint").alias("o_orderkey"), "value")


# ---------------------------------------------------------------- discovery


@query(given(fx.CATALOG, """,
fx_s as (select *, list_filter(string_split(path, '/'), lambda p: p not in ('', '.', '..')) as parts from fx_catalog
         where dataset_name = 'd1' and required is not null and multi_hand_flag is not distinct from false and path <> ''),
fx_t as (select *, list_transform(parts, lambda p, i: case when i = len(parts) then regexp_replace(p, '\\.[^.]+$', '') else p end) as named from fx_s)
select array_to_string(named[-3:], '_') as sample_id, path as video_path,
       coalesce(pose3d_hand_path, replace(path, '.mp4', '.pose3d_hand')) as data_path,
       ('0x' || md5(array_to_string(named[-3:], '_'))[1:13])::bigint / 4503599627370496.0 < 0.3 as visualize from fx_t"""))  # fmt: skip
def catalog_scan(spark: SparkSession, sf: str) -> DataFrame:
    return readers.scan_catalog(
        fx.catalog(spark, sf), dataset="d1", required="required", data="pose3d_hand_path", tail=3, visualize=0.3, algo="md5"
    )


@query(given(fx.CATALOG, " select path, page_id from fx_catalog order by path limit 50 offset 20"))
def catalog_page(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.page(fx.catalog(spark, sf).select("path", "page_id"), ["path"], 20, 50)


@query("""
with fx_ids as (select cast(l_orderkey as varchar) as sample_id, l_linenumber as pos from lineitem)
select i.sample_id, min(pos) as pos, o_orderpriority from fx_ids i
join orders o on cast(o.o_orderkey as varchar) = i.sample_id
where o.o_totalprice > 100000 and i.sample_id in (select cast(o_orderkey as varchar) from orders where o_orderstatus = 'F')
group by 1, 3""")  # fmt: skip
def processed_outputs(spark: SparkSession, sf: str) -> DataFrame:
    li, o = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders")
    key = F.col("o_orderkey").cast("string").alias("sample_id")
    index = li.select(F.col("l_orderkey").cast("string").alias("sample_id"), F.col("l_linenumber").alias("pos"))
    meta = o.filter("o_totalprice > 100000").select(key, "o_orderpriority")
    return readers.processed_clips(index, o.filter("o_orderstatus = 'F'").select(key), meta)


@query("""
with fx_e as (select case when l_linenumber = 1 then cast(l_orderkey as varchar) end as one, ['s' || l_linenumber, 'p' || l_partkey] as many from lineitem)
select sample_id, count(*) as n from (select one as sample_id from fx_e where one is not null union all select unnest(many) from fx_e) group by 1""")  # fmt: skip
def index_reading(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    entries = fx.table(spark, sf, "lineitem").select(
        F.when(F.col("l_linenumber") == 1, text("l_orderkey")).alias("sample_id"),
        F.array(F.concat(F.lit("s"), text("l_linenumber")), F.concat(F.lit("p"), text("l_partkey")), F.lit("")).alias("sample_ids"),
    )
    return readers.index_ids(entries).groupBy("sample_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
with fx_x as (select l_orderkey as k, unnest(['p' || l_partkey, 's' || l_suppkey]) as sample_id from lineitem where l_linenumber <= 3)
select form, sample_id, count(*) as n from fx_x, (select unnest(['line', 'indented']) as form) group by 1, 2""")  # fmt: skip
def index_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Entries written as lines, several to a list, and as the indented documents of the older writer, parsed again."""
    li = fx.table(spark, sf, "lineitem").filter("l_linenumber <= 3")
    ids = F.array(F.concat(F.lit("p"), F.col("l_partkey").cast("string")), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")))
    entries = li.groupBy("l_orderkey").agg(F.collect_list(F.struct(ids.alias("sample_ids"))).alias("e"))
    line = entries.select(F.concat(F.to_json("e"), F.lit(",")).alias("value"))
    indented = entries.select(F.regexp_replace(F.to_json("e", {"pretty": "true"}), " : ", ": ").alias("value"))
    parsed = [readers.parse_index(t).select(F.lit(f).alias("form"), "sample_id") for f, t in (("line", line), ("indented", indented))]
    return parsed[0].unionAll(parsed[1]).groupBy("form", "sample_id").agg(F.count(F.lit(1)).alias("n"))


@query("""
select cast(o_orderkey as varchar) as sample_id, case when o_orderpriority = '2-HIGH' then 'pending' else 'completed' end as status,
       cast(o_custkey as integer) as attempts from orders where o_orderpriority <> '1-URGENT'""")  # fmt: skip
def legacy_task_rows(spark: SparkSession, sf: str) -> DataFrame:
    key, n = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    body = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("7"))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit('{"attempts":'), n, F.lit("}")))
        .otherwise(F.concat(F.lit('{"status":"completed","attempts":'), n, F.lit("}")))
    )
    text = F.concat(F.lit('{"tasks":{"'), key, F.lit('":'), body, F.lit("}}"))
    rows = readers.parse_task_json(fx.table(spark, sf, "orders").select(text.alias("value")), "value")
    return rows.select("sample_id", "status", "attempts")


# ---------------------------------------------------------------- events

KIND = ("claim", "claim", "complete", "fail", "recover", "sync", "reset")


def log(spark: SparkSession, sf: str) -> DataFrame:
    """Events of two workers: one per line item, some for tasks that are not there yet."""
    li = fx.table(spark, sf, "lineitem")
    key, part = F.col("l_orderkey").cast("string"), F.col("l_partkey") + F.col("l_linenumber")
    kind = F.array(*map(F.lit, KIND))[F.pmod(part, F.lit(len(KIND))).cast("int")]
    return li.select(
        F.when(F.col("l_suppkey") % 5 == 0, F.concat(F.lit("n"), key)).otherwise(key).alias("sample_id"),
        F.col("l_shipdate").cast("timestamp").alias("at"), F.col("l_linenumber").cast("long").alias("seq"), kind.alias("kind"),
        F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("payload"),
        F.concat(F.lit("w"), (F.col("l_suppkey") % 2).cast("string")).alias("worker"),
        F.concat(F.lit("r"), F.col("l_linenumber").cast("string")).alias("result"), F.lit("broken").alias("error"),
    )


LOG = f""",
fx_log as (
  select case when l_suppkey % 5 = 0 then 'n' || l_orderkey else l_orderkey::varchar end as sample_id, l_shipdate::timestamp as ts,
         l_linenumber::bigint as seq, ({list(KIND)!r})[(l_partkey + l_linenumber) % {len(KIND)} + 1] as kind, 'p' || l_partkey as payload,
         'w' || l_suppkey % 2 as worker, 'r' || l_linenumber as result
  from lineitem),
fx_step as (select *, row_number() over (partition by sample_id order by ts, seq, kind, payload, worker, result) as i from fx_log),
fx_start as (
  select sample_id, status, payload, attempts, worker, last_error, started_at::timestamp as started_at, updated_at::timestamp as updated_at, summary
  from fx_tasks
  union all
  select distinct sample_id, null, null, null::integer, null, null, null::timestamp, null::timestamp, null from fx_log
  where sample_id not in (select sample_id from fx_tasks)),
fx_run as (
  select *, 0::bigint as i, 0::bigint as skipped, 0::bigint as skipped_w1 from fx_start
  union all
  select r.sample_id,
    case when r.status is null then case when e.kind = 'sync' then 'pending' end
         when e.kind = 'claim' and r.status = 'pending' then 'in_progress' when e.kind = 'complete' then 'completed'
         when e.kind in ('fail', 'reset') or e.kind = 'recover' and r.status = 'in_progress' then 'pending' else r.status end,
    case when e.kind = 'sync' then e.payload else r.payload end,
    case when r.status is null then case when e.kind = 'sync' then 0 end when e.kind = 'reset' then 0
         when e.kind = 'claim' and r.status = 'pending' then r.attempts + 1 else r.attempts end,
    case when r.status is null then null when e.kind = 'claim' and r.status = 'pending' then e.worker
         when e.kind in ('complete', 'fail', 'reset') or e.kind = 'recover' and r.status = 'in_progress' then null else r.worker end,
    case when r.status is null then null when e.kind in ('complete', 'reset') or e.kind = 'claim' and r.status = 'pending' then null
         when e.kind = 'fail' then 'broken' when e.kind = 'recover' and r.status = 'in_progress' then 'Recovered from unfinished in_progress task.'
         else r.last_error end,
    case when r.status is null or e.kind = 'reset' then null when e.kind = 'claim' and r.status = 'pending' then e.ts else r.started_at end,
    case when r.status is null then case when e.kind = 'sync' then e.ts end
         when e.kind in ('sync', 'complete', 'fail', 'reset') or e.kind = 'claim' and r.status = 'pending'
              or e.kind = 'recover' and r.status = 'in_progress' then e.ts else r.updated_at end,
    case when r.status is null or e.kind = 'reset' then null when e.kind = 'complete' then e.result else r.summary end,
    e.i, r.skipped + (e.kind = 'claim' and r.status <> 'pending' and r.status is not null)::int,
    r.skipped_w1 + (e.kind = 'claim' and r.status <> 'pending' and r.status is not null and e.worker = 'w1')::int
  from fx_run r join fx_step e on e.sample_id = r.sample_id and e.i = r.i + 1),
fx_end as (select * from fx_run qualify row_number() over (partition by sample_id order by i desc) = 1)"""
FOLD_TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S') as {0}"


@query(given(fx.TASKS, LOG + f"""
select sample_id, status, payload, attempts, worker, last_error, {FOLD_TIME.format("started_at")}, {FOLD_TIME.format("updated_at")}, summary,
       skipped, skipped_w1 from fx_end where status is not null""", recursive=True))  # fmt: skip
def ledger_fold(spark: SparkSession, sf: str) -> DataFrame:
    """The ledger behind a log of events, with the claims that came too late."""
    out = events.fold(fx.tasks(spark, sf), log(spark, sf))
    stamp = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)
    return out.select(
        "sample_id", "status", "payload", "attempts", "worker", "last_error", stamp("started_at"), stamp("updated_at"), "summary",
        F.size("lost").cast("long").alias("skipped"), F.size(F.filter("lost", lambda x: x["worker"] == "w1")).cast("long").alias("skipped_w1"),
    )


@query(given(fx.TASKS, LOG + """
select worker, case kind when 'complete' then 'completed' else 'failed' end as outcome, count(*) as n from fx_log where kind in ('complete', 'fail') group by 1, 2
union all select 'w1', 'skipped', sum(skipped_w1)::bigint from fx_end having sum(skipped_w1) > 0
union all select 'w0', 'skipped', sum(skipped - skipped_w1)::bigint from fx_end having sum(skipped - skipped_w1) > 0""", recursive=True))  # fmt: skip
def ledger_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """What each worker completed, failed and lost to the other."""
    own = log(spark, sf)
    return events.outcomes(events.fold(fx.tasks(spark, sf), own), own)


# ---------------------------------------------------------------- written and read back


@query(given(fx.TASKS, OUTPUTS + """
select distinct sample_id from fx_tasks where status = 'completed'
and sample_id in (select sample_id from fx_traj) and sample_id in (select sample_id from fx_m)"""))  # fmt: skip
def index_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """The published index, written as entries and read back from its files."""
    path = shared_path(spark, "index")
    t, traj, meta = outputs(spark, sf)
    writers.publish_index(t, traj, meta, "/out", path)
    done = readers.processed_clips(readers.read_index(spark, path), traj.distinct(), meta.distinct())
    return done.select("sample_id")


@query(given(fx.META, f"""
select sample_id, {s6("left_reachable_ratio")} as l, {s6("right_collision_ratio")} as r, '2024-01-02T03:04:05.000000Z' as updated_at from fx_meta"""))  # fmt: skip
def clip_meta_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Clip metadata, written as JSON and read back."""
    path = shared_path(spark, "meta")
    writers.write_clip_meta(fx.meta(spark, sf), path, F.to_timestamp(F.lit("2024-01-02 03:04:05")))
    back = readers.read_clip_meta(spark, path, "sample_id string, left_reachable_ratio double, right_collision_ratio double, updated_at string", strict=True)
    return back.select("sample_id", q6(F.col("left_reachable_ratio")).alias("l"), q6(F.col("right_collision_ratio")).alias("r"), "updated_at")
