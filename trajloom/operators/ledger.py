"""Task ledger: every clip's state as a table, every transition a DataFrame to DataFrame step.

States: pending, in_progress, completed. A failure goes back to pending with its
error. Transitions work on whole batches; the caller writes the result as a new
version of the table. Columns: ``sample_id, status, payload, artifacts,
temp_artifacts, attempts, created_at, updated_at, last_error, worker, started_at,
completed_at, summary``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATUSES = ("pending", "in_progress", "completed")  # fixed values
RECOVERED = "Recovered from unfinished in_progress task."  # fixed value

SCHEMA = (
    "sample_id string, status string, payload string, artifacts array<string>, temp_artifacts array<string>, "
    "attempts int, created_at timestamp, updated_at timestamp, last_error string, worker string, "
    "started_at timestamp, completed_at timestamp, summary string"
)


def _typed(name: str) -> Column:
    kind = dict(part.strip().split(" ", 1) for part in SCHEMA.split(", "))[name]
    return F.lit(None).cast(kind)


def _none() -> Column:
    return F.array().cast("array<string>")


def _change(tasks: DataFrame, when: Column, changes: dict[str, Column]) -> DataFrame:
    cols = {c: F.when(when, v.cast(tasks.schema[c].dataType)).otherwise(F.col(c)) for c, v in changes.items()}
    return tasks.withColumns(cols)


def _flagged(tasks: DataFrame, ids: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Join the ids (and their payload) to the tasks; ``_hit`` marks the matches.

    Of several rows for one id the last counts: by ``at`` if there is such a column, then
    by the payload itself, so the outcome does not depend on how rows are dealt.
    """
    marked = _last(ids, extra).withColumn("_hit", F.lit(True))
    return tasks.join(marked, "sample_id", "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)))


def _last(rows: DataFrame, extra: Sequence[str]) -> DataFrame:
    """One row per id with the ``extra`` columns of its last row."""
    order = [*(["at"] if "at" in rows.columns else []), *extra]
    if not order:
        return rows.select("sample_id").distinct()
    top = rows.groupBy("sample_id").agg(F.max(F.struct(*order)).alias("_top"))
    return top.select("sample_id", *[F.col("_top")[c].alias(c) for c in extra])


def sync(tasks: DataFrame, clips: DataFrame, now: Column) -> DataFrame:
    """Upsert discovered clips (``sample_id, payload``).

    New ids come in pending with no attempts; known ids get the payload and
    ``updated_at`` only; ids not discovered stay as they are. ``_sync`` says which
    (new, refreshed, or NULL).
    """
    found = _last(clips, ["payload"]).withColumnRenamed("payload", "_payload")
    found = found.withColumn("_found", F.lit(True))
    both = tasks.withColumn("_known", F.lit(True)).join(found, "sample_id", "full_outer")
    known, seen = F.col("_known").isNotNull(), F.col("_found").isNotNull()
    fresh = ~known & seen
    cols = {
        "status": F.when(fresh, "pending").otherwise(F.col("status")),
        "payload": F.when(seen, F.col("_payload")).otherwise(F.col("payload")),
        "artifacts": F.when(fresh, _none()).otherwise(F.col("artifacts")),
        "temp_artifacts": F.when(fresh, _none()).otherwise(F.col("temp_artifacts")),
        "attempts": F.when(fresh, 0).otherwise(F.col("attempts")),
        "created_at": F.when(fresh, now).otherwise(F.col("created_at")),
        "updated_at": F.when(seen, now).otherwise(F.col("updated_at")),
        "_sync": F.when(fresh, "new").when(seen, "refreshed"),
    }
    cols = {k: v for k, v in cols.items() if k == "_sync" or k in tasks.columns}
    return both.withColumns(cols).drop("_known", "_found", "_payload")


def sync_counts(synced: DataFrame) -> DataFrame:
    """How many tasks a sync added and refreshed."""
    return synced.agg(
        F.count_if(F.col("_sync").eqNullSafe("new")).alias("new"),
        F.count_if(F.col("_sync").eqNullSafe("refreshed")).alias("refreshed"),
    )


def claim(tasks: DataFrame, ids: DataFrame, worker: Column, now: Column) -> DataFrame:
    """Pending tasks among ``ids`` become in_progress; others are not touched."""
    df = _flagged(tasks, ids)
    hit = F.col("_hit") & (F.col("status") == "pending")
    changes = {
        "status": F.lit("in_progress"),
        "worker": worker,
        "started_at": now,
        "updated_at": now,
        "last_error": F.lit(None),
        "attempts": F.col("attempts") + 1,
    }
    return _change(df, hit, changes).drop("_hit")


def complete(tasks: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Finished clips (``sample_id, result``) become completed with their summary."""
    df = _flagged(tasks, results, ["result"])
    changes = {
        "status": F.lit("completed"),
        "worker": F.lit(None),
        "completed_at": now,
        "updated_at": now,
        "last_error": F.lit(None),
        "summary": F.col("result"),
    }
    return _change(df, F.col("_hit"), changes).drop("_hit", "result")


def fail(tasks: DataFrame, results: DataFrame, now: Column) -> DataFrame:
    """Failed clips (``sample_id, error``) go back to pending; attempts are kept."""
    df = _flagged(tasks, results, ["error"])
    changes = {
        "status": F.lit("pending"),
        "worker": F.lit(None),
        "artifacts": _none(),
        "temp_artifacts": _none(),
        "updated_at": now,
        "last_error": F.col("error"),
    }
    return _change(df, F.col("_hit"), changes).drop("_hit", "error")


def reset(tasks: DataFrame, ids: DataFrame, now: Column, last_error: str | None = None) -> DataFrame:
    """Back to pending from any state: attempts 0, times and summary cleared."""
    df = _flagged(tasks, ids)
    changes = {
        "status": F.lit("pending"),
        "worker": F.lit(None),
        "artifacts": _none(),
        "temp_artifacts": _none(),
        "attempts": F.lit(0),
        "started_at": F.lit(None),
        "completed_at": F.lit(None),
        "summary": F.lit(None),
        "updated_at": now,
        "last_error": F.lit(last_error),
    }
    return _change(df, F.col("_hit"), changes).drop("_hit")


def artifact_paths(tasks: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Distinct artifact paths of some tasks: what a reset or recovery must delete."""
    some = tasks if ids is None else tasks.join(ids.select("sample_id"), "sample_id", "left_semi")
    both = F.array_union(F.coalesce("artifacts", _none()), F.coalesce("temp_artifacts", _none()))
    return some.select(F.explode(both).alias("path")).distinct()


def recover(tasks: DataFrame, now: Column) -> DataFrame:
    """Every in_progress task, discovered or not, goes back to pending with a fixed message."""
    changes = {
        "status": F.lit("pending"),
        "worker": F.lit(None),
        "artifacts": _none(),
        "temp_artifacts": _none(),
        "updated_at": now,
        "last_error": F.lit(RECOVERED),
    }
    was = F.col("status") == "in_progress"
    return _change(tasks.withColumn("_hit", was), F.col("_hit"), changes).drop("_hit")


def recovered(tasks: DataFrame) -> DataFrame:
    """Ids and artifact lists a recovery will free."""
    return tasks.filter(F.col("status") == "in_progress").select("sample_id", "artifacts", "temp_artifacts")


def pending(tasks: DataFrame, ids: DataFrame | None = None, limit: int | None = None) -> DataFrame:
    """Pending tasks in id order. ``ids=None`` means all; an empty table of ids means none."""
    df = tasks.filter(F.col("status") == "pending")
    if ids is not None:
        df = df.join(ids.select("sample_id"), "sample_id", "left_semi")
    df = df.orderBy("sample_id")
    return df if limit is None else df.limit(max(0, int(limit)))


def payloads(tasks: DataFrame, ids: DataFrame) -> DataFrame:
    """Payload by id."""
    return tasks.join(ids.select("sample_id"), "sample_id", "left_semi").select("sample_id", "payload")


def completed_ids(tasks: DataFrame) -> DataFrame:
    """Ids of the completed tasks in order."""
    return tasks.filter(F.col("status") == "completed").select("sample_id").orderBy("sample_id")


def summary(tasks: DataFrame) -> DataFrame:
    """Tasks per status; the three base statuses appear even when empty."""
    spark = tasks.sparkSession
    base = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in STATUSES])).alias("status"))
    zero = base.withColumn("n", F.lit(0).cast("bigint"))
    counts = tasks.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
    return counts.unionByName(zero).groupBy("status").agg(F.sum("n").alias("n"))


def _add(have: str, new: Column) -> Column:
    return F.array_union(F.coalesce(F.col(have), _none()), new)


def _grouped(paths: DataFrame) -> DataFrame:
    """All paths of an id in one list: rows by ``at`` if there is such a column, then by their paths."""
    order = [c for c in ("at", "paths") if c in paths.columns]
    rows = F.sort_array(F.collect_list(F.when(F.col("paths").isNotNull(), F.struct(*order))))
    lists = F.array_distinct(F.flatten(F.transform(rows, lambda r: r["paths"])))
    return paths.groupBy("sample_id").agg(lists.alias("_p"))


def artifacts_add(tasks: DataFrame, paths: DataFrame, now: Column, column: str = "artifacts") -> DataFrame:
    """Append paths (``sample_id, paths``) that are not listed yet; order is kept."""
    df = tasks.join(_grouped(paths), "sample_id", "left")
    new = F.size(F.array_except(F.col("_p"), F.coalesce(F.col(column), _none()))) > 0
    hit = F.col("_p").isNotNull() & new
    return df.withColumns(
        {
            column: F.when(hit, _add(column, F.col("_p"))).otherwise(F.col(column)),
            "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
        }
    ).drop("_p")


def artifacts_remove(tasks: DataFrame, paths: DataFrame, now: Column, columns: Sequence[str] = ("temp_artifacts",)) -> DataFrame:
    """Remove paths (``sample_id, paths``) from the given lists."""
    df = tasks.join(_grouped(paths), "sample_id", "left")
    hit = F.col("_p").isNotNull()

    def without(c: str) -> Column:
        return F.filter(F.col(c), lambda x: ~F.array_contains(F.col("_p"), x))

    cols = {c: F.when(hit, without(c)).otherwise(F.col(c)) for c in columns}
    return df.withColumns({**cols, "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}).drop("_p")


def artifacts_discard(tasks: DataFrame, paths: DataFrame, now: Column) -> DataFrame:
    """Remove paths from both lists; an empty path list changes nothing."""
    some = paths.filter(F.size("paths") > 0)
    return artifacts_remove(tasks, some, now, ("artifacts", "temp_artifacts"))


def carry_visualize(clips: DataFrame, tasks: DataFrame) -> DataFrame:
    """Discovered clips keep the ``visualize`` flag their task already has in its payload."""
    old = tasks.select("sample_id", F.get_json_object("payload", "$.visualize").cast("boolean").alias("_v"))
    return clips.join(old, "sample_id", "left").withColumn("visualize", F.coalesce("_v", "visualize")).drop("_v")


def prepare(
    tasks: DataFrame, clips: DataFrame, now: Column, resume: bool = True, limit: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Start of a run: the new ledger and the clips to work on.

    With ``resume``: recover, carry the flags, sync, take what is pending among
    the discovered clips. Without: discovered clips are reset, completed ones too.
    ``clips`` has ``sample_id, video_path, data_path, visualize``.
    """
    ledger = recover(tasks, now) if resume else tasks
    found = carry_visualize(clips, ledger) if resume else clips
    found = found.withColumn("payload", F.to_json(F.struct("sample_id", "video_path", "data_path", "visualize")))
    ledger = sync(ledger, found, now).drop("_sync")
    if not resume:
        ledger = reset(ledger, found, now)
    return ledger, pending(ledger, found, limit)


def run_summary(results: DataFrame) -> DataFrame:
    """Completed, failed and skipped (claim lost) clips of a run, from ``outcome``."""
    return results.agg(*[F.count_if(F.col("outcome").eqNullSafe(o)).alias(o) for o in ("completed", "failed", "skipped")])


# ---------------------------------------------------------------- reports


def _with_ratio(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "completion_ratio": F.when(F.col("total") > 0, F.col("completed") / F.col("total")).otherwise(0.0),
            "complete": (F.col("total") > 0) & (F.col("completed") == F.col("total")),
        }
    )


def status_report(tasks: DataFrame, ledger: str = "ledger", total: bool = False) -> DataFrame:
    """Counts per ledger, zero-filled, with completion ratio and verdict.

    ``total`` adds the row over all ledgers (NULL ledger, ``is_total``) through a
    rollup. A task listed twice under one ledger counts once, under its furthest status.
    """
    counts = [F.count_if(F.col("status") == s).alias(s) for s in STATUSES]
    every = F.count(F.lit(1)).alias("total")
    place = F.array_position(F.array(*map(F.lit, STATUSES)), F.col("status"))
    unique = tasks.groupBy(ledger, "sample_id").agg(F.max_by("status", place).alias("status"))
    if not total:
        return _with_ratio(unique.groupBy(ledger).agg(every, *counts))
    rolled = unique.rollup(ledger).agg(every, *counts, (F.grouping(ledger) == 1).alias("is_total"))
    return _with_ratio(rolled)


def status_samples(tasks: DataFrame, n: int) -> DataFrame:
    """First ``n`` ids of each unfinished status and how many more there are.

    The rank filter is pushed below the shuffle, so a status shared by most tasks
    sends only ``n`` rows per input partition.
    """
    open_tasks = tasks.filter(F.col("status") != "completed")
    w = Window.partitionBy("status").orderBy("sample_id")
    top = open_tasks.select("status", "sample_id").withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)
    sizes = open_tasks.groupBy("status").agg(F.count(F.lit(1)).alias("_n"))
    remaining = F.greatest(F.col("_n") - n, F.lit(0)).alias("remaining")
    return top.join(sizes, "status").select("status", "sample_id", "rank", remaining)
