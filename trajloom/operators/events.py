"""The task ledger as a log of events, folded in order.

Workers append events and never change a row: what a task is follows from its events, by
time and then by number. So two workers that claim a task at once leave two events, the
order says whose claim holds, and the other one is told that it lost. Folding a ledger with
the events since gives the next ledger; a log is compacted that way, so what is folded for a
task are its events since the last time.

Events: ``sample_id, at, seq, kind`` and, as the kind asks, ``payload`` (sync), ``worker``
(claim), ``result`` (complete), ``error`` (fail). Kinds: sync, claim, complete, fail, reset,
recover; others, and events of tasks that no sync has brought in, change nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ledger import RECOVERED, SCHEMA

FIELDS = dict(part.strip().split(" ", 1) for part in SCHEMA.split(", "))
EVENT = {"at": "timestamp", "seq": "bigint", "kind": "string", "payload": "string", "worker": "string", "result": "string", "error": "string"}
LOST = "array<struct<at:timestamp,seq:bigint,worker:string>>"


def _null(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _step(s: Column, e: Column) -> Column:
    """The state behind an event."""
    kind, known = e["kind"], s["status"].isNotNull()
    new = ~known & (kind == "sync")
    seen = known & (kind == "sync")
    won = (kind == "claim") & (s["status"] == "pending")
    lost = (kind == "claim") & known & ~won
    done, failed, reset = (known & (kind == k) for k in ("complete", "fail", "reset"))
    freed = (kind == "recover") & (s["status"] == "in_progress")
    back = failed | reset | freed
    none = F.array().cast("array<string>")

    def field(name: str, *cases: tuple[Column, Column]) -> Column:
        value = s[name]
        for when, then in reversed(cases):
            value = F.when(when, then.cast(FIELDS[name])).otherwise(value)
        return value.alias(name)

    changed = new | seen | won | done | back
    return F.struct(
        field("status", (new | back, F.lit("pending")), (won, F.lit("in_progress")), (done, F.lit("completed"))),
        field("payload", (new | seen, e["payload"])),
        field("artifacts", (new | back, none)),
        field("temp_artifacts", (new | back, none)),
        field("attempts", (new | reset, F.lit(0)), (won, s["attempts"] + 1)),
        field("created_at", (new, e["at"])),
        field("updated_at", (changed, e["at"])),
        field("last_error", (won | done | reset, _null("string")), (failed, e["error"]), (freed, F.lit(RECOVERED))),
        field("worker", (won, e["worker"]), (done | back, _null("string"))),
        field("started_at", (won, e["at"]), (reset, _null("timestamp"))),
        field("completed_at", (done, e["at"]), (reset, _null("timestamp"))),
        field("summary", (done, e["result"]), (reset, _null("string"))),
        F.when(lost, F.concat(s["lost"], F.array(F.struct(e["at"].alias("at"), e["seq"].alias("seq"), e["worker"].alias("worker")))))
        .otherwise(s["lost"])
        .alias("lost"),
    )


def fold(tasks: DataFrame, events: DataFrame) -> DataFrame:
    """The ledger behind the events, with the claims that were ``lost`` in them.

    Events of one time stand by ``seq``, and equal ones by what they hold. Tasks without
    events stay as they are.
    """
    cols = [F.col(c).cast(t).alias(c) if c in events.columns else _null(t).alias(c) for c, t in EVENT.items()]
    own = events.select(F.col("sample_id").alias("_id"), F.struct(*cols).alias("e"))
    own = own.groupBy("_id").agg(F.sort_array(F.collect_list("e")).alias("_events"))
    both = tasks.join(own, F.col("sample_id").eqNullSafe(F.col("_id")), "full_outer")
    start = F.struct(*[F.col(c).cast(t).alias(c) for c, t in FIELDS.items() if c != "sample_id"], F.array().cast(LOST).alias("lost"))
    state = F.aggregate(F.coalesce("_events", F.array().cast(own.schema["_events"].dataType)), start, _step)
    rows = both.select(F.coalesce("sample_id", "_id").alias("sample_id"), state.alias("_s"))
    return rows.filter("_s.status is not null").select("sample_id", "_s.*")


def lost_claims(folded: DataFrame) -> DataFrame:
    """One row for each claim that another worker's claim, or the task's state, came before."""
    return folded.select("sample_id", F.inline("lost"))


def outcomes(folded: DataFrame, events: DataFrame) -> DataFrame:
    """Completed, failed and skipped clips by worker and kind of outcome, as rows ``worker, outcome, n``.

    A result belongs to the worker that its event names; a lost claim is skipped.
    """
    results = events.filter(F.col("kind").isin("complete", "fail"))
    named = results.select("worker", F.when(F.col("kind") == "complete", "completed").otherwise("failed").alias("outcome"))
    skipped = lost_claims(folded).select("worker", F.lit("skipped").alias("outcome"))
    return named.unionByName(skipped).groupBy("worker", "outcome").agg(F.count(F.lit(1)).alias("n"))
