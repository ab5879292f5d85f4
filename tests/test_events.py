"""The ledger as a log: order settles claims, folding in parts equals folding at once."""

import datetime as dt
import random

from trajloom.operators import events, ledger

EVENTS = "sample_id string, at timestamp, seq long, kind string, payload string, worker string, result string, error string"
T0 = dt.datetime(2024, 5, 1)


def at(k):
    return T0 + dt.timedelta(seconds=k)


def log(spark, rows):
    return spark.createDataFrame([(i, at(t), n, kind, p.get("payload"), p.get("worker"), p.get("result"), p.get("error")) for i, t, n, kind, p in rows], EVENTS)


def test_two_workers_claim_one_task(spark):
    rows = [
        ("a", 0, 0, "sync", {"payload": "p"}), ("a", 5, 2, "claim", {"worker": "late"}), ("a", 5, 1, "claim", {"worker": "first"}),
        ("a", 9, 0, "complete", {"result": "r", "worker": "first"}), ("b", 1, 0, "claim", {"worker": "x"}), ("b", 2, 0, "complete", {"result": "?"}),
        ("c", 1, 0, "sync", {"payload": "q"}), ("c", 2, 0, "claim", {"worker": "first"}), ("c", 3, 0, "fail", {"error": "e", "worker": "first"}),
        ("c", 4, 0, "claim", {"worker": "late"}), ("c", 5, 0, "recover", {}), ("c", 6, 0, "other", {}),
    ]
    own = log(spark, rows)
    folded = events.fold(spark.createDataFrame([], ledger.SCHEMA), own)
    got = {r.sample_id: r for r in folded.collect()}
    assert set(got) == {"a", "c"}  # nothing brought b in
    assert (got["a"].status, got["a"].attempts, got["a"].summary, got["a"].worker) == ("completed", 1, "r", None)
    assert (got["c"].status, got["c"].attempts, got["c"].last_error) == ("pending", 2, ledger.RECOVERED)
    assert [(r.sample_id, r.worker, r.seq) for r in events.lost_claims(folded).collect()] == [("a", "late", 2)]
    counts = {(r.worker, r.outcome): r.n for r in events.outcomes(folded, own).collect()}
    assert counts[("late", "skipped")] == 1 and counts[("first", "completed")] == 1 and counts[("first", "failed")] == 1


def test_folding_in_parts_equals_folding_at_once(spark):
    rng, rows = random.Random(2), []
    for k in range(600):
        kind = rng.choice(["sync", "claim", "claim", "complete", "fail", "reset", "recover"])
        rows.append((f"s{rng.randint(0, 40)}", k // 3, k % 3, kind, {"payload": f"p{k}", "worker": f"w{k % 2}", "result": f"r{k}", "error": f"e{k}"}))
    none = spark.createDataFrame([], ledger.SCHEMA)
    whole = events.fold(none, log(spark, rows))
    half = events.fold(none, log(spark, rows[:300])).drop("lost")
    parts = events.fold(half, log(spark, rows[300:]))
    cols = [c for c in whole.columns if c != "lost"]
    key = lambda df: sorted((tuple(r) for r in df.select(cols).collect()), key=str)
    assert key(whole) == key(parts)


def test_one_event_does_what_the_batch_step_does(spark):
    rows = [(s, st, "p", ["a"], ["t"], 2, at(0), at(0), "old", w, at(0), None, "s") for s, st, w in (("i", "in_progress", "w"), ("p", "pending", None), ("c", "completed", None))]
    tasks = spark.createDataFrame(rows, ledger.SCHEMA)
    ids = tasks.select("sample_id")
    now = log(spark, [("x", 50, 0, "sync", {})]).selectExpr("max(at)").first()[0]
    from pyspark.sql import functions as F

    t = F.lit(now)
    steps = {
        "claim": lambda: ledger.claim(tasks, ids, F.lit("w2"), t),
        "complete": lambda: ledger.complete(tasks, ids.withColumn("result", F.lit("r")), t),
        "fail": lambda: ledger.fail(tasks, ids.withColumn("error", F.lit("e")), t),
        "reset": lambda: ledger.reset(tasks, ids, t),
        "recover": lambda: ledger.recover(tasks, t),
        "sync": lambda: ledger.sync(tasks, ids.withColumn("payload", F.lit("new")), t).drop("_sync"),
    }
    key = lambda df: sorted(tuple(r) for r in df.select(*tasks.columns).collect())
    for kind, run in steps.items():
        made = log(spark, [(i, 50, 0, kind, {"payload": "new", "worker": "w2", "result": "r", "error": "e"}) for i in "ipc"])
        assert key(events.fold(tasks, made)) == key(run()), kind
