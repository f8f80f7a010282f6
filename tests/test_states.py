
from tidewell.operators import states

TASK = "id long, status string, priority int, attempt_count int, max_attempts int, next_retry_at string, failure_kind string, next_action string, last_status_detail string, output_path string, processed_at string, updated_at string, processing_owner string, processing_started_at string, processing_heartbeat_at string"
MESSAGE = "k string, lane string, state string, attempts int, business_story_fit double, final_score double, created_at string, expires_at string, claimed_at string, sent_at string, failed_at string, updated_at string, delivery_attempts array<struct<attempt:int,status:string,started_at:string,finished_at:string,receipt:map<string,string>>>"
OUTCOME = "id long, state string, failure_kind string, next_action string, detail string, output_path string, next_retry_at string"


def _tasks(spark, *rows):
    return spark.createDataFrame([(i, st, p, n, 3, at, "", "", "", "", "", "2025-01-01", own, "", beat) for i, st, p, n, at, own, beat in rows], TASK)


def _one(df, k, key="id"):
    return {r[key]: r for r in df.collect()}[k]


def test_claim_takes_the_first_ready_and_nothing_else(spark):
    t = _tasks(spark, (1, "pending", 5, 0, "", None, None), (2, "pending", 1, None, None, None, None), (3, "retry_scheduled", 1, 1, "2025-02-01", None, None), (4, "retry_scheduled", 0, 1, "2025-04-01", None, None), (5, None, None, None, None, None, None))
    got = states.claimed(t, "w", "2025-03-01", 2)
    assert {r.id for r in got.where("processing_owner = 'w'").collect()} == {2, 3} and got.count() == 5 and got.columns == t.columns
    assert _one(got, 2).attempt_count == 1 and _one(got, 3).next_retry_at == ""
    assert states.claimed(got, "v", "2025-03-01", 10).where("processing_owner = 'w'").count() == 2
    assert states.claimed(t.limit(0), "w", "x", 3).count() == 0


def test_only_the_owner_keeps_a_lease_alive(spark):
    t = _tasks(spark, (1, "processing", 1, 1, "", "w", "2025-01-01"), (2, "processing", 1, 1, "", "w", "2025-01-01"), (3, "done", 1, 1, "", "w", "2025-01-01"))
    beats = spark.createDataFrame([(1, "w", "2025-02-01"), (1, "w", "2025-02-03"), (2, "v", "2025-02-01"), (3, "w", "2025-02-01")], "id long, owner string, at string")
    got = states.beaten(t, beats)
    assert [_one(got, i).processing_heartbeat_at for i in (1, 2, 3)] == ["2025-02-03", "2025-01-01", "2025-01-01"]
    assert {r.id for r in states.recovered(got, "2025-02-01", "2025-03-01").where("status = 'retry_scheduled'").collect()} == {2}


def test_outcomes(spark):
    t = _tasks(spark, *[(i, "processing", 1, 3 if i == 4 else 1, "", "w", "b") for i in range(1, 7)])
    o = spark.createDataFrame([(1, "done", None, None, None, "/x.md", None), (2, "done", None, None, None, "", None), (3, "retry_scheduled", "timeout", "retry_later", "d", None, "2025-05-01"), (4, "retry_scheduled", "timeout", "retry_later", "d", None, "2025-05-01"), (5, "retry_scheduled", None, None, None, None, None)], OUTCOME)
    got = states.finished(t, o, "2025-03-01")
    assert [(_one(got, i).status, _one(got, i).next_action, _one(got, i).processing_owner) for i in range(1, 7)] == [("done", "", ""), ("processing", "", "w"), ("retry_scheduled", "retry_later", ""), ("failed_terminal", "manual_review", ""), ("processing", "", "w"), ("processing", "", "w")]
    again = states.requeued(got, "timeout", "2025-04-01")
    assert _one(again, 4).status == "pending" and _one(again, 4).attempt_count == 0 and _one(again, 1).status == "done"


def test_deliveries(spark):
    row = lambda k, state, n, **x: (k, x.get("lane"), state, n, x.get("fit"), 0.5, x.get("made", "2025-01-01T00:00:00+00:00"), x.get("until"), None, x.get("sent"), None, None, [])
    m = spark.createDataFrame([row("a", "pending", 0, fit=0.9), row("b", "pending", 2, fit=0.1), row("c", "pending", None), row("d", "sent", 1, sent="2024-01-01"), row("e", "pending", 0, made="junk", until="junk"), row(None, "sent", 1, sent="2024-01-01")], MESSAGE)
    took = states.taken(m, "2025-01-01", 2, "k")
    assert {r.k for r in took.where("state = 'processing'").collect()} == {"a", "b"} and _one(took, "b", "k").delivery_attempts[0].attempt == 3
    receipts = spark.createDataFrame([("a", "ack", None), ("b", "nack", "E"), ("c", "ack", None)], "k string, result string, error_code string")
    got = states.receipted(took, receipts, "k", "2025-01-02")
    assert [_one(got, k, "k").state for k in "abc"] == ["sent", "failed", "pending"] and _one(got, "b", "k").delivery_attempts[0].receipt == {"error_code": "E"}
    late = states.expired(m, "2025-01-02 01:00:00", {"slow": 192})
    assert {r.k for r in late.where("failure IS NOT NULL").collect()} == {"a", "b", "c"}
    kept, marks = states.reaped(m, "2025-01-01 00:00:00", 14, "k")
    assert kept.count() == 4 and [r.k for r in marks.collect()] == ["d"]
    fresh = spark.createDataFrame([("a",), ("z",), ("d",), (" ",), (None,)], "k string")
    assert [r.k for r in states.offered(fresh, kept, marks, "k").collect()] == ["z"]
