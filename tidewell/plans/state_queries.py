"""Queries of leases and deliveries over the whole queue and outbox, each beside the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import states
from ..session import configure, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOW, BEFORE = "2025-08-15T00:00:00+00:00", "2025-08-10T00:00:00+00:00"
HOURS = {"business": 24, "requested": 24, "strategic": 192}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: table(configure(spark), sf, name))
        ORACLE[f.__name__] = sql
        return f

    return add


_READY = f"(status = 'pending' OR (status = 'retry_scheduled' AND (coalesce(next_retry_at, '') = '' OR next_retry_at <= '{NOW}')))"


@query(f"""WITH t AS (SELECT id FROM queue_task WHERE {_READY} ORDER BY priority NULLS LAST, id LIMIT 200)
SELECT q.id, CASE WHEN t.id IS NULL THEN status ELSE 'processing' END AS status, CASE WHEN t.id IS NULL THEN attempt_count ELSE coalesce(attempt_count, 0) + 1 END AS attempt_count,
  CASE WHEN t.id IS NULL THEN processing_owner ELSE 'worker-1' END AS processing_owner, CASE WHEN t.id IS NULL THEN processing_heartbeat_at ELSE '{NOW}' END AS processing_heartbeat_at FROM queue_task q LEFT JOIN t ON t.id = q.id""")
def queue_claim(t):
    return states.claimed(t("queue_task"), "worker-1", NOW, 200).select("id", "status", "attempt_count", "processing_owner", "processing_heartbeat_at")


@query(f"""SELECT id, CASE WHEN status = 'processing' AND id % 3 > 0 AND processing_owner IS NOT NULL THEN '{NOW}' ELSE processing_heartbeat_at END AS processing_heartbeat_at FROM queue_task""")
def queue_heartbeat(t):
    """Every task's owner gives a sign of life twice; those of each third task come from a stranger."""
    q = t("queue_task")
    owner = F.when(F.col("id") % 3 == 0, F.lit("stranger")).otherwise(F.col("processing_owner"))
    beats = q.select("id", owner.alias("owner"), F.explode(F.array(F.lit(BEFORE), F.lit(NOW))).alias("at"))
    return states.beaten(q, beats).select("id", "processing_heartbeat_at")


_ASKED = "CASE id % 4 WHEN 0 THEN 'done' WHEN 1 THEN 'rejected' WHEN 2 THEN 'retry_scheduled' ELSE 'failed_terminal' END"


@query(f"""WITH a AS (SELECT *, {_ASKED} AS asked, status = 'processing' AND NOT (id % 4 = 0 AND coalesce(output_path, '') = '') AS hit FROM queue_task),
s AS (SELECT *, CASE WHEN hit AND asked = 'retry_scheduled' AND attempt_count >= max_attempts THEN 'failed_terminal' WHEN hit THEN asked ELSE status END AS new FROM a)
SELECT id, new AS status, CASE WHEN NOT hit THEN next_action WHEN asked <> 'retry_scheduled' THEN '' WHEN new = asked THEN 'retry_later' ELSE 'manual_review' END AS next_action,
  CASE WHEN NOT hit THEN next_retry_at WHEN new = 'retry_scheduled' THEN '{NOW}' ELSE '' END AS next_retry_at, CASE WHEN hit THEN '' ELSE processing_owner END AS processing_owner,
  CASE WHEN NOT hit THEN processed_at WHEN new = 'retry_scheduled' THEN '' ELSE '{NOW}' END AS processed_at FROM s""")
def queue_finish(t):
    """Every task being worked on comes to an end, by turns done, rejected, to be tried again and failed."""
    q = t("queue_task")
    asked = F.element_at(F.array(*map(F.lit, ("done", "rejected", "retry_scheduled", "failed_terminal"))), (F.col("id") % 4 + 1).cast("int"))
    retry = asked == "retry_scheduled"
    o = q.where("status = 'processing'").select("id", asked.alias("state"), F.lit("timeout").alias("failure_kind"), F.when(retry, F.lit("retry_later")).otherwise(F.lit("")).alias("next_action"), F.lit("").alias("detail"), "output_path", F.when(retry, F.lit(NOW)).alias("next_retry_at"))
    return states.finished(q, o, NOW).select("id", "status", "next_action", "next_retry_at", "processing_owner", "processed_at")


_STALE = f"coalesce(status = 'processing' AND CASE WHEN coalesce(processing_heartbeat_at, '') = '' THEN updated_at ELSE processing_heartbeat_at END < '{BEFORE}', false)"


@query(f"SELECT id, CASE WHEN {_STALE} THEN 'retry_scheduled' ELSE status END AS status, CASE WHEN {_STALE} THEN '{NOW}' ELSE next_retry_at END AS next_retry_at, CASE WHEN {_STALE} THEN '' ELSE processing_owner END AS processing_owner FROM queue_task")
def queue_recover(t):
    return states.recovered(t("queue_task"), BEFORE, NOW).select("id", "status", "next_retry_at", "processing_owner")


_AGAIN = "coalesce(status = 'failed_terminal' AND failure_kind = 'content_blocked', false)"


@query(f"SELECT id, CASE WHEN {_AGAIN} THEN 'pending' ELSE status END AS status, CASE WHEN {_AGAIN} THEN 0 ELSE attempt_count END AS attempt_count, CASE WHEN {_AGAIN} THEN '' ELSE failure_kind END AS failure_kind, CASE WHEN {_AGAIN} THEN '' ELSE last_error END AS last_error FROM queue_task")
def queue_requeue(t):
    return states.requeued(t("queue_task"), "content_blocked", NOW).select("id", "status", "attempt_count", "failure_kind", "last_error")


@query(f"SELECT id, processing_heartbeat_at FROM queue_task WHERE status = 'processing' AND processing_heartbeat_at <> '' AND processing_heartbeat_at < '{BEFORE}'")
def lease_heartbeats(t):
    return t("queue_task").where(states.stale(BEFORE) & ~states.blank("processing_heartbeat_at")).select("id", "processing_heartbeat_at")


@query("""SELECT DISTINCT event_id FROM outbox_item WHERE batch_no >= 4 AND trim(event_id) <> '' AND event_id NOT IN (SELECT event_id FROM outbox_item WHERE batch_no < 4 AND event_id IS NOT NULL)""")
def outbox_offer(t):
    """Messages of later batches that no earlier one holds; earlier sent ones are known by their markers alone."""
    o = t("outbox_item").select("event_id", "batch_no", "state")
    early = o.where("batch_no < 4")
    return states.offered(o.where("batch_no >= 4").select("event_id"), early.where("state <> 'sent' OR state IS NULL"), early.where("state = 'sent'"), "event_id").distinct()


@query(f"""WITH t AS (SELECT delivery_id FROM outbox_item WHERE state = 'pending' ORDER BY business_story_fit DESC NULLS LAST, final_score DESC NULLS LAST, created_at, delivery_id LIMIT 100)
SELECT o.delivery_id, CASE WHEN t.delivery_id IS NULL THEN state ELSE 'processing' END AS state, CASE WHEN t.delivery_id IS NULL THEN attempts ELSE coalesce(attempts, 0) + 1 END AS attempts,
  CAST(coalesce(len(delivery_attempts), 0) + CASE WHEN t.delivery_id IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_attempts FROM outbox_item o LEFT JOIN t ON t.delivery_id = o.delivery_id""")
def outbox_claim(t):
    n = F.coalesce(F.size("delivery_attempts"), F.lit(0)).cast("bigint").alias("n_attempts")
    return states.taken(t("outbox_item"), NOW, 100, "delivery_id").select("delivery_id", "state", "attempts", n)


_HIT = "coalesce(state = 'processing', false)"
_TO = "CASE WHEN delivery_id % 3 = 0 THEN 'sent' WHEN delivery_id % 3 = 1 OR attempts >= 3 THEN 'failed' ELSE 'pending' END"


@query(f"""SELECT delivery_id, CASE WHEN {_HIT} THEN {_TO} ELSE state END AS state, CASE WHEN {_HIT} AND {_TO} = 'sent' THEN '{NOW}' ELSE sent_at END AS sent_at, CASE WHEN {_HIT} AND {_TO} = 'failed' THEN '{NOW}' ELSE failed_at END AS failed_at,
  CASE WHEN {_HIT} AND len(delivery_attempts) > 0 THEN CASE WHEN delivery_id % 3 = 0 THEN 'sent' WHEN delivery_id % 3 = 1 THEN 'delivery_unknown' WHEN attempts >= 3 THEN 'failed' ELSE 'retryable_failure' END
  ELSE delivery_attempts[len(delivery_attempts)].status END AS last_status FROM outbox_item""")
def outbox_receipts(t):
    """A receipt for every message, by turns good, unknown and bad; only those being delivered take it."""
    o = t("outbox_item")
    result = F.element_at(F.array(F.lit("ack"), F.lit("unknown"), F.lit("nack")), (F.col("delivery_id") % 3 + 1).cast("int"))
    got = states.receipted(o, o.select("delivery_id", result.alias("result"), F.lit("E1").alias("error_code")), "delivery_id", NOW)
    return got.select("delivery_id", "state", "sent_at", "failed_at", F.try_element_at("delivery_attempts", F.lit(-1))["status"].alias("last_status"))


_TTL = "CASE lane " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in HOURS.items()) + " ELSE 24 END"
_UNTIL = f"coalesce(TRY_CAST(nullif(expires_at, '') AS TIMESTAMPTZ), TRY_CAST(created_at AS TIMESTAMPTZ) + to_hours({_TTL}))"


@query(f"SELECT delivery_id, CASE WHEN coalesce(state = 'pending' AND {_UNTIL} < TIMESTAMPTZ '2025-03-01 00:00:00+00', false) THEN 'failed' ELSE state END AS state, CASE WHEN coalesce(state = 'pending' AND {_UNTIL} < TIMESTAMPTZ '2025-03-01 00:00:00+00', false) THEN 'OUTBOX_EXPIRED' END AS failure FROM outbox_item")
def outbox_expire(t):
    return states.expired(t("outbox_item"), "2025-03-01T00:00:00+00:00", HOURS).select("delivery_id", "state", "failure")


@query("SELECT delivery_id, event_id FROM outbox_item WHERE NOT coalesce(state = 'sent' AND TRY_CAST(sent_at AS TIMESTAMPTZ) < TIMESTAMPTZ '2025-03-01 00:00:00+00' - INTERVAL 14 DAY, false)")
def outbox_reap(t):
    return states.reaped(t("outbox_item"), "2025-03-01 00:00:00", 14, "event_id")[0].select("delivery_id", "event_id")


@query("SELECT DISTINCT event_id FROM outbox_item WHERE state = 'sent' AND trim(event_id) <> '' AND TRY_CAST(sent_at AS TIMESTAMPTZ) < TIMESTAMPTZ '2025-03-01 00:00:00+00' - INTERVAL 14 DAY")
def outbox_markers(t):
    return states.reaped(t("outbox_item"), "2025-03-01 00:00:00", 14, "event_id")[1]


@query(f"SELECT delivery_id, CASE WHEN claimed_at < '{BEFORE}' AND state = 'processing' THEN 'failed' ELSE state END AS state FROM outbox_item")
def outbox_quarantine(t):
    """Deliveries claimed long ago and never answered: what became of them is unknown, so they are not sent again."""
    o = t("outbox_item")
    old = o.where(f"state = 'processing' AND claimed_at < '{BEFORE}'").select("delivery_id", F.lit("unknown").alias("result"), F.lit("STALE_CLAIM").alias("error_code"))
    return states.receipted(o, old, "delivery_id", NOW).select("delivery_id", "state")
