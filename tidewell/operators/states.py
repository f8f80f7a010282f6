"""Rows that change state: leases of a work queue and deliveries of an outbox, as set-wise changes of whole tables.

A change is a guard and new values; rows that fail the guard stay as they are, so repeating a change does nothing. Claims
take the first rows of an order, a top-k whose size is the caller's limit. Outcomes come as a table of one row per key
and are merged by one join. Names of states are parameters; the defaults are those of the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rows import small

LEASE = ("processing_owner", "processing_started_at", "processing_heartbeat_at")


def changed(rows: DataFrame, guard: Column, values: dict[str, Column]) -> DataFrame:
    """The rows with new values where the guard holds; a null guard does not hold."""
    holds = F.coalesce(guard, F.lit(False))
    return rows.withColumns({c: F.when(holds, v).otherwise(F.col(c)) for c, v in values.items()})


def blank(column: str) -> Column:
    """Whether a text is unset: null or ''."""
    return F.coalesce(F.col(column), F.lit("")) == ""


def ready(now: str, pending: str = "pending", retry: str = "retry_scheduled") -> Column:
    """Whether a task may be taken: pending, or to be tried again at a time that has come or is not set."""
    return (F.col("status") == pending) | ((F.col("status") == retry) & (blank("next_retry_at") | (F.col("next_retry_at") <= now)))


def claimed(tasks: DataFrame, owner: str, now: str, limit: int, processing: str = "processing") -> DataFrame:
    """All tasks; the first `limit` ready ones (by priority, then id) are leased to `owner` and have one more attempt."""
    taken = tasks.where(ready(now)).orderBy(F.asc_nulls_last("priority"), "id").limit(limit).select(F.col("id").alias("_id"))
    marked = tasks.join(small(taken), F.col("id") == F.col("_id"), "left")
    lease = {"status": F.lit(processing), "attempt_count": F.coalesce("attempt_count", F.lit(0)) + 1, "updated_at": F.lit(now), "next_retry_at": F.lit("")}
    return changed(marked, F.col("_id").isNotNull(), lease | {"processing_owner": F.lit(owner), "processing_started_at": F.lit(now), "processing_heartbeat_at": F.lit(now)}).drop("_id")


def beaten(tasks: DataFrame, beats: DataFrame, processing: str = "processing") -> DataFrame:
    """All tasks; those whose owner gave a sign of life have its time. beats: id, owner, at; one that comes from another
    owner, or for a task not being worked on, changes nothing. The latest of several counts."""
    last = beats.groupBy(F.col("id").alias("_id"), F.col("owner").alias("_owner")).agg(F.max("at").alias("_at"))
    met = tasks.join(last, (F.col("id") == F.col("_id")) & (F.col("processing_owner") == F.col("_owner")), "left")
    guard = (F.col("status") == processing) & F.col("_at").isNotNull()
    return changed(met, guard, {"processing_heartbeat_at": F.col("_at"), "updated_at": F.col("_at")}).drop("_id", "_owner", "_at")


def finished(tasks: DataFrame, outcomes: DataFrame, now: str) -> DataFrame:
    """All tasks; those with an outcome are in the state it asks for, without lease.

    outcomes: id, state (`done`, `rejected`, `retry_scheduled` or `failed_terminal`), failure_kind, next_action, detail,
    output_path, next_retry_at, at most one row a task. A done task must name its output and one to be tried again a
    time, else nothing changes. A task without attempts left is not tried again but fails, to be looked at by hand where
    it would have been retried.
    """
    o = outcomes.select(F.col("id").alias("_id"), F.struct("state", "failure_kind", "next_action", "detail", "output_path", "next_retry_at").alias("_o"))
    met = tasks.join(o, F.col("id") == F.col("_id"), "left")
    text = lambda f: F.coalesce(F.col(f"_o.{f}"), F.lit(""))
    sound = F.col("_o").isNotNull() & ~((text("state") == "done") & (text("output_path") == "")) & ~((text("state") == "retry_scheduled") & (text("next_retry_at") == ""))
    spent = (text("state") == "retry_scheduled") & (F.col("attempt_count") >= F.col("max_attempts"))
    state = F.when(spent, F.lit("failed_terminal")).otherwise(text("state"))
    action = F.when(spent & (text("next_action") == "retry_later"), F.lit("manual_review")).otherwise(text("next_action"))
    values = {
        "status": state, "failure_kind": text("failure_kind"), "next_action": action, "last_status_detail": text("detail"), "output_path": text("output_path"),
        "next_retry_at": F.when(state == "retry_scheduled", text("next_retry_at")).otherwise(F.lit("")), "processed_at": F.when(state == "retry_scheduled", F.lit("")).otherwise(F.lit(now)), "updated_at": F.lit(now),
    }
    return changed(met, sound, values | {c: F.lit("") for c in LEASE}).drop("_id", "_o")


def stale(before: str, processing: str = "processing") -> Column:
    """Whether a lease has given no sign of life since `before`; leases without heartbeat go by their last update."""
    beat = F.when(blank("processing_heartbeat_at"), F.col("updated_at")).otherwise(F.col("processing_heartbeat_at"))
    return (F.col("status") == processing) & (beat < before)


def recovered(tasks: DataFrame, before: str, now: str) -> DataFrame:
    """All tasks; stale leases are given up, to be tried again at once."""
    return changed(tasks, stale(before), {**{c: F.lit("") for c in LEASE}, "next_retry_at": F.lit(now), "updated_at": F.lit(now), "status": F.lit("retry_scheduled")})


def requeued(tasks: DataFrame, kind: str | None, now: str, state: str = "failed_terminal") -> DataFrame:
    """All tasks; those that failed for good (of one kind of failure, if given) begin anew, as if never tried."""
    guard = (F.col("status") == state) & (F.lit(True) if kind is None else F.col("failure_kind") == kind)
    marked = tasks.withColumn("_again", F.coalesce(guard, F.lit(False)))
    unset = ("next_retry_at", "failure_kind", "last_error", "last_status_detail", "next_action", "result_title", "output_path", "processed_at", "provider_route", "last_reply_status", *LEASE)
    values = {c: F.lit("") for c in unset if c in tasks.columns} | {"attempt_count": F.lit(0), "status": F.lit("pending"), "updated_at": F.lit(now)}
    return changed(marked, F.col("_again"), values).drop("_again")


# Deliveries ----------------------------------------------------------------------------------------------------------
def offered(fresh: DataFrame, held: DataFrame, markers: DataFrame, key: str) -> DataFrame:
    """The new messages to take, with `key` neither held in any state nor marked as delivered once; of several with one
    key none is a repeat of what is held, so the caller keeps one of them. Null and blank keys are refused."""
    known = held.select(key).unionByName(markers.select(key)).distinct()
    return fresh.where(F.trim(key) != "").join(known, key, "left_anti")



def taken(messages: DataFrame, now: str, limit: int, key: str, lane: str | None = None) -> DataFrame:
    """All messages; the first `limit` pending ones (best fit, then best score, then oldest) are being delivered, with an
    attempt begun."""
    order = [F.desc_nulls_last("business_story_fit"), F.desc_nulls_last("final_score"), F.col("created_at"), F.col(key)]
    first = messages.where((F.col("state") == "pending") & (F.lit(True) if lane is None else F.col("lane") == lane)).orderBy(*order).limit(limit).select(F.col(key).alias("_k"))
    met = messages.join(small(first), F.col(key) == F.col("_k"), "left")
    n = F.coalesce("attempts", F.lit(0)) + 1
    begun = F.struct(n.alias("attempt"), F.lit("processing").alias("status"), F.lit(now).alias("started_at"), F.lit("").alias("finished_at"), F.create_map().cast("map<string,string>").alias("receipt"))
    kind = messages.schema["delivery_attempts"].dataType
    values = {"delivery_attempts": F.concat(F.coalesce("delivery_attempts", F.array().cast(kind)), F.array(begun).cast(kind)), "attempts": n, "state": F.lit("processing"), "claimed_at": F.lit(now), "updated_at": F.lit(now)}
    return changed(met, F.col("_k").isNotNull(), values).drop("_k")


def receipted(messages: DataFrame, receipts: DataFrame, key: str, now: str, most: int = 3) -> DataFrame:
    """All messages; those being delivered for which a receipt came have their attempt closed.

    receipts: key, result (`ack`, `nack` or `unknown`), error_code; one row a message. ack: sent. nack: pending again,
    failed after `most` attempts. unknown: failed, never sent again by itself, as it may have arrived.
    """
    r = receipts.select(F.col(key).alias("_k"), F.col("result").alias("_r"), F.coalesce("error_code", F.lit("")).alias("_e"))
    met = messages.join(r, F.col(key) == F.col("_k"), "left")
    a, spent = F.col("delivery_attempts"), F.coalesce("attempts", F.lit(0)) >= most
    status = F.when(F.col("_r") == "ack", "sent").when(F.col("_r") == "unknown", "delivery_unknown").when(spent, "failed").otherwise("retryable_failure")
    state = F.when(F.col("_r") == "ack", "sent").when((F.col("_r") == "unknown") | spent, "failed").otherwise("pending")
    last = F.try_element_at(a, F.lit(-1)).withField("status", status).withField("finished_at", F.lit(now)).withField("receipt", F.create_map(F.lit("error_code"), F.col("_e")))
    closed = F.when(F.size(a) > 0, F.concat(F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0))), F.array(last))).otherwise(a)
    values = {"delivery_attempts": closed, "state": state, "updated_at": F.lit(now), "sent_at": F.when(state == "sent", F.lit(now)).otherwise(F.col("sent_at")), "failed_at": F.when(state == "failed", F.lit(now)).otherwise(F.col("failed_at"))}
    return changed(met, (F.col("state") == "processing") & F.col("_r").isin("ack", "nack", "unknown"), values).drop("_k", "_r", "_e")


def until(hours: dict[str, int], otherwise: int) -> Column:
    """When a message expires: as it says, else its lane's hours after it was made; null if neither can be read."""
    ttl = F.lit(otherwise)
    for lane, h in hours.items():
        ttl = F.when(F.col("lane") == lane, F.lit(h)).otherwise(ttl)
    made = F.col("created_at").try_cast("timestamp")
    return F.coalesce(F.nullif(F.col("expires_at"), F.lit("")).try_cast("timestamp"), F.timestamp_seconds(F.unix_seconds(made) + ttl * 3600))


def expired(messages: DataFrame, now: str, hours: dict[str, int], otherwise: int = 24) -> DataFrame:
    """All messages, with `failure`; pending ones past their time have failed with OUTBOX_EXPIRED."""
    gone = F.coalesce((F.col("state") == "pending") & (until(hours, otherwise) < F.lit(now).cast("timestamp")), F.lit(False))
    marked = messages.withColumn("_gone", gone).withColumn("failure", F.when(F.col("_gone"), F.lit("OUTBOX_EXPIRED")))
    return changed(marked, F.col("_gone"), {"state": F.lit("failed"), "failed_at": F.lit(now), "updated_at": F.lit(now)}).drop("_gone")


def reaped(messages: DataFrame, now: str, days: int, key: str) -> tuple[DataFrame, DataFrame]:
    """The messages without those sent more than `days` days ago, and the keys of these, to be kept as markers so that
    none is ever taken again. A time that cannot be read keeps its message."""
    old = F.coalesce((F.col("state") == "sent") & (F.col("sent_at").try_cast("timestamp") < F.expr(f"timestamp '{now}' - interval {days} days")), F.lit(False))
    return messages.where(~old), messages.where(old & (F.trim(key) != "")).select(key).distinct()
