"""Whole passes over the tables, put together of the operators: a scheduler's tick, a worker's pass, a stream into two
tables. Each is one plan up to its result, beside the same steps in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import urls
from ..operators import content, rows, sinks, states
from ..session import configure, scratch_path, table
from ..streaming import flows
from . import core_queries, state_queries

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOW, BEFORE = state_queries.NOW, state_queries.BEFORE


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: table(configure(spark), sf, name))
        ORACLE[f.__name__] = sql
        return f

    return add


#: What the admission says where the queue is as it stood after the second batch.
_ADMITTED = core_queries.ORACLE["admission_control"].replace("(SELECT DISTINCT url FROM queue_task)", "(SELECT DISTINCT url FROM queue_task WHERE batch_no < 3)")


@query(f"""WITH outcome AS ({_ADMITTED}), i AS (SELECT s.url, min(s.item_id) AS item_id FROM source_item s JOIN outcome o USING (item_id) WHERE o.outcome = 'enqueued' GROUP BY 1)
SELECT coalesce(q.url, i.url) AS url, CASE WHEN q.url IS NULL THEN 'pending' ELSE q.status END AS status, CASE WHEN q.url IS NULL THEN s.priority ELSE q.priority END AS priority, q.url IS NULL AS fresh
FROM (SELECT * FROM queue_task WHERE batch_no < 3) q FULL OUTER JOIN i ON i.url = q.url LEFT JOIN source_item s ON s.item_id = i.item_id""")
def scheduler_tick(t):
    """The queue after a tick: the discovered items in order of priority, those seen or queued left out, at most 500 of
    the rest put into the queue as it stood after the second batch."""
    queue = t("queue_task").where("batch_no < 3")
    norm = urls.normalize(F.col("url")).alias("u")
    items = t("source_item").select("item_id", "priority", "url", norm)
    told = rows.admit(items, "u", ["priority", "item_id"], queue.where("batch_no = 0").select(norm), queue, "url", 500)
    fresh = told.where("outcome = 'enqueued'").select("url", "priority", "item_id", F.lit("pending").alias("status"))
    fresh = rows.first_per(fresh, F.col("url"), ["item_id"])
    merged = rows.merged(queue, fresh, "url", F.lit(True), ["status", "priority"])
    return merged.select("url", "status", "priority", (F.col("action") == "inserted").alias("fresh"))


_STEPS = f"""WITH judged AS ({core_queries.ORACLE["validate_ladder"]}), last AS (SELECT url, max(content_id) AS content_id FROM fetched_content WHERE url IS NOT NULL GROUP BY 1),
r AS (SELECT id, url, priority, max_attempts, attempt_count, CASE WHEN {state_queries._STALE} THEN 'retry_scheduled' ELSE status END AS status, CASE WHEN {state_queries._STALE} THEN '{NOW}' ELSE next_retry_at END AS next_retry_at, output_path, next_action FROM queue_task),
c AS (SELECT id FROM r WHERE {state_queries._READY} ORDER BY priority NULLS LAST, id LIMIT 500),
a AS (SELECT r.*, c.id IS NOT NULL AS mine, coalesce(r.attempt_count, 0) + 1 AS n, last.content_id, judged.kind, judged.action FROM r LEFT JOIN c ON c.id = r.id LEFT JOIN last ON last.url = r.url LEFT JOIN judged ON judged.content_id = last.content_id),
o AS (SELECT *, CASE WHEN NOT mine THEN status WHEN content_id IS NULL AND n >= max_attempts THEN 'failed_terminal' WHEN content_id IS NULL THEN 'retry_scheduled' WHEN kind IS NULL THEN 'done' WHEN action = 'drop' THEN 'rejected' ELSE 'failed_terminal' END AS new FROM a)
"""


@query(_STEPS + """SELECT id, new AS status, CASE WHEN NOT mine THEN next_action WHEN content_id IS NULL THEN CASE WHEN new = 'failed_terminal' THEN 'manual_review' ELSE 'retry_later' END WHEN kind IS NULL THEN 'none' ELSE action END AS next_action,
  CASE WHEN NOT mine THEN output_path WHEN new = 'done' THEN 'dry-run://' || id || '/' || content_id ELSE '' END AS output_path FROM o""")
def worker_pass(t):
    """The queue after a worker's pass: stale leases given up, 500 tasks claimed, what was fetched for each judged, and
    each brought to its end: done, rejected, to be tried again or failed."""
    recovered = states.recovered(t("queue_task"), BEFORE, NOW)
    mine = states.claimed(recovered, "worker-1", NOW, 500)
    last = t("fetched_content").where("url IS NOT NULL").groupBy("url").agg(F.max("content_id").alias("content_id"))
    v = content.verdict(F.col("text"), F.col("title"), F.col("source_type"))
    judged = t("fetched_content").select("content_id", v.alias("v"))
    work = mine.where(f"status = 'processing' AND processing_owner = 'worker-1' AND processing_started_at = '{NOW}'").select("id", "url").join(last, "url", "left").join(judged, "content_id", "left")
    none, sound = F.col("content_id").isNull(), F.col("v.kind").isNull()
    state = F.when(none, "retry_scheduled").when(sound, "done").when(F.col("v.action") == "drop", "rejected").otherwise("failed_terminal")
    path = F.concat(F.lit("dry-run://"), F.col("id").cast("string"), F.lit("/"), F.col("content_id").cast("string"))
    outcomes = work.select(
        "id", state.alias("state"), F.when(none, "fetch_failed").when(sound, "").otherwise(F.col("v.kind")).alias("failure_kind"), F.when(none, "retry_later").when(sound, "none").otherwise(F.col("v.action")).alias("next_action"),
        F.lit("").alias("detail"), F.when(~none & sound, path).alias("output_path"), F.when(none, F.lit(NOW)).alias("next_retry_at"),
    )
    return states.finished(mine, outcomes, NOW).select("id", "status", "next_action", "output_path")


def stream_to_two_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The queue as a stream into a table of all tasks and a table of failed ones, fed in order by each batch."""
    configure(spark)
    path = f"{sf}/queue_task.parquet"
    stream = flows.stream_of(spark, path, spark.read.parquet(path).schema).select("id", "status")
    every, failed, check = (scratch_path(spark, f"two-{x}") for x in ("all", "failed", "checkpoint"))
    into = lambda at, keep: lambda df, n: df.where(keep).write.mode("overwrite").parquet(f"{at}/_b={n}")
    both = sinks.to_all(into(every, "true"), into(failed, "status = 'failed_terminal'"))
    stream.writeStream.foreachBatch(both).option("checkpointLocation", check).trigger(availableNow=True).start().awaitTermination()
    a, b = (spark.read.schema("id bigint, status string").parquet(p) for p in (every, failed))
    n = b.groupBy("status").agg(F.count(F.lit(1)).alias("n_failed"))
    return a.groupBy("status").agg(F.count(F.lit(1)).alias("n")).join(n, "status", "left").select("status", "n", F.coalesce("n_failed", F.lit(0)).alias("n_failed"))


QUERIES["stream_to_two_tables"] = stream_to_two_tables
ORACLE["stream_to_two_tables"] = "SELECT status, count(*) AS n, count(*) FILTER (WHERE status = 'failed_terminal') AS n_failed FROM queue_task GROUP BY 1"
