"""Queries of merges, expiry, reports and text formats, each beside the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import rows, sinks
from ..session import configure, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
NOW = "2025-08-10T00:00:00+00:00"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: table(configure(spark), sf, name))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


@query("""WITH u AS (SELECT url, source_id AS source, priority FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY item_id) AS k FROM source_item WHERE url IS NOT NULL) WHERE k = 1)
SELECT coalesce(q.url, u.url) AS url, CASE WHEN u.url IS NULL OR (q.url IS NOT NULL AND q.status = 'done') THEN q.source ELSE u.source END AS source,
  CASE WHEN u.url IS NULL OR (q.url IS NOT NULL AND q.status = 'done') THEN q.priority ELSE u.priority END AS priority,
  CASE WHEN u.url IS NULL THEN 'untouched' WHEN q.url IS NULL THEN 'inserted' WHEN q.status = 'done' THEN 'kept' ELSE 'reset' END AS action FROM queue_task q FULL OUTER JOIN u ON u.url = q.url""")
def enqueue_upsert(t):
    fresh = rows.first_per(t("source_item").where("url IS NOT NULL").select("url", F.col("source_id").alias("source"), "priority", "item_id"), F.col("url"), ["item_id"])
    return rows.merged(t("queue_task"), fresh, "url", F.col("status") == "done", ["source", "priority"])


@query(f"SELECT id, coalesce(nullif(processing_heartbeat_at, ''), updated_at) AS beat FROM queue_task WHERE status = 'processing' AND coalesce(nullif(processing_heartbeat_at, ''), updated_at) < '{NOW}'")
def stale_leases(t):
    beat = F.coalesce(F.nullif(F.col("processing_heartbeat_at"), F.lit("")), F.col("updated_at"))
    return t("queue_task").where(F.col("status") == "processing").select("id", beat.alias("beat")).where(F.col("beat") < NOW)


@query("""SELECT lane, count(*) AS n, count(*) FILTER (WHERE CAST(coalesce(nullif(expires_at, ''), '9999-01-01T00:00:00+00:00') AS TIMESTAMPTZ) < TIMESTAMPTZ '2025-03-01 00:00:00+00') AS expired,
  max(date_diff('hour', CAST(created_at AS TIMESTAMPTZ), CAST(expires_at AS TIMESTAMPTZ))) AS longest_hours FROM outbox_item GROUP BY 1""")
def outbox_expiry(t):
    until, since = F.col("expires_at").try_cast("timestamp"), F.col("created_at").try_cast("timestamp")
    gone = F.count_if(until < F.lit("2025-03-01 00:00:00").cast("timestamp"))
    return t("outbox_item").groupBy("lane").agg(F.count(F.lit(1)).alias("n"), gone.alias("expired"), F.max(((F.unix_seconds(until) - F.unix_seconds(since)) / 3600).cast("bigint")).alias("longest_hours"))


@query("SELECT q.id, q.output_path, coalesce(len(string_split(f.text, chr(10))), 0) AS n_lines, coalesce(len(string_split(f.text, chr(10))), 0) >= 40 AS complete FROM queue_task q LEFT JOIN (SELECT url, max_by(text, content_id) AS text FROM fetched_content GROUP BY url) f ON f.url = q.url WHERE q.status = 'done'")
def file_completeness(t):
    last = t("fetched_content").groupBy("url").agg(F.max_by("text", "content_id").alias("text"))
    n = F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("bigint")
    return t("queue_task").where("status = 'done'").join(last, "url", "left").select("id", "output_path", n.alias("n_lines"), (n >= 40).alias("complete"))


@query("""SELECT batch_no, n, failed, CAST(sum(n) OVER (ORDER BY batch_no) AS BIGINT) AS n_so_far, CAST(sum(failed) OVER (ORDER BY batch_no) AS BIGINT) AS failed_so_far
FROM (SELECT batch_no, count(*) AS n, count(*) FILTER (WHERE status = 'failed_terminal') AS failed FROM queue_task GROUP BY 1)""")
def batch_running_totals(t):
    per = t("queue_task").groupBy("batch_no").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "failed_terminal").alias("failed"))
    w = Window.orderBy("batch_no").rowsBetween(Window.unboundedPreceding, 0)  # over one row per batch
    return per.withColumn("n_so_far", F.sum("n").over(w)).withColumn("failed_so_far", F.sum("failed").over(w))


@query("SELECT failure_kind, next_action, count(*) AS n FROM queue_task WHERE failure_kind <> '' GROUP BY ALL ORDER BY n DESC, failure_kind, next_action LIMIT 8")
def failure_kinds_top(t):
    return t("queue_task").where("failure_kind <> ''").groupBy("failure_kind", "next_action").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "failure_kind", "next_action").limit(8)


@query("SELECT lang, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS chars, round(avg(length(text)), 6) AS mean_chars, count(*) FILTER (WHERE length(text) > 10000) AS n_long FROM documents GROUP BY 1")
def length_stats(t):
    n = F.length("text")
    return t("documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(n).alias("chars"), F.round(F.avg(n), 6).alias("mean_chars"), F.count_if(n > 10_000).alias("n_long"))


@query("SELECT type, string_agg(id, ',' ORDER BY id) AS ids, CAST(sum(CAST(enabled AS INT)) AS BIGINT) AS n_enabled FROM source_config GROUP BY 1")
def capability_map(t):
    return t("source_config").groupBy("type").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("ids"), F.sum(F.col("enabled").cast("int")).alias("n_enabled"))


@query("SELECT id, len(list_filter(['name', 'language', 'timezone', 'date_order'], lambda k: NOT list_contains(map_keys(metadata), k))) AS n_missing FROM source_config")
def required_minus_present(t):
    need = F.array(*map(F.lit, ["name", "language", "timezone", "date_order"]))
    return t("source_config").select("id", F.size(F.array_except(need, F.map_keys("metadata"))).cast("bigint").alias("n_missing"))


@query("SELECT id, array_to_string(list_filter(tags, lambda x, i: list_position(tags, x) = i), ',') AS tags FROM source_config")
def ordered_distinct(t):
    return t("source_config").select("id", F.array_join(F.array_distinct("tags"), ",").alias("tags"))


@query("""SELECT id, CASE WHEN len(tags) = 0 THEN 'unavailable' ELSE array_to_string(list_transform(tags, lambda x, i: i || '. ' || x), chr(10)) END AS listed FROM source_config""")
def numbered_tags(t):
    return t("source_config").select("id", tx.numbered(F.col("tags")).alias("listed"))


@query(r"""SELECT doc_id, CASE WHEN regexp_matches(coalesce(title, ''), '^[A-Za-z0-9][A-Za-z0-9 ._/-]*$') THEN title ELSE '"' || replace(replace(coalesce(title, ''), '\', '\\'), '"', '\"') || '"' END AS scalar, trim(regexp_replace(replace(coalesce(title, ''), '|', '/'), '\s*\n\s*', ' ', 'g')) AS cell FROM documents""")
def yaml_and_cells(t):
    return t("documents").select("doc_id", tx.yaml_scalar(F.col("title")).alias("scalar"), tx.table_cell(F.col("title")).alias("cell"))


@query("SELECT doc_id, coalesce(nullif(trim(split_part(title, chr(10), 1)), ''), NULL) AS title, trim(text, ' ' || chr(10)) = trim(text, ' ' || chr(10)) AS same_body FROM documents WHERE text IS NOT NULL")
def reader_split(t):
    """A reader's output made of each document, and taken apart again."""
    made = F.concat(F.lit("Title: "), F.coalesce("title", F.lit("")), F.lit("\n\nURL Source: x\n\nMarkdown Content:\n"), F.col("text"))
    d = t("documents").where("text IS NOT NULL").select("doc_id", "text", made.alias("made"))
    strip = lambda c: F.regexp_replace(c, r"^[ \n]+|[ \n]+$", "")
    return d.select("doc_id", tx.reader_title(F.col("made")).alias("title"), (strip(tx.reader_body(F.col("made"))) == strip(F.col("text"))).alias("same_body"))


@query("SELECT doc_id, coalesce(source, '') AS source FROM documents WHERE source <> ''")
def front_matter_round_trip(t):
    made = sinks.markdown(t("documents"), ["doc_id", "source"], F.col("title"), F.col("text"))
    got = made.select(tx.front_matter(F.col("document"), "doc_id").cast("bigint").alias("doc_id"), tx.front_matter(F.col("document"), "source").alias("source"))
    return got.where("source IS NOT NULL")


@query("""SELECT score_id, raw_text AS answer FROM score_result""")
def response_text(t):
    """Each raw answer wrapped as two vendors would, and unwrapped."""
    one = F.to_json(F.struct(F.array(F.struct(F.struct(F.col("raw_text").alias("content")).alias("message"))).alias("choices")))
    two = F.to_json(F.struct(F.array(F.struct(F.lit("text").alias("type"), F.col("raw_text").alias("text"))).alias("content")))
    body = F.when(F.col("score_id") % 3 == 0, one).when(F.col("score_id") % 3 == 1, two).otherwise(F.col("raw_text"))
    return t("score_result").select("score_id", tx.response_text(body).alias("answer"))


@query(r"""SELECT k AS setting, CASE WHEN lower(trim(v)) IN ('', 'null', '~') OR v IS NULL THEN 'null' WHEN lower(trim(v)) IN ('true', 'false', 'yes', 'no', 'on', 'off') THEN 'bool' WHEN regexp_matches(trim(v), '^[+-]?\d+$') THEN 'int'
  WHEN regexp_matches(lower(trim(v)), '^[+-]?(\d+\.\d*|\.\d+)([e][+-]?\d+)?$') THEN 'float' ELSE 'string' END AS kind, count(*) AS n FROM (SELECT unnest(map_keys(metadata)) AS k, unnest(map_values(metadata)) AS v FROM source_item) GROUP BY ALL""")
def setting_kinds(t):
    one = t("source_item").select(F.explode("metadata").alias("setting", "v"))
    return one.groupBy("setting", tx.typed(F.col("v")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT id, least(1.0 * pow(2.0, attempt_count - 1), 10.0) AS delay FROM queue_task WHERE attempt_count > 0")
def backoff_delay(t):
    return t("queue_task").where("attempt_count > 0").select("id", tx.backoff(F.col("attempt_count")).alias("delay"))


@query("SELECT delivery_id, len(delivery_attempts) AS n, delivery_attempts[len(delivery_attempts)].status AS last_status, 'closed' AS new_status FROM outbox_item WHERE len(delivery_attempts) > 0")
def attempt_closed(t):
    """The last attempt of each delivery replaced by a closed one."""
    a = F.col("delivery_attempts")
    closed = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.element_at(a, -1).withField("status", F.lit("closed"))))
    d = t("outbox_item").where(F.size(a) > 0).select("delivery_id", F.element_at(a, -1)["status"].alias("last_status"), closed.alias("c"))
    return d.select("delivery_id", F.size("c").cast("bigint").alias("n"), "last_status", F.element_at("c", -1)["status"].alias("new_status"))


@query("""WITH s AS (SELECT source_type, final_score FROM score_result WHERE final_score BETWEEN 0 AND 1)
SELECT source_type, CAST(least(floor(final_score * 10), 9) AS BIGINT) AS band, count(*) AS n FROM s GROUP BY ALL""")
def score_bands(t):
    s = t("score_result").where("final_score BETWEEN 0 AND 1")
    return s.groupBy("source_type", F.least(F.floor(F.col("final_score") * 10), F.lit(9)).cast("bigint").alias("band")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT grouping(source_type) AS g, source_type, signal_tier, count(*) AS n FROM score_result GROUP BY GROUPING SETS ((source_type, signal_tier), (signal_tier))")
def tier_grouping_sets(t):
    s = t("score_result").select("source_type", "signal_tier")
    both = s.groupBy("source_type", "signal_tier").agg(F.count(F.lit(1)).alias("n")).withColumn("g", F.lit(0).cast("bigint"))
    # the coarser set comes from the finer one, not from the rows again
    total = both.groupBy("signal_tier").agg(F.sum("n").alias("n")).select(F.lit(1).cast("bigint").alias("g"), F.lit(None).cast("string").alias("source_type"), "signal_tier", "n")
    return both.select("g", "source_type", "signal_tier", "n").unionByName(total)
