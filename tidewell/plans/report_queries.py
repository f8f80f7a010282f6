"""Queries of health, logs, lists and small forms, each beside the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..operators import content, records, sinks
from ..session import configure, scratch_path, table
from ..streaming import flows
from .core_queries import _HOST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
SINCE = "2025-08-01T00:00:00+00:00"
RANK = ["healthy", "warning", "error", "critical"]


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: table(configure(spark), sf, name))
        ORACLE[f.__name__] = sql
        return f

    return add


_RATES = f"SELECT count(*) AS n, count(*) FILTER (WHERE status IN ('failed_terminal', 'rejected')) AS bad FROM queue_task WHERE updated_at >= '{SINCE}'"


@query(f"""WITH q AS ({_RATES}), s AS (SELECT count(*) AS n FROM queue_task WHERE status = 'processing' AND coalesce(nullif(processing_heartbeat_at, ''), updated_at) < '{SINCE}'),
e AS (SELECT count(*) AS n FROM fetched_content WHERE coalesce(trim(text), '') = ''), o AS (SELECT count(*) AS n FROM outbox_item WHERE state = 'failed'), d AS (SELECT count(*) AS n FROM source_config WHERE NOT enabled),
c AS (SELECT 'failure_rate' AS check_name, round(bad / greatest(n, 1), 3) AS value, CASE WHEN bad > 10 OR bad / greatest(n, 1) > 0.5 THEN 2 ELSE 1 END AS r FROM q
  UNION ALL SELECT 'stale_leases', n, CASE WHEN n > 0 THEN 2 ELSE 1 END FROM s UNION ALL SELECT 'empty_contents', n, CASE WHEN n > 0 THEN 2 ELSE 1 END FROM e
  UNION ALL SELECT 'failed_messages', n, CASE WHEN n > 100 THEN 3 ELSE 1 END FROM o UNION ALL SELECT 'sources_off', n, 1 FROM d)
SELECT check_name, CAST(value AS DOUBLE) AS value, ['healthy', 'warning', 'error', 'critical'][r] AS status, ['healthy', 'warning', 'error', 'critical'][max(r) OVER ()] AS worst FROM c""")
def health_report(t):
    """Five checks, each one aggregation, and the worst of them beside each."""
    q, recent = t("queue_task"), t("queue_task").where(F.col("updated_at") >= SINCE)
    bad = F.count_if(F.col("status").isin("failed_terminal", "rejected"))
    rate = bad / F.greatest(F.count(F.lit(1)), F.lit(1))
    beat = F.coalesce(F.nullif(F.col("processing_heartbeat_at"), F.lit("")), F.col("updated_at"))
    n = F.count(F.lit(1))
    check = lambda df, name, value, rank: df.agg(F.lit(name).alias("check_name"), value.cast("double").alias("value"), rank.alias("r"))
    checks = [
        check(recent, "failure_rate", F.round(rate, 3), F.when((bad > 10) | (rate > 0.5), 2).otherwise(1)),
        check(q.where((F.col("status") == "processing") & (beat < SINCE)), "stale_leases", n, F.when(n > 0, 2).otherwise(1)),
        check(t("fetched_content").where(F.coalesce(F.trim("text"), F.lit("")) == ""), "empty_contents", n, F.when(n > 0, 2).otherwise(1)),
        check(t("outbox_item").where("state = 'failed'"), "failed_messages", n, F.when(n > 100, 3).otherwise(1)),
        check(t("source_config").where("NOT enabled"), "sources_off", n, F.lit(1)),
    ]
    every = reduce(DataFrame.unionByName, checks)
    names = F.array(*map(F.lit, RANK))
    worst = every.agg(F.max("r").alias("w"))  # one row
    return every.crossJoin(F.broadcast(worst)).select("check_name", "value", F.element_at(names, F.col("r")).alias("status"), F.element_at(names, F.col("w")).alias("worst"))


@query("SELECT id, status, updated_at FROM queue_task ORDER BY updated_at DESC NULLS LAST, id DESC LIMIT 10")
def recent_tasks_topk(t):
    return t("queue_task").select("id", "status", "updated_at").orderBy(F.desc_nulls_last("updated_at"), F.desc("id")).limit(10)


@query("SELECT id, failure_kind, last_error FROM queue_task WHERE status IN ('failed_terminal', 'rejected') ORDER BY updated_at DESC NULLS LAST, id DESC LIMIT 10")
def failed_tasks_topk(t):
    return t("queue_task").where(F.col("status").isin("failed_terminal", "rejected")).select("id", "failure_kind", "last_error", "updated_at").orderBy(F.desc_nulls_last("updated_at"), F.desc("id")).limit(10).drop("updated_at")


@query("SELECT DISTINCT prompt_bundle AS bundle FROM score_result WHERE prompt_bundle IS NOT NULL UNION SELECT unnest(['v1', 'v9'])")
def bundle_names(t):
    s = t("score_result").where("prompt_bundle IS NOT NULL").select(F.col("prompt_bundle").alias("bundle"))
    return s.distinct().union(s.sparkSession.createDataFrame([("v1",), ("v9",)], "bundle string")).distinct()


@query("SELECT prompt_bundle AS bundle, count(DISTINCT prompt_hash) AS n_hashes, substr(sha256(string_agg(DISTINCT prompt_hash, '' ORDER BY prompt_hash)), 1, 16) AS identity FROM score_result WHERE prompt_hash IS NOT NULL GROUP BY 1")
def prompt_identities(t):
    """The hashes a bundle was used with (a handful each) and one name for them all."""
    h = t("score_result").where("prompt_hash IS NOT NULL").select(F.col("prompt_bundle").alias("bundle"), "prompt_hash").distinct()
    return h.groupBy("bundle").agg(F.count(F.lit(1)).alias("n_hashes"), tx.short_hash(F.array_join(F.array_sort(F.collect_list("prompt_hash")), "")).alias("identity"))


@query("SELECT q.id, 'dry-run://' || q.id || '/' || coalesce(f.h, '') AS path FROM queue_task q LEFT JOIN (SELECT url, arg_max(content_hash, content_id) AS h FROM fetched_content WHERE content_hash IS NOT NULL GROUP BY 1) f ON f.url = q.url")
def dry_run_paths(t):
    last = t("fetched_content").where("content_hash IS NOT NULL AND url IS NOT NULL").groupBy("url").agg(F.max_by("content_hash", "content_id").alias("h"))
    return t("queue_task").select("id", "url").join(last, "url", "left").select("id", F.concat(F.lit("dry-run://"), F.col("id").cast("string"), F.lit("/"), F.coalesce("h", F.lit(""))).alias("path"))


@query("SELECT content_id, coalesce(content_hash, '') || CASE WHEN content_id % 2 = 0 THEN '-request-' || substr(sha256(content_id || ':' || coalesce(fetched_at, '')), 1, 16) ELSE '' END AS event_id FROM fetched_content")
def event_ids(t):
    """What a content is delivered under; one that was asked for has the request in its name."""
    key = tx.short_hash(F.concat(F.col("content_id").cast("string"), F.lit(":"), F.coalesce("fetched_at", F.lit(""))))
    asked = F.when(F.col("content_id") % 2 == 0, F.concat(F.lit("-request-"), key)).otherwise(F.lit(""))
    return t("fetched_content").select("content_id", F.concat(F.coalesce("content_hash", F.lit("")), asked).alias("event_id"))


@query("SELECT id, status, failure_kind FROM queue_task WHERE id IS NOT NULL")
def json_log_round_trip(t):
    """The tasks' outcomes appended to a log of JSON lines in two goes, and read again."""
    q = t("queue_task").where("id IS NOT NULL").select("id", "status", "failure_kind")
    at = scratch_path(q.sparkSession, "log")
    sinks.append_json(q.where("id % 2 = 0"), at)
    sinks.append_json(q.where("id % 2 = 1"), at)
    return q.sparkSession.read.schema(q.schema).json(at)


@query("SELECT id, CASE id % 5 WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 1 WHEN 3 THEN 5 ELSE 2 END AS minutes FROM queue_task")
def retry_after_minutes(t):
    said = F.element_at(F.array(*map(F.lit, ("Retry-After: 90 seconds", "retry after 3 minutes", "Retry-After: 1", "slow down", "please retry-after 120s"))), (F.col("id") % 5 + 1).cast("int"))
    return t("queue_task").select("id", records.retry_after(said).alias("minutes"))


@query("SELECT item_id, CASE WHEN item_id % 2 = 0 THEN trim(url) ELSE 'https://' || regexp_replace(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://', '') END AS url FROM source_item WHERE trim(url) <> '' AND regexp_matches(trim(url), '^[A-Za-z][A-Za-z0-9+.-]*://')")
def schemes_ensured(t):
    i = t("source_item").where(F.trim("url").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"))
    given = F.when(F.col("item_id") % 2 == 0, F.col("url")).otherwise(F.regexp_replace(F.trim("url"), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""))
    return i.select("item_id", urls.with_scheme(given).alias("url"))


@query("""SELECT score_id, CASE WHEN json_valid(raw_text) AND json_type(raw_text, '$.score') IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN greatest(0.0, least(1.0, CAST(raw_text->>'score' AS DOUBLE))) ELSE 0.0 END AS share FROM score_result""")
def strict_shares(t):
    """A field of a JSON answer as a share; texts and booleans are no numbers."""
    v = F.try_parse_json("raw_text")
    kind = F.schema_of_variant(F.try_variant_get(v, "$.score", "variant"))
    number = kind.startswith("BIGINT") | kind.startswith("DECIMAL") | kind.startswith("DOUBLE")
    return t("score_result").select("score_id", records.clip01(F.when(number, F.try_variant_get(v, "$.score", "double"))).alias("share"))


@query("""SELECT v2, v3, count(*) AS n FROM (SELECT content_id, max(signal_tier) FILTER (WHERE prompt_bundle = 'v2_stable_cn') AS v2, max(signal_tier) FILTER (WHERE prompt_bundle = 'v3_business_stories') AS v3 FROM score_result GROUP BY 1) GROUP BY ALL""")
def tiers_crossed(t):
    """How often one bundle gave a tier where the other gave another; a pivot per content, then counted."""
    s = t("score_result").select("content_id", "prompt_bundle", "signal_tier")
    one = lambda b, name: F.max(F.when(F.col("prompt_bundle") == b, F.col("signal_tier"))).alias(name)
    return s.groupBy("content_id").agg(one("v2_stable_cn", "v2"), one("v3_business_stories", "v3")).groupBy("v2", "v3").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH l AS (SELECT content_id, unnest(regexp_extract_all(raw, '(?is)<a\\s[^>]*href="([^"]*)"', 1)) AS href, url FROM fetched_content)
SELECT DISTINCT content_id, href FROM l WHERE href <> '' AND (starts_with(href, '/') OR {_HOST('href')} = {_HOST('url')}) AND href <> url AND NOT starts_with(href, '/about')""")
def same_site_links(t):
    pages = t("fetched_content").select("content_id", "url", "raw")
    found = content.links(pages, "content_id").join(pages.select("content_id", "url"), "content_id")
    return content.same_site(found, F.col("url"), ["/about"]).select("content_id", "href").distinct()


@query("""WITH s AS (SELECT id, CASE WHEN enabled THEN id END AS on_, coalesce(max_items, 0) AS m, lookback_days AS d FROM source_config), n AS (SELECT source_id, count(*) AS n FROM source_item GROUP BY 1)
SELECT s.id, CASE WHEN on_ IS NULL THEN 'off' WHEN n IS NULL THEN 'empty' ELSE 'ok' END AS outcome, CASE WHEN d <= 1 THEN 'oneDay' WHEN d <= 7 THEN 'oneWeek' ELSE 'oneMonth' END AS recency, CASE WHEN on_ IS NULL THEN 0 ELSE least(coalesce(n, 0), m) END AS taken FROM s LEFT JOIN n ON n.source_id = s.id""")
def discovery_outcomes(t):
    """What a round over all sources takes from each; a source that is off or empty does not keep the others back."""
    n = t("source_item").groupBy(F.col("source_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    s = t("source_config").select("id", "enabled", F.coalesce("max_items", F.lit(0)).alias("m"), "lookback_days").join(n, "id", "left")
    on = F.coalesce("enabled", F.lit(False))
    outcome = F.when(~on, "off").when(F.col("n").isNull(), "empty").otherwise("ok")
    recency = F.when(F.col("lookback_days") <= 1, "oneDay").when(F.col("lookback_days") <= 7, "oneWeek").otherwise("oneMonth")
    return s.select("id", outcome.alias("outcome"), recency.alias("recency"), F.when(~on, F.lit(0)).otherwise(F.least(F.coalesce("n", F.lit(0)), F.col("m"))).cast("bigint").alias("taken"))


@query("SELECT strftime(ts, '%Y-%m') || '-W' || ((day(ts) - 1) // 7 + 1) AS month_week, event_type, count(*) AS n FROM events GROUP BY ALL")
def month_week_types(t):
    return rows_by_week(t("events"))


def rows_by_week(events: DataFrame) -> DataFrame:
    return events.groupBy(tx.month_week(F.col("ts").cast("timestamp")).alias("month_week"), "event_type").agg(F.count(F.lit(1)).alias("n"))


def stream_month_weeks(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    path = f"{sf}/events.parquet"
    counted = rows_by_week(flows.stream_of(spark, path, spark.read.parquet(path).schema))
    return flows.run_to_table(counted, "update", "month-weeks", ["month_week", "event_type"])


QUERIES["stream_month_weeks"] = stream_month_weeks
ORACLE["stream_month_weeks"] = ORACLE["month_week_types"]
