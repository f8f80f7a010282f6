"""The data-processing operators over whole tables, each beside the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..operators import content, rows, sinks
from ..session import configure, table
from ..sources import feeds, pages
from ..streaming import flows

AS_OF = "2025-08-15 00:00:00"
TERMS = ["revenue", "renewed", "percent"]
GROUPS = {"ai": ["agent", "model evaluation", "edge inference"], "infra": ["data centre", "grid storage", "chip packaging"], "finance": ["revenue", "margin", "investors"], "company": ["customer", "vendor", "融资"]}
STATES = ["pending", "processing", "sent", "failed", "archived"]
SEVERITY = ["healthy", "warning", "error", "critical"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: table(configure(spark), sf, name))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


# Addresses -----------------------------------------------------------------------------------------------------------
_SPLIT = r"'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?$'"
_PART = lambda u, i: f"regexp_extract(trim({u}, chr(32)), {_SPLIT}, {i})"
_HOST = lambda u: rf"regexp_replace(regexp_replace(regexp_replace(lower({_PART(u, 2)}), '^.*@', ''), ':\d*$', ''), '^(?:www\d?\.|m\.|mobile\.|amp\.)+', '')"
_NORM = rf"""CASE WHEN regexp_matches(trim(url), {_SPLIT}) THEN concat(lower({_PART("url", 1)}), '://', regexp_replace(lower({_PART("url", 2)}), ':(?:80|443)$', ''),
  regexp_replace({_PART("url", 3)}, '/$', ''), regexp_extract(trim(url), '^[^?#]*(\?[^#]*)?', 1)) ELSE trim(url) END"""


@query(f"SELECT id, {_NORM} AS url_norm FROM queue_task")
def url_normalize(t):
    return t("queue_task").select("id", urls.normalize(F.col("url")).alias("url_norm"))


@query(f"SELECT id, url_norm FROM (SELECT id, {_NORM} AS url_norm, row_number() OVER (PARTITION BY {_NORM} ORDER BY id) AS k FROM queue_task) WHERE k = 1")
def url_dedupe_first(t):
    tasks = t("queue_task").select("id", urls.normalize(F.col("url")).alias("url_norm"))
    return rows.first_per(tasks, F.col("url_norm"), ["id"])


@query(f"SELECT {_HOST('url')} AS host, count(*) AS n, count(DISTINCT source) AS n_sources FROM fetched_content GROUP BY 1")
def host_counts(t):
    return t("fetched_content").groupBy(urls.host_of(F.col("url")).alias("host")).agg(F.count(F.lit(1)).alias("n"), F.countDistinct("source").alias("n_sources"))


@query(f"SELECT id, coalesce(lower({_PART('url', 1)}) IN ('http', 'https') AND {_PART('url', 2)} <> '', false) AS ok FROM queue_task")
def url_well_formed(t):
    return t("queue_task").select("id", urls.well_formed(F.col("url")).alias("ok"))


# Joins ---------------------------------------------------------------------------------------------------------------
@query("SELECT item_id, url FROM source_item s WHERE NOT EXISTS (SELECT 1 FROM queue_task q WHERE q.url = s.url AND q.batch_no = 0) AND url IS NOT NULL")
def anti_join_queue(t):
    return rows.unseen(t("source_item").select("item_id", "url").where("url IS NOT NULL"), t("queue_task").where("batch_no = 0"), "url")


@query(f"""WITH i AS (SELECT item_id, {_NORM} AS u FROM source_item), q AS (SELECT DISTINCT {_NORM} AS u FROM queue_task WHERE batch_no = 0)
SELECT min(item_id) AS item_id, u AS url_norm FROM i WHERE u IS NOT NULL AND u NOT IN (SELECT u FROM q WHERE u IS NOT NULL) GROUP BY u""")
def filter_unseen(t):
    norm = urls.normalize(F.col("url")).alias("url_norm")
    fresh = rows.unseen(t("source_item").select("item_id", norm).where("url_norm IS NOT NULL"), t("queue_task").where("batch_no = 0").select(norm), "url_norm")
    return fresh.groupBy("url_norm").agg(F.min("item_id").alias("item_id"))


@query("SELECT s.score_id, s.content_id, f.source, f.content_id IS NULL AS unknown FROM score_result s LEFT JOIN fetched_content f USING (content_id)")
def id_lookup_left(t):
    known = t("fetched_content").select("content_id", "source", F.lit(True).alias("known"))
    return t("score_result").select("score_id", "content_id").join(known, "content_id", "left").select("score_id", "content_id", "source", F.col("known").isNull().alias("unknown"))


@query("SELECT s.id, s.type, coalesce(a.adapter, 'none') AS adapter, count(i.item_id) AS n_items FROM source_config s LEFT JOIN (VALUES ('rss_feed', 'feed'), ('web_article', 'page')) a(type, adapter) ON a.type = s.type LEFT JOIN source_item i ON i.source_id = s.id GROUP BY ALL")
def adapter_lookup(t):
    config = t("source_config").select("id", "type")
    adapters = config.sparkSession.createDataFrame([("rss_feed", "feed"), ("web_article", "page")], "type string, adapter string")
    n = t("source_item").groupBy(F.col("source_id").alias("id")).agg(F.count(F.lit(1)).alias("n"))
    out = config.join(F.broadcast(adapters), "type", "left").join(n, "id", "left")
    return out.select("id", "type", F.coalesce("adapter", F.lit("none")).alias("adapter"), F.coalesce("n", F.lit(0)).cast("bigint").alias("n_items"))


@query("SELECT b.bundle, s.prompt_bundle AS stored, count(*) AS n FROM score_result s, (VALUES ('v2_stable_cn'), ('v3_business_stories'), ('v4')) b(bundle) WHERE b.bundle <> s.prompt_bundle GROUP BY ALL")
def bundle_cross_eval(t):
    scores = t("score_result").select(F.col("prompt_bundle").alias("stored"))
    bundles = scores.sparkSession.createDataFrame([("v2_stable_cn",), ("v3_business_stories",), ("v4",)], "bundle string")
    # counted per stored bundle first: only the groups meet the few bundles
    return scores.groupBy("stored").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(bundles), F.col("bundle") != F.col("stored")).select("bundle", "stored", "n")


@query(r"""WITH q AS (SELECT DISTINCT item_id, trim(unnest(string_split(regexp_replace(regexp_replace(regexp_replace(text, '([.!?])[ \t]+', '\1' || chr(1), 'g'), '([。!?])', '\1' || chr(1), 'g'), '\n+', chr(1), 'g'), chr(1)))) AS q FROM benchmark)
SELECT item_id, doc_id, count(*) AS n_quotes FROM documents JOIN (SELECT * FROM q WHERE length(q) >= 40) ON contains(text, q) GROUP BY ALL""")
def quote_locatable(t):
    return content.quotes_located(t("benchmark"), t("documents"))


@query("""WITH f AS (SELECT title, content_hash, row_number() OVER (PARTITION BY title ORDER BY content_id) AS k, row_number() OVER (PARTITION BY title ORDER BY content_id DESC) AS r FROM fetched_content WHERE title IS NOT NULL)
SELECT a.title, a.content_hash AS stored, b.content_hash AS current FROM f a JOIN f b USING (title) WHERE a.k = 1 AND b.r = 1 AND a.content_hash <> b.content_hash AND a.content_hash <> '' AND b.content_hash <> ''""")
def fingerprint_drift(t):
    """Titles whose first and latest fetched texts differ."""
    f = t("fetched_content").where("title IS NOT NULL").select("title", "content_hash", "content_id")
    return rows.drift(rows.first_per(f, F.col("title"), ["content_id"]), rows.last_per(f, F.col("title"), ["content_id"]), "title", "content_hash")


@query("SELECT DISTINCT result_title AS line FROM queue_task WHERE result_title IS NOT NULL AND batch_no > 0 AND result_title NOT IN (SELECT result_title FROM queue_task WHERE batch_no = 0 AND result_title IS NOT NULL)")
def ledger_unique_append(t):
    line = t("queue_task").where("result_title IS NOT NULL").select(F.col("result_title").alias("line"), "batch_no")
    return sinks.new_lines(line.where("batch_no > 0"), line.where("batch_no = 0"))


@query("SELECT i.item_id, map_concat(MAP {'category': 'none', 'via': 'feed'}, i.metadata)['category'] AS category, coalesce(i.metadata['via'], 'feed') AS via FROM source_item i")
def metadata_merge(t):
    merged = F.map_concat(F.create_map(F.lit("category"), F.lit("none"), F.lit("via"), F.lit("feed")), F.coalesce("metadata", F.create_map().cast("map<string,string>")))
    return t("source_item").select("item_id", merged.alias("m")).select("item_id", F.col("m")["category"].alias("category"), F.col("m")["via"].alias("via"))


# Aggregations --------------------------------------------------------------------------------------------------------
@query("SELECT status, count(*) AS n FROM queue_task GROUP BY 1")
def queue_status_counts(t):
    return t("queue_task").groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT CASE WHEN grouping(status) = 1 THEN 'TOTAL' ELSE status END AS status, count(*) AS n FROM queue_task GROUP BY ROLLUP (status)")
def queue_stats_rollup(t):
    return rows.with_total(t("queue_task"), "status")


@query(f"SELECT source_id, count(*) AS n, count(DISTINCT url) AS n_urls FROM source_item WHERE discovered_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR AND discovered_ts < TIMESTAMP '{AS_OF}' GROUP BY 1")
def recent_counts(t):
    recent = t("source_item").where(F.col("discovered_ts").between(F.expr(f"timestamp '{AS_OF}' - interval 72 hours"), F.expr(f"timestamp '{AS_OF}' - interval 1 microsecond")))
    return recent.groupBy("source_id").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("url").alias("n_urls"))


@query("""SELECT source, count(*) AS n, count(*) FILTER (WHERE status IN ('failed_terminal', 'rejected')) AS failed, round(count(*) FILTER (WHERE status IN ('failed_terminal', 'rejected')) / count(*), 3) AS rate,
  count(*) FILTER (WHERE status IN ('failed_terminal', 'rejected')) > 10 OR count(*) FILTER (WHERE status IN ('failed_terminal', 'rejected')) / count(*) > 0.5 AS high FROM queue_task GROUP BY 1""")
def failure_rates(t):
    failed = F.count_if(F.col("status").isin("failed_terminal", "rejected"))
    return t("queue_task").groupBy("source").agg(F.count(F.lit(1)).alias("n"), failed.alias("failed"), F.round(failed / F.count(F.lit(1)), 3).alias("rate"), ((failed > 10) | (failed / F.count(F.lit(1)) > 0.5)).alias("high"))


@query("""SELECT source_type, CASE max(CASE WHEN final_score IS NULL OR isnan(final_score) THEN 2 WHEN final_score < 0 OR final_score > 1 THEN 3 WHEN final_score < 0.3 THEN 1 ELSE 0 END)
WHEN 0 THEN 'healthy' WHEN 1 THEN 'warning' WHEN 2 THEN 'error' ELSE 'critical' END AS worst FROM score_result GROUP BY 1""")
def worst_status(t):
    s = F.col("final_score")
    rank = F.when(s.isNull() | F.isnan(s), 2).when((s < 0) | (s > 1), 3).when(s < 0.3, 1).otherwise(0)
    return t("score_result").groupBy("source_type").agg(F.element_at(F.array(*map(F.lit, SEVERITY)), F.max(rank) + 1).alias("worst"))


@query("SELECT d.state, count(o.delivery_id) AS n FROM (VALUES ('pending'), ('processing'), ('sent'), ('failed'), ('archived')) d(state) LEFT JOIN outbox_item o ON o.state = d.state GROUP BY 1")
def outbox_zero_filled_counts(t):
    return rows.zero_filled(t("outbox_item"), "state", STATES)


@query("SELECT DISTINCT source, output_path FROM queue_task WHERE status = 'done' AND output_path <> ''")
def done_files(t):
    return t("queue_task").where("status = 'done' AND output_path <> ''").select("source", "output_path").distinct()


@query("SELECT source_type, round(avg(CASE WHEN text IS NOT NULL AND trim(text) <> '' THEN 100.0 ELSE 0.0 END), 6) AS success_rate, count(*) AS n FROM fetched_content GROUP BY 1")
def success_rate(t):
    ok = F.when(F.trim("text") != "", 100.0).otherwise(0.0)
    return t("fetched_content").groupBy("source_type").agg(F.round(F.avg(ok), 6).alias("success_rate"), F.count(F.lit(1)).alias("n"))


@query("SELECT count(DISTINCT content_id) AS n_contents, count(DISTINCT prompt_hash) AS n_prompts, count(*) AS n FROM score_result")
def distinct_counts(t):
    return t("score_result").agg(F.countDistinct("content_id").alias("n_contents"), F.countDistinct("prompt_hash").alias("n_prompts"), F.count(F.lit(1)).alias("n"))


@query("""WITH h AS (SELECT DISTINCT source, content_hash AS h FROM fetched_content WHERE content_hash IS NOT NULL), b AS (SELECT source, substr(h, 1, 3) AS p, sha256(string_agg(h, '' ORDER BY h)) AS d FROM h GROUP BY ALL)
SELECT source, sha256(string_agg(d, '' ORDER BY p)) AS source_hash FROM b GROUP BY 1""")
def source_hash(t):
    """A digest per source of its contents' hashes: of the digests of up to 4096 ranges, so no task gathers a source."""
    h = t("fetched_content").where("content_hash IS NOT NULL").select("source", F.col("content_hash").alias("h"), F.substring("content_hash", 1, 3).alias("p")).distinct()
    ranges = h.groupBy("source", "p").agg(F.sha2(F.array_join(F.array_sort(F.collect_list("h")), ""), 256).alias("d"))
    ordered = F.array_sort(F.collect_list(F.struct("p", "d")))
    return ranges.groupBy("source").agg(F.sha2(F.array_join(F.transform(ordered, lambda x: x["d"]), ""), 256).alias("source_hash"))


# Windows, sorts and limits -------------------------------------------------------------------------------------------
@query("SELECT item_id, source_id FROM (SELECT i.item_id, i.source_id, c.max_items, row_number() OVER (PARTITION BY i.source_id ORDER BY i.priority, i.item_id) AS k FROM source_item i JOIN source_config c ON c.id = i.source_id WHERE c.enabled) WHERE k <= max_items")
def per_source_limit(t):
    config = t("source_config").where("enabled").select(F.col("id").alias("source_id"), "max_items")
    most = config.agg(F.coalesce(F.max("max_items"), F.lit(0))).first()[0]
    items = t("source_item").select("item_id", "source_id", "priority").join(rows.small(config), "source_id")
    return rows.top_per(items, "source_id", [F.col("priority"), F.col("item_id")], F.col("max_items"), most).select("item_id", "source_id")


@query(f"""WITH i AS (SELECT item_id, priority, url, {_NORM} AS u FROM source_item), q AS (SELECT DISTINCT url FROM queue_task), s AS (SELECT DISTINCT {_NORM} AS u FROM queue_task WHERE batch_no = 0),
m AS (SELECT i.*, s.u IS NOT NULL AS seen, q.url IS NOT NULL AS queued FROM i LEFT JOIN s ON s.u = i.u LEFT JOIN q ON q.url = i.url),
f AS (SELECT *, NOT seen AND NOT queued AND row_number() OVER (PARTITION BY u, seen, queued ORDER BY priority, item_id) = 1 AS fresh FROM m),
n AS (SELECT *, coalesce(sum(CAST(fresh AS INT)) OVER (ORDER BY priority, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
  max(CAST(fresh AS INT)) OVER (PARTITION BY u ORDER BY priority, item_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM f)
SELECT item_id, CASE WHEN taken >= 500 THEN 'limit' WHEN seen OR before = 1 THEN 'duplicate' WHEN queued THEN 'silent' ELSE 'enqueued' END AS outcome FROM n""")
def admission_control(t):
    norm = urls.normalize(F.col("url")).alias("u")
    items = t("source_item").select("item_id", "priority", "url", norm)
    queue = t("queue_task")
    return rows.admit(items, "u", ["priority", "item_id"], queue.where("batch_no = 0").select(norm), queue, "url", 500).select("item_id", "outcome")


@query("SELECT content_id, score_id, CASE WHEN NOT isnan(final_score) THEN final_score ELSE -1 END AS final_score, final_score IS NULL OR isnan(final_score) AS unset FROM (SELECT *, row_number() OVER (PARTITION BY content_id ORDER BY scored_ts DESC, score_id DESC) AS k FROM score_result) WHERE k = 1")
def latest_by_id(t):
    """A score that is null or no number comes as -1 and unset."""
    unset = F.col("final_score").isNull() | F.isnan("final_score")
    _set_score = (F.when(unset, F.lit(-1.0)).otherwise(F.col("final_score")).alias("final_score"), unset.alias("unset"))
    return rows.last_per(t("score_result").select("content_id", "score_id", "final_score", "scored_ts"), F.col("content_id"), ["scored_ts", "score_id"]).select("content_id", "score_id", *_set_score)


@query("""SELECT source_type, score_id, best FROM (SELECT source_type, score_id, row_number() OVER (PARTITION BY source_type ORDER BY final_score DESC, score_id) AS b, row_number() OVER (PARTITION BY source_type ORDER BY final_score, score_id) AS w
FROM score_result WHERE final_score BETWEEN 0 AND 1), (VALUES (true), (false)) v(best) WHERE (best AND b <= 3) OR (NOT best AND w <= 3)""")
def best_worst_3(t):
    ok = t("score_result").where("final_score BETWEEN 0 AND 1").select("source_type", "score_id", "final_score")
    best = rows.top_per(ok, "source_type", [F.desc("final_score"), F.col("score_id")], 3).withColumn("best", F.lit(True))
    return best.unionByName(rows.top_per(ok, "source_type", [F.asc("final_score"), F.col("score_id")], 3).withColumn("best", F.lit(False))).select("source_type", "score_id", "best")


@query("SELECT id, priority FROM queue_task WHERE status = 'pending' OR (status = 'retry_scheduled' AND (coalesce(next_retry_at, '') = '' OR next_retry_at <= '2025-08-15T00:00:00+00:00')) ORDER BY priority, id LIMIT 10")
def ready_tasks_topk(t):
    due = (F.coalesce("next_retry_at", F.lit("")) == "") | (F.col("next_retry_at") <= "2025-08-15T00:00:00+00:00")
    return t("queue_task").where((F.col("status") == "pending") | ((F.col("status") == "retry_scheduled") & due)).select("id", "priority").orderBy("priority", "id").limit(10)


@query("SELECT delivery_id, lane FROM outbox_item WHERE state = 'pending' ORDER BY business_story_fit DESC NULLS LAST, final_score DESC NULLS LAST, created_at, delivery_id LIMIT 20")
def outbox_claim_topk(t):
    order = [F.desc_nulls_last("business_story_fit"), F.desc_nulls_last("final_score"), F.col("created_at"), F.col("delivery_id")]
    return t("outbox_item").where("state = 'pending'").orderBy(*order).limit(20).select("delivery_id", "lane")


@query("""WITH m AS (SELECT id, source, CAST(status IN ('failed_terminal', 'rejected') AS INT) AS f FROM queue_task), g AS (SELECT *, sum(1 - f) OVER (PARTITION BY source ORDER BY id) AS g FROM m)
SELECT id, CAST(sum(f) OVER (PARTITION BY source, g ORDER BY id) AS BIGINT) AS streak FROM g""")
def failure_streaks(t):
    q = t("queue_task").select("id", "source", "status")
    return rows.streaks(q, "source", "id", F.col("status").isin("failed_terminal", "rejected")).select("id", "streak")


@query("SELECT delivery_id, a.attempt AS attempt, a.status AS status, row_number() OVER (PARTITION BY delivery_id ORDER BY a.started_at, a.attempt) AS ordinal FROM (SELECT delivery_id, unnest(delivery_attempts) AS a FROM outbox_item)")
def attempt_ordinals(t):
    one = t("outbox_item").select("delivery_id", F.explode("delivery_attempts").alias("a")).select("delivery_id", "a.attempt", "a.status", "a.started_at")
    w = Window.partitionBy("delivery_id").orderBy("started_at", "attempt")
    return one.withColumn("ordinal", F.row_number().over(w).cast("bigint")).drop("started_at")


@query("SELECT source_id AS id, url FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY p, k) AS r FROM (SELECT id AS source_id, url, 0 AS p, id AS k FROM source_config UNION ALL SELECT source_id, url, 1, CAST(item_id AS VARCHAR) FROM source_item)) WHERE r = 1 AND url IS NOT NULL")
def source_union_dedupe(t):
    a = t("source_config").select("id", "url", F.lit(0).alias("p"), F.col("id").alias("k"))
    b = t("source_item").select(F.col("source_id").alias("id"), "url", F.lit(1).alias("p"), F.col("item_id").cast("string").alias("k"))
    return rows.first_per(a.unionByName(b).where("url IS NOT NULL"), F.col("url"), ["p", "k"]).select("id", "url")


@query("SELECT DISTINCT source FROM documents EXCEPT SELECT source FROM mix_target")
def sources_except_targets(t):
    return t("documents").select("source").subtract(t("mix_target").select("source"))


@query("SELECT source FROM documents INTERSECT SELECT source FROM mix_target")
def sources_with_targets(t):
    return t("documents").select("source").intersect(t("mix_target").select("source"))


# Text scalars --------------------------------------------------------------------------------------------------------
@query("SELECT doc_id, substr(sha256(text), 1, 16) AS h FROM documents")
def content_hash(t):
    return t("documents").select("doc_id", tx.short_hash(F.col("text")).alias("h"))


@query(r"SELECT doc_id, coalesce(len(list_filter(string_split_regex(text, '[\t\n\r\f\x0B\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+'), lambda w: w <> '')), 0) AS n_words FROM documents")
def word_count(t):
    return t("documents").select("doc_id", tx.word_count(F.col("text")).alias("n_words"))


@query(r"""SELECT doc_id, coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9一-鿿]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), '-+$', ''), ''), 'untitled') AS slug FROM documents""")
def safe_slug(t):
    return t("documents").select("doc_id", tx.slug(F.col("title")).alias("slug"))


@query(r"SELECT content_id, trim(string_split_regex(title, '\s+[|-]\s+')[1]) AS clean FROM fetched_content")
def clean_title(t):
    return t("fetched_content").select("content_id", tx.clean_title(F.col("title")).alias("clean"))


@query("SELECT strftime(discovered_ts, '%Y-%m') || '-W' || ((day(discovered_ts) - 1) // 7 + 1) AS month_week, count(*) AS n FROM source_item GROUP BY 1")
def month_week_counts(t):
    return t("source_item").groupBy(tx.month_week(F.col("discovered_ts")).alias("month_week")).agg(F.count(F.lit(1)).alias("n"))


_HAS = lambda w: f"CAST(regexp_matches(text, '(?i)(^|[^A-Za-z0-9]){w}($|[^A-Za-z0-9])') AS INT)" if w.isascii() else f"CAST(contains(text, '{w}') AS INT)"
_HITS = "SELECT doc_id, " + ", ".join(f"coalesce({' + '.join(map(_HAS, words))}, 0) AS {g}" for g, words in GROUPS.items()) + " FROM documents"


def _hits(t):
    return t("documents").select("doc_id", *[tx.hits(F.col("text"), w).alias(g) for g, w in GROUPS.items()])


@query(_HITS)
def keyword_hits(t):
    return _hits(t)


@query(f"""SELECT doc_id, ai + infra + finance + least(company, 2) AS relevance FROM ({_HITS})
WHERE (infra >= 2 AND ai >= 1) OR (infra >= 1 AND finance >= 1) OR (infra >= 1 AND ai >= 1 AND company >= 1) OR finance >= 2 OR (finance >= 1 AND company >= 1) ORDER BY relevance DESC, doc_id LIMIT 8""")
def keyword_relevance_topk(t):
    weight = tx.relevance(*[F.col(g) for g in GROUPS]).alias("relevance")
    return _hits(t).select("doc_id", weight).where("relevance IS NOT NULL").orderBy(F.desc("relevance"), "doc_id").limit(8)


_WS = r"[\t\n\r\f\x0B\x1C-\x1F \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@query(rf"""WITH f AS (SELECT doc_id, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS t FROM documents),
s AS (SELECT doc_id, string_split(regexp_replace(t, '([.!?]) ', '\1' || chr(1), 'g'), chr(1)) AS l FROM f WHERE t <> ''),
e AS (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) AS i FROM s),
w AS (SELECT *, 3 * (CAST(contains(lower(sentence), 'revenue') AS INT) + CAST(contains(lower(sentence), 'renewed') AS INT) + CAST(contains(lower(sentence), 'percent') AS INT)) + 2 * CAST(contains(sentence, '$') AS INT)
  + 2 * CAST(regexp_matches(lower(sentence), '\b[0-9]+(?:\.[0-9]+)?[ ]*(?:m|b|million|billion)\b') AS INT) AS w FROM e WHERE length(sentence) BETWEEN 50 AND 320),
k AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, i) AS k, sentence FROM w)
SELECT doc_id, CAST(k AS INT) AS rank, sentence FROM k WHERE k <= 3 UNION ALL SELECT doc_id, 1, trim(substr(t, 1, 260)) FROM f WHERE t <> '' AND doc_id NOT IN (SELECT doc_id FROM k)""")
def evidence_sentences(t):
    return content.evidence(t("documents"), "doc_id", TERMS)


_SUM = lambda words: " + ".join(f"2 * CAST(contains(lower(p), '{w}') AS INT)" for w in words)
_SKIP = " OR ".join(f"contains(lower(p), '{w}')" for w in content.SKIPPED)
_SHORT = rf"""WITH base AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), long AS (SELECT * FROM base WHERE length(t) > 3000),
c AS (SELECT doc_id, string_split(regexp_replace(t, '(?i){"|".join(content.NOISE)}', '', 'g'), chr(10)) AS l FROM long),
p AS (SELECT doc_id, regexp_replace(unnest(l), '^{_WS}|{_WS}$', '', 'g') AS p, generate_subscripts(l, 1) AS k FROM c),
d AS (SELECT doc_id, p, min(k) AS k FROM p WHERE length(p) >= 20 AND NOT ({_SKIP}) GROUP BY doc_id, p),
i AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS i, count(*) OVER (PARTITION BY doc_id) AS n FROM d),
w AS (SELECT *, 3 * CAST(i < 3 OR i >= n - 3 AS INT) + CAST(length(p) BETWEEN 50 AND 300 AS INT) + %s AS w FROM i),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY w DESC, i DESC) AS r FROM w),
b AS (SELECT doc_id, string_agg(p, chr(10) || chr(10) ORDER BY %s) AS j FROM r WHERE r <= %d GROUP BY doc_id),
h AS (SELECT doc_id, j, substr(j, 1, 2500) AS h, length(substr(j, 1, 2500)) - position('。' IN reverse(substr(j, 1, 2500))) AS stop FROM b),
o AS (SELECT base.doc_id, t, CASE WHEN length(t) <= 3000 THEN t WHEN j IS NULL THEN substr(t, 1, 2500)
  ELSE regexp_replace(CASE WHEN length(j) <= 2500 THEN j WHEN contains(h, '。') AND stop > 2000 THEN substr(h, 1, stop + 1) ELSE h END, '^{_WS}|{_WS}$', '', 'g') END AS x FROM base LEFT JOIN h USING (doc_id))
SELECT doc_id, length(t) AS n_before, length(x) AS n_after, length(t) - length(x) AS saved, CASE WHEN length(t) > 0 THEN round(length(x) / length(t), 3) ELSE 1.0 END AS ratio, x AS text FROM o"""
WEIGHTY = ["revenue", "customer", "risk", "数据", "增长"]


@query(_SHORT % (_SUM(content.PHRASES), "w DESC, i DESC", 15))
def long_text_compress(t):
    """Texts beyond 3 000 characters, as the given ones are shorter than the operator's defaults."""
    return content.compressed(t("documents"), "doc_id", long=3_000, cut=2_500)


@query(_SHORT % (_SUM(WEIGHTY), "i", 20))
def long_text_in_order(t):
    return content.compressed(t("documents"), "doc_id", long=3_000, cut=2_500, keep=20, terms=WEIGHTY, in_order=True)


_WORDS = lambda x: f"len(list_filter(string_split_regex({x}, '{_WS}'), lambda w: w <> ''))"
_ANY = lambda marks, x="t": "(" + " OR ".join(f"contains(lower({x}), '{m}')" for m in marks) + ")"
_BARE = lambda x: f"regexp_replace(coalesce({x}, ''), '^{_WS}|{_WS}$', '', 'g')"


@query(f"""WITH x AS (SELECT content_id, {_BARE("text")} AS t, {_BARE("title")} AS h, source_type IN ('web_article', 'rss_feed', 'wechat_article') AS page, source_type FROM fetched_content),
k AS (SELECT content_id, CASE WHEN t = '' THEN 1 WHEN {_ANY(content.BLOCKED)} OR (source_type = 'wechat_article' AND length(t) < 200) THEN 2
  WHEN page AND ({_WORDS("t")} < 80 OR (h <> '' AND {_WORDS("replace(t, h, '')")} < 30) OR {_ANY(content.SHELL)} OR {_ANY(content.LOGIN)} OR ({_ANY(content.PAYWALL)} AND {_WORDS("t")} < 450)) THEN 3 END AS k FROM x)
SELECT content_id, CASE k WHEN 1 THEN 'validation_failed' WHEN 2 THEN 'content_blocked' WHEN 3 THEN 'content_blocked' END AS kind, CASE k WHEN 1 THEN 'drop' WHEN 2 THEN 'manual_review' WHEN 3 THEN 'drop' END AS action FROM k""")
def validate_ladder(t):
    v = content.verdict(F.col("text"), F.col("title"), F.col("source_type"))
    judged = F.transform(F.array(v), lambda x: F.struct(x["kind"].alias("kind"), x["action"].alias("action")))  # once for both fields
    return t("fetched_content").select("content_id", F.inline(judged))


@query(rf"""WITH x AS (SELECT content_id, {_HOST('url')} AS host, coalesce(title, '') || chr(10) || coalesce(text, '') AS b, coalesce(text, '') AS t, coalesce(raw, '') AS raw FROM fetched_content),
n AS (SELECT *, {_WORDS("t")} AS n, {_ANY(content.PAYWALL, "b")} AS m FROM x)
SELECT content_id, CASE WHEN contains(host, 'ledgerpost') THEN m OR n < 350 ELSE m AND n < 450 END AS paywalled, NOT {_ANY(content.PAYWALL)} AND n >= 350 AS real_body,
  {_ANY(content.VERIFICATION)} OR {_ANY(content.VERIFICATION_HEAD, "substr(t, 1, 4000)")} AS verification, NOT regexp_matches(raw, '(?i)<html|<article|<body|<p\b') AS unsupported,
  regexp_matches({_BARE("t")}, '^https?://t\.co/\S+$') OR (length({_BARE("t")}) < 80 AND contains({_BARE("t")}, 't.co/')) AS thin FROM n""")
def page_checks(t):
    text = F.col("text")
    return t("fetched_content").select(
        "content_id", content.paywalled(urls.host_of(F.col("url")), F.col("title"), text, ["ledgerpost"]).alias("paywalled"), content.real_body(text).alias("real_body"),
        content.verification(text).alias("verification"), content.unsupported(F.lit(None).cast("string"), F.col("raw")).alias("unsupported"), content.thin(text).alias("thin"),
    )


_Q = """[「“"]([^」”"]{4,})[」”"]"""
_STRIPPED = lambda x: rf"regexp_replace({x}, '[「」\"‘’\s]+', '', 'g')"


@query(rf"""WITH f AS (SELECT url, max_by(text, content_id) AS src FROM fetched_content GROUP BY url),
x AS (SELECT delivery_id, {_BARE("o.text")} AS t, coalesce(f.src, '') AS src FROM outbox_item o LEFT JOIN f ON f.url = o.url)
SELECT delivery_id, CASE WHEN t = '' THEN 'empty' ELSE array_to_string(list_filter([CASE WHEN length(regexp_replace(regexp_replace(t, 'https?://\S+', '', 'g'), '[\n ]', '', 'g')) > 150 THEN 'too_long' END,
  CASE WHEN NOT regexp_matches(t, 'https?://\S') THEN 'no_url' END, CASE WHEN {" OR ".join(f"contains(t, '{m}')" for m in content.SECTIONS)} THEN 'section' END,
  CASE WHEN {" OR ".join(f"contains(lower(t), '{m.lower()}')" for m in content.FILLER)} THEN 'filler' END,
  CASE WHEN src <> '' AND len(list_filter(regexp_extract_all(t, '{_Q}', 1), lambda q: NOT contains(src, q) AND NOT contains({_STRIPPED("src")}, {_STRIPPED("q")}))) > 0 THEN 'quote' END], lambda v: v IS NOT NULL), ',') END AS faults FROM x""")
def brief_contract(t):
    last = t("fetched_content").groupBy("url").agg(F.max_by("text", "content_id").alias("_src"))
    faults = content.brief_faults(F.col("text"), F.col("_src"), 150)
    return t("outbox_item").select("delivery_id", "text", "url").join(last, "url", "left").select("delivery_id", F.array_join(faults, ",").alias("faults"))


@query(r"""SELECT content_id, regexp_extract(url, '/r/([^/]+)', 1) AS subreddit, regexp_extract(coalesce(text, ''), '(?i)([0-9]+(?:\.[0-9]+k)?)\s+points?', 1) AS points, regexp_extract(coalesce(text, ''), '(?i)([0-9]+)\s+comments?', 1) AS comments,
  regexp_extract(coalesce(text, ''), '(?i)\bby\s+([A-Za-z0-9_-]+)', 1) AS author FROM fetched_content""")
def post_facts(t):
    return t("fetched_content").select("content_id", tx.post_facts(F.col("text"), F.col("url")).alias("f")).select("content_id", "f.*")


@query("""SELECT score_id, CASE WHEN NOT json_valid(raw_text) OR raw_text IS NULL THEN 'invalid_json' WHEN coalesce(raw_text->>'rationale', '') = '' THEN 'missing:rationale' WHEN coalesce(raw_text->>'score', '') = '' THEN 'missing:score'
  WHEN json_type(raw_text, '$.score') NOT IN ('DOUBLE', 'BIGINT', 'UBIGINT') THEN 'not_number:score' WHEN NOT CAST(raw_text->>'score' AS DOUBLE) BETWEEN 0 AND 10 THEN 'range:score' END AS broken FROM score_result""")
def json_contract(t):
    return t("score_result").select("score_id", content.json_contract(F.col("raw_text"), ["rationale", "score"], {"score": (0, 10)}).alias("broken"))


@query(r"""WITH l AS (SELECT content_id, trim(regexp_replace(unnest(string_split(text, chr(10))), '[ \t\r\f\x0B]+', ' ', 'g')) AS l, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM fetched_content),
k AS (SELECT *, lag(l) OVER (PARTITION BY content_id ORDER BY i) AS p FROM l WHERE l <> '')
SELECT f.content_id, CASE WHEN f.text IS NULL THEN NULL ELSE coalesce(string_agg(l, chr(10) ORDER BY i) FILTER (WHERE p IS NULL OR p <> l), '') END AS text FROM fetched_content f LEFT JOIN k USING (content_id) GROUP BY f.content_id, f.text""")
def line_normalize(t):
    return content.lines_once(t("fetched_content"), "content_id")


@query(r"""WITH p AS (SELECT content_id, regexp_replace(CASE WHEN regexp_extract(raw, '(?is)<body[^>]*>(.*)</body>', 1) <> '' THEN regexp_extract(raw, '(?is)<body[^>]*>(.*)</body>', 1) ELSE raw END, '(?is)<(script|style)[^>]*>.*?</(?:script|style)>', ' ', 'g') AS b FROM fetched_content)
SELECT content_id, trim(regexp_replace(regexp_replace(b, '<[^>]+>', ' ', 'g'), '[ \t\n\r\f\x0B]+', ' ', 'g')) AS stripped FROM p""")
def html_tag_strip(t):
    return t("fetched_content").select("content_id", tx.strip_tags(F.col("raw")).alias("stripped"))


@query()
def html_extract(t):
    return pages.extracted(t("fetched_content"), "content_id")


@query(r"""WITH a AS (SELECT content_id, unnest(regexp_extract_all(raw, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>')) AS a, generate_subscripts(regexp_extract_all(raw, '(?is)<a\s[^>]*href="[^"]*"[^>]*>.*?</a>'), 1) - 1 AS position FROM fetched_content)
SELECT content_id, CAST(position AS INT) AS position, href, label FROM (SELECT content_id, position, regexp_extract(a, '(?is)href="([^"]*)"', 1) AS href, trim(regexp_replace(a, '<[^>]+>', '', 'g')) AS label, row_number() OVER (PARTITION BY content_id, regexp_extract(a, '(?is)href="([^"]*)"', 1) ORDER BY position) AS n FROM a) WHERE n = 1 AND href <> ''""")
def link_extract(t):
    return content.links(t("fetched_content"), "content_id")


@query("SELECT item_id, url, title, author FROM (SELECT item_id, trim(url) AS url, nullif(trim(title), '') AS title, nullif(trim(author), '') AS author FROM source_item WHERE url IS NOT NULL AND trim(url) <> '')")
def rss_round_trip(t):
    """Every item written as RSS, fifty to a feed, and parsed again."""
    cell = lambda c: F.replace(F.replace(F.replace(F.coalesce(F.trim(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    item = F.concat(F.lit("<item><title>"), cell("title"), F.lit("</title><link>"), cell("url"), F.lit("</link><dc:creator>"), cell("author"), F.lit("</dc:creator><guid>"), F.col("item_id").cast("string"), F.lit("</guid></item>"))
    src = t("source_item").select("item_id", item.alias("x"), F.floor(F.col("item_id") / 50).alias("feed"))
    made = src.groupBy("feed").agg(F.array_sort(F.collect_list(F.struct("item_id", "x"))).alias("i"))
    made = made.select("feed", F.transform("i", lambda x: x["item_id"]).alias("ids"), F.concat(F.lit('<rss xmlns:dc="urn:dc"><channel><title>f</title>'), F.array_join(F.transform("i", lambda x: x["x"]), ""), F.lit("</channel></rss>")).alias("content"))
    return feeds.feed_items(made).select(F.get("ids", F.col("position")).alias("item_id"), "url", "title", "author")


@query("""SELECT delivery_id, a.attempt AS attempt, CASE WHEN a.receipt['message_id'] = '' THEN '' ELSE 'sha256:' || substr(sha256(a.receipt['message_id']), 1, 16) END AS message_id, substr(a.receipt['error_code'], 1, 160) AS error_code
FROM (SELECT delivery_id, unnest(delivery_attempts) AS a FROM outbox_item)""")
def receipt_redaction(t):
    one = t("outbox_item").select("delivery_id", F.explode(content.redacted(F.col("delivery_attempts"))).alias("a"))
    return one.select("delivery_id", "a.attempt", F.col("a.receipt")["message_id"].alias("message_id"), F.col("a.receipt")["error_code"].alias("error_code"))


# Streams -------------------------------------------------------------------------------------------------------------
def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    path = f"{sf}/{name}.parquet"
    return flows.stream_of(spark, path, spark.read.parquet(path).schema)


def stream_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return flows.run_to_table(flows.counts(_stream(spark, sf, "queue_task"), "status"), "complete", "status-counts")


def stream_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return flows.run_to_table(flows.first_sightings(_stream(spark, sf, "source_item"), "url"), "append", "first-sightings")


def stream_event_windows(spark: SparkSession, sf: str) -> DataFrame:
    counted = flows.sliding_counts(_stream(spark, sf, "events"), "ts", "event_type")
    return flows.run_to_table(counted, "update", "windows", ["window_start", "event_type"])


def stream_failure_streaks(spark: SparkSession, sf: str) -> DataFrame:
    """Per source the failures in a row up to its last task, state being that number alone."""
    tasks = _stream(spark, sf, "queue_task").select(F.coalesce("source", F.lit("none")).alias("source"), "id", F.coalesce(F.col("status").isin("failed_terminal", "rejected"), F.lit(False)).alias("failed"))
    return flows.run_to_table(flows.open_streaks(tasks, "source", "id", "failed"), "update", "streaks", ["source"])


QUERIES |= {f.__name__: f for f in (stream_failure_streaks, stream_status_counts, stream_dedupe, stream_event_windows)}
ORACLE |= {
    "stream_failure_streaks": """WITH m AS (SELECT coalesce(source, 'none') AS source, id, CAST(status IN ('failed_terminal', 'rejected') AS INT) AS f FROM queue_task)
SELECT m.source, count(*) FILTER (WHERE id > coalesce(l.last, -1)) AS streak FROM m LEFT JOIN (SELECT source, max(id) FILTER (WHERE f = 0) AS last FROM m GROUP BY 1) l USING (source) GROUP BY 1""",
    "stream_status_counts": "SELECT status, count(*) AS n FROM queue_task GROUP BY 1",
    "stream_dedupe": "SELECT DISTINCT url FROM source_item WHERE url IS NOT NULL",
    "stream_event_windows": """SELECT time_bucket(INTERVAL 12 HOUR, ts, TIMESTAMP '1970-01-01') - k * INTERVAL 12 HOUR AS window_start, event_type, count(*) AS n FROM events, (VALUES (0), (1)) v(k) GROUP BY ALL""",
}


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Fetched pages validated, joined with their latest score and counted by source type and verdict."""
    t = lambda name: table(configure(spark), sf, name)
    v = content.verdict(F.col("text"), F.col("title"), F.col("source_type"))
    judged = t("fetched_content").select("content_id", "source_type", v["kind"].alias("kind"), tx.word_count(F.col("text")).alias("n_words"))
    scores = rows.last_per(t("score_result").select("content_id", "final_score", "scored_ts", "score_id"), F.col("content_id"), ["scored_ts", "score_id"])
    return judged.join(scores, "content_id", "left").groupBy("source_type", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("n_words"), F.count_if(F.col("final_score").between(0, 1)).alias("n_scored"))
