"""Queries of records between their forms, each beside the same query in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls
from ..functions.times import utc_text
from ..operators import instants, records, rows, sinks
from ..session import configure, table
from ..sources import feeds
from . import time_sql
from .core_queries import _BARE, _HOST

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
AS_OF = "2025-08-15 00:00:00"


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = lambda spark, sf: f(lambda name: table(configure(spark), sf, name))
        ORACLE[f.__name__] = sql
        return f

    return add


@query(f"SELECT content_id, {_HOST('url')} AS source, coalesce(nullif({_BARE('title')}, ''), substr(url, 1, 100)) AS title, substr(sha256(coalesce(text, '')), 1, 16) AS content_hash, coalesce(author, '') AS author, cardinality(coalesce(metadata, MAP {{}})) AS n_meta FROM fetched_content")
def fetched_projection(t):
    made = records.fetched(F.col("url"), F.col("title"), F.col("text"), F.col("source_type"), F.col("author"), F.col("published_at"), F.col("metadata"), F.col("fetched_at"))
    return t("fetched_content").select("content_id", made.alias("c")).select("content_id", "c.source", "c.title", "c.content_hash", "c.author", F.size("c.metadata").cast("bigint").alias("n_meta"))


@query("SELECT item_id, coalesce(url, '') AS url, substr(coalesce(title, ''), 1, 200) AS title, CASE WHEN coalesce(url, '') = '' THEN 'missing_url' END AS error FROM source_item")
def search_projection(t):
    return t("source_item").select("item_id", records.searched(F.col("url"), F.col("title"), F.lit(None).cast("string")).alias("r")).select("item_id", "r.url", "r.title", "r.error")


@query("SELECT id, CASE WHEN coalesce(reply_channel, '') <> '' THEN reply_channel END AS reply_channel, CASE WHEN coalesce(reply_channel, '') <> '' THEN CAST(id AS VARCHAR) || ':' || updated_at END AS request_key FROM queue_task")
def reply_metadata(t):
    channel = F.nullif(F.coalesce("reply_channel", F.lit("")), F.lit(""))
    extra = {"reply_channel": channel, "reply_request_key": F.when(channel.isNotNull(), F.concat(F.col("id").cast("string"), F.lit(":"), F.col("updated_at")))}
    m = records.with_defaults(F.lit(None).cast("map<string,string>"), extra)
    return t("queue_task").select("id", m.alias("m")).select("id", F.try_element_at("m", F.lit("reply_channel")).alias("reply_channel"), F.try_element_at("m", F.lit("reply_request_key")).alias("request_key"))


@query("SELECT id, coalesce(source, '') AS source, CASE WHEN status IN ('pending', 'processing', 'done') THEN status ELSE 'other' END AS status, coalesce(failure_kind, '') AS failure_kind, 7 AS priority FROM queue_task")
def task_rows(t):
    """Rows as objects: no nulls, states of a closed domain; the priority overridden, all else kept."""
    q = t("queue_task").withColumn("priority", F.lit(7))
    return q.select("id", records.text_of(F.col("source")).alias("source"), records.enum_of(F.col("status"), ["pending", "processing", "done"], "other").alias("status"), records.text_of(F.col("failure_kind")).alias("failure_kind"), "priority")


@query("""SELECT delivery_id, coalesce(event_id, '') AS event_id, coalesce(lane, '') AS lane, CASE WHEN final_score IS NULL OR isnan(final_score) THEN 0.0 ELSE greatest(0.0, least(1.0, final_score)) END AS final_score,
  greatest(0, coalesce(attempts, 0)) AS attempts, CASE WHEN state IN ('pending', 'processing', 'sent', 'failed') THEN state ELSE 'pending' END AS state, coalesce(text, '') AS text FROM outbox_item""")
def outbox_json(t):
    """Every message written as JSON and read again."""
    fields = ["event_id", "lane", "text", "url", "prompt_hash", "created_at", "expires_at", "final_score", "business_story_fit", "attempts", "state"]
    made = t("outbox_item").select("delivery_id", records.item_json(fields).alias("payload"))
    got = made.select("delivery_id", records.item_of(F.col("payload")).alias("m"))
    return got.select("delivery_id", "m.event_id", "m.lane", "m.final_score", "m.attempts", "m.state", "m.text")


@query("SELECT q.id, coalesce(q.result_title, '') AS title, coalesce(f.content_hash, '') AS content_hash, s.final_score IS NOT NULL AND NOT isnan(s.final_score) AS scored FROM queue_task q LEFT JOIN (SELECT url, max(content_id) AS content_id FROM fetched_content GROUP BY 1) l ON l.url = q.url LEFT JOIN fetched_content f USING (content_id) LEFT JOIN (SELECT content_id, arg_max(final_score, score_id) FILTER (WHERE final_score IS NOT NULL) AS final_score FROM score_result GROUP BY 1) s USING (content_id)")
def result_projection(t):
    """What became of each task: its title, the last content fetched for it and whether that was scored at last."""
    last = t("fetched_content").groupBy("url").agg(F.max_by(F.struct("content_id", "content_hash"), "content_id").alias("f")).where("url IS NOT NULL")
    score = t("score_result").where("final_score IS NOT NULL").groupBy("content_id").agg(F.max_by("final_score", "score_id").alias("final_score"))
    out = t("queue_task").select("id", "url", "result_title").join(last, "url", "left").select("id", "result_title", F.col("f.content_id").alias("content_id"), F.col("f.content_hash").alias("h")).join(score, "content_id", "left")
    return out.select("id", records.text_of(F.col("result_title")).alias("title"), records.text_of(F.col("h")).alias("content_hash"), (F.col("final_score").isNotNull() & ~F.isnan("final_score")).alias("scored"))


_LAST = "SELECT DISTINCT ON (content_id) content_id, coalesce(signal_tier, '') AS tier FROM score_result {} ORDER BY content_id, scored_ts DESC, score_id DESC"


@query(f"""WITH a AS ({_LAST.format("WHERE prompt_bundle = 'v2_stable_cn'")}), b AS ({_LAST.format("WHERE prompt_bundle = 'v3_business_stories'")}), c AS ({_LAST.format("")})
SELECT c.content_id, coalesce(a.tier, 'missing') AS v2, coalesce(b.tier, 'missing') AS v3, c.tier AS last, coalesce(a.tier, 'missing') = coalesce(b.tier, 'missing') AND coalesce(a.tier, 'missing') = c.tier AS agree
FROM c LEFT JOIN a USING (content_id) LEFT JOIN b USING (content_id)""")
def three_runs_compared(t):
    s = t("score_result").select("content_id", "prompt_bundle", "signal_tier", "scored_ts", "score_id")
    run = lambda df: rows.last_per(df, F.col("content_id"), ["scored_ts", "score_id"])
    of = lambda name: s.where(F.col("prompt_bundle") == name)
    return records.compared({"v2": run(of("v2_stable_cn")), "v3": run(of("v3_business_stories")), "last": run(s)}, "content_id", "signal_tier")


@query(r"""SELECT source_type, '| score_id | signal_tier |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || score_id || ' | ' || replace(regexp_replace(coalesce(signal_tier, ''), '\s+', ' ', 'g'), '|', '/') || ' |', chr(10) ORDER BY score_id) AS lines, count(*) AS n
FROM score_result WHERE final_score > 0.9 AND final_score <= 1 GROUP BY 1""")
def report_tables(t):
    best = t("score_result").where("final_score > 0.9 AND final_score <= 1")
    return records.table_markdown(best, ["score_id", "signal_tier"], "source_type", ["score_id"])


@query("""SELECT delivery_id, CASE delivery_id % 4 WHEN 3 THEN NULL ELSE CAST(delivery_id AS VARCHAR) END AS chat, CASE WHEN delivery_id % 4 = 3 THEN '' ELSE coalesce(text, '') END AS text FROM outbox_item""")
def chat_updates(t):
    """Every message as one of four kinds of update (one of them unknown), read again."""
    body = F.struct(F.struct(F.col("delivery_id").alias("id")).alias("chat"), F.when(F.col("delivery_id") % 2 == 0, F.col("text")).alias("text"), F.when(F.col("delivery_id") % 2 == 1, F.col("text")).alias("caption"))
    kind = F.col("delivery_id") % 4
    update = F.to_json(F.struct(F.when(kind == 0, body).alias("message"), F.when(kind == 1, body).alias("edited_message"), F.when(kind == 2, body).alias("channel_post"), F.when(kind == 3, body).alias("poll")))
    kinds = ["message", "edited_message", "channel_post", "edited_channel_post"]
    return t("outbox_item").select("delivery_id", records.coalesced(update, kinds).alias("u")).select("delivery_id", "u.chat", "u.text")


@query(r"""WITH x AS (SELECT id, CASE id % 3 WHEN 0 THEN '/Add ' || url WHEN 1 THEN ' ' || url ELSE coalesce(result_title, '') END AS t FROM queue_task),
k AS (SELECT id, trim(t) AS t, lower(regexp_extract(trim(t), '^/([A-Za-z_]+)', 1)) AS name FROM x)
SELECT id, CASE WHEN name <> '' THEN 'command' WHEN regexp_matches(t, '^(?:https?://|www\.)\S+$') THEN 'url' ELSE 'input' END AS kind, name, CASE WHEN name <> '' THEN trim(substr(t, length(name) + 2)) ELSE t END AS rest FROM k""")
def commands(t):
    said = F.when(F.col("id") % 3 == 0, F.concat(F.lit("/Add "), "url")).when(F.col("id") % 3 == 1, F.concat(F.lit(" "), "url")).otherwise(F.col("result_title"))
    return t("queue_task").select("id", records.command_of(said).alias("c")).select("id", "c.kind", "c.name", "c.rest")


@query("SELECT source, arg_max(output_path, (updated_at, output_path)) AS output_path FROM queue_task WHERE coalesce(output_path, '') <> '' AND updated_at IS NOT NULL GROUP BY 1")
def newest_files(t):
    return records.latest_file(t("queue_task").where("output_path <> '' AND updated_at IS NOT NULL"), "source", "updated_at", "output_path")


@query("""WITH c AS (SELECT coalesce(provider_route, '') AS route, id, updated_at, status IN ('failed_terminal', 'retry_scheduled') AS f FROM queue_task), g AS (SELECT route, max(id) AS good FROM c WHERE NOT coalesce(f, false) GROUP BY 1)
SELECT c.route, count(*) AS failures FROM c LEFT JOIN g USING (route) WHERE good IS NULL OR id > good GROUP BY 1 HAVING count(*) >= 1""")
def open_circuits(t):
    calls = t("queue_task").select(records.text_of(F.col("provider_route")).alias("route"), "id", "updated_at", "status")
    return records.open_circuits(calls, "route", "id", F.col("status").isin("failed_terminal", "retry_scheduled"), 1, 30, "updated_at").select("route", "failures")


@query("""SELECT score_id, CASE WHEN final_score IS NULL OR isnan(final_score) THEN 0.0 ELSE greatest(0.0, least(1.0, final_score)) END AS clipped FROM score_result""")
def clipped_scores(t):
    return t("score_result").select("score_id", records.clip01(F.col("final_score")).alias("clipped"))


@query("""WITH s(status) AS (SELECT unnest([200, 204, 301, 401, 403, 404, 418, 429, 500, 503])), m AS (SELECT id, [200, 204, 301, 401, 403, 404, 418, 429, 500, 503][CAST(id % 10 AS INT) + 1] AS s FROM queue_task)
SELECT id, CASE WHEN s BETWEEN 200 AND 299 THEN NULL WHEN s = 401 THEN 'auth_invalid' WHEN s = 403 THEN 'content_blocked' WHEN s = 429 THEN 'rate_limited' ELSE 'fetch_failed' END AS kind, s = 429 OR s >= 500 AS retryable FROM m""")
def http_failures(t):
    status = F.element_at(F.array(*map(F.lit, (200, 204, 301, 401, 403, 404, 418, 429, 500, 503))), (F.col("id") % 10 + 1).cast("int"))
    return t("queue_task").select("id", records.http_failure(status).alias("f")).select("id", "f.kind", "f.retryable")


@query(rf"""WITH x AS (SELECT delivery_id, concat_ws(' ', text, url) AS t FROM outbox_item), f AS (SELECT delivery_id, unnest(regexp_extract_all(t, '((?:https?://|www\.)[^\s<>"]+)', 1)) AS u FROM x),
c AS (SELECT delivery_id, regexp_replace(u, '[.,;:!?)\]}}''。，；：！？）】》]+$', '') AS u FROM f)
SELECT DISTINCT delivery_id, CASE WHEN regexp_matches(u, '^[A-Za-z][A-Za-z0-9+.-]*://') OR u = '' THEN u ELSE 'https://' || u END AS found FROM c""")
def urls_in_text(t):
    return t("outbox_item").select("delivery_id", F.explode(urls.urls_in(F.concat_ws(" ", "text", "url"))).alias("found"))


_CELL = lambda c: f"""'"' || replace(replace(coalesce({c}, ''), '\\', '\\\\'), '"', '\\"') || '"'"""


@query(f"""SELECT doc_id, '---' || chr(10) || 'source: ' || {_CELL("source")} || chr(10) || 'lang: ' || {_CELL("lang")} || chr(10) || '---' AS front, substr(sha256(coalesce(text, '')), 1, 8) AS h FROM documents""")
def markdown_front(t):
    """The front matter of each document's Markdown, and the hash in its file's name."""
    made = sinks.markdown(t("documents").withColumn("id_", F.col("doc_id")), ["doc_id", "source", "lang"], F.col("title"), F.col("text"))
    front = F.regexp_replace(F.regexp_extract("document", r"(?s)^(---\n.*?\n---)", 1), r"\ndoc_id: [^\n]*", "")
    return made.select(tx.front_matter(F.col("document"), "doc_id").cast("bigint").alias("doc_id"), front.alias("front"), F.regexp_extract("file_name", r"-([0-9a-f]{8})\.md$", 1).alias("h"))


_SLUG = """coalesce(nullif(regexp_replace(substr(regexp_replace(regexp_replace(lower(title), '[^a-z0-9一-鿿]+', '-', 'g'), '^-+|-+$', '', 'g'), 1, 80), '-+$', ''), ''), 'untitled')"""


@query(f"""SELECT {_SLUG} || '-' || substr(sha256(coalesce(text, '')), 1, 8) || '.md' AS file_name, '---' || chr(10) || 'source: ' || {_CELL("source")} || chr(10) || 'lang: ' || {_CELL("lang")} || chr(10) || 'title: ' || {_CELL("title")} || chr(10) || '---'
  || chr(10) || chr(10) || '# ' || coalesce(title, '') || chr(10) || chr(10) || coalesce(text, '') AS document FROM documents""")
def markdown_documents(t):
    return sinks.markdown(t("documents"), ["source", "lang", "title"], F.col("title"), F.col("text"))


@query(time_sql.READ + f"""SELECT i.item_id FROM source_item i JOIN source_config s ON s.id = i.source_id LEFT JOIN r ON r.field = 'source_item.published_at' AND r.rec_id = i.item_id WHERE r.utc IS NULL OR r.utc >= TIMESTAMP '{AS_OF}' - to_days(s.lookback_days)""")
def item_lookback_filter(t):
    """Items whose date cannot be read, or is not older than their source looks back."""
    config = t("source_config")
    dated = instants.instants(t("source_item"), config, "published_at", "source_id", "url", "item_id", "x").select(F.col("rec_id").alias("item_id"), "utc")
    known = t("source_item").select("item_id", F.col("source_id").alias("id")).join(rows.small(config.select("id", "lookback_days")), "id")
    return known.join(dated, "item_id", "left").where(F.col("utc").isNull() | (F.col("utc") >= F.expr(f"timestamp '{AS_OF}' - make_dt_interval(lookback_days)"))).select("item_id")


@query("SELECT item_id, trim(url) AS url, nullif(trim(title), '') AS title, nullif(trim(author), '') AS author, strftime(discovered_ts, '%Y-%m-%dT%H:%M:%SZ') AS published FROM source_item WHERE url IS NOT NULL AND trim(url) <> ''")
def atom_round_trip(t):
    """Every item written as Atom, fifty to a feed, and parsed again."""
    cell = lambda c: F.replace(F.replace(F.replace(F.replace(F.coalesce(F.trim(c), F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;")), F.lit('"'), F.lit("&quot;"))
    x = F.concat(F.lit('<entry><id>x</id><link rel="self" href="https://self.example/"/><link rel="alternate" href="'), cell("url"), F.lit('"/><title>'), cell("title"), F.lit("</title><updated>"), F.coalesce(utc_text(F.col("discovered_ts")), F.lit("")), F.lit("</updated><author><name>"), cell("author"), F.lit("</name></author></entry>"))
    src = t("source_item").select("item_id", x.alias("x"), F.floor(F.col("item_id") / 50).alias("feed"))
    made = src.groupBy("feed").agg(F.array_sort(F.collect_list(F.struct("item_id", "x"))).alias("i"))
    whole = F.concat(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'), F.array_join(F.transform("i", lambda e: e["x"]), ""), F.lit("</feed>"))
    got = feeds.feed_items(made.select("feed", F.transform("i", lambda e: e["item_id"]).alias("ids"), whole.alias("content")))
    return got.select(F.get("ids", F.col("position")).alias("item_id"), "url", "title", "author", "published")


@query(f"""WITH x AS (SELECT item_id, source_id, CASE WHEN item_id % 2 = 0 THEN '[' || replace(replace(coalesce(title, ''), '[', ''), ']', '') || '](' || url || ')' ELSE 'see ' || url || '.' END AS t, url, title FROM source_item WHERE regexp_matches(url, '^https?://[^\\s()<>"\\]]+$'))
SELECT item_id, CASE WHEN item_id % 2 = 0 THEN replace(replace(title, '[', ''), ']', '') ELSE '' END AS title, CASE WHEN item_id % 2 = 0 THEN url ELSE regexp_replace(url, '[.,;)]+$', '') END AS url FROM x WHERE item_id % 2 = 1 OR replace(replace(coalesce(title, ''), '[', ''), ']', '') <> ''""")
def markdown_links(t):
    """Every item as a Markdown link or as a bare address in a sentence, found again."""
    title = F.translate(F.coalesce("title", F.lit("")), "[]", "")
    text = F.when(F.col("item_id") % 2 == 0, F.concat(F.lit("["), title, F.lit("]("), "url", F.lit(")"))).otherwise(F.concat(F.lit("see "), "url", F.lit(".")))
    items = t("source_item").where(F.col("url").rlike(r'^https?://[^\s()<>"\]]+$')).where((F.col("item_id") % 2 == 1) | (title != ""))
    return feeds.markdown_links(items.select("item_id", text.alias("text")), "item_id").select("item_id", "title", "url")


@query("SELECT doc_id, nullif(trim(regexp_extract(text, '(?m)^# (.+)$', 1)), '') AS heading, coalesce(nullif(trim(title), ''), 'none') AS title FROM (SELECT doc_id, title, CASE WHEN doc_id % 2 = 0 THEN '# ' || coalesce(title, '') || chr(10) || text ELSE text END AS text FROM documents)")
def headings(t):
    text = F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("# "), F.coalesce("title", F.lit("")), F.lit("\n"), "text")).otherwise(F.col("text"))
    return t("documents").select("doc_id", tx.heading(text).alias("heading"), F.coalesce(F.nullif(F.trim("title"), F.lit("")), F.lit("none")).alias("title"))


@query("SELECT status, count(*) AS n FROM (SELECT CASE WHEN status IN ('pending', 'done') THEN status ELSE 'other' END AS status FROM queue_task) GROUP BY 1")
def states_with_default(t):
    return rows.zero_filled(t("queue_task"), "status", ["pending", "done", "other"], "other").where("n > 0")
