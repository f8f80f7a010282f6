"""Records between their forms: raw answers, rows, JSON texts, log lines and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import short_hash, strip
from ..functions.urls import host_of


def text_of(value: Column) -> Column:
    """A text, '' for null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def enum_of(value: Column, domain: list[str], otherwise: str) -> Column:
    """A value of a closed domain; null and foreign values become `otherwise`."""
    return F.when(value.isin(domain), value).otherwise(F.lit(otherwise))


def clip01(value: Column) -> Column:
    """A share between 0 and 1: what lies outside is cut off, null and no number are 0."""
    return F.when(value.isNull() | F.isnan(value), F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)))


def fetched(url: Column, title: Column, text: Column, source_type: Column, author: Column, published: Column, metadata: Column, at: Column) -> Column:
    """A fetched content of a channel's raw answer: the title is the first 100 characters of the address where none is
    given, the source the host, the hash that of the text; null texts are ''."""
    body = text_of(text)
    return F.struct(
        url.alias("url"), host_of(url).alias("source"), text_of(source_type).alias("source_type"), F.coalesce(F.nullif(strip(title), F.lit("")), F.substring(url, 1, 100)).alias("title"), body.alias("text"),
        at.alias("fetched_at"), short_hash(body).alias("content_hash"), text_of(author).alias("author"), text_of(published).alias("published_at"), F.coalesce(metadata, F.create_map().cast("map<string,string>")).alias("metadata"),
    )


def searched(url: Column, title: Column, content: Column) -> Column:
    """url, title (200 characters), text, error of a search result; one without address is an error."""
    missing = text_of(url) == ""
    return F.struct(text_of(url).alias("url"), F.substring(text_of(title), 1, 200).alias("title"), text_of(content).alias("text"), F.when(missing, F.lit("missing_url")).alias("error"))


def with_defaults(metadata: Column, defaults: dict[str, Column]) -> Column:
    """A map with entries added where their keys are missing; null values are not added, a null map counts as empty."""
    kept = F.map_filter(F.create_map(*[x for k, v in defaults.items() for x in (F.lit(k), v)]), lambda _, v: v.isNotNull())
    return F.map_concat(kept, F.coalesce(metadata, F.create_map().cast("map<string,string>")))


def merged_tree(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """key, value of settings given as paths: those of `over` win, and one that is set there takes the place of a whole
    branch below it (and of a value above it) in `base`."""
    b, o = base.select(F.col(key).alias("k"), "value"), over.select(F.col(key).alias("k"), "value")
    clash = (F.col("b.k") == F.col("o.k")) | F.col("b.k").startswith(F.concat(F.col("o.k"), F.lit("."))) | F.col("o.k").startswith(F.concat(F.col("b.k"), F.lit(".")))
    return b.alias("b").join(F.broadcast(o.alias("o")), clash, "left_anti").unionByName(o).select(F.col("k").alias(key), "value")


def item_json(columns: list[str]) -> Column:
    """A row as a JSON text with its keys in order; null fields stay in it."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def item_of(payload: Column) -> Column:
    """A message of a JSON text, whatever is missing or of another kind: texts '', scores 0, attempts 0, state pending."""
    get = lambda f: F.get_json_object(payload, f"$.{f}")
    number = lambda f: clip01(get(f).try_cast("double"))
    states = ["pending", "processing", "sent", "failed"]
    return F.struct(
        *[text_of(get(f)).alias(f) for f in ("event_id", "lane", "text", "url", "prompt_hash", "created_at", "expires_at")],
        *[number(f).alias(f) for f in ("final_score", "business_story_fit")],
        F.greatest(F.lit(0), F.coalesce(get("attempts").try_cast("int"), F.lit(0))).alias("attempts"),
        enum_of(get("state"), states, "pending").alias("state"),
    )


def compared(runs: dict[str, DataFrame], key: str, value: str) -> DataFrame:
    """key, one column a run (`missing` where it has no such key) and `agree`: runs side by side, one row for each key of
    any. Each run has one row a key."""
    out = None
    for name, run in runs.items():
        side = run.select(key, F.coalesce(F.col(value), F.lit("")).alias(name))
        out = side if out is None else out.join(side, key, "full_outer")
    out = out.select(key, *[F.coalesce(F.col(n), F.lit("missing")).alias(n) for n in runs])
    first = next(iter(runs))
    same = F.lit(True)
    for n in runs:
        same = same & (F.col(n) == F.col(first))
    return out.withColumn("agree", same)


def table_markdown(rows: DataFrame, columns: list[str], group: str, order: list[str]) -> DataFrame:
    """group, lines, n: the rows of each group as the lines of a Markdown table, in order. Meant for reports: a group is
    as long as its table."""
    cell = lambda c: F.replace(F.regexp_replace(text_of(F.col(c)), r"\s+", " "), F.lit("|"), F.lit("/"))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in columns]), F.lit(" |"))
    one = rows.select(F.col(group), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], line.alias("_l"))
    got = one.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*[f"_o{i}" for i in range(len(order))], "_l"))).alias("_s"))
    head = F.lit("| " + " | ".join(columns) + " |\n|" + "---|" * len(columns))
    return got.select(group, F.concat_ws("\n", head, F.array_join(F.transform("_s", lambda x: x["_l"]), "\n")).alias("lines"), F.size("_s").cast("bigint").alias("n"))


def coalesced(update: Column, kinds: list[str]) -> Column:
    """chat, text of a chat update in JSON: of the first kind it holds, the text or else the caption; null chat and ''
    for one that holds none."""
    at = lambda k, f: F.get_json_object(update, f"$.{k}.{f}")
    held = [F.get_json_object(update, f"$.{k}") for k in kinds]
    chat, text = F.lit(None).cast("string"), F.lit("")
    for k, h in reversed(list(zip(kinds, held))):
        chat = F.when(h.isNotNull(), at(k, "chat.id")).otherwise(chat)
        text = F.when(h.isNotNull(), F.coalesce(at(k, "text"), at(k, "caption"), F.lit(""))).otherwise(text)
    return F.struct(chat.alias("chat"), text.alias("text"))


def command_of(text: Column) -> Column:
    """kind (`command`, `url` or `input`), name and rest of what a user wrote: `/name rest`, an address, or anything."""
    t = strip(F.coalesce(text, F.lit("")))
    name = F.lower(F.regexp_extract(t, r"^/([A-Za-z_]+)", 1))
    kind = F.when(name != "", "command").when(t.rlike(r"^(?:https?://|www\.)\S+$"), "url").otherwise("input")
    return F.struct(kind.alias("kind"), name.alias("name"), F.when(kind == "command", strip(F.regexp_replace(t, r"^/[A-Za-z_]+(?:@\S+)?", ""))).otherwise(t).alias("rest"))


def latest_file(files: DataFrame, group: str, at: str, path: str) -> DataFrame:
    """group, path of the newest file of each group; of equally new ones the last by name."""
    return files.groupBy(group).agg(F.max(F.struct(at, path)).alias("_f")).select(group, F.col(f"_f.{path}").alias(path))


def retry_after(header: Column, otherwise: int = 5) -> Column:
    """Minutes to wait by an answer's text: `retry after N seconds` or `N minutes`, rounded up, at least one; `otherwise`
    where it says nothing."""
    seconds = F.regexp_extract(header, r"(?i)retry[- ]after[: ]+([0-9]+)\s*(?:s|sec|seconds?)?\b", 1).try_cast("double")
    minutes = F.regexp_extract(header, r"(?i)retry[- ]after[: ]+([0-9]+)\s*(?:m|min|minutes?)\b", 1).try_cast("double")
    said = F.coalesce(minutes, F.ceil(seconds / 60).cast("double"))
    return F.when(said.isNull(), F.lit(otherwise)).otherwise(F.greatest(F.lit(1), said.cast("int")))


def http_failure(status: Column) -> Column:
    """kind, action, retryable of an answer's status; kind null for success."""
    s = lambda kind, action, again: F.struct(F.lit(kind).cast("string").alias("kind"), F.lit(action).alias("action"), F.lit(again).alias("retryable"))
    return (
        F.when(status.between(200, 299), s(None, "none", False)).when(status == 401, s("auth_invalid", "auth_refresh_required", False)).when(status == 403, s("content_blocked", "manual_review", False))
        .when(status == 404, s("fetch_failed", "drop", False)).when(status == 429, s("rate_limited", "retry_later", True)).when(status >= 500, s("fetch_failed", "retry_later", True)).otherwise(s("fetch_failed", "manual_review", False))
    )


def open_circuits(calls: DataFrame, route: str, order: str, failed: Column, most: int, rest_minutes: int, at: str) -> DataFrame:
    """route, failures, open_until: routes whose last `most` calls or more failed in a row, and until when they rest."""
    good = calls.where(~F.coalesce(failed, F.lit(False))).groupBy(route).agg(F.max(order).alias("_good"))
    later = calls.join(good, route, "left").where(F.col("_good").isNull() | (F.col(order) > F.col("_good")))
    n = later.groupBy(route).agg(F.count(F.lit(1)).alias("failures"), F.max(F.col(at).try_cast("timestamp")).alias("_at")).where(F.col("failures") >= most)
    return n.select(route, "failures", F.timestamp_seconds(F.unix_seconds("_at") + rest_minutes * 60).alias("open_until"))


