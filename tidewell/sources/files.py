"""Folders of small files as tables: notes, JSON states, heartbeats, settings. Listing and reading are Spark's own, so a
folder may lie on any file system and be of any size. Files of no bytes are not listed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import snippet, strip


def _name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def notes(spark: SparkSession, folder: str, since: str | None = None, skip: tuple[str, ...] = ()) -> DataFrame:
    """path, modified, title, snippet, text of the Markdown files below a folder, changed after `since` (a timestamp, put
    to the listing), without those under a folder named in `skip`. The title is the first `# ` line, else a `title:`
    line, else the file's name."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md")
    files = (reader.option("modifiedAfter", since) if since else reader).load(folder)
    for s in skip:
        files = files.where(~F.contains("path", F.lit(f"/{s}/")))
    text = F.decode("content", "UTF-8")
    one = files.select("path", F.col("modificationTime").alias("modified"), text.alias("text"))
    heading, named = F.regexp_extract("text", r"(?m)^\s*# (.+)$", 1), F.regexp_extract("text", r"(?m)^\s*title:(.*)$", 1)
    bare = lambda c: F.nullif(strip(F.regexp_replace(c, r"^[\s\"]+|[\s\"]+$", "")), F.lit(""))
    title = F.coalesce(bare(heading), bare(named), F.regexp_replace(_name(F.col("path")), r"\.md$", ""))
    return one.select("path", "modified", title.alias("title"), snippet(F.col("text")).alias("snippet"), "text")


def some_files(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """name, text of the files of these names that the folder holds."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "{" + ",".join(names) + "}").load(folder)
    return files.select(_name(F.col("path")).alias("name"), F.decode("content", "UTF-8").alias("text"))


def json_states(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """state, path and the fields of `schema` of the JSON files in a folder of one subfolder a state. Files that hold no
    JSON object are left out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").load(folder)
    one = files.select("path", F.decode("content", "UTF-8").alias("_t")).where(F.get_json_object("_t", "$").startswith("{"))
    parsed = one.select(F.element_at(F.split("path", "/"), -2).alias("state"), "path", F.from_json("_t", schema).alias("_j"))
    return parsed.select("state", "path", "_j.*")


def heartbeats(spark: SparkSession, folder: str, now: str, stale_seconds: int = 600) -> DataFrame:
    """role, status, pid, updated_at, stale: the JSON files of a folder by name; one without a readable time is stale."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(folder).select("path", F.decode("content", "UTF-8").alias("_t"))
    get = lambda f: F.get_json_object("_t", f"$.{f}")
    age = F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(get("updated_at").try_cast("timestamp"))
    role = F.regexp_replace(_name(F.col("path")), r"\.json$", "")
    return files.select(role.alias("role"), get("status").alias("status"), get("pid").try_cast("bigint").alias("pid"), get("updated_at").alias("updated_at"), (F.coalesce(age, F.lit(stale_seconds + 1)) > stale_seconds).alias("stale"))


def flat_yaml(rows: DataFrame, text: str = "text") -> DataFrame:
    """All columns but the text, with position and item (map<string,string>): the entries of a YAML list of flat mappings
    or of plain values (key `value`). Comments and blank lines are dropped, quotes taken off; nesting is not read."""
    lines = F.filter(F.split(F.col(text), "\n"), lambda x: ~x.rlike(r"^\s*(?:#.*)?$"))
    joined = F.concat(F.lit("\n"), F.array_join(lines, "\n"))
    entries = F.slice(F.split(joined, r"\n\s*- "), 2, 1_000_000_000)
    one = rows.select(*[c for c in rows.columns if c != text], F.posexplode(entries).alias("position", "_e"))
    clean = lambda x: F.regexp_replace(strip(F.regexp_replace(x, r"\s+#.*$", "")), r"^([\"'])(.*)\1$", "$2")
    pairs = F.transform(F.filter(F.split("_e", "\n"), lambda x: x.rlike(r"^\s*[A-Za-z_][A-Za-z0-9_]*:(?:\s|$)")), lambda x: F.struct(F.regexp_extract(x, r"^\s*([A-Za-z0-9_]+):", 1).alias("k"), clean(F.regexp_replace(x, r"^\s*[A-Za-z0-9_]+:", "")).alias("v")))
    item = F.when(F.size(pairs) > 0, F.map_from_entries(pairs)).otherwise(F.create_map(F.lit("value"), clean(F.col("_e"))))
    return one.select(*[c for c in one.columns if c != "_e"], item.alias("item"))


def required(items: DataFrame, fields: list[str], item: str = "item") -> DataFrame:
    """The rows with `missing`: which of the fields are absent or blank, in their order."""
    lacks = [F.when(F.coalesce(strip(F.try_element_at(F.col(item), F.lit(f))), F.lit("")) == "", F.lit(f)) for f in fields]
    return items.withColumn("missing", F.array_compact(F.array(*lacks)))


# Where sites commonly keep their feed.
FEED_PATHS = ["/feed", "/feed/", "/rss", "/rss.xml", "/atom.xml", "/feed.xml", "/index.xml", "/feeds/posts/default"]


def feed_candidates(page: Column, site: Column, paths: list[str] = FEED_PATHS) -> Column:
    """The addresses at which a site's feed may be, in order: those its page names as alternates, then common paths."""
    links = F.filter(F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(r"(?is)<link\b[^>]*>"), F.lit(0)), lambda x: x.rlike(r"(?i)rel=[\"']?alternate") & x.rlike(r"(?i)application/(?:rss|atom)\+xml"))
    named = F.filter(F.transform(links, lambda x: F.regexp_extract(x, r"(?i)href=[\"']([^\"']+)", 1)), lambda x: x != "")
    root = F.regexp_replace(site, r"^([a-z]+://[^/]+).*$", "$1")
    whole = F.transform(named, lambda x: F.when(x.startswith("/"), F.concat(root, x)).otherwise(x))
    return F.array_distinct(F.concat(whole, F.array(*[F.concat(root, F.lit(p)) for p in paths])))
