"""Feeds and lists: RSS, Atom, address lists, and a Python data source that reads a folder of feed files."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


_SEPARATOR = "\u241f"


def _fields(item: Column, paths: list[str]) -> Column:
    """The text at each path below the item's root element, '' where there is none. All are asked for in one expression,
    as every call of the XPath functions parses the item again."""
    asked = f", '{_SEPARATOR}', ".join(f"string(/*/{p})" for p in paths)
    return F.split(F.xpath_string(F.replace(item, F.lit(_SEPARATOR), F.lit(" ")), F.lit(f"concat({asked})")), _SEPARATOR)


def _items(content: Column, tag: str) -> Column:
    return F.regexp_extract_all(content, F.lit(rf"(?is)<(?:[a-z0-9]+:)?{tag}(?:\s[^>]*)?>.*?</(?:[a-z0-9]+:)?{tag}>"), F.lit(0))


def feed_items(feeds: DataFrame, content: str = "content") -> DataFrame:
    """All columns of `feeds` but the content, with position, title, url, published, author: an RSS feed's items or, where
    it has none, an Atom feed's entries. Items without link are dropped; text that is no feed gives none.

    A feed is cut into items by tag first, so that one malformed item does not lose the others; namespaces are
    stripped from tags, as items cut out do not declare them.
    """
    rss, atom = _items(F.col(content), "item"), _items(F.col(content), "entry")
    bare = lambda x: F.regexp_replace(F.regexp_replace(x, r"<(/?)[A-Za-z0-9]+:", "<$1"), r"\sxmlns(?::[A-Za-z0-9]+)?=(?:\"[^\"]*\"|'[^']*')|(\s)[A-Za-z0-9]+:([A-Za-z]+=)", "$1$2")
    chosen = F.when(F.size(rss) > 0, rss).otherwise(atom)
    one = feeds.select("*", F.posexplode(F.transform(chosen, bare)).alias("position", "_x"))
    at = {
        "title": ["title"],
        "url": ["link[not(@href)]", "link[@rel='alternate' or not(@rel)]/@href", "link/@href"],
        "published": ["pubDate", "date", "published", "updated"],
        "author": ["author/name", "author", "creator"],
    }
    paths = [p for asked in at.values() for p in asked]
    one = one.withColumn("_f", _fields(F.col("_x"), paths))
    first = lambda asked: F.coalesce(*[F.nullif(F.trim(F.try_element_at("_f", F.lit(paths.index(p) + 1))), F.lit("")) for p in asked])
    out = one.select(*[c for c in feeds.columns if c != content], "position", *[first(asked).alias(name) for name, asked in at.items()])
    return out.where("url IS NOT NULL")


def address_list(spark: SparkSession, path: str) -> DataFrame:
    """url: one address per line; blank lines and those that begin with # are dropped."""
    line = F.trim("value")
    return spark.read.text(path).select(line.alias("url")).where((F.col("url") != "") & ~F.col("url").startswith("#"))


def markdown_links(rows: DataFrame, row_id: str, text: str = "text") -> DataFrame:
    """row_id, title, url: `[title](url)` links, or where a text has none its bare addresses; the first of each."""
    marked = F.regexp_extract_all(text, F.lit(r"\[[^\]]+\]\(https?://[^)\s]+\)"), F.lit(0))
    bare = F.regexp_extract_all(text, F.lit(r"https?://[^\s)\]<>\"]+"), F.lit(0))
    pairs = F.transform(marked, lambda m: F.struct(F.regexp_extract(m, r"^\[([^\]]+)\]", 1).alias("title"), F.regexp_extract(m, r"\(([^)]+)\)$", 1).alias("url")))
    plain = F.transform(bare, lambda u: F.struct(F.lit("").alias("title"), F.regexp_replace(u, r"[.,;)]+$", "").alias("url")))
    found = rows.select(row_id, F.posexplode(F.when(F.size(marked) > 0, pairs).otherwise(plain)).alias("i", "l"))
    first = found.groupBy(row_id, F.col("l.url").alias("url")).agg(F.min_by("l.title", "i").alias("title"))
    return first.select(row_id, "title", "url")


class _File(InputPartition):
    def __init__(self, path: str):
        self.path = path


class _FolderReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder = urlsplit(options["path"]).path

    def partitions(self) -> list[_File]:
        return [_File(str(p)) for p in sorted(Path(self.folder).glob("**/*")) if p.suffix in (".xml", ".rss", ".atom")]

    def read(self, partition: _File) -> Iterator[tuple[str, str | None, str | None]]:
        try:
            yield partition.path, Path(partition.path).read_text("utf-8", "replace"), None
        except OSError as e:  # an unreadable feed is a row with its error, not a failed query
            yield partition.path, None, f"fetch_failed: {e.__class__.__name__}"


class FeedFolder(DataSource):
    """`spark.read.format("feed_folder").load(path)`: feed_url, content, error; one partition per file."""

    @classmethod
    def name(cls) -> str:
        return "feed_folder"

    def schema(self) -> str:
        return "feed_url string, content string, error string"

    def reader(self, schema) -> _FolderReader:
        return _FolderReader(self.options)
