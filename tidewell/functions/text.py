"""Scalars over text."""

from __future__ import annotations

import html
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: White space as Unicode has it, and the separators of files, groups, records and units.
SPACES = r" \t\n\r\f\x0B\x1C-\x1F\u0085\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
BLANK = f"[{SPACES}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` computed once, where the branches of a condition would each compute it again."""
    return F.element_at(F.transform(F.array(value), body), 1)


def strip(text: Column) -> Column:
    """A text without white space at its ends."""
    return F.regexp_replace(text, f"^{BLANK}|{BLANK}$", "")


def short_hash(value: Column, length: int = 16) -> Column:
    """The first `length` hexadecimal digits of a text's SHA-256."""
    return F.substring(F.sha2(value, 256), 1, length)


def word_count(text: Column) -> Column:
    """Words between white space; 0 for null."""
    return F.coalesce(F.size(F.filter(F.split(text, BLANK), lambda w: w != "")), F.lit(0)).cast("bigint")


def slug(text: Column, length: int = 80, otherwise: str = "untitled") -> Column:
    """Letters, digits and Han characters kept, everything else one hyphen; cut to `length`."""
    s = F.regexp_replace(F.lower(text), r"[^a-z0-9一-鿿]+", "-")
    s = F.regexp_replace(F.substring(F.regexp_replace(s, r"^-+|-+$", ""), 1, length), r"-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(otherwise))


def clean_title(title: Column) -> Column:
    """What comes before the first ` | ` or ` - `."""
    return F.trim(F.element_at(F.split(title, r"\s+[|-]\s+"), 1))


def heading(markdown: Column) -> Column:
    """The first `# ` line of a Markdown text, null if there is none."""
    return F.nullif(F.trim(F.regexp_extract(markdown, r"(?m)^# (.+)$", 1)), F.lit(""))


def unfenced(text: Column) -> Column:
    """A text without the code fence around it."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[A-Za-z]*\s*", ""), r"\s*```$", ""))


def strip_tags(html: Column) -> Column:
    """The body's text with tags, scripts and styles replaced by spaces; the whole page where there is no body."""
    body = F.regexp_extract(html, r"(?is)<body[^>]*>(.*)</body>", 1)
    page = F.when(body != "", body).otherwise(html)
    page = F.regexp_replace(page, r"(?is)<(script|style)[^>]*>.*?</(?:script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(page, r"<[^>]+>", " "), BLANK, " "))


def sentences(text: Column) -> Column:
    """Sentences: cut after . ! ? before white space, at line ends, and after the Chinese full stops."""
    return F.filter(F.transform(F.split(text, r"(?<=[.!?])[ \t]+|(?<=[。!?])\n*|\n+"), lambda s: F.trim(s)), lambda s: s != "")


def has_keyword(text: Column, word: str) -> Column:
    """Whether a text holds a keyword: one of ASCII letters or digits between others than such, in any case; another as
    it stands. Never null."""
    if word.isascii() and any(c.isalnum() for c in word):
        return F.coalesce(text.rlike(rf"(?i)(?<![A-Za-z0-9]){re.escape(word)}(?![A-Za-z0-9])"), F.lit(False))
    return F.coalesce(F.contains(text, F.lit(word)), F.lit(False))


def hits(text: Column, terms: list[str]) -> Column:
    """How many of the keywords a text holds."""
    return sum((has_keyword(text, t).cast("int") for t in terms), F.lit(0))


def relevance(ai: Column, infra: Column, finance: Column, company: Column, most_companies: int = 2) -> Column:
    """The weight of a note by its keywords; null where they do not belong together."""
    belong = ((infra >= 2) & (ai >= 1)) | ((infra >= 1) & (finance >= 1)) | ((infra >= 1) & (ai >= 1) & (company >= 1)) | (finance >= 2) | ((finance >= 1) & (company >= 1))
    return F.when(belong, ai + infra + finance + F.least(company, F.lit(most_companies)))


def snippet(markdown: Column, length: int = 140, otherwise: str = "") -> Column:
    """The first `length` characters of a Markdown text's plain lines: no front matter, no headings, bars as slashes."""
    body = F.regexp_replace(markdown, r"(?s)^\s*---[ \t]*\n.*?\n[ \t]*---[ \t]*(?:\n|$)", "")
    lines = F.transform(F.split(body, "\n"), lambda x: F.replace(strip(x), F.lit("|"), F.lit("/")))
    plain = F.array_join(F.filter(lines, lambda x: (x != "") & ~x.startswith("#") & (x != "---")), " ")
    return F.coalesce(F.nullif(F.substring(plain, 1, length), F.lit("")), F.lit(otherwise))


@F.pandas_udf(StringType())
def unescaped(text: pd.Series) -> pd.Series:
    """Character references (`&amp;`, `&#8217;`) read; named ones are too many for an expression."""
    return text.map(html.unescape, na_action="ignore")


def inline(text: Column) -> Column:
    """A text on one line: character references read, white space single."""
    return F.trim(F.regexp_replace(unescaped(text), BLANK, " "))


def post_facts(text: Column, url: Column) -> Column:
    """subreddit, points, comments, author of a post as discussion sites write them; each '' where it is not said."""
    of = lambda pattern, where: F.coalesce(F.regexp_extract(where, pattern, 1), F.lit(""))
    return F.struct(of(r"/r/([^/]+)", url).alias("subreddit"), of(r"(?i)([0-9]+(?:\.[0-9]+[kK])?)\s+points?", text).alias("points"), of(r"(?i)([0-9]+)\s+comments?", text).alias("comments"), of(r"(?i)\bby\s+([A-Za-z0-9_-]+)", text).alias("author"))


def month_week(ts: Column) -> Column:
    """`yyyy-MM-Wn`, the n-th seven days of the month."""
    return F.concat(F.date_format(ts, "yyyy-MM"), F.lit("-W"), F.floor((F.dayofmonth(ts) - 1) / 7).cast("int") + 1)


def reader_title(text: Column) -> Column:
    """The `Title: ` line of a reader's output, null if there is none."""
    return F.nullif(F.trim(F.regexp_extract(text, r"(?m)^Title: (.*)$", 1)), F.lit(""))


def reader_body(text: Column) -> Column:
    """What follows `Markdown Content:`; the whole text where that line is missing."""
    body = F.regexp_extract(text, r"(?s)Markdown Content:\s*(.*)$", 1)
    return F.when(text.rlike("Markdown Content:"), F.trim(body)).otherwise(text)


def front_matter(document: Column, field: str) -> Column:
    """A field of a Markdown document's front matter, without quotes; null if absent."""
    block = F.regexp_extract(document, r"(?s)^---\n(.*?)\n---(?:\n|$)", 1)
    return F.nullif(F.regexp_replace(F.regexp_extract(block, rf"(?m)^{field}: (.*)$", 1), r'^"|"$', ""), F.lit(""))


def yaml_scalar(value: Column) -> Column:
    """A value as a YAML scalar: bare where plain, else quoted; null is ''."""
    v = F.coalesce(value, F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    return F.when(v.rlike(r"^[A-Za-z0-9][A-Za-z0-9 ._/-]*$"), v).otherwise(quoted)


def table_cell(value: Column) -> Column:
    """A value inside a Markdown table: bars and line ends replaced."""
    return F.trim(F.regexp_replace(F.replace(F.coalesce(value, F.lit("")), F.lit("|"), F.lit("/")), r"\s*\n\s*", " "))


def numbered(items: Column) -> Column:
    """`1. a\\n2. b`, `unavailable` for no items."""
    made = F.array_join(F.transform(items, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    return F.when(F.coalesce(F.size(items), F.lit(0)) > 0, made).otherwise(F.lit("unavailable"))


def response_text(body: Column) -> Column:
    """The text of a service's JSON answer: the first choice's message, the first text part, else the body as it is."""
    return F.coalesce(F.get_json_object(body, "$.choices[0].message.content"), F.get_json_object(body, "$.content[0].text"), body)


def typed(value: Column) -> Column:
    """kind of a setting written as text: null, bool, int, float or string."""
    v = F.lower(F.trim(value))
    return F.when(v.isNull() | v.isin("", "null", "~"), "null").when(v.isin("true", "false", "yes", "no", "on", "off"), "bool").when(v.rlike(r"^[+-]?\d+$"), "int").when(v.rlike(r"^[+-]?(\d+\.\d*|\.\d+)([e][+-]?\d+)?$"), "float").otherwise("string")


def backoff(attempt: Column, base: float = 1.0, most: float = 10.0) -> Column:
    """Seconds to wait before an attempt (from 1): doubling from `base` up to `most`."""
    return F.least(F.lit(base) * F.pow(F.lit(2.0), attempt - 1), F.lit(most))
