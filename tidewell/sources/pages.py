"""Pages to text: title, description, author, date and body of HTML, by the standard parser in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements whose text is not shown, and those that begin a new line.
HIDDEN = {"script", "style", "noscript", "template", "svg", "nav", "footer", "aside", "form"}
BLOCK = {"p", "div", "li", "h1", "h2", "h3", "h4", "section", "article", "main", "blockquote", "br", "tr", "ul", "ol", "table"}
BODIES = ("article", "main", "section", "div", "body")


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.meta: dict[str, str] = {}
        self.title: list[str] = []
        self.bodies: list[tuple[str, list[str]]] = []
        self.whole: list[str] = []
        self.loose: list[str] = []
        self.open: list[tuple[str, list[str]]] = []
        self.hidden = 0
        self.in_title = False

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            key = (a.get("property") or a.get("name") or "").lower()
            self.meta.setdefault(key, a.get("content", ""))
        self.in_title = self.in_title or tag == "title"
        self.hidden += tag in HIDDEN
        if tag in BODIES:
            body = (tag, [])
            self.open.append(body)
            self.bodies.append(body)
        if tag in BLOCK:
            self._add("\n")

    def handle_endtag(self, tag):
        self.in_title = self.in_title and tag != "title"
        self.hidden = max(0, self.hidden - (tag in HIDDEN))
        if tag in BLOCK:
            self._add("\n")
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                del self.open[i:]
                break

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.hidden:
            self._add(data)

    def _add(self, text):
        self.whole.append(text)
        if not self.open:
            self.loose.append(text)
        for _, parts in self.open:
            parts.append(text)


def _lines(parts: list[str]) -> str:
    lines = [" ".join(x.split()) for x in "".join(parts).split("\n")]
    return "\n".join(x for x in lines if x)


def extract(raw: str) -> tuple[str, str, str, str, str]:
    """title, description, author, published, text. The body is the candidate element of most words, an article before a
    main, section, div or the body, or all text of a fragment that has more words outside them; a page's own title gives way to og:title and twitter:title."""
    page = _Page()
    page.feed(raw or "")
    page.close()
    best, most = "", -1
    for kind in BODIES:
        for tag, parts in page.bodies:
            if tag == kind:
                text = _lines(parts)
                n = len(text.split())
                if n > most:
                    best, most = text, n
        if most > 0 and kind in ("article", "main"):
            break
    if len("".join(page.loose).split()) > most:
        best = _lines(page.whole)
    m = page.meta
    title = m.get("og:title") or m.get("twitter:title") or " ".join("".join(page.title).split())
    return title, m.get("description") or m.get("og:description", ""), m.get("author", ""), m.get("article:published_time", ""), best


def extracted(pages: DataFrame, row_id: str, raw: str = "raw") -> DataFrame:
    """row_id, page_title, description, page_author, page_published, body of each page; null raw gives empty texts."""
    kind = dict(pages.dtypes)[row_id]
    names = [row_id, "page_title", "description", "page_author", "page_published", "body"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [extract(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[k] for r in rows], pa.string()) for k in range(5))], names)

    return pages.select(F.col(row_id), F.col(raw)).mapInArrow(run, f"`{row_id}` {kind}, " + ", ".join(f"{n} string" for n in names[1:]))
