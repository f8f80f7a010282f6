"""The main body of pages (problem 1), by minimum cut.

A page is a list of blocks, the text nodes of its HTML between block tags. For each block a classifier gives the odds
that it is part of the article, from its words and its place in the DOM; the odds' logarithm becomes a terminal
capacity, to the source where positive and to the sink where negative. Smoothness edges join neighbouring blocks and
each block with a node for its parent element, so that the children of one element tend to go together, and a few of
them (a byline, a prompt between paragraphs) may still leave. The minimum cut is the labelling of least cost: nodes
whose own capacity outweighs all their edges are settled first, which is exact, and augmenting paths cut the rest.

The word part is naive Bayes over pairs of words (of characters for Han), fitted on blocks whose place
leaves little doubt (navigation, footers and link lists against paragraphs of the largest body of text), of about
`FIT_PAGES` pages. Everything else runs over all pages, whole; so are the lines counted that come back within a site.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host_of
from . import sitelines
from .residue import furniture

#: Pages the word model is fitted on, chosen by a hash of their id; the only bound in this operator.
FIT_PAGES = 12_000
CLIP, WORD_CLIP, NEW = 6.0, 5.0, 1.0
NEIGHBOUR, NEIGHBOUR_APART, PARENT = 0.35, 0.1, 0.8

# HTML elements by role.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
SKIP = {"script", "style", "noscript", "template", "svg", "head", "iframe", "select", "button"}
INLINE = {"b", "i", "em", "strong", "u", "sup", "sub", "code", "mark", "abbr", "time", "q", "cite", "font", "br", "wbr"}
FURNITURE = {"nav", "footer", "aside", "header", "menu", "form", "dialog"}
BODY = {"article": 1.5, "main": 1.0}
PROSE = {"p", "li", "blockquote", "pre", "h1", "h2"}
TAG = {"p": 0.8, "h1": 2.5, "h2": 1.2, "h3": -0.8, "h4": -0.5, "li": 0.4, "blockquote": 1.5, "pre": 1.0, "figcaption": -1.0, "small": -4.0, "span": -3.0, "a": -3.0, "div": -1.5, "td": -0.5}

_TOKEN = re.compile(r"<!--.*?-->|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|([^<]+)|<", re.S)
_ELEMENT = r"(?i)<(?:a|abbr|address|article|aside|audio|b|blockquote|body|br|button|center|cite|code|dd|del|details|dialog|div|dl|dt|em|embed|fieldset|figcaption|figure|font|footer|form|h[1-6]|head|header|hr|html|i|iframe|img|input|ins|label|li|link|main|mark|menu|meta|nav|noscript|ol|option|p|picture|pre|q|s|script|section|select|small|source|span|strong|style|sub|summary|sup|svg|table|tbody|td|template|tfoot|th|thead|time|title|tr|u|ul|video|wbr)(?=[\s/>])"
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")
_WORD = re.compile(r"[^\W\d_]+|0")
_HAN = re.compile(r"[㐀-鿿]")


def is_html(raw: Column, text: Column) -> Column:
    """Whether a page's raw form is HTML: a whole document, or a fragment, which holds an element and is not the text
    itself. Never null."""
    whole = raw.rlike(r"(?is)^\s*(?:<\?xml[^>]*>\s*)?(?:<!--.*?-->\s*)*<(?:!doctype\s+html|html|head|body)\b")
    return F.coalesce(whole | (~raw.eqNullSafe(text) & raw.rlike(_ELEMENT)), F.lit(False))


def plain(text: str) -> str:
    """A line as it is compared: case and white space ignored."""
    return " ".join(text.split()).lower()


def blocks(raw: str) -> list[tuple[str, str, int, bool, float]]:
    """(text, tag, parent, in furniture, share of link text) of each block; parents are numbers of elements."""
    out: list[tuple[str, str, int, bool, float]] = []
    stack: list[tuple[str, int, bool]] = [("", 0, False)]
    buf: list[str] = []
    linked = total = n = skip = 0
    skipping = ""

    def flush() -> None:
        nonlocal linked, total
        if buf:
            text = html.unescape("".join(buf))
            if text and not text.isspace():
                tag, at, furniture = stack[-1]
                parent = stack[-2][1] if len(stack) > 1 else 0
                if tag == "a" or tag == "span" and len(stack) > 2 and stack[-2][0] == "a":
                    linked = total
                out.append((text, tag, parent, furniture, linked / total if total else 0.0))
            buf.clear()
        linked = total = 0

    anchor = 0
    for m in _TOKEN.finditer(raw):
        close, tag, _, text = m.groups()
        if text is not None:
            if not skip:
                buf.append(text)
                total += len(text)
                if anchor:
                    linked += len(text)
            continue
        if tag is None:
            continue
        tag = tag.lower()
        if skip:
            if tag == skipping:
                skip += -1 if close else 1
            continue
        if tag in INLINE:
            if tag == "br":
                buf.append("\n")
            continue
        flush()
        if close:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == tag:
                    anchor -= sum(x[0] == "a" for x in stack[k:])
                    del stack[k:]
                    break
        elif tag in SKIP:
            skip, skipping = 1, tag
        elif tag not in VOID and not m.group(3).endswith("/"):
            if tag in ("p", "li") and stack[-1][0] == tag:  # their end tags may be left out
                stack.pop()
            n += 1
            stack.append((tag, n, stack[-1][2] or tag in FURNITURE))
            anchor += tag == "a"
    flush()
    return out


def _masked(text: str, site: str) -> str:
    """A block's text with digits alike and the site's name as one word."""
    low = _DIGITS.sub("0", plain(text))
    return low.replace(site, " _site_ ") if site else low


def _terms(masked: str) -> set:
    """Pairs of neighbouring words of a block and its ends. Single words would tell furniture from prose by "you" and
    "not" alone."""
    words: list[str] = []
    for w in _WORD.findall(masked):
        if _HAN.search(w):
            words.extend(w)
        else:
            words.append(w)
    return set(zip(["^", *words], [*words, "$"]))


def _weak(page: list[tuple]) -> list[int]:
    """1 article, 0 furniture, -1 not sure, by place alone: for fitting the words."""
    mass: Counter = Counter()
    for text, tag, parent, furniture, link in page:
        if tag in ("p", "blockquote") and not furniture and link < 0.5:
            mass[parent] += len(text)
    body = max(mass, key=lambda k: mass[k]) if mass else -1
    total = sum(mass.values())
    out = []
    for _, tag, parent, furniture, link in page:
        if furniture or link > 0.5 or tag in ("small", "span", "div", "a"):
            out.append(0)
        elif parent == body and mass[body] > 0.7 * total and mass[body] > 400:
            out.append(1)
        else:
            out.append(0 if total and mass[body] > 0.7 * total and mass[body] > 400 else -1)
    return out


def _site(source: str | None, url: str | None) -> str:
    if source:
        return source.lower()
    host = re.match(r"^[a-zA-Z]+://(?:[^/@]*@)?(?:www\.|m\.)?([^./:]+)", url or "")
    return host.group(1).lower() if host else ""


def fit(rows: DataFrame, fit_pages: int = FIT_PAGES) -> dict:
    """The word model: term -> logarithm of the odds for the article. rows: content_id, url, source, text, raw.

    The pages are those whose id hashes below a limit that lets through about `fit_pages` of them. Prompts set as
    paragraphs are known by their return, word for word, in otherwise different texts of a site, counted over all rows.
    """
    pages = rows.where(is_html(F.col("raw"), F.col("text")))
    n = pages.count()
    if n > fit_pages:
        pages = pages.where(F.pmod(F.xxhash64("content_id"), F.lit(n)) < fit_pages)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for host, url, source, raw in zip(*(b.column(c).to_pylist() for c in ("host", "url", "source", "raw"))):
                page = blocks(raw)
                site = _site(source, url)
                out.extend((host, plain(p[0]) if p[1] in PROSE - {"h1", "h2"} else None, _masked(p[0], site), label) for p, label in zip(page, _weak(page)) if label >= 0)
            cols = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, (pa.string(), pa.string(), pa.string(), pa.int32()))], ["host", "prose", "text", "label"])

    host = host_of(F.col("url")).alias("host")
    found = pages.select(host, "url", "source", "raw").mapInArrow(cut, "host string, prose string, text string, label int")
    prompts = furniture(rows.select(host_of(F.col("url")).alias("source"), "text")).select(F.col("source").alias("host"), "h", F.lit(True).alias("prompt"))
    keyed = found.withColumn("h", F.xxhash64(sitelines.norm(F.col("prose"))))
    lines = keyed.join(prompts, ["host", "h"], "left").groupBy("text", F.when(F.col("prompt") & F.col("prose").isNotNull(), F.lit(0)).otherwise(F.col("label")).alias("label")).agg(F.count(F.lit(1)).alias("n"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple, list[int]] = {}
        for b in batches:
            for text, n, label in zip(*(b.column(c).to_pylist() for c in ("text", "n", "label"))):
                for t in _terms(text):
                    seen.setdefault(t, [0, 0])[label] += n
        yield pa.RecordBatch.from_arrays([pa.array(["\t".join(t) for t in seen], pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], ["term", "furniture", "article"])

    counted = lines.mapInArrow(count, "term string, furniture bigint, article bigint")
    summed = counted.groupBy("term").agg(F.sum("furniture").alias("f"), F.sum("article").alias("a")).where("f + a > 1")
    got = [(r.term, r.f, r.a) for r in summed.collect()]  # the vocabulary of about fit_pages pages
    nf, na = max(1, sum(x[1] for x in got)), max(1, sum(x[2] for x in got))
    return {tuple(t.split("\t")): -math.log((f / nf * 1e6 + 5) / (a / na * 1e6 + 5)) for t, f, a in got}


def costs(page: list[tuple], model: dict, site: str, memo: dict) -> list[float]:
    """For each block the logarithm of the odds that it is article; the terminal capacities."""
    out = []
    for text, tag, _, furniture, link in page:
        prose = tag in PROSE
        key = (text, site, prose) if len(text) < 200 else None  # short blocks come back on many pages
        words = memo.get(key) if key else None
        if words is None:
            terms = _terms(_masked(text, site))
            known = [model[t] for t in terms if t in model]
            # in elements of prose, terms never seen speak for content: furniture says the same on many pages
            total = sum(known) + (NEW * (len(terms) - len(known)) if prose else 0.0)
            words = max(-WORD_CLIP, min(WORD_CLIP, 2.0 * total / math.sqrt(len(terms) + 4))) if terms else 0.0
            if key:
                if len(memo) > 200_000:
                    memo.clear()
                memo[key] = words
        place = TAG.get(tag, -0.5) - (4.0 if furniture else 0.0) - 3.0 * link
        if tag in ("h1", "h2", "h3"):
            words *= 0.4  # headings are short and formulaic on either side
        out.append(max(-CLIP, min(CLIP, place + words)))
    return out


def minimum_cut(unary: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the article's side of a minimum cut. unary: positive pulls there, negative away."""
    n = len(unary)
    u = list(unary)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        if a != b and w > 0:
            near[a][b] = near[a].get(b, 0.0) + w
            near[b][a] = near[b].get(a, 0.0) + w
    label: list[bool | None] = [None] * n
    todo = list(range(n))
    while todo:  # a node that outweighs all its edges is on its own side in some minimum cut
        i = todo.pop()
        if label[i] is not None or abs(u[i]) < sum(near[i].values()):
            continue
        label[i] = u[i] > 0
        for j, w in near[i].items():
            u[j] += w if label[i] else -w
            del near[j][i]
            if label[j] is None:
                todo.append(j)
        near[i] = {}
    rest = [i for i in range(n) if label[i] is None]
    if rest:
        side = _cut_by_paths(rest, u, near)
        for i in rest:
            label[i] = i in side
    return [bool(x) for x in label]


def _cut_by_paths(nodes: list[int], u: list[float], near: list[dict[int, float]]) -> set[int]:
    """Augmenting paths (shortest first) on the nodes left; returns the source's side."""
    supply = {i: u[i] for i in nodes if u[i] > 0}
    demand = {i: -u[i] for i in nodes if u[i] < 0}
    room = {i: dict(near[i]) for i in nodes}
    eps = 1e-9
    while True:
        back: dict[int, int] = {}
        queue = [i for i, s in supply.items() if s > eps]
        reached = set(queue)
        end = -1
        for i in queue:
            if demand.get(i, 0.0) > eps:
                end = i
                break
            for j, w in room[i].items():
                if w > eps and j not in reached:
                    reached.add(j)
                    back[j] = i
                    queue.append(j)
        if end < 0:
            return reached
        path = [end]
        while path[-1] in back:
            path.append(back[path[-1]])
        flow = min(supply[path[-1]], demand[end], *(room[b][a] for a, b in zip(path, path[1:])))
        supply[path[-1]] -= flow
        demand[end] -= flow
        for a, b in zip(path, path[1:]):
            room[b][a] -= flow
            room[a][b] = room[a].get(b, 0.0) + flow


def article_blocks(page: list[tuple], unary: list[float], tags: dict[int, float] | None = None) -> list[bool]:
    """The labels of a page's blocks: a node per block and one per parent element."""
    n = len(page)
    hub: dict[int, int] = {}
    u = list(unary)
    edges: list[tuple[int, int, float]] = []
    for i, (_, _, parent, furniture, _) in enumerate(page):
        k = hub.setdefault(parent, n + len(hub))
        if k == len(u):
            u.append(-1.0 if furniture else 0.0)
        edges.append((i, k, PARENT))
        if i:
            edges.append((i - 1, i, NEIGHBOUR if page[i - 1][2] == parent else NEIGHBOUR_APART))
    for parent, k in hub.items():  # an element leans as its children do, weighed against its parent's other content
        u[k] += (tags or {}).get(parent, 0.0)
    return minimum_cut(u, edges)[:n]


def page_labels(text: str, raw: str, source: str | None, url: str | None, model: dict, memo: dict) -> list[bool | None]:
    """For each line of the text: True article, False not, None blank. Lines are matched with blocks in order; one
    that matches no block is judged by its words alone."""
    page = blocks(raw)
    site = _site(source, url)
    unary = costs(page, model, site, memo)
    lean: dict[int, float] = {}
    for (_, tag, parent, furniture, _), c in zip(page, unary):
        if tag in ("p", "h1", "h2", "blockquote", "li") and not furniture:
            lean[parent] = lean.get(parent, 0.0) + c
    if lean:
        body = max(lean, key=lambda k: lean[k])
        unary = [c + (1.0 if p[2] == body else -2.0) for p, c in zip(page, unary)]
    labels = article_blocks(page, unary)
    keys: dict[str, list[int]] = {}
    for i, p in enumerate(page):
        for part in p[0].split("\n"):
            k = plain(part)
            if k:
                keys.setdefault(k, []).append(i)
    out: list[bool | None] = []
    at = 0
    for line in text.split("\n"):
        k = plain(line)
        if not k:
            out.append(None)
            continue
        places = keys.get(k)
        if places:
            i = next((x for x in places if x >= at), places[-1])
            at = i
            out.append(labels[i])
        else:
            out.append(costs([(line, "p", 0, False, 0.0)], model, site, memo)[0] > 0)
    return out


def _labelled(rows: DataFrame, model: dict, want: str, schema: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for b in batches:
            ids, second = [], []
            for i, url, source, text, raw in zip(*(b.column(c).to_pylist() for c in ("content_id", "url", "source", "text", "raw"))):
                labels = page_labels(text, raw, source, url, shared.value, memo)
                if want == "lines":
                    dropped = [n for n, x in enumerate(labels, 1) if x is False]
                    ids.extend([i] * len(dropped))
                    second.extend(dropped)
                else:
                    ids.append(i)
                    second.append("\n".join(t for t, x in zip(text.split("\n"), labels) if x is not False))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(second, pa.int32() if want == "lines" else pa.string())], names)

    pages = rows.where(is_html(F.col("raw"), F.col("text")) & F.col("text").isNotNull() & (F.col("text") != ""))
    return pages.select(F.col("content_id").cast("bigint").alias("content_id"), "url", "source", "text", "raw").mapInArrow(run, schema)


def boilerplate_lines(rows: DataFrame, model: dict | None = None) -> DataFrame:
    """content_id, line_no: the lines (from 1) of pages that are not part of the article. Blank lines are neither.

    rows: content_id, url, source, text, raw. Rows whose raw is null or no HTML, and null or empty texts, give none.
    """
    return _labelled(rows, fit(rows) if model is None else model, "lines", "content_id bigint, line_no int")


def main_text(rows: DataFrame, model: dict | None = None) -> DataFrame:
    """content_id, text: the article of every row; a row that is no page keeps its text, null stays null."""
    model = fit(rows) if model is None else model
    pages = _labelled(rows, model, "text", "content_id bigint, text string")
    other = rows.where(~is_html(F.col("raw"), F.col("text")) | F.col("text").isNull() | (F.col("text") == ""))
    return pages.unionByName(other.select(F.col("content_id").cast("bigint").alias("content_id"), "text"))
