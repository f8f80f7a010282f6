"""Validation, compression and evidence of texts; contracts of JSON texts; links and lines of pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import BLANK, let, sentences, strip, word_count
from ..functions.urls import host_of

# Marks of pages that hold no content, of paywalls, and of pages that ask readers to verify themselves.
BLOCKED = ["当前环境异常", "完成验证后即可继续访问", "去验证", "environment abnormal", "verify you are human", "please complete verification"]
SHELL = ["javascript is required", "please enable javascript", "requires javascript", "please enable cookies", "enable cookies to continue"]
LOGIN = ["sign in to continue reading", "log in to continue", "register to continue", "create an account to continue", "subscribe to continue reading", "to continue reading, please", "this article is exclusive to subscribers"]
PAYWALL = ["already a subscriber", "become a subscriber", "sign in to continue", "subscribe to continue", "subscription required", "start your free trial", "to keep reading", "unlock this article", "you have reached your free article limit"]
PAGE_TYPES = ["web_article", "rss_feed", "wechat_article"]
VERIFICATION, VERIFICATION_HEAD = ["环境异常", "验证后即可继续访问"], ["captcha", "verification page"]
# What long texts are freed of, and what marks their weightier paragraphs.
NOISE = ["点击.*?关注", "扫码.*?关注", "转载.*?授权", "本文.*?版权", "更多精彩.*?关注", "欢迎.*?订阅"]
SKIPPED = ["点击关注", "扫码关注", "转载请注明", "版权声明", "商务合作", "投稿", "广告", "更多精彩", "推荐阅读"]
PHRASES = ["融资", "投资", "估值", "上市", "IPO", "并购", "技术", "研发", "创新", "发布", "推出", "数据", "增长", "下降", "营收", "利润", "认为", "指出", "强调", "透露", "宣布"]
# Sections and phrases that a brief must not hold.
SECTIONS = ["🏷", "🧭", "🛠", "分类：", "分类:", "信源说明", "下一步", "背景套话"]
FILLER = ["这篇文章主要讨论", "随着AI的发展", "随着AI的", "值得注意的是", "需要指出的是", "总的来说", "综上所述"]


def _any(low: Column, marks: list[str], raw: Column | None = None) -> Column:
    """Whether a text, lower-cased, holds one of the marks; or as it stands, where `raw` is given."""
    found = F.lit(False)
    for m in marks:
        found = found | F.contains(low, F.lit(m))
        if raw is not None:
            found = found | F.contains(raw, F.lit(m))
    return found


def verdict(text: Column, title: Column, source_type: Column, blocked=BLOCKED, shell=SHELL, login=LOGIN, paywall=PAYWALL) -> Column:
    """kind, action: why a fetched text is no content, the first reason that holds; both null for sound content.

    Errors are values: an ordered ladder of empty, blocked, too little, shell, login wall and paywall.
    """
    trimmed = F.struct(strip(F.coalesce(text, F.lit(""))).alias("t"), strip(F.coalesce(title, F.lit(""))).alias("head"))
    out = lambda kind, action: F.struct(F.lit(kind).alias("kind"), F.lit(action).alias("action"))
    page = source_type.isin(PAGE_TYPES)

    def judged(x: Column) -> Column:
        little = (x["n"] < 80) | ((x["head"] != "") & (word_count(F.replace(x["t"], x["head"])) < 30)) | _any(x["low"], shell) | _any(x["low"], login) | (_any(x["low"], paywall) & (x["n"] < 450))
        return (
            F.when(x["t"] == "", out("validation_failed", "drop"))
            .when(_any(x["low"], blocked, x["t"]) | ((source_type == "wechat_article") & (F.length(x["t"]) < 200)), out("content_blocked", "manual_review"))
            .when(page & little, out("content_blocked", "drop"))
            .otherwise(F.struct(F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("action")))
        )

    return let(trimmed, lambda x: let(F.struct(x["t"].alias("t"), x["head"].alias("head"), F.lower(x["t"]).alias("low"), word_count(x["t"]).alias("n")), judged))


def paywalled(host: Column, title: Column, text: Column, strict: list[str], marks: list[str] = PAYWALL) -> Column:
    """Whether a page stands behind a paywall: on `strict` hosts a mark or fewer than 350 words, elsewhere a mark and
    fewer than 450 words."""
    low = F.lower(F.concat_ws("\n", F.coalesce(title, F.lit("")), F.coalesce(text, F.lit(""))))
    on = F.lit(False)
    for h in strict:
        on = on | F.contains(F.lower(host), F.lit(h))
    judged = lambda x: F.when(F.coalesce(on, F.lit(False)), x["m"] | (x["n"] < 350)).otherwise(x["m"] & (x["n"] < 450))
    return let(F.struct(let(low, lambda x: _any(x, marks)).alias("m"), word_count(text).alias("n")), judged)


def real_body(text: Column, marks: list[str] = PAYWALL) -> Column:
    """Whether a text is a body of its own: no mark of a paywall and 350 words or more."""
    return ~let(F.lower(F.coalesce(text, F.lit(""))), lambda x: _any(x, marks)) & (word_count(text) >= 350)


def unsupported(content_type: Column, raw: Column) -> Column:
    """Whether an answer is no readable page: by its content type or, where it gives none, for lack of markup."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    return F.when(kind == "", ~F.coalesce(raw, F.lit("")).rlike(r"(?i)<html|<article|<body|<p\b")).otherwise(~kind.rlike("text/html|application/xhtml|text/plain|charset="))


def verification(text: Column) -> Column:
    """Whether a page asks its reader to verify themselves; some marks count near its beginning only."""
    t = F.coalesce(text, F.lit(""))
    return _any(F.lower(t), VERIFICATION, t) | let(F.lower(F.substring(t, 1, 4000)), lambda x: _any(x, VERIFICATION_HEAD))


def thin(text: Column, short_link: str = "t.co/") -> Column:
    """Whether a post holds hardly more than a shortened link."""
    t, link = strip(F.coalesce(text, F.lit(""))), short_link.replace(".", r"\.")
    return t.rlike(rf"^https?://{link}\S+$") | ((F.length(t) < 80) & F.contains(t, F.lit(short_link)))


UNIT = r"\b[0-9]+(?:\.[0-9]+)?[ ]*(?:m|b|million|billion)\b"


def evidence(rows: DataFrame, row_id: str, terms: list[str], limit: int = 3) -> DataFrame:
    """row_id, rank, sentence: each text's weightiest sentences of 50 to 320 characters; three points for every term, two
    for a money sign, two for a number with a unit; the earlier of equals first. A text without such a sentence gives its
    first 260 characters, an empty or null one nothing."""
    flat = F.trim(F.regexp_replace("text", BLANK, " "))
    weight = lambda s: sum((F.contains(F.lower(s), F.lit(t.lower())).cast("int") * 3 for t in terms), F.contains(s, F.lit("$")).cast("int") * 2 + F.lower(s).rlike(UNIT).cast("int") * 2)
    scored = F.transform(F.split("_flat", r"(?<=[.!?]) "), lambda s, i: F.struct((-weight(s)).alias("w"), i.alias("i"), s.alias("s")))
    fit = F.slice(F.filter(F.array_sort(scored), lambda x: F.length(x["s"]).between(50, 320)), 1, limit)
    first = F.array(F.struct(F.lit(0).alias("w"), F.lit(0).alias("i"), F.trim(F.substring("_flat", 1, 260)).alias("s")))
    held = rows.select(row_id, flat.alias("_flat")).where("_flat <> ''").select(row_id, "_flat", fit.alias("_fit"))
    chosen = F.when(F.size("_fit") > 0, F.col("_fit")).otherwise(first)
    return held.select(row_id, F.posexplode(chosen).alias("k", "e")).select(row_id, (F.col("k") + 1).alias("rank"), F.col("e.s").alias("sentence"))


def compressed(rows: DataFrame, row_id: str, long: int = 10_000, cut: int = 8_000, keep: int = 15, terms: list[str] = PHRASES, in_order: bool = False) -> DataFrame:
    """row_id, n_before, n_after, saved, ratio, text: texts longer than `long` reduced to their weightiest distinct
    paragraphs, the heaviest first (the later of equals), or in document order.

    Noise is taken out and paragraphs of notices are skipped. A paragraph of 20 characters or more scores three for
    standing among the first or last three, two for each term and one for a length of 50 to 300. What is longer than
    `cut` ends there, at the last full stop if that leaves four fifths. Where no paragraph is left, the text is cut.
    Shorter texts stay as they are; a null text counts as empty. ratio is n_after / n_before, 1 for an empty text.
    """
    base = rows.select(row_id, F.coalesce("text", F.lit("")).alias("_t"))
    short = F.length("_t") <= long
    clean = F.regexp_replace("_t", "(?i)" + "|".join(NOISE), "")
    lines = F.transform(F.split(clean, "\n"), strip)
    good = F.array_distinct(F.filter(lines, lambda p: (F.length(p) >= 20) & ~_any(F.lower(p), SKIPPED)))
    # the paragraphs are a column of their own, so that they are split once and not for every paragraph
    held = base.select(row_id, "_t", F.when(short, F.array().cast("array<string>")).otherwise(good).alias("_p")).withColumn("_n", F.size("_p"))
    score = lambda p, i: sum((F.contains(F.lower(p), F.lit(x)).cast("int") * 2 for x in terms), ((i < 3) | (i >= F.col("_n") - 3)).cast("int") * 3 + F.length(p).between(50, 300).cast("int"))
    scored = F.transform("_p", lambda p, i: F.struct((-score(p, i)).alias("w"), (-i).alias("i"), p.alias("p")))
    best = F.slice(F.array_sort(scored), 1, keep)
    best = F.reverse(F.array_sort(F.transform(best, lambda x: F.struct(x["i"].alias("i"), x["p"].alias("p"))))) if in_order else best
    held = held.select(row_id, "_t", "_n", F.array_join(F.transform(best, lambda x: x["p"]), "\n\n").alias("_j"))
    head = F.substring("_j", 1, cut)
    stop = F.length(head) - F.instr(F.reverse(head), "。")  # where the last full stop stands, from 0
    ended = F.when(F.contains(head, F.lit("。")) & (stop > cut * 0.8), F.substring(head, F.lit(1), stop + 1)).otherwise(head)
    joined = strip(F.when(F.length("_j") > cut, ended).otherwise(F.col("_j")))
    out = F.when(short, F.col("_t")).when(F.col("_n") == 0, F.substring("_t", 1, cut)).otherwise(joined)
    sized = held.select(row_id, F.length("_t").cast("bigint").alias("n_before"), out.alias("text"))
    n = F.length("text").cast("bigint")
    ratio = F.when(F.col("n_before") > 0, F.round(n / F.col("n_before"), 3)).otherwise(F.lit(1.0))
    return sized.select(row_id, "n_before", n.alias("n_after"), (F.col("n_before") - n).alias("saved"), ratio.alias("ratio"), "text")


#: Opening and closing marks of quotations.
QUOTED = "[「“\"]([^」”\"]{4,})[」”\"]"


def brief_faults(brief: Column, source: Column, most: int = 300) -> Column:
    """What a brief breaks, in order: `empty`, else any of `too_long` (addresses and white space do not count), `no_url`,
    `section`, `filler` and `quote` (one that its source does not hold, with or without white space and quotation marks;
    not judged without source)."""
    t = strip(F.coalesce(brief, F.lit("")))
    body = F.regexp_replace(F.regexp_replace(t, r"https?://\S+", ""), "[\n ]", "")
    bare = lambda x: F.regexp_replace(x, r"[「」\"‘’\s]+", "")
    src = F.coalesce(source, F.lit(""))
    quotes = F.regexp_extract_all(t, F.lit(QUOTED), F.lit(1))
    lost = F.exists(quotes, lambda q: ~F.contains(src, q) & ~F.contains(bare(src), bare(q)))
    sections = F.lit(False)
    for m in SECTIONS:
        sections = sections | F.contains(t, F.lit(m))
    faults = [F.when(F.length(body) > most, "too_long"), F.when(~t.rlike(r"https?://\S"), "no_url"), F.when(sections, "section"), F.when(_any(F.lower(t), [f.lower() for f in FILLER]), "filler"), F.when((src != "") & lost, "quote")]
    return F.when(t == "", F.array(F.lit("empty"))).otherwise(F.array_compact(F.array(*faults)))


def json_contract(raw: Column, required: list[str], numeric: dict[str, tuple[float, float]]) -> Column:
    """What a JSON text breaks: `invalid_json`, `not_object`, `missing:<first key>`, `not_number:<key>`, `range:<key>`, or
    null. A number must be written as one: text and booleans are not converted."""
    v = F.try_parse_json(raw)
    kind = F.schema_of_variant(v)
    out = F.when(v.isNull(), F.lit("invalid_json")).when(~kind.startswith("OBJECT"), F.lit("not_object"))
    for k in required:
        out = out.when(F.coalesce(F.try_variant_get(v, f"$.{k}", "string"), F.lit("")) == "", F.lit(f"missing:{k}"))
    for k, (lo, hi) in numeric.items():
        field = F.schema_of_variant(F.try_variant_get(v, f"$.{k}", "variant"))
        value = F.try_variant_get(v, f"$.{k}", "double")
        out = out.when(~(field.startswith("BIGINT") | field.startswith("DECIMAL") | field.startswith("DOUBLE")), F.lit(f"not_number:{k}"))
        out = out.when(~value.between(lo, hi), F.lit(f"range:{k}"))
    return out


#: Quotes are sent to the tasks, and searched for all at once, up to so many; beyond it in blocks of as many.
MOST_QUOTES = 200_000


def quotes_located(items: DataFrame, docs: DataFrame, least: int = 40) -> DataFrame:
    """item_id, doc_id, n_quotes: documents that hold sentences of an item word for word, and how many distinct ones.

    items: item_id, text, cut into sentences of which those of `least` characters or more count; docs: doc_id, text. Null
    and empty texts match nothing. All quotes are found in one pass over each text, by an automaton, so the work does not
    grow with their number.
    """
    cut = items.select(F.col("item_id").cast("bigint").alias("item_id"), F.explode(sentences(F.col("text"))).alias("quote"))
    probe = cut.where(F.length("quote") >= least).distinct()
    blocks = max(1, -(-probe.count() // MOST_QUOTES))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text <> ''")
    found = None
    for n in range(blocks):
        part = probe if blocks == 1 else probe.where(F.pmod(F.xxhash64("quote"), F.lit(blocks)) == n)
        one = _located(texts, [(r.quote, r.item_id) for r in part.collect()])  # about MOST_QUOTES
        found = one if found is None else found.unionByName(one)
    return found.groupBy("item_id", "doc_id").agg(F.sum("n").alias("n_quotes"))


def _located(texts: DataFrame, quotes: list[tuple[str, int]]) -> DataFrame:
    by_quote: dict[str, list[int]] = {}
    for q, i in quotes:
        by_quote.setdefault(q, []).append(i)
    shared = texts.sparkSession.sparkContext.broadcast(by_quote)
    made: dict = {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            import ahocorasick

            made["a"] = automaton = ahocorasick.Automaton()
            for q in shared.value:
                automaton.add_word(q, q)
            automaton.make_automaton()
        for b in batches:
            out: dict[tuple[int, int], int] = {}
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for q in {q for _, q in made["a"].iter(t)} if shared.value else ():
                    for i in shared.value[q]:
                        out[i, d] = out.get((i, d), 0) + 1
            cols = ([k[0] for k in out], [k[1] for k in out], list(out.values()))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item_id", "doc_id", "n"])

    return texts.mapInArrow(run, "item_id bigint, doc_id bigint, n bigint")


def links(pages: DataFrame, row_id: str) -> DataFrame:
    """row_id, position, href, label: the anchors of an HTML text, in order, the first of each address."""
    found = F.regexp_extract_all(F.col("raw"), F.lit(r"(?is)<a\s[^>]*href=\"[^\"]*\"[^>]*>.*?</a>"), F.lit(0))
    one = pages.select(row_id, F.posexplode(found).alias("position", "a"))
    parts = one.select(row_id, "position", F.regexp_extract("a", r"(?is)href=\"([^\"]*)\"", 1).alias("href"), F.trim(F.regexp_replace("a", r"<[^>]+>", "")).alias("label"))
    w = Window.partitionBy(row_id, "href").orderBy("position")
    return parts.where("href <> ''").withColumn("_n", F.row_number().over(w)).where("_n = 1").select(row_id, "position", "href", "label")


def same_site(links_: DataFrame, page_url: Column, exclude: list[str]) -> DataFrame:
    """The links that stay on the page's site and lead neither to the page itself nor below an excluded path."""
    relative = F.col("href").startswith("/")
    keep = (relative | (host_of(F.col("href")) == host_of(page_url))) & (F.col("href") != page_url)
    for p in exclude:
        keep = keep & ~F.col("href").startswith(p)
    return links_.where(keep)


def lines_once(rows: DataFrame, row_id: str) -> DataFrame:
    """row_id, text: blank lines dropped, a line equal to the one before it dropped, white space inside lines single."""
    tidy = F.filter(F.transform(F.split("text", "\n"), lambda x: F.trim(F.regexp_replace(x, r"[ \t\r\f\x0B]+", " "))), lambda x: x != "")
    rows = rows.select(row_id, tidy.alias("l"))
    kept = F.filter("l", lambda x, i: (i == 0) | (F.get("l", i - 1) != x))
    return rows.select(row_id, F.array_join(kept, "\n").alias("text"))


def redacted(attempts: Column) -> Column:
    """Delivery attempts with the receipts' references hashed and long values cut to 160 characters."""
    safe = lambda k, v: F.when(k.rlike("(_id|_ref)$") & (v != ""), F.concat(F.lit("sha256:"), F.substring(F.sha2(v, 256), 1, 16))).otherwise(F.substring(v, 1, 160))
    return F.transform(attempts, lambda a: a.withField("receipt", F.transform_values(a["receipt"], safe)))
