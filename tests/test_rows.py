from pyspark.sql import functions as F

from tidewell.functions import text as tx
from tidewell.functions import urls
from tidewell.functions import text
from tidewell.operators import content, rows, sinks


def one(spark, c):
    return spark.range(1).select(c.alias("v")).first().v


def test_normalize(spark):
    for given, want in [("HTTP://Example.com/Path", "http://example.com/Path"), ("https://a.b/x/", "https://a.b/x"), ("https://a.b/x#f", "https://a.b/x"), ("http://a.b:80/x", "http://a.b/x"), ("https://a.b:443/x?q=1", "https://a.b/x?q=1"), (" not one ", "not one")]:
        assert one(spark, urls.normalize(F.lit(given))) == want


def test_page_key(spark):
    same = ["https://www.x.example/p/Ab-1", "http://X.example:80/p/Ab-1/?utm_source=f#top", "https://m.x.example/p/Ab-1?fbclid=1&spm=2 "]
    keys = {one(spark, urls.page_key(F.lit(u))) for u in same}
    assert keys == {"x.example/p/Ab-1"}
    other = ["https://x.example/p/ab-1", "https://x.example/p/Ab-1?page=2", "https://x.example:8443/p/Ab-1"]
    assert len({one(spark, urls.page_key(F.lit(u))) for u in other} | keys) == 4
    assert one(spark, urls.page_key(F.lit("https://x.example/i.php?id=2&cat=1"))) == one(spark, urls.page_key(F.lit("https://x.example/i.php?cat=1&id=2")))
    assert one(spark, urls.page_key(F.lit("junk"))) is None and one(spark, urls.page_key(F.lit(None).cast("string"))) is None


def test_urls_in(spark):
    assert one(spark, urls.urls_in(F.lit("see https://a.example/x, www.b.example. and https://a.example/x"))) == ["https://a.example/x", "https://www.b.example"]


def test_text(spark):
    assert one(spark, tx.slug(F.lit("Hello, World! 你好"))) == "hello-world-你好"
    assert one(spark, tx.slug(F.lit(None).cast("string"))) == "untitled"
    assert one(spark, tx.word_count(F.lit(" a  b\n"))) == 2
    assert one(spark, tx.unfenced(F.lit("```json\n{}\n```"))) == "{}"
    assert one(spark, tx.heading(F.lit("x\n# Title\n"))) == "Title"
    assert one(spark, tx.has_keyword(F.lit("an AI thing"), "ai")) and not one(spark, tx.has_keyword(F.lit("said"), "ai"))
    for d, want in [("2026-03-24", "2026-03-W4"), ("2026-05-31", "2026-05-W5")]:
        assert one(spark, tx.month_week(F.lit(d).cast("timestamp"))) == want


def test_unseen_keeps_repeats(spark):
    df = spark.createDataFrame([("1",), ("2",), ("1",)], "url string")
    assert [r.url for r in rows.unseen(df, spark.createDataFrame([("2",)], "url string"), "url").collect()] == ["1", "1"]


def test_admission(spark):
    items = spark.createDataFrame([(i, 0, f"u{i}") for i in range(10)], "item_id int, priority int, u string")
    none = spark.createDataFrame([], "u string")
    outcome = lambda seen, queued: dict(map(tuple, rows.admit(items, "u", ["priority", "item_id"], seen, queued, "u", 3).groupBy("outcome").count().collect()))
    assert outcome(none, none) == {"enqueued": 3, "limit": 7}
    assert outcome(spark.createDataFrame([(f"u{i}",) for i in range(4)], "u string"), none) == {"duplicate": 4, "enqueued": 3, "limit": 3}
    assert outcome(none, spark.createDataFrame([("u0",)], "u string")) == {"silent": 1, "enqueued": 3, "limit": 6}


def test_streaks(spark):
    import random

    r = random.Random(3)
    data = [(i, r.choice(["a", "a", "b", None]), int(r.random() < 0.85)) for i in range(400)]
    df = spark.createDataFrame(data, "i int, k string, f int")
    want, now = [], {}
    for _, k, f in data:
        now[k] = now.get(k, 0) + 1 if f else 0
        want.append(now[k])
    for chunks in (1, 7, 64):
        assert [x.streak for x in rows.streaks(df, "k", "i", F.col("f") == 1, chunks).orderBy("i").collect()] == want
    assert rows.streaks(df.limit(0), "k", "i", F.col("f") == 1).count() == 0


def test_zero_filled_and_drift(spark):
    df = spark.createDataFrame([("a",), ("a",), ("q",)], "s string")
    assert {tuple(r) for r in rows.zero_filled(df, "s", ["a", "b"]).collect()} == {("a", 2), ("b", 0)}
    a = spark.createDataFrame([("x", "1"), ("y", ""), ("z", "3")], "k string, v string")
    b = spark.createDataFrame([("x", "2"), ("y", "5"), ("w", "1")], "k string, v string")
    assert [tuple(r) for r in rows.drift(a, b, "k", "v").collect()] == [("x", "1", "2")]


def test_json_contract(spark):
    check = lambda s: one(spark, content.json_contract(F.lit(s), ["a", "n"], {"n": (0, 1)}))
    assert check('{"a": "x", "n": 0.5}') is None
    assert check("{") == "invalid_json" and check("[1]") == "not_object"
    assert check('{"n": 1}') == "missing:a"
    assert check('{"a": "x", "n": "0.5"}') == "not_number:n" and check('{"a": "x", "n": true}') == "not_number:n"
    assert check('{"a": "x", "n": 2}') == "range:n"


def test_verdict(spark):
    v = lambda t, title, s: one(spark, content.verdict(F.lit(t), F.lit(title), F.lit(s))["kind"])
    assert v("", None, "web_article") == "validation_failed"
    assert v("Please complete verification", "t", "twitter_thread") == "content_blocked"
    assert v("short", "t", "web_article") == "content_blocked" and v("short", "t", "twitter_thread") is None
    assert v("word " * 100, "t", "web_article") is None and v("word\u00a0" * 100, "t", "web_article") is None
    assert v("word " * 100 + "Become a subscriber", "t", "web_article") == "content_blocked" and v("word " * 500 + "Become a subscriber", "t", "web_article") is None


def test_keywords_stand_between_others(spark):
    hits = lambda t, *w: one(spark, text.hits(F.lit(t), list(w)))
    assert hits("AI, c++ and said", "ai", "id", "C++", "and") == 3 and hits("融资了", "融资") == 1 and hits(None, "ai") == 0
    assert one(spark, text.relevance(F.lit(1), F.lit(2), F.lit(0), F.lit(5))) == 5 and one(spark, text.relevance(F.lit(9), F.lit(0), F.lit(1), F.lit(0))) is None
    assert one(spark, text.snippet(F.lit("---\ntitle: x\n---\n# H\n\na | b\nc"))) == "a / b c" and one(spark, text.inline(F.lit("a &amp;\n &#8217; "))) == "a & ’"


def test_brief(spark):
    broken = lambda b, s: one(spark, content.brief_faults(F.lit(b), F.lit(s)))
    assert broken(" ", "x") == ["empty"] and broken("text https://a.example/1", None) == []
    assert broken("「some words」 https://a.example", "has some  words here") == [] and broken("「other words」 https://a.example", "has some words") == ["quote"]
    assert broken("总的来说" + "x" * 300, "") == ["too_long", "no_url", "filler"]


def test_evidence_falls_back_to_the_beginning(spark):
    df = spark.createDataFrame([(1, "Short one. Another."), (2, None), (3, " \n"), (4, "x" * 400)], "id int, text string")
    assert {(r.id, r.rank, r.sentence) for r in content.evidence(df, "id", ["revenue"]).collect()} == {(1, 1, "Short one. Another."), (4, 1, "x" * 260)}


def test_compression_keeps_order_and_short_texts(spark):
    long = "\n".join(f"Paragraph {i} with enough characters to count, and revenue {i}." * 4 for i in range(80))
    df = spark.createDataFrame([(1, long), (2, "short"), (3, None)], "id int, text string")
    got = {r.id: r for r in content.compressed(df, "id", in_order=True).collect()}
    numbers = [int(p.split()[1]) for p in got[1].text.split("\n\n")]
    assert numbers == sorted(numbers) and got[1].n_after <= 8000 and got[2].text == "short" and got[3].text == "" and got[3].ratio == 1.0
    first = content.compressed(df, "id").where("id = 1").first().text.split("\n\n")
    assert [int(p.split()[1]) for p in first][:6] == [79, 78, 77, 2, 1, 0]  # the heaviest first, the later of equals


def test_ledger_and_files(spark, tmp_path):
    lines = spark.createDataFrame([("a",), ("b",), ("a",)], "line string")
    path = f"file://{tmp_path}/ledger"
    assert sinks.append_lines(lines, path).count() == 2
    assert sinks.append_lines(lines, path).count() == 0
    assert sorted(r.value for r in spark.read.text(path).collect()) == ["a", "b"]
    docs = spark.createDataFrame([("T: 1", "body"), (None, None)], "title string, text string")
    made = sinks.markdown(docs, ["title"], F.col("title"), F.col("text"))
    manifest = sinks.write_files(made, f"{tmp_path}/out").collect()
    assert len(manifest) == 2 and all((tmp_path / "out" / m.file_name).stat().st_size == m.n_bytes for m in manifest)


def test_quotes(spark, monkeypatch):
    items = spark.createDataFrame([(1, "abcdef"), (2, "abc"), (3, ""), (4, None), (5, "abc")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "xxabcabcdefabc"), (2, "ab"), (3, None), (None, "abc")], "doc_id long, text string").withColumn("quote", F.lit("x"))
    want = {(1, 1, 1), (2, 1, 1), (5, 1, 1)}
    assert {tuple(r) for r in content.quotes_located(items, docs, 3).collect()} == want
    monkeypatch.setattr(content, "MOST_QUOTES", 1)
    assert {tuple(r) for r in content.quotes_located(items, docs, 3).collect()} == want
    assert content.quotes_located(items.limit(0), docs).count() == 0
