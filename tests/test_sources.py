
from pyspark.sql import functions as F

from tidewell.plans import core_queries
from tidewell.sources import feeds, files, pages
from tidewell.streaming import flows

RSS = '<rss xmlns:dc="urn:dc"><channel><title>f</title><item><title>One &amp; two</title><link>https://a.example/1</link><pubDate>Fri, 14 Feb 2025 01:54:14 GMT</pubDate><dc:creator>Ann</dc:creator></item><item><title>no link</title></item></channel></rss>'
ATOM = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>E</title><link href="https://a.example/e" rel="alternate"/><updated>2025-01-01T00:00:00Z</updated><author><name>Bo</name></author></entry></feed>'


def test_feeds(spark):
    df = spark.createDataFrame([("r", RSS), ("a", ATOM), ("x", "<broken"), ("n", None)], "feed string, content string")
    got = {tuple(r) for r in feeds.feed_items(df).select("feed", "title", "url", "published", "author").collect()}
    assert got == {("r", "One & two", "https://a.example/1", "Fri, 14 Feb 2025 01:54:14 GMT", "Ann"), ("a", "E", "https://a.example/e", "2025-01-01T00:00:00Z", "Bo")}


def test_feed_folder(spark, tmp_path):
    (tmp_path / "f.xml").write_text(RSS)
    (tmp_path / "g.txt").write_text("no feed")
    spark.dataSource.register(feeds.FeedFolder)
    df = spark.read.format("feed_folder").load(str(tmp_path))
    assert feeds.feed_items(df.select("feed_url", "content")).count() == 1


def test_lists_and_links(spark, tmp_path):
    (tmp_path / "l.txt").write_text("# c\n\n https://a.example/1 \nhttps://b.example\n")
    assert [r.url for r in feeds.address_list(spark, str(tmp_path / "l.txt")).collect()] == ["https://a.example/1", "https://b.example"]
    df = spark.createDataFrame([(1, "[x](https://a.example/1) https://c.example [y](https://a.example/1)"), (2, "see https://b.example/2."), (3, None)], "id int, text string")
    assert {tuple(r) for r in feeds.markdown_links(df, "id").collect()} == {(1, "x", "https://a.example/1"), (2, "", "https://b.example/2")}


def test_page():
    raw = '<html><head><title>T - S</title><meta property="og:title" content="T"><meta name="author" content="A"></head><body><nav>menu</nav><article><h1>T</h1><p>Body &amp; more</p></article></body></html>'
    assert pages.extract(raw) == ("T", "", "A", "", "T\nBody & more")
    assert pages.extract(None) == ("", "", "", "", "")


def test_streams(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1, "a", True), (2, "a", True), (3, "b", False), (4, None, True)], "i int, k string, failed boolean").coalesce(1).write.parquet(path)
    schema = spark.read.parquet(path).schema
    s = lambda: flows.stream_of(spark, path, schema)
    assert {tuple(r) for r in flows.run_to_table(flows.counts(s(), "k"), "complete", "c").collect()} == {("a", 2), ("b", 1), (None, 1)}
    assert {r.k for r in flows.run_to_table(flows.first_sightings(s(), "k"), "append", "f").collect()} == {"a", "b"}
    seen = []
    q = flows.open_streaks(s().where("k IS NOT NULL"), "k", "i", "failed").writeStream.outputMode("update").foreachBatch(lambda df, _: seen.extend(map(tuple, df.collect()))).trigger(availableNow=True).start()
    q.awaitTermination()
    assert set(seen) == {("a", 2), ("b", 0)}


def test_fragments_are_extracted(spark, tmp_path):
    rows = [(1, "<html><body><article><p>One two</p></article></body></html>"), (2, "<div><h1>Head</h1><p>Three four</p></div>"), (3, "<table><tr><td><p>Five six</p><p>Seven</p></td></tr></table><div>Terms</div>"), (4, "plain\nlines"), (5, None)]
    spark.createDataFrame(rows, "content_id long, raw string").write.parquet(str(tmp_path / "fetched_content.parquet"))
    got = {r.content_id: r.body for r in core_queries.QUERIES["html_extract"](spark, str(tmp_path)).collect()}
    assert got == {1: "One two", 2: "Head\nThree four", 3: "Five six\nSeven\nTerms", 4: "plain\nlines", 5: ""}


def test_notes_and_states(spark, tmp_path):
    d = tmp_path / "2025-01-W1" / "a"
    d.mkdir(parents=True)
    (tmp_path / "daily").mkdir()
    (d / "one.md").write_text("---\ntitle: x\n---\n# First | note\n\nbody | text")
    (d / "two.md").write_text('title: "Second"\nbody')
    (d / "three.md").write_text("\n")
    (tmp_path / "daily" / "r.md").write_text("# no")
    got = {r.title: r.snippet for r in files.notes(spark, str(tmp_path), skip=("daily",)).collect()}
    assert set(got) == {"First | note", "Second", "three"} and got["First | note"] == "body / text"
    assert files.notes(spark, str(tmp_path), since="2999-01-01T00:00:00").count() == 0
    assert {r.name for r in files.some_files(spark, str(d), ["one.md", "none.md"]).collect()} == {"one.md"}
    for state, name, text in [("pending", "a", '{"event_id": "a", "n": 1}'), ("sent", "b", '{"event_id": "b"}'), ("sent", "c", "{broken"), ("sent", "d", "[1]")]:
        (tmp_path / "box" / state).mkdir(parents=True, exist_ok=True)
        (tmp_path / "box" / state / f"{name}.json").write_text(text)
    assert {(r.state, r.event_id, r.n) for r in files.json_states(spark, str(tmp_path / "box"), "event_id string, n int").collect()} == {("pending", "a", 1), ("sent", "b", None)}
    (tmp_path / "roles").mkdir()
    (tmp_path / "roles" / "worker.json").write_text('{"status": "up", "pid": 7, "updated_at": "2025-01-01T00:00:00Z"}')
    (tmp_path / "roles" / "bot.json").write_text("junk")
    beats = {r.role: (r.status, r.pid, r.stale) for r in files.heartbeats(spark, str(tmp_path / "roles"), "2025-01-01 00:05:00").collect()}
    assert beats == {"worker": ("up", 7, False), "bot": (None, None, True)}


def test_flat_yaml(spark):
    text = "# list\nitems:\n  - id: a  # first\n    name: \"A b\"\n\n  - id: b\n- https://c.example/x\n"
    df = spark.createDataFrame([("f", text), ("g", None), ("h", "")], "file string, text string")
    got = [(r.position, r.item) for r in files.flat_yaml(df).orderBy("position").collect()]
    assert got == [(0, {"id": "a", "name": "A b"}), (1, {"id": "b"}), (2, {"value": "https://c.example/x"})]
    assert [r.missing for r in files.required(files.flat_yaml(df).where("position < 2"), ["id", "name"]).orderBy("position").collect()] == [[], ["name"]]


def test_feed_candidates(spark):
    page = '<head><link rel="alternate" type="application/rss+xml" href="/my.xml"><link rel="stylesheet" href="/x.css"></head>'
    got = spark.range(1).select(files.feed_candidates(F.lit(page), F.lit("https://a.example/p")).alias("c")).first().c
    assert got[0] == "https://a.example/my.xml" and "https://a.example/feed" in got and len(got) == len(files.FEED_PATHS) + 1


def test_stream_windows_and_forgetting_keys(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    spark.sql("SELECT timestamp '2025-01-01' + make_interval(0, 0, 0, 0, CAST(id AS INT)) AS ts, concat('k', id % 2) AS k FROM range(48)").repartition(5).write.parquet(path)
    schema = spark.read.parquet(path).schema
    counted = flows.sliding_counts(flows.stream_of(spark, path, schema, 1), "ts", "k")
    got = flows.run_to_table(counted, "update", "w", ["window_start", "k"])
    assert got.agg(F.sum("n")).first()[0] == 96 and got.groupBy("window_start", "k").count().where("count > 1").count() == 0
    once = flows.run_to_table(flows.first_sightings(flows.stream_of(spark, path, schema), "k", "ts", "30 days"), "append", "s")
    assert {r.k for r in once.collect()} == {"k0", "k1"}
