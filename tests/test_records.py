from pyspark.sql import functions as F

from tidewell.operators import records


def one(spark, column):
    return spark.range(1).select(column.alias("c")).first().c


def test_values(spark):
    clip = lambda v: one(spark, records.clip01(F.lit(v).cast("double")))
    assert [clip(v) for v in (None, "nan", -1, 0.4, 7)] == [0.0, 0.0, 0.0, 0.4, 1.0]
    assert one(spark, records.retry_after(F.lit("Retry-After: 61 s"))) == 2 and one(spark, records.retry_after(F.lit(None).cast("string"))) == 5
    assert one(spark, records.http_failure(F.lit(503))).retryable and one(spark, records.http_failure(F.lit(200))).kind is None
    assert one(spark, records.enum_of(F.lit(None).cast("string"), ["a"], "a")) == "a"


def test_contents_have_defaults(spark):
    none = F.lit(None).cast("string")
    c = one(spark, records.fetched(F.lit("https://www.a.example/" + "x" * 200), F.lit(" "), none, none, none, none, F.lit(None).cast("map<string,string>"), F.lit("t")))
    assert c.source == "a.example" and len(c.title) == 100 and c.text == "" and c.metadata == {} and len(c.content_hash) == 16
    assert one(spark, records.searched(none, none, none)).error == "missing_url"
    m = one(spark, records.with_defaults(F.create_map(F.lit("a"), F.lit("own")), {"a": F.lit("x"), "b": F.lit("y"), "c": none}))
    assert m == {"a": "own", "b": "y"}


def test_messages_as_json(spark):
    bad = one(spark, records.item_of(F.lit('{"event_id": 7, "attempts": "x", "state": "odd", "final_score": "nan"}')))
    assert bad.event_id == "7" and bad.attempts == 0 and bad.state == "pending" and bad.final_score == 0.0
    assert one(spark, records.item_of(F.lit("junk"))).event_id == ""


def test_settings_merge_by_branch(spark):
    base = spark.createDataFrame([("a.b", "1"), ("a.c", "2"), ("d", "3"), ("e.f", "4")], "path string, value string")
    over = spark.createDataFrame([("a.c", "9"), ("e", "5"), ("d.x", "6")], "path string, value string")
    assert {tuple(r) for r in records.merged_tree(base, over, "path").collect()} == {("a.b", "1"), ("a.c", "9"), ("e", "5"), ("d.x", "6")}


def test_runs_side_by_side(spark):
    a = spark.createDataFrame([(1, "x"), (2, None)], "id int, v string")
    b = spark.createDataFrame([(1, "x"), (3, "y")], "id int, v string")
    assert {tuple(r) for r in records.compared({"a": a, "b": b}, "id", "v").collect()} == {(1, "x", "x", True), (2, "", "missing", False), (3, "missing", "y", False)}


def test_circuits_open_after_failures_in_a_row(spark):
    calls = spark.createDataFrame([("r", 1, False, "2025-01-01T00:00:00Z"), ("r", 2, True, "2025-01-01T01:00:00Z"), ("r", 3, True, "2025-01-01T02:00:00Z"), ("s", 4, True, "2025-01-01T00:00:00Z"), ("s", 5, False, "2025-01-01T00:00:00Z")], "route string, n int, failed boolean, at string")
    got = records.open_circuits(calls, "route", "n", F.col("failed"), 2, 30, "at").collect()
    assert [(r.route, r.failures, str(r.open_until)) for r in got] == [("r", 2, "2025-01-01 02:30:00")]


def test_updates_and_commands(spark):
    said = lambda t: tuple(one(spark, records.command_of(F.lit(t))))
    assert said("/Add@bot https://a.example ") == ("command", "add", "https://a.example") and said("www.a.example/x") == ("url", "", "www.a.example/x") and said(None) == ("input", "", "")
    update = one(spark, records.coalesced(F.lit('{"channel_post": {"chat": {"id": 5}, "caption": "c"}}'), ["message", "channel_post"]))
    assert tuple(update) == ("5", "c")
