import pytest
from pyspark.sql import functions as F

from tidewell.functions.times import to_utc, utc_text
from tidewell.operators.instants import instants

CASES = [
    # value, zone, day first, expected
    ("2025-03-17T08:27:57.380+11:00", "UTC", True, "2025-03-16T21:27:57Z"),
    ("2025-01-11T13:33:22Z", "Asia/Tokyo", True, "2025-01-11T13:33:22Z"),
    ("2025-03-09T04:12:34-0400", "UTC", True, "2025-03-09T08:12:34Z"),
    ("20241203T071551Z", "UTC", True, "2024-12-03T07:15:51Z"),
    ("20250618", "America/New_York", True, "2025-06-18T04:00:00Z"),
    ("1753220118", "Asia/Tokyo", True, "2025-07-22T21:35:18Z"),
    ("1755379537999", "UTC", True, "2025-08-16T21:25:37Z"),
    ("  Sat, 11 Jan 2025 02:40:25 GMT ", "Asia/Tokyo", True, "2025-01-11T02:40:25Z"),
    ("Sun, 09 Mar 2025 04:12:34 EDT", "America/New_York", False, "2025-03-09T08:12:34Z"),
    ("2025-01-30 18:17 IST", "Asia/Kolkata", True, "2025-01-30T12:47:00Z"),
    ("Wed Jul 02 16:52:14 +0000 2025", "Asia/Tokyo", True, "2025-07-02T16:52:14Z"),
    ("08/11/2025 01:37", "UTC", False, "2025-08-11T01:37:00Z"),
    ("08/11/2025 01:37", "UTC", True, "2025-11-08T01:37:00Z"),
    ("16.12.2024 20:47", "Europe/Berlin", True, "2024-12-16T19:47:00Z"),
    ("28. August 2025, 19:44 Uhr", "Europe/Berlin", True, "2025-08-28T17:44:00Z"),
    ("15 de julio de 2025, 09:46", "Europe/Madrid", True, "2025-07-15T07:46:00Z"),
    ("11 avril 2025, 10:00", "Europe/Paris", True, "2025-04-11T08:00:00Z"),
    ("Jun 10, 2025 12:15 AM", "UTC", True, "2025-06-10T00:15:00Z"),
    ("2025年3月22日 下午7:28", "Asia/Shanghai", True, "2025-03-22T11:28:00Z"),
    ("2024-10-04 06:37:57 UTC-7", "UTC", True, "2024-10-04T13:37:57Z"),
    ("2024-10-04 06:37 -03", "UTC", True, "2024-10-04T09:37:00Z"),
    ("2024-10-27 02:30", "Europe/Berlin", True, "2024-10-27T00:30:00Z"),  # shown twice: the first
    ("2024-10-27 02:30 CEST", "Europe/Berlin", True, "2024-10-27T00:30:00Z"),
    ("2024-10-27 02:30 CET", "Europe/Berlin", True, "2024-10-27T01:30:00Z"),  # standard time: the second
    ("2024-11-03 01:10 EST", "America/New_York", True, "2024-11-03T06:10:00Z"),
    ("2024-11-03 00:59 EST", "America/New_York", True, "2024-11-03T04:59:00Z"),  # not shown twice: the source's zone
    ("2025-04-06 02:10 AEST", "Australia/Sydney", True, "2025-04-05T16:10:00Z"),
    ("2025-03-30 02:30", "Europe/Berlin", True, "2025-03-30T01:30:00Z"),  # skipped: moved forward
    ("2025-02-29 00:00", "UTC", True, None),
    ("32/13/2025 25:61", "UTC", True, None),
    ("2025-13-41", "UTC", True, None),
    ("0000-00-00T00:00:00Z", "UTC", True, None),
    ("Jun 10, 2025 13:15 PM", "UTC", True, None),
    ("just now", "UTC", True, None),
    ("", "UTC", True, None),
    (None, "UTC", None, None),
    ("x" * 20_000, "UTC", True, None),
]


def test_cascade(spark):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, v string, z string, d boolean, want string")
    got = df.select("i", "v", utc_text(to_utc(F.col("v"), F.col("z"), F.col("d"))).alias("got"), "want").collect()
    assert [(r.v and r.v[:40], r.got) for r in got] == [(r.v and r.v[:40], r.want) for r in got]


def test_source_and_host_tell_the_zone(spark):
    config = spark.createDataFrame(
        [("a", "https://www.a.example/feed", {"timezone": "America/New_York", "date_order": "mdy"}), ("b", "https://b.example/f", {"timezone": "Mars/Base"}), ("c", None, None)],
        "id string, url string, metadata map<string,string>",
    )
    rows = spark.createDataFrame(
        [(1, "a", "x", "2025-01-01 00:00"), (2, None, "https://m.a.example/p", "01/02/2025 00:00"), (3, "b", None, "01/02/2025 00:00"), (4, "c", None, "2025-01-01"), (5, "zzz", None, "2025-01-01"), (6, None, None, "2025-01-01"), (6, " ", "junk", None)],
        "id long, src string, url string, at string",
    ).withColumns({"zone": F.lit("clash"), "key": F.lit(1), "utc": F.lit(2)})
    got = {(r.rec_id, r.utc and str(r.utc)) for r in instants(rows, config, "at", "src", "url", "id", "f").select("rec_id", utc_text(F.col("utc")).alias("utc")).collect()}
    assert got == {(1, "2025-01-01T05:00:00Z"), (2, "2025-01-02T05:00:00Z"), (3, "2025-02-01T00:00:00Z"), (4, "2025-01-01T00:00:00Z"), (5, "2025-01-01T00:00:00Z"), (6, "2025-01-01T00:00:00Z"), (6, None)}
    assert instants(rows.limit(0), config.limit(0), "at", "src", "url", "id", "f").count() == 0


@pytest.mark.parametrize("value", ["2025-01-01T00:00:00+99:99", "1 Foo 2025, 10:00", "2025-01-01T24:00:00Z", "99/99/2025"])
def test_never_raises(spark, value):
    assert spark.range(1).select(to_utc(F.lit(value), F.lit("UTC"), F.lit(True)).alias("t")).first().t is None
