from pyspark.sql import functions as F

from tidewell.operators.bucket_store import BucketStore, one_of_each, surplus

SCHEMA = "delivery_id long, batch_no int, event_id string, k string, o int, row string, copies int"
ROWS = [(1, 1, "A", "x", 1, "r", 0), (2, 1, " a\n", "x", 1, "r", 0), (3, 2, None, "x", 1, "r", 0), (4, 2, " ", None, None, None, None), (5, 3, "b", "y", 1, "r", 0), (6, 4, "a", "z", 1, "r", 0), (7, None, "B", "z", 1, "r", 0), (8, 4, "", "z", 1, "r", 0)]


def test_one_of_each_and_surplus(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    kept = one_of_each(df, "event_id", "delivery_id", "batch_no")
    assert kept.columns == df.columns
    assert sorted(r.delivery_id for r in kept.collect()) == [1, 3, 4, 5, 8]
    assert sorted(r.delivery_id for r in surplus(df, "event_id", "delivery_id", "batch_no").collect()) == [2, 6, 7]
    assert surplus(df.limit(0), "event_id", "delivery_id", "batch_no").count() == 0
    assert one_of_each(df, "event_id", "delivery_id").count() == 5


def test_redelivered_batch_changes_nothing(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    store = BucketStore(spark, "event_id", "delivery_id")
    store.upsert(df.where("batch_no <= 2"), "one")
    store.upsert(df.where("batch_no > 2"), "two")
    before = sorted(map(tuple, store.survivors().collect()))
    store.upsert(df.where("batch_no > 2"), "two")
    assert sorted(map(tuple, store.survivors().collect())) == before
    assert store.runs() == ["one", "two"]


def test_compaction_merges_without_shuffle_and_is_written(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    store = BucketStore(spark, "event_id", "delivery_id", path=f"file://{tmp_path}/store", buckets=3)
    store.upsert(df.where("batch_no <= 2"), "one")
    store.upsert(df.where("batch_no > 2 OR batch_no IS NULL"), "two")
    assert "Exchange" not in store._merged(True)._jdf.queryExecution().executedPlan().toString()
    before = sorted(map(tuple, store.survivors().collect()))
    store.compact()
    assert store.runs() == ["base"] and sorted(map(tuple, store.survivors().collect())) == before
    folders = [p for p in (tmp_path / "store").iterdir() if p.name.startswith("run=")]
    assert len(folders) == 1 and len(list(folders[0].glob("*.parquet"))) <= 3  # one sorted file a bucket
    store.upsert(df.where("batch_no <= 2"), "one")  # delivered again after it was merged
    assert store.runs() == ["base"]


def test_store_is_opened_anew(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = f"file://{tmp_path}/store"
    store = BucketStore(spark, "event_id", "delivery_id", path=path, buckets=3)
    store.upsert(df.where("batch_no <= 2"), "one")
    before = sorted(map(tuple, store.survivors().collect()))
    other = spark.newSession()
    spark.sql(f"DROP TABLE {store.table.name}")  # another driver knows nothing of the catalogue
    again = BucketStore(other, "event_id", "delivery_id", path=path)
    assert again.table.buckets == 3 and again.runs() == ["one"] and sorted(map(tuple, again.survivors().collect())) == before
    rows = other.createDataFrame(ROWS, SCHEMA)
    again.upsert(rows.where("batch_no <= 2"), "one")
    assert sorted(map(tuple, again.survivors().collect())) == before
    again.upsert(rows.where("batch_no > 2 OR batch_no IS NULL"), "two")
    again.compact()
    assert sorted(r.o for r in BucketStore(other, "event_id", "delivery_id", path=path).survivors().collect()) == [1, 3, 4, 5, 8]


def test_half_written_run_is_ignored(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    path = f"file://{tmp_path}/store"
    store = BucketStore(spark, "event_id", "delivery_id", path=path, buckets=2)
    store.upsert(df.where("batch_no <= 2"), "one")
    lost = store._collapsed(df).repartition(2, "k").withColumn("run", F.lit("two~9"))  # a writer that ended before the manifest
    lost.select(*spark.table(store.table.name).columns).write.insertInto(store.table.name)
    assert store.runs() == ["one"] and {r.o for r in store.survivors().collect()} == {1, 3, 4}


def test_a_batch_is_shuffled_once(spark):
    store = BucketStore(spark, "event_id", "delivery_id", buckets=3)
    store.upsert(spark.createDataFrame(ROWS, SCHEMA), "one")
    tracker = spark.sparkContext._jsc.sc().statusStore()
    was = spark.conf.get("spark.sql.shuffle.partitions")
    before = tracker.jobsList(None).size()
    store.upsert(spark.createDataFrame(ROWS, SCHEMA), "two")
    assert spark.conf.get("spark.sql.shuffle.partitions") == was
    jobs = tracker.jobsList(None)
    assert sum(jobs.apply(i).stageIds().size() > 2 for i in range(jobs.size() - before)) == 0


def test_hot_identifier(spark):
    df = spark.range(30_000).select(F.col("id").alias("delivery_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"))
    assert surplus(df, "event_id", "delivery_id").count() == 9_999
