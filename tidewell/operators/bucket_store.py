"""Messages delivered more than once (problem 3): an idempotent store bucketed and sorted by identifier.

A batch becomes one run of the store: its rows, equal identifiers already collapsed, hashed into buckets by identifier
and sorted inside each bucket. Runs are only ever added or replaced as a whole, so delivering a batch again rewrites its
run and changes nothing. Compaction merges the sorted runs bucket by bucket, as every run hashes alike without a
shuffle, and puts one run in their place. A hot identifier is collapsed before the first shuffle, so no task holds its
copies together.

A store lives in its folder: a manifest names its layout and its live runs, and is replaced in one step. A store opened
anew, in another session or after a crash, goes on where the manifest left it; files that it does not name are ignored.

Which copy stays: the one with the smallest order value (the first to arrive). Identifiers are compared without regard
to letter case and surrounding white space. A null or blank identifier says nothing: each such row is a message of its
own. Rows that agree in identifier and order value are one delivery read twice and collapse too.
"""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_small, scratch_path, write_small


def identity(event_id: Column) -> Column:
    """The identifier as it is compared; null for null and blank ones."""
    return F.nullif(F.lower(F.regexp_replace(event_id, r"(?U)^\s+|\s+$", "")), F.lit(""))


class Runs:
    """A table under `path` of runs that are added or replaced as a whole, hashed into buckets by `key` and sorted in
    them by `sort`. Joins and aggregations by `key` over all runs need no shuffle.

    A folder that holds such a table already is opened, with the buckets it was made with. Of a run replaced or merged,
    the files go only after the manifest has stopped naming them.
    """

    def __init__(self, spark: SparkSession, key: str, sort: list[str], path: str | None = None, buckets: int | None = None):
        self.spark, self.key, self.sort = spark, key, sort
        self.path = (path or scratch_path(spark, "store")).rstrip("/")
        self.name = "tidewell_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        self._at = f"{self.path}/_manifest.json"
        have = read_small(spark, self._at)
        self._m = json.loads(have) if have else {"key": key, "sort": sort, "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions")), "schema": None, "live": {}, "merged": [], "next": 0}
        if (self._m["key"], self._m["sort"]) != (key, sort):
            raise ValueError(f"{self.path} is stored by {self._m['key']}, not by {key}")
        self.buckets = self._m["buckets"]
        if have:
            self._declare()

    def _save(self) -> None:
        write_small(self.spark, self._at, json.dumps(self._m))

    def _declare(self) -> None:
        if not self.spark.catalog.tableExists(self.name):
            made = f"CREATE TABLE {self.name} ({self._m['schema']}, run STRING) USING parquet OPTIONS (path '{self.path}', compression 'zstd') PARTITIONED BY (run)"
            self.spark.sql(f"{made} CLUSTERED BY (`{self.key}`) SORTED BY ({', '.join(f'`{c}`' for c in self.sort)}) INTO {self.buckets} BUCKETS")
            self.spark.sql(f"ALTER TABLE {self.name} RECOVER PARTITIONS")
        else:
            self.spark.catalog.refreshTable(self.name)

    def put(self, rows: DataFrame, run: str, placed: bool = False) -> bool:
        """Store rows as the run `run` in place of an earlier one of that name. A run that was merged already is not
        taken again: it has been delivered before. placed: the rows are hashed by key already. Whether it was taken."""
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
            raise ValueError(f"{run!r} names no run: letters, digits, _ . - only")
        if run in self._m["merged"]:
            return False
        self._write(rows, run, placed, [run])
        return True

    def _write(self, rows: DataFrame, run: str, placed: bool, instead: list[str]) -> None:
        if self._m["schema"] is None:
            self._m["schema"] = rows.schema.toDDL()
            self._save()
            self._declare()
        part = f"{run}~{self._m['next']}"
        self._m["next"] += 1
        self._save()  # no later attempt, of this store or of one opened anew, writes to the same place
        rows = rows if placed else rows.repartition(self.buckets, self.key)
        columns = [c for c in self.spark.table(self.name).columns if c != "run"]
        # an aggregation by key that comes before then hashes to the buckets itself, and rows are shuffled once
        setting, before = "spark.sql.shuffle.partitions", self.spark.conf.get("spark.sql.shuffle.partitions")
        self.spark.conf.set(setting, self.buckets)
        try:
            rows.select(*columns, F.lit(part).alias("run")).write.insertInto(self.name)
        finally:
            self.spark.conf.set(setting, before)
        gone = [self._m["live"].pop(r) for r in instead if r in self._m["live"]]
        self._m["live"][run] = part
        self._save()
        for p in gone:
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION (run='{p}')")
            self._delete(p)

    def _delete(self, part: str) -> None:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/run={part}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)

    def merge(self, merged: DataFrame, into: str) -> None:
        """Put the one run `into` in place of all live runs; `merged` is made of them by an aggregation by key."""
        was = self.runs()
        self._m["merged"] = sorted({*self._m["merged"], *was} - {into})
        self._write(merged, into, True, was)

    def read(self, runs: list[str] | None = None) -> DataFrame:
        """The rows of all runs, or of those named, with `run`."""
        parts = [p for r, p in self._m["live"].items() if runs is None or r in runs]
        rows = self.spark.table(self.name).where(F.col("run").isin(parts) if parts else F.lit(False))
        return rows.withColumn("run", F.substring_index("run", "~", 1))

    def runs(self) -> list[str]:
        return sorted(self._m["live"])

    def has(self) -> bool:
        return self._m["schema"] is not None


def buckets_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """How many buckets a store of so many rows needs: one per `rows_each`, and one for every core at least."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // rows_each))


class BucketStore:
    """Keyed storage of whole rows under `path`; columns of any name may be stored, as a row is kept as one struct.

    key: the identifier's column. order: a column whose smallest value names the copy that stays. buckets: fixed for the
    life of a store, so chosen for the size it is to reach (about one per 128 MB of distinct rows); by default the
    session's shuffle partitions.
    """

    def __init__(self, spark: SparkSession, key: str, order: str, path: str | None = None, buckets: int | None = None):
        self.key, self.order = key, order
        self.table = Runs(spark, "k", ["k", "o"], path, buckets)

    def _collapsed(self, df: DataFrame) -> DataFrame:
        row = F.struct(*[df[c] for c in df.columns])
        ident = identity(df[self.key].cast("string"))
        own = F.concat(F.lit("row:"), F.coalesce(df[self.order].cast("string"), F.lit("null")))
        keyed = df.select(F.coalesce(F.concat(F.lit("id:"), ident), own).alias("k"), df[self.order].alias("o"), row.alias("row"))
        # a null order value sorts last: such a copy stays only if there is no other
        first = F.struct(F.col("o").isNull(), F.col("o"))
        return keyed.groupBy("k").agg(F.min_by("row", first).alias("row"), F.min("o").alias("o"), F.count(F.lit(1)).alias("copies"))

    def upsert(self, batch: DataFrame, run: str) -> None:
        """Store a batch as the run `run`, replacing an earlier delivery of the same run and nothing else. A run that
        compaction has merged is not taken again."""
        self.table.put(self._collapsed(batch), run)

    def runs(self) -> list[str]:
        return self.table.runs()

    def _merged(self, with_row: bool) -> DataFrame:
        aggs = [F.min("o").alias("o"), F.sum("copies").alias("copies")]
        if with_row:
            aggs.append(F.min_by("row", F.struct(F.col("o").isNull(), F.col("o"))).alias("row"))
        return self.table.read().groupBy("k").agg(*aggs)

    def compact(self, into: str = "base") -> None:
        """Merge all runs into one, bucket by bucket, and put it in their place. One run alone stays as it is."""
        if len(self.runs()) > 1:
            self.table.merge(self._merged(True), into)

    def rows(self) -> DataFrame:
        """k, o, copies and the surviving row of every identifier, whether compacted or not."""
        return self._merged(True) if len(self.runs()) != 1 else self.table.read().select("k", "o", "copies", "row")

    def survivors(self) -> DataFrame:
        """k, o and copies alone; the stored rows are not read."""
        return self._merged(False) if len(self.runs()) != 1 else self.table.read().select("k", "o", "copies")


#: Messages a bucket, about 128 MB of them.
ROWS_EACH = 200_000


def load(df: DataFrame, batch: str | None, key: str, order: str, open_batches: int = 2, path: str | None = None) -> BucketStore:
    """A compacted store of all batches: those before the last `open_batches` as one run, each later batch as its own.

    Loading history batch by batch would write a run of small files for each; one bulk run gives the same store.
    """
    facts = df.agg(F.count(F.lit(1)).alias("n"), (F.max(F.col(batch)) if batch else F.lit(None)).alias("last")).first()
    last = facts["last"]
    store = BucketStore(df.sparkSession, key, order, path, buckets_for(df.sparkSession, facts["n"], ROWS_EACH))
    if last is None:
        store.upsert(df, "all")
        return store
    cut = last - open_batches
    b = F.col(batch)
    store.upsert(df.where(b.isNull() | (b <= cut)), "history")
    for n in range(cut + 1, last + 1):
        store.upsert(df.where(b == n), f"batch{n}")
    store.compact()
    return store


def one_of_each(df: DataFrame, key: str, order: str, batch: str | None = None) -> DataFrame:
    """Exactly one row of each message, with the columns of `df`."""
    kept = load(df, batch, key, order).rows()
    return kept.select(*[F.col("row")[c].alias(c) for c in df.columns])


def surplus(df: DataFrame, key: str, order: str, batch: str | None = None) -> DataFrame:
    """The order values of the surplus copies: rows whose identifier has a copy that stays, and it is another one."""
    kept = load(df, batch, key, order).survivors()
    named = df.where(identity(F.col(key).cast("string")).isNotNull()).select(F.col(order))
    return named.join(kept.select(F.col("o").alias(order)), order, "left_anti")
