"""Streams: counts by value, sliding counts, first sightings and consecutive failures, each to a table of files.

Every flow runs over what is there (`availableNow`) or on a timer; state lives in the checkpoint, which is put in the
session's shared folder, so a lost executor only repeats a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from ..session import scratch_path


def stream_of(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 4) -> DataFrame:
    """A stream over a folder of parquet files (or over one file)."""
    folder, _, name = path.rpartition("/")
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if path.endswith(".parquet") and spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(spark._jvm.org.apache.hadoop.fs.Path(path)).isFile():
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run_to_table(stream: DataFrame, mode: str, what: str, keys: list[str] | None = None) -> DataFrame:
    """Run a stream over what is there and read its table. `complete` results are replaced, `append` ones added; of
    `update` ones the last row of each value of `keys` counts, so that state behind the watermark may be let go."""
    spark = stream.sparkSession
    out, check = scratch_path(spark, what), scratch_path(spark, what + "-checkpoint")
    if mode == "complete":

        def keep(df: DataFrame, _: int) -> None:
            df.write.mode("overwrite").parquet(out)

        query = stream.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", check).trigger(availableNow=True).start()
    elif mode == "update":

        def add(df: DataFrame, batch: int) -> None:
            df.write.mode("overwrite").parquet(f"{out}/_b={batch}")  # a batch run again replaces its rows

        query = stream.writeStream.outputMode("update").foreachBatch(add).option("checkpointLocation", check).trigger(availableNow=True).start()
    else:
        query = stream.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", check).trigger(availableNow=True).start()
    query.awaitTermination()
    if mode == "update":
        told = spark.read.schema(StructType([*stream.schema.fields, StructField("_b", LongType())])).parquet(out)
        rest = [c for c in stream.columns if c not in keys]
        return told.groupBy(*keys).agg(*[F.max_by(c, "_b").alias(c) for c in rest]).select(*stream.columns)
    return spark.read.schema(stream.schema).parquet(out)


def counts(stream: DataFrame, column: str) -> DataFrame:
    """column, n of everything seen."""
    return stream.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def sliding_counts(stream: DataFrame, ts: str, column: str, length: str = "24 hours", step: str = "12 hours", late: str = "7 days") -> DataFrame:
    """window_start, column, n over sliding windows, with a watermark for late rows."""
    w = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late).groupBy(F.window(ts, length, step), column).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("window.start").alias("window_start"), column, "n")


def first_sightings(stream: DataFrame, key: str, ts: str | None = None, late: str = "7 days") -> DataFrame:
    """The keys, each once, as they first arrive. With a time column a key is forgotten once it is `late` behind, and
    may come again; without one all are remembered, which is what a list of everything seen asks for."""
    if ts is None:
        return stream.select(key).where(F.col(key).isNotNull()).dropDuplicates([key])
    timed = stream.select(key, F.col(ts).cast("timestamp").alias(ts)).where(F.col(key).isNotNull())
    return timed.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def open_streaks(stream: DataFrame, key: str, order: str, failed: str) -> DataFrame:
    """key, streak: per key the failures in a row up to the last row, in an order within each micro-batch; state is the
    streak alone."""

    def step(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        streak = state.get[0] if state.exists else 0
        rows = pd.concat(list(frames)).sort_values(order)
        fails = rows[failed].to_numpy()
        resets = (~fails).nonzero()[0]
        streak = int(len(fails) - 1 - resets[-1]) if len(resets) else streak + len(fails)
        state.update((streak,))
        yield pd.DataFrame({key: [k[0]], "streak": [streak]})

    kind = dict(stream.dtypes)[key]
    grouped = stream.select(key, order, failed).groupBy(key)
    return grouped.applyInPandasWithState(step, f"{key} {kind}, streak bigint", "streak bigint", "update", GroupStateTimeout.NoTimeout)
