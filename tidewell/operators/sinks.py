"""Sinks: ledgers that take a line once, JSON logs, Markdown files with a manifest, one batch into several tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import short_hash, slug
from ..session import settle


def new_lines(lines: DataFrame, ledger: DataFrame, column: str = "line") -> DataFrame:
    """The distinct lines that the ledger does not hold yet."""
    return lines.select(column).distinct().join(ledger.select(column).distinct(), column, "left_anti")


def append_lines(lines: DataFrame, path: str, column: str = "line") -> DataFrame:
    """Append to a text ledger the lines it lacks; returns them. Repeating it appends nothing."""
    spark = lines.sparkSession
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)
    fresh = new_lines(lines, spark.read.text(path).withColumnRenamed("value", column), column) if there else lines.select(column).distinct()
    fresh = settle(fresh, "lines")  # worked out again after the append it would be empty
    fresh.select(F.col(column).alias("value")).write.mode("append").text(path)
    return fresh


def append_json(rows: DataFrame, path: str) -> None:
    """Append rows to a log of JSON lines."""
    rows.write.mode("append").json(path)


def markdown(rows: DataFrame, fields: list[str], title: Column, body: Column) -> DataFrame:
    """file_name, document: each row as Markdown with front matter of the fields; names are slug and hash."""
    front = F.concat_ws("\n", F.lit("---"), *[F.concat(F.lit(f"{f}: "), F.to_json(F.struct(F.coalesce(F.col(f).cast("string"), F.lit("")).alias("v")))) for f in fields], F.lit("---"))
    plain = F.regexp_replace(front, r'\{"v":(".*?")\}', "$1")
    name = F.concat(slug(title, 80), F.lit("-"), short_hash(F.coalesce(body, F.lit("")), 8), F.lit(".md"))
    return rows.select(name.alias("file_name"), F.concat(plain, F.lit("\n\n# "), F.coalesce(title, F.lit("")), F.lit("\n\n"), F.coalesce(body, F.lit(""))).alias("document"))


def write_files(documents: DataFrame, folder: str) -> DataFrame:
    """Write file_name, document as files below a folder all executors share, whole or not at all (a temporary name,
    then a rename); returns the manifest file_name, n_bytes. A repeated or retried write leaves the same files."""
    root = Path(folder.removeprefix("file://"))
    root.mkdir(parents=True, exist_ok=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        for b in batches:
            names, sizes = [], []
            for name, text in zip(b.column("file_name").to_pylist(), b.column("document").to_pylist()):
                target = root / os.path.basename(name)  # no path may lead out of the folder
                data = text.encode()
                part = target.with_name(f".{target.name}.{os.getpid()}")
                part.write_bytes(data)
                part.replace(target)
                names.append(target.name)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int64())], ["file_name", "n_bytes"])

    return documents.mapInArrow(run, "file_name string, n_bytes bigint")


def to_all(*sinks: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """One `foreachBatch` function that feeds several sinks in order; a later one does not run if an earlier one fails."""

    def run(df: DataFrame, batch: int) -> None:
        kept = df.persist()
        try:
            for sink in sinks:
                sink(kept, batch)
        finally:
            kept.unpersist()

    return run
