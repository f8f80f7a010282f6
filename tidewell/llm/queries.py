"""Queries of the corpus operators over their whole tables, with the parameters meant for use."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rows import small
from ..session import configure, table
from . import boilerplate, cutoffs, incremental, leaks, mixing, residue, sitelines, spans


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return table(configure(spark), sf, "documents")


def _content(spark: SparkSession, sf: str) -> DataFrame:
    return table(configure(spark), sf, "fetched_content")


def _selected(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return cutoffs.select(table(configure(spark), sf, "score_result"), _content(spark, sf), table(spark, sf, "keep_target"))


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.boilerplate_lines(_content(spark, sf))


def p1_texts(spark: SparkSession, sf: str) -> DataFrame:
    return boilerplate.main_text(_content(spark, sf))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return _selected(spark, sf)[0].select("content_id")


def p2_cutoffs(spark: SparkSession, sf: str) -> DataFrame:
    return _selected(spark, sf)[1]


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = _content(spark, sf)
    return sitelines.marked(rows, sitelines.repeated_lines(rows), "content_id").select("content_id", "line_no")


def p4_texts(spark: SparkSession, sf: str) -> DataFrame:
    rows = _content(spark, sf)
    return sitelines.cleaned(rows, sitelines.repeated_lines(rows)).select("content_id", "text")


def p4_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = _content(spark, sf)
    named = sitelines.marked(rows, sitelines.repeated_lines(rows), "content_id").withColumn("line", sitelines.norm(F.col("line")))
    return named.groupBy("source", "line").agg(F.countDistinct("content_id").alias("n_rows"))


def p4_excess(spark: SparkSession, sf: str) -> DataFrame:
    """What the comparison says of each line removed: how often it stands outside, and whether it exceeds that too."""
    rows = _content(spark, sf)
    named = sitelines.repeated_lines(rows)
    lines = sitelines.marked(rows, named, "content_id").select("source", sitelines.norm(F.col("line")).alias("line")).distinct()
    held = lines.withColumn("h", F.xxhash64("line")).join(small(named.drop("llr")), ["source", "h"])
    return held.select("source", "line", "n_rows", "n_outside", F.round("llr_outside", 4).alias("llr_outside"), "only_here")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return residue.residue_rows(_content(spark, sf))


def p6_lines(spark: SparkSession, sf: str) -> DataFrame:
    return residue.residue_lines(_content(spark, sf))


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = _content(spark, sf)
    return incremental.repeated_tasks(table(spark, sf, "queue_task"), rows)


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(_docs(spark, sf), table(spark, sf, "benchmark")).where("longest >= 80").select("doc_id", "item_id")


def p8_tiles(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.leaks(_docs(spark, sf), table(spark, sf, "benchmark"))


def p8_report(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.report(_docs(spark, sf), table(spark, sf, "benchmark")).select("item_id", "n_docs", F.when(F.col("n_docs") > 0, F.col("longest")).otherwise(0).alias("longest"))


def _copies(spark: SparkSession, sf: str) -> DataFrame:
    targets = table(spark, sf, "mix_target")
    # only the targets' sources are tokenized
    docs = _docs(spark, sf).join(small(targets.select("source").distinct()), "source", "left_semi")
    return mixing.copies(mixing.token_counts(docs), targets)


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.shares(_copies(spark, sf), table(spark, sf, "mix_target"))


def p9_copies(spark: SparkSession, sf: str) -> DataFrame:
    return _copies(spark, sf)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return spans.pairs(_docs(spark, sf).select(F.col("doc_id").alias("id"), "text"))


def p10_report(spark: SparkSession, sf: str) -> DataFrame:
    return spans.report(_docs(spark, sf).select(F.col("doc_id").alias("id"), "text")).withColumnRenamed("id", "doc_id")


def p10_groups(spark: SparkSession, sf: str) -> DataFrame:
    return spans.groups(_docs(spark, sf).select(F.col("doc_id").alias("id"), "text")).withColumnRenamed("id", "doc_id")


QUERIES = {f.__name__: f for f in (p1_found, p1_texts, p2_found, p2_cutoffs, p4_found, p4_texts, p4_lines, p4_excess, p6_found, p6_lines, p7_found, p8_found, p8_tiles, p8_report, p9_copies, p9_shares, p10_found, p10_report, p10_groups)}
