"""Queries over whole tables for the two general problems: repeated messages (3) and mixed times (5)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import bucket_store, instants
from ..session import configure, table
from . import time_sql


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return bucket_store.surplus(table(spark, sf, "outbox_item"), "event_id", "delivery_id", "batch_no")


def p3_messages(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    kept = bucket_store.one_of_each(table(spark, sf, "outbox_item"), "event_id", "delivery_id", "batch_no")
    return kept.select("delivery_id", "batch_no", "event_id", "state", "sent_at", F.size("delivery_attempts").cast("bigint").alias("n_attempts"))


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    configure(spark)
    return instants.found(table(spark, sf, "fetched_content"), table(spark, sf, "source_item"), table(spark, sf, "source_config"))


QUERIES = {"p3_found": p3_found, "p3_messages": p3_messages, "p5_found": p5_found}

_IDENT = r"nullif(lower(regexp_replace(event_id, '^\s+|\s+$', '', 'g')), '')"
ORACLE = {
    "p5_found": time_sql.FOUND,
    "p3_found": f"SELECT delivery_id FROM (SELECT delivery_id, {_IDENT} k, row_number() OVER (PARTITION BY {_IDENT} ORDER BY delivery_id) n FROM outbox_item) WHERE k IS NOT NULL AND n > 1",
    "p3_messages": f"""SELECT delivery_id, batch_no, event_id, state, sent_at, CAST(len(delivery_attempts) AS BIGINT) AS n_attempts
FROM (SELECT *, {_IDENT} k, row_number() OVER (PARTITION BY {_IDENT} ORDER BY delivery_id) n FROM outbox_item) WHERE k IS NULL OR n = 1""",
}
