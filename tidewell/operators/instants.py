"""Mixed timestamp formats and time zones brought to one UTC instant (problem 5)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import known_zone, to_utc, utc_text
from ..functions.urls import host_of

#: The lookup is broadcast up to this many rows; beyond it the join shuffles.
BROADCAST_ROWS = 50_000


def source_zones(config: DataFrame) -> DataFrame:
    """key, zone, day_first: one row per source id and one per host of a source's address.

    A missing or unknown zone is UTC. Several rows of one id (or host) collapse to the smallest by (id, zone).
    """
    meta = F.col("metadata")
    base = config.select(
        F.col("id"),
        host_of(F.col("url")).alias("host"),
        known_zone(F.try_element_at(meta, F.lit("timezone"))).alias("zone"),
        (F.coalesce(F.lower(F.try_element_at(meta, F.lit("date_order"))), F.lit("dmy")) != "mdy").alias("day_first"),
    )
    keyed = base.select(F.concat(F.lit("id:"), "id").alias("key"), "id", "zone", "day_first").unionByName(
        base.select(F.concat(F.lit("host:"), "host").alias("key"), "id", "zone", "day_first")
    )
    return keyed.where("key IS NOT NULL").groupBy("key").agg(F.min_by(F.struct("zone", "day_first"), F.struct("id", "zone")).alias("v")).select("key", "v.zone", "v.day_first")


def instants(rows: DataFrame, config: DataFrame, value: str, source: str, url: str, rec_id: str, field: str, zoned_default: str | None = None) -> DataFrame:
    """field, rec_id, raw, utc (timestamp or null): the instant each `value` names.

    The row's zone is its source's; where the source is null or blank, the host of the url tells the source. With
    `zoned_default` the values without zone are in that zone instead, and no lookup takes place. Null, blank and
    unreadable values give a null instant; repeated rows are each kept; other columns are not touched.
    """
    picked = rows.select(F.lit(field).alias("field"), F.col(rec_id).alias("rec_id"), F.col(value).alias("raw"), F.col(source).alias("s"), F.col(url).alias("u"))
    if zoned_default:
        return picked.select("field", "rec_id", "raw", to_utc(F.col("raw"), F.lit(zoned_default), F.lit(True)).alias("utc"))
    zones = source_zones(config)
    if config.limit(BROADCAST_ROWS // 2 + 1).count() <= BROADCAST_ROWS // 2:
        zones = F.broadcast(zones)
    key = F.when(F.trim("s") != "", F.concat(F.lit("id:"), "s")).otherwise(F.concat(F.lit("host:"), host_of(F.col("u"))))
    joined = picked.withColumn("key", key).join(zones, "key", "left")
    return joined.select("field", "rec_id", "raw", to_utc(F.col("raw"), F.coalesce("zone", F.lit("UTC")), F.col("day_first")).alias("utc"))


def all_instants(content: DataFrame, items: DataFrame, config: DataFrame) -> DataFrame:
    """The instants of fetched_content.published_at, fetched_content.fetched_at and source_item.published_at."""
    parts = [
        instants(content, config, "published_at", "source", "url", "content_id", "fetched_content.published_at"),
        instants(content, config, "fetched_at", "source", "url", "content_id", "fetched_content.fetched_at", zoned_default="UTC"),
        instants(items, config, "published_at", "source_id", "url", "item_id", "source_item.published_at"),
    ]
    return reduce(DataFrame.unionByName, parts)


def found(content: DataFrame, items: DataFrame, config: DataFrame) -> DataFrame:
    """field, rec_id, utc (text): each value that names an instant."""
    return all_instants(content, items, config).where("utc IS NOT NULL").select("field", F.col("rec_id").cast("bigint").alias("rec_id"), utc_text(F.col("utc")).alias("utc"))
