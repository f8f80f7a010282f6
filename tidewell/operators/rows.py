"""First, last, limited, counted and compared rows: the relational core."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

#: A side of a join is broadcast up to this many rows, counted first; beyond it the join shuffles.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame with a broadcast hint if it has at most `rows` rows, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def first_per(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The first row of each key in an order. It is an aggregation, so a hot key is reduced before the shuffle."""
    first = df.groupBy(key.alias("_key")).agg(F.min_by(F.struct("*"), F.struct(*order)).alias("_row"))
    return first.select("_row.*")


def last_per(df: DataFrame, key: Column, order: list[str]) -> DataFrame:
    """The last row of each key in an order."""
    last = df.groupBy(key.alias("_key")).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_row"))
    return last.select("_row.*")


def top_per(df: DataFrame, key: str, order: list[Column], n: int | Column, most: int | None = None) -> DataFrame:
    """The first n rows of each key. Spark cuts each task's share to n (to `most` where n is a column) before the
    shuffle, so a hot key sends a few rows per task."""
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    out = df.withColumn("_rank", rank)
    out = out.where(F.col("_rank") <= (n if isinstance(n, int) else most)) if isinstance(n, int) or most is not None else out
    return (out if isinstance(n, int) else out.where(F.col("_rank") <= n)).drop("_rank")


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the seen ones; repeated unseen rows stay."""
    return df.join(seen.select(key).distinct(), key, "left_anti")


def zero_filled(df: DataFrame, column: str, domain: list[str], otherwise: str | None = None) -> DataFrame:
    """column, n: counts over a closed domain, 0 where a value does not occur; others count as `otherwise` or not."""
    value = F.col(column)
    value = F.when(value.isin(domain), value).otherwise(F.lit(otherwise)) if otherwise else value
    counted = df.select(value.alias(column)).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.createDataFrame([(d,) for d in domain], f"{column} string")
    return every.join(counted, column, "left").select(column, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def with_total(df: DataFrame, column: str, total: str = "TOTAL") -> DataFrame:
    """column, n: counts and their total, by rollup."""
    rolled = df.rollup(column).agg(F.count(F.lit(1)).cast("bigint").alias("n"), F.grouping(column).alias("g"))
    return rolled.select(F.when(F.col("g") == 1, F.lit(total)).otherwise(F.col(column)).alias(column), "n")


def drift(stored: DataFrame, current: DataFrame, key: str, value: str) -> DataFrame:
    """key, stored, current: keys whose value changed, both being set; a full outer comparison."""
    a = stored.select(key, F.col(value).alias("stored"))
    b = current.select(key, F.col(value).alias("current"))
    both = a.join(b, key, "full_outer")
    return both.where("stored <> '' AND current <> '' AND stored <> current").select(key, "stored", "current")


def streaks(df: DataFrame, key: str, order: str, failed: Column, chunks: int = 64) -> DataFrame:
    """The rows with `streak`, the number of failures in a row up to each, reset by every success; `order` is numeric.

    A key's rows are cut into ranges of the order (by quantiles of the whole table), so that a hot key is worked on in
    pieces; what a piece carries over from those before it is found on one row per key and piece. A row without order
    value counts as the first.
    """
    shares = [i / chunks for i in range(1, chunks)]
    cuts = sorted(set(df.agg(F.percentile_approx(order, shares, chunks * 20)).first()[0] or [])) if shares else []
    piece = F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c < F.col(order))) if cuts else F.lit(0)
    marked = df.withColumn("_f", F.coalesce(failed, F.lit(False)).cast("int")).withColumn("_piece", F.coalesce(piece, F.lit(0)))
    so_far = Window.partitionBy(key, "_piece").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    marked = marked.withColumn("_island", F.sum(1 - F.col("_f")).over(so_far))
    run = Window.partitionBy(key, "_piece", "_island").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = settle(marked.withColumn("_run", F.sum("_f").over(run)), "streaks")  # read four times below
    # of each piece: the successes in it and the failures it ends with
    ends = local.groupBy(key, "_piece").agg(F.max("_island").alias("_s"))
    tails = local.join(ends.select(F.col(key).alias("_k"), F.col("_piece").alias("_p"), "_s"), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")) & (F.col("_island") == F.col("_s")))
    tails = tails.groupBy(key, "_piece").agg(F.max("_run").alias("_tail"))
    line = ends.join(tails.select(F.col(key).alias("_k"), F.col("_piece").alias("_p"), "_tail"), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")))
    w = Window.partitionBy(key).orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)  # over at most `chunks` rows
    line = line.withColumn("_g", F.sum((F.col("_s") > 0).cast("int")).over(w))
    inside = Window.partitionBy(key, "_g").orderBy("_piece").rowsBetween(Window.unboundedPreceding, 0)
    line = line.withColumn("_end", F.sum("_tail").over(inside))
    carried = line.select(F.col(key).alias("_k"), F.col("_piece").alias("_p"), F.coalesce(F.lag("_end").over(Window.partitionBy(key).orderBy("_piece")), F.lit(0)).alias("_carry"))
    out = local.join(small(carried), F.col(key).eqNullSafe(F.col("_k")) & (F.col("_piece") == F.col("_p")))
    streak = F.col("_run") + F.when(F.col("_island") == 0, F.col("_carry")).otherwise(F.lit(0))
    return out.withColumn("streak", streak.cast("bigint")).select(*df.columns, "streak")


def admit(items: DataFrame, key: str, order: list[str], seen: DataFrame, queued: DataFrame, queue_key: str, limit: int) -> DataFrame:
    """The items with `outcome`: what a queue that takes at most `limit` new items says to each, in an order.

    `limit` once enough are taken, before anything else; else `duplicate` for a key seen before or taken in this run;
    else `silent` where the exact address is queued already; else `enqueued`. The place of the last one taken is found
    by a top-k over first occurrences, so no window runs over all rows.
    """
    place = F.struct(*order)
    base = items.withColumn("_place", place)
    base = base.join(seen.select(F.col(key).alias("_seen")).distinct(), F.col(key) == F.col("_seen"), "left")
    base = base.join(queued.select(F.col(queue_key).alias("_queued")).distinct(), F.col(queue_key) == F.col("_queued"), "left")
    fresh = base.where("_seen IS NULL AND _queued IS NULL").groupBy(F.col(key).alias("_k")).agg(F.min("_place").alias("_first"))
    taken = fresh.orderBy("_first").limit(limit)  # the feature itself: at most `limit` are taken
    last = taken.agg(F.count(F.lit(1)).alias("_n"), F.max("_first").alias("_last"))
    out = base.join(fresh, F.col(key) == F.col("_k"), "left").crossJoin(F.broadcast(last))
    outcome = (
        F.when((F.col("_n") >= limit) & (F.col("_place") > F.col("_last")), "limit")
        .when(F.col("_seen").isNotNull(), "duplicate")
        .when(F.col("_first") < F.col("_place"), "duplicate")
        .when(F.col("_queued").isNotNull(), "silent")
        .otherwise("enqueued")
    )
    return out.withColumn("outcome", outcome).drop("_place", "_seen", "_queued", "_k", "_first", "_n", "_last")


def merged(target: DataFrame, updates: DataFrame, key: str, keep: Column, columns: list[str]) -> DataFrame:
    """key, the columns, and `action`: an upsert as one full outer join. A key of both sides is `kept` as in the target
    where `keep` (over the target's columns) holds, else `reset` to the update; others are `untouched` or `inserted`.
    Both sides have one row per key."""
    t = target.select(F.col(key).alias("_tk"), F.struct(*columns).alias("_t"), keep.alias("_keep"))
    u = updates.select(F.col(key).alias("_uk"), F.struct(*columns).alias("_u"))
    action = F.when(F.col("_uk").isNull(), "untouched").when(F.col("_tk").isNull(), "inserted").when(F.col("_keep"), "kept").otherwise("reset")
    both = t.join(u, F.col("_tk") == F.col("_uk"), "full_outer").withColumn("action", action)
    row = F.when(F.col("action").isin("untouched", "kept"), F.col("_t")).otherwise(F.col("_u"))
    return both.select(F.coalesce("_tk", "_uk").alias(key), row.alias("_r"), "action").select(key, "_r.*", "action")
