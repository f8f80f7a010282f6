"""A score cutoff per source that keeps a target share of its records (problem 2).

Sketch-bracketed exact selection:
1. one quantile sketch per source (Greenwald-Khanna summaries, whose rank error is guaranteed) gives a grid of
   quantiles; the two grid values around the target rank, moved outward by the error, bracket the cutoff;
2. one pass counts each source's records above and inside its bracket, which proves the bracket or, should it miss,
   widens it to all values of that source;
3. only distinct values inside the brackets are sorted, with their counts; the cutoff is where the count from above
   reaches the target.
A source with a third of all records gives one sketch per task and some half per cent of its records to the sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

GRID = 400
ACCURACY = 10_000
#: Targets and bounds have a row per source; they are broadcast up to this many.
BROADCAST_ROWS = 50_000


def records(scores: DataFrame, content: DataFrame) -> DataFrame:
    """source, content_id, score: one row per content with a source and a valid score.

    scores: content_id, final_score, scored_ts, score_id. Valid is a score from 0 to 1; null and NaN are not. Of several
    valid rows of a content the one with the latest scored_ts counts (null is earliest; the larger score_id decides a
    tie). content: content_id, source; contents without source, and ids of no content, have no record.
    """
    s = F.col("final_score").cast("double")
    valid = scores.where(s.isNotNull() & ~F.isnan(s) & s.between(0.0, 1.0) & F.col("content_id").isNotNull())
    last = valid.groupBy("content_id").agg(F.max_by(s, F.struct("scored_ts", "score_id")).alias("score"))
    owner = content.where("source IS NOT NULL AND content_id IS NOT NULL").groupBy("content_id").agg(F.min("source").alias("source"))
    return last.join(owner, "content_id").select("source", "content_id", (F.col("score") + F.lit(0.0)).alias("score"))


def _maybe_broadcast(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def cutoffs(recs: DataFrame, targets: DataFrame) -> DataFrame:
    """source, keep_percent, n_records, n_kept, cutoff: one row per source that has records and a target.

    The cutoff is the highest score at which at least keep_percent per cent of the source's records lie at or above it;
    all records tied at it are kept. A target of 0 or less keeps those at the highest score, one of 100 or more keeps
    all. Of repeated targets of a source the largest counts; null targets are none.
    """
    goal = targets.where("source IS NOT NULL AND keep_percent IS NOT NULL").groupBy("source").agg(F.max("keep_percent").alias("keep_percent"))
    n_goals = goal.count()
    goal = _maybe_broadcast(goal, n_goals)
    grid = [i / GRID for i in range(GRID + 1)]
    sketch = recs.groupBy("source").agg(F.percentile_approx("score", grid, ACCURACY).alias("q"), F.count(F.lit(1)).alias("n"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    need = F.greatest(F.lit(1).cast("bigint"), F.least(F.col("n"), F.expr("(CAST(keep_percent AS BIGINT) * n + 99) div 100")))
    rank = (F.col("n") - F.col("need") + 1) / F.col("n")  # of the cutoff, from below
    slack = 2.0 / ACCURACY
    below = F.floor((rank - slack - 1 / F.col("n")) * GRID).cast("int")
    above = F.ceil((rank + slack + 1 / F.col("n")) * GRID).cast("int")
    bounds = (
        sketch.join(goal, "source")
        .withColumn("need", need)
        .select(
            "source", "keep_percent", "n", "need", "lo", "hi",
            F.when(below < 0, F.col("lo")).otherwise(F.get("q", below)).alias("from"),
            F.when(above > GRID, F.col("hi")).otherwise(F.get("q", above)).alias("to"),
        )
    )
    bounds = settle(bounds, "bounds")
    inside = F.col("score").between(F.col("from"), F.col("to"))
    held = recs.join(_maybe_broadcast(bounds.select("source", "from", "to"), n_goals), "source").groupBy("source").agg(F.count(F.when(F.col("score") > F.col("to"), 1)).alias("over"), F.count(F.when(inside, 1)).alias("within"))
    proven = (F.col("over") < F.col("need")) & (F.col("need") <= F.col("over") + F.col("within"))
    sure = settle(
        bounds.join(held, "source").select(
            "source", "keep_percent", "n", "need",
            F.when(proven, F.col("from")).otherwise(F.col("lo")).alias("from"),
            F.when(proven, F.col("to")).otherwise(F.col("hi")).alias("to"),
            F.when(proven, F.col("over")).otherwise(F.lit(0)).alias("over"),
        ),
        "brackets",
    )
    values = recs.join(_maybe_broadcast(sure, n_goals), "source").where(inside).groupBy("source", "keep_percent", "n", "need", "over", "score").agg(F.count(F.lit(1)).alias("c"))
    running = F.col("over") + F.sum("c").over(Window.partitionBy("source").orderBy(F.desc("score")))
    reached = values.withColumn("kept", running).where("kept >= need")
    best = reached.groupBy("source").agg(F.max(F.struct("score", "kept", "n", "keep_percent")).alias("b"))
    return best.select("source", "b.keep_percent", F.col("b.n").alias("n_records"), F.col("b.kept").alias("n_kept"), F.col("b.score").alias("cutoff"))


def select(scores: DataFrame, content: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The kept records (source, content_id, score, cutoff) and the cutoffs. Empty tables give empty results."""
    recs = settle(records(scores, content), "records")
    cuts = settle(cutoffs(recs, targets), "cutoffs")
    kept = recs.join(_maybe_broadcast(cuts.select("source", "cutoff"), cuts.count()), "source").where("score >= cutoff")
    return kept.select("source", "content_id", "score", "cutoff"), cuts
