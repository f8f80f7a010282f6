"""Sources mixed to target weights (problem 9), by entropy balancing.

Sizes are tokens of a public tokenizer. The total T is the largest at which every source can fill its share without a
document being used more than max_repeats times. Each document gets a rate between 0 and its source's cap R; among all
rates that meet the token constraints those are taken that stay closest in relative entropy (of use and of room left) to
using every document once. By convex duality they are exponentially tilted by size,

    rate = R / (1 + (R / q - 1) exp(-lambda t / mean t)),

with one multiplier per source, the root of a monotone function, found by Newton steps that fall back to bisection where
they would leave the bracket. A step needs two sums per source, computed over distinct (source, size) pairs with
their counts, which is what all documents come down to. Rates become copies by systematic rounding: in order of size the
running sum of the fractions is cut at whole numbers, so a source's tokens are off by about one document per stratum of
at most `STRATUM` documents. What is off in all is then made up for by rounding `EVENED` documents of each source the
other way, those whose sizes come nearest to it.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle

STRATUM = 50_000
EVENED = 2
STEPS, TOLERANCE = 60, 1e-9
#: Targets are a table of settings: one multiplier each is held by the driver.
MOST_TARGETS = 20_000
# Fixed value: the pattern by which the public byte-level vocabulary splits text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DEFAULT_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"


@lru_cache(maxsize=2)  # a worker serves many tasks
def _encoder(ranks: str, pattern: str) -> Callable[[str], list[int]]:
    import tiktoken

    with open(ranks, "rb") as f:
        vocabulary = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={}).encode_ordinary


def token_counts(docs: DataFrame, ranks: str = DEFAULT_RANKS, pattern: str = PATTERN) -> DataFrame:
    """doc_id, source, n_tokens of each row; a null text has 0. ranks: the vocabulary's file, present on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(ranks, pattern)
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), pa.array(n, pa.int64())], ["doc_id", "source", "n_tokens"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "source", "text").mapInArrow(run, "doc_id bigint, source string, n_tokens bigint")


def _rate(cap: Column, base: Column, tilt: Column) -> Column:
    # a saturated source has an infinite multiplier
    return cap / (1 + (cap / base - 1) * F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), -tilt))))


def balance(sized: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """source, target_weight, cap, base, mean, multiplier, total: the solution per source of the targets.

    sized: source, n_tokens, docs (distinct pairs). A source without tokens cannot take part: its weight is spread over
    the others in proportion. total: tokens wanted instead of the largest feasible; sources that cannot fill their share
    of it are used to the cap.
    """
    goals = {r.source: (r.w, r.cap) for r in targets.where("source IS NOT NULL AND target_weight > 0 AND max_repeats > 0").groupBy("source").agg(F.sum("target_weight").alias("w"), F.max("max_repeats").alias("cap")).limit(MOST_TARGETS + 1).collect()}
    if len(goals) > MOST_TARGETS:
        raise ValueError(f"more than {MOST_TARGETS} targets")
    spark = sized.sparkSession
    schema = "source string, target_weight double, cap double, base double, mean double, multiplier double, total double"
    if not goals:
        return spark.createDataFrame([], schema)
    sized = sized.where("n_tokens > 0").join(F.broadcast(spark.createDataFrame([(g,) for g in goals], "source string")), "source", "left_semi")
    facts = {r.source: r for r in sized.groupBy("source").agg(F.sum(F.col("docs") * F.col("n_tokens")).alias("tokens"), F.sum("docs").alias("docs")).collect()}  # one row a target
    if not facts:
        return spark.createDataFrame([], schema)
    whole = sum(goals[s][0] for s in facts)
    weight = {s: goals[s][0] / whole for s in facts}
    cap = {s: float(goals[s][1]) for s in facts}
    base = {s: min(1.0, cap[s] / 2) for s in facts}
    mean = {s: facts[s].tokens / facts[s].docs for s in facts}
    most = min(cap[s] * facts[s].tokens / weight[s] for s in facts)
    want_total = float(total) if total is not None else most
    want = {s: weight[s] * want_total for s in facts}
    low, high, at = dict.fromkeys(facts, -60.0), dict.fromkeys(facts, 60.0), dict.fromkeys(facts, 0.0)
    open_ = {s for s in facts if want[s] < cap[s] * facts[s].tokens * (1 - 1e-12)}
    at |= {s: math.inf for s in facts if s not in open_}
    for _ in range(STEPS):
        if not open_:
            break
        now = spark.createDataFrame([(s, cap[s], base[s], mean[s], at[s]) for s in sorted(open_)], "source string, cap double, base double, mean double, multiplier double")
        x = F.col("n_tokens") / F.col("mean")
        rate = _rate(F.col("cap"), F.col("base"), F.col("multiplier") * x)
        sums = sized.join(F.broadcast(now), "source").groupBy("source").agg(F.sum(F.col("docs") * F.col("n_tokens") * rate).alias("got"), F.sum(F.col("docs") * F.col("n_tokens") * x * rate * (1 - rate / F.col("cap"))).alias("slope"))
        for r in sums.collect():
            s, gap = r.source, r.got - want[r.source]
            if abs(gap) <= TOLERANCE * want[s]:
                open_.discard(s)
                continue
            low[s], high[s] = (at[s], high[s]) if gap < 0 else (low[s], at[s])
            step = at[s] - gap / r.slope if r.slope > 0 else math.nan
            at[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
            if high[s] - low[s] < 1e-13:
                open_.discard(s)
    return spark.createDataFrame([(s, weight[s], cap[s], base[s], mean[s], at[s], want_total) for s in sorted(facts)], schema)


def copies(counted: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """doc_id, source, n_tokens, rate, copies: how often each document of a target's source is used (0 for some).

    counted: doc_id, source, n_tokens. Documents of other or no sources do not come out; empty documents get 0 copies.
    Repeated doc_ids are separate rows. No document gets more copies than its source's max_repeats.
    """
    names = targets.where("source IS NOT NULL").select("source").distinct()
    own = settle(counted.join(F.broadcast(names) if names.count() <= MOST_TARGETS else names, "source", "left_semi").select("doc_id", "source", "n_tokens"), "tokens")
    sized = settle(own.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("docs")), "sizes")
    solved = balance(sized, targets, total)
    n_docs = sized.groupBy("source").agg(F.sum("docs").alias("n_docs"))
    rated = own.join(F.broadcast(solved), "source").join(F.broadcast(n_docs), "source")
    rate = F.when(F.col("n_tokens") > 0, F.least(F.col("cap"), _rate(F.col("cap"), F.col("base"), F.col("multiplier") * F.col("n_tokens") / F.col("mean")))).otherwise(F.lit(0.0))
    strata = F.ceil(F.col("n_docs") / STRATUM)
    rated = rated.withColumn("rate", rate).withColumn("part", F.pmod(F.xxhash64("doc_id"), strata))
    order = Window.partitionBy("source", "part").orderBy("n_tokens", F.hash("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    run = F.sum("rate").over(order)
    start = F.pmod(F.xxhash64("source", "part"), F.lit(1000)) / 1000.0  # where the first cut falls
    placed = rated.withColumn("run", run).withColumn("copies", F.least(F.col("cap").cast("bigint"), (F.floor(F.col("run") + start + 1e-9) - F.floor(F.col("run") - F.col("rate") + start + 1e-9)).cast("bigint")))
    return _evened(placed, solved.select("source", (F.col("total") * F.col("target_weight")).alias("want"))).select("doc_id", "source", "n_tokens", "rate", "copies")


def _evened(placed: DataFrame, want: DataFrame) -> DataFrame:
    """The copies with the gap of each source closed as far as rounding single documents the other way does."""
    for _ in range(EVENED):
        placed = settle(placed, "placed")
        gap = want.join(placed.groupBy("source").agg(F.sum(F.col("copies") * F.col("n_tokens")).alias("got")), "source").select("source", (F.col("want") - F.col("got")).alias("gap"))
        key, rate = F.struct("doc_id", "part", "run"), F.col("rate")
        room = ((F.col("gap") > 0) & (F.col("copies") < F.ceil(rate - 1e-9))) | ((F.col("gap") < 0) & (F.col("copies") > F.floor(rate + 1e-9)))
        miss = F.abs(F.abs("gap") - F.col("n_tokens"))
        near = placed.join(F.broadcast(gap), "source").where(room & (miss < F.abs("gap")))
        pick = near.groupBy("source").agg(F.min_by(key, F.struct(miss.alias("miss"), "doc_id", "part", "run")).alias("pick"), F.max(F.signum("gap")).cast("bigint").alias("turn"))
        turned = F.when(F.col("pick") == key, F.col("turn")).otherwise(F.lit(0))
        placed = placed.join(F.broadcast(pick), "source", "left").withColumn("copies", F.col("copies") + turned).drop("pick", "turn")
    return placed


def shares(used: DataFrame, targets: DataFrame) -> DataFrame:
    """source, target_weight, max_repeats, share, tokens, tokens_available, docs_used, most_copies: one row per target,
    what the copies come to; a source without documents has 0."""
    per = used.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.sum("n_tokens").alias("tokens_available"), F.count(F.when(F.col("copies") > 0, 1)).alias("docs_used"), F.max("copies").alias("most_copies")
    )
    zero = F.lit(0).cast("bigint")
    goal = targets.where("source IS NOT NULL").groupBy("source").agg(F.sum("target_weight").alias("target_weight"), F.max("max_repeats").alias("max_repeats"))
    every = goal.join(per, "source", "left").select("source", "target_weight", "max_repeats", *[F.coalesce(c, zero).alias(c) for c in ("tokens", "tokens_available", "docs_used", "most_copies")])
    total = every.agg(F.sum("tokens").alias("all_tokens"))
    return every.crossJoin(F.broadcast(total)).withColumn("share", F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(F.lit(0.0))).drop("all_tokens")
