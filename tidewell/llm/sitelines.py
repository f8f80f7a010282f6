"""Lines that come back within one source (problem 4).

For each source and line the rows that hold it are counted, as are the rows of other sources. A log-likelihood ratio
compares the two frequencies, and the false discovery rate over all tested lines is held at `fdr`
(Benjamini-Hochberg, over upper bounds of the p-values in steps of a tenth of a decade, which only makes it stricter).
Significant lines are then held against the definition: at least `min_rows` rows and `min_share` of the source's rows.

What is compared outside. The same line's outside frequency alone would acquit a line that every source repeats
("Advertisement"), though it comes back within each of them. So the outside frequency is that of the same line or, where
lower, of an average line of the other sources; `only_here` tells which lines exceed their own outside frequency too.

Lines meet as 64-bit hashes, counted in the map side first, so a line in a third of all rows is one row per task. The
named lines of a source number at most 1 / min_share times its lines per row; they are sent to the texts, which are
filtered in place, so no text is shuffled and positions never need to be put back in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

#: Named lines are broadcast up to this many; beyond it the texts are joined by source.
BROADCAST_LINES = 200_000


def norm(line: Column) -> Column:
    """A line as it is compared: case, surrounding and repeated white space ignored."""
    return F.lower(F.trim(F.regexp_replace(line, r"(?U)\s+", " ")))


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def counts(rows: DataFrame) -> DataFrame:
    """source, h, n: rows of each source that hold each line (by hash), a line counting once per row."""
    distinct = F.array_distinct(F.transform(F.filter(F.transform(_lines(F.col("text")), norm), lambda x: x != ""), lambda x: F.xxhash64(x)))
    return rows.where("source IS NOT NULL AND text IS NOT NULL").select("source", F.explode(distinct).alias("h")).groupBy("source", "h").agg(F.count(F.lit(1)).alias("n"))


def _xlogx(x: Column) -> Column:
    return F.when(x > 0, x * F.log(x)).otherwise(F.lit(0.0))


def _g2(a: Column, n: Column, b: Column, m: Column) -> Column:
    """Twice the log-likelihood ratio of a of n against b of m, 0 where a/n is not the larger."""
    g = 2 * (_xlogx(a) + _xlogx(b) + _xlogx(n - a) + _xlogx(m - b) + _xlogx(n + m) - _xlogx(n) - _xlogx(m) - _xlogx(a + b) - _xlogx(n + m - a - b))
    return F.when(a * m > b * n, F.greatest(g, F.lit(0.0))).otherwise(F.lit(0.0))


def _log10_p(g2: Column) -> Column:
    """An upper bound of the one-sided p-value's decimal logarithm: the normal tail is below density / z."""
    z = F.sqrt(g2)
    return F.when(z > 1, (-(g2 / 2) - F.log(z) - 0.5 * math.log(2 * math.pi)) / math.log(10)).otherwise(F.lit(0.0))


def repeated_lines(rows: DataFrame, min_rows: int = 5, min_share: float = 0.05, fdr: float = 0.05) -> DataFrame:
    """source, h, n_rows, n_source, n_outside, llr, llr_outside, only_here: the lines to remove, by hash of their compared
    form. llr is the ratio they were tested by, llr_outside that against the same line's outside frequency alone.

    rows: source, text. Rows with null source, and blank lines, do not count; null and empty texts count as rows of
    their source but hold no line.
    """
    sized = rows.where("source IS NOT NULL").groupBy("source").agg(F.count(F.lit(1)).alias("n_source"))
    every = settle(counts(rows), "lines")
    totals = every.agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("distinct")).first()
    n_all = sized.agg(F.coalesce(F.sum("n_source"), F.lit(0))).first()[0]
    mean = (totals["occurrences"] or 0) / max(totals["distinct"], 1)  # rows of a source that hold an average line
    often = every.where(F.col("n") >= min_rows)
    outside = every.join(often.select("h").distinct(), "h", "left_semi").groupBy("h").agg(F.sum("n").alias("n_total"))
    tested = often.join(outside, "h").join(sized, "source").withColumn("n_outside", F.col("n_total") - F.col("n"))
    a, n = F.col("n").cast("double"), F.col("n_source").cast("double")
    m = F.when(F.lit(n_all) > n, F.lit(n_all) - n).otherwise(n)  # a lone source is held against its own average line
    b = F.least(F.when(F.lit(n_all) > n, F.col("n_outside").cast("double")).otherwise(F.lit(mean)), F.lit(mean))
    own = _g2(a, n, F.col("n_outside").cast("double"), m)
    tested = tested.withColumn("llr", _g2(a, n, b, m)).withColumn("p", F.ceil(_log10_p(F.col("llr")) * 10)).withColumn("llr_outside", own)
    tested = settle(tested.withColumn("only_here", _log10_p(F.col("llr_outside")) < math.log10(fdr)), "tested")
    # p is in tenths of a decade: a few thousand values at most, whatever the input
    steps = tested.groupBy("p").agg(F.count(F.lit(1)).alias("c")).orderBy("p").collect()
    n_tests, seen, limit = sum(s["c"] for s in steps), 0, None
    for s in steps:
        seen += s["c"]
        if s["p"] / 10 <= math.log10(fdr * seen / n_tests):
            limit = s["p"]
    significant = tested.where(F.lit(False) if limit is None else F.col("p") <= limit)
    return significant.where((F.col("n") >= min_rows) & (F.col("n") >= F.col("n_source") * min_share - 1e-9)).select("source", "h", F.col("n").alias("n_rows"), "n_source", "n_outside", "llr", "llr_outside", "only_here")


def with_named(rows: DataFrame, named: DataFrame) -> DataFrame:
    """row (the whole row), named_lines: the hashes of its source's lines to remove."""
    named = settle(named.select("source", "h"), "named")
    by_source = named.groupBy(F.col("source").alias("named_source")).agg(F.collect_set("h").alias("named_lines"))
    if named.count() <= BROADCAST_LINES:
        by_source = F.broadcast(by_source)
    whole = rows.select(F.struct("*").alias("row"))  # so that no name of the rows can clash
    return whole.join(by_source, F.col("row.source") == F.col("named_source"), "left").drop("named_source")


def marked(rows: DataFrame, named: DataFrame, row_id: str) -> DataFrame:
    """row_id, line_no (from 1), source, line: every line to remove, where it stands."""
    picked = rows.select(F.col(row_id), "source", "text").where("source IS NOT NULL AND text IS NOT NULL")
    hit = with_named(picked, named).where("named_lines IS NOT NULL").select("row.*", "named_lines")
    numbered = F.transform(_lines(F.col("text")), lambda x, i: F.struct((i + 1).alias("line_no"), x.alias("line"), norm(x).alias("norm")))
    mine = F.filter(numbered, lambda x: (x["norm"] != "") & F.array_contains(F.col("named_lines"), F.xxhash64(x["norm"])))
    return hit.select(row_id, "source", F.explode(mine).alias("l")).select(row_id, "source", "l.line_no", "l.line")


def cleaned(rows: DataFrame, named: DataFrame) -> DataFrame:
    """The rows, all columns kept, with `text` freed of its source's repeated lines; a null text stays null."""
    # a blank line's hash is never named, as blank lines are not counted
    kept = F.filter(_lines(F.col("row.text")), lambda x: ~F.array_contains(F.col("named_lines"), F.xxhash64(norm(x))))
    text = F.when(F.col("named_lines").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return with_named(rows, named).select(F.col("row").withField("text", text).alias("row")).select("row.*")
