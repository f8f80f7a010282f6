"""New batches against all history (problem 7), over tables bucketed by hash.

A history is a folder of tables that grow by a run per batch and are never rewritten: page keys; hashes of whole
normalised articles; the articles themselves, one per text, with the hashes of their parts; and the parts by hash, each
with the article that holds it. A batch is appended, and looked up bucket by bucket: joins on the page key and the whole
hash find full copies, the join on part hashes finds articles that share parts. Nothing is recounted or read again but
what the batch's own hashes meet, and a history opened in another session goes on where it stood.

Parts. Paragraph hashes alone would miss articles whose every paragraph was touched or whose lines were broken anew, so
paragraphs are cut at sentence ends. A copy keeps at least `KEPT_PARTS` of its words in untouched sentences, so among
its rarest sentences that make up the rest and a little more at least one is shared with what it copies: those are
looked up. A pair that meets is decided on its texts: the longest common subsequence of words must keep `KEPT_WORDS` of
the earlier article and `OWN_WORDS` of the later one.

Wanted is the first article that is repeated, and a sentence may stand in a third of all articles. So the articles that
hold a sentence are tried in order of id, `ROUNDS` at a time: an article is done once no untried holder of its sentences
is earlier than what it was found to repeat. In a group of copies, however large, nearly all are done after the first
holders. What is left are articles that consist of stock sentences to a quarter or more and repeat nothing early; they
meet all further holders that are rich enough in shared sentences themselves. Before texts are read, a pair must share
`KEPT_PARTS` of the later one's words in sentences. No size switches anything: every holder that could be the first is
tried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.urls import page_key
from ..operators.bucket_store import Runs, buckets_for
from ..session import scratch_path, settle
from . import residue

KEPT_WORDS, OWN_WORDS, KEPT_PARTS = 0.7, 0.5, 0.25
#: What is left of a page in fewer words is no article and repeats nothing.
LEAST_WORDS = 12
#: Holders of a sentence tried in the first and the second round.
ROUNDS = (4, 64)
#: A sentence in more articles of one run than this is spread over several buckets.
SPREAD = 1_000_000
BROADCAST_IDS = 200_000
#: Tasks a bucket of a history that is made for them, about 60 MB of their texts and parts.
TASKS_EACH = 20_000

_WORD = re.compile(r"[㐀-鿿]|[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[。!?;])|\n")


def words(text: str) -> list[str]:
    """Lower-cased words; each Han character is one."""
    return _WORD.findall(text.lower())


def common(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, by bit-parallel dynamic programming."""
    where: dict[str, int] = {}
    for i, w in enumerate(a):
        where[w] = where.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for w in b:
        u = v & where.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def _hash(ws: list[str]) -> int:
    h = xxhash.xxh3_64_intdigest(" ".join(ws))
    return h - (1 << 64) if h >> 63 else h


_CUT = "id bigint, content_id bigint, whole bigint, n int, text string, parts array<struct<h:bigint,w:int>>"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Articles with the hash and words of the whole and of each distinct sentence; too short ones are left out."""
    part = pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int32())]))
    for b in batches:
        out: list[list] = [[] for _ in range(6)]
        for i, c, text in zip(b.column("id").to_pylist(), b.column("content_id").to_pylist(), b.column("text").to_pylist()):
            sentences = [p for p in (words(s) for s in _SENTENCE.split(text or "") if s) if p]
            n = sum(map(len, sentences))
            if n >= LEAST_WORDS:
                held = {_hash(p): len(p) for p in sentences}
                for col, x in zip(out, (i, c, _hash([w for p in sentences for w in p]), n, text, [{"h": h, "w": w} for h, w in held.items()])):
                    col.append(x)
        types = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), part)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["id", "content_id", "whole", "n", "text", "parts"])


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = []
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            wa, wb = words(a), words(b)
            n = common(wa, wb)
            kept.append(n >= KEPT_WORDS * len(wa) and n >= OWN_WORDS * len(wb))
        yield pa.RecordBatch.from_arrays([batch.column("whole"), batch.column("id_a"), pa.array(kept, pa.bool_())], ["whole", "id_a", "kept"])


def _some(df: DataFrame, n: int) -> DataFrame:
    """For a join with a bucketed table: broadcast if small, else hashed to its buckets, so that the table is not sorted."""
    return F.broadcast(df) if n <= BROADCAST_IDS else df.hint("shuffle_hash")


class History:
    """Everything accepted so far, in the folder `path`; an existing one is opened. buckets: fixed for its life, so chosen
    for the size it is to reach; by default the session's shuffle partitions."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or scratch_path(spark, "history")
        at = lambda what: f"{self.path}/{what}"
        self.pages = Runs(spark, "k", ["k", "id"], at("pages"), buckets)
        self.wholes = Runs(spark, "whole", ["whole", "id"], at("wholes"), buckets)
        self.texts = Runs(spark, "whole", ["whole"], at("texts"), buckets)
        self.parts = Runs(spark, "k", ["k", "id"], at("parts"), buckets)
        self.spread = Runs(spark, "h", ["h"], at("spread"), 1)
        self.found = Runs(spark, "whole", ["whole"], at("found"), buckets)

    def add(self, run: str, tasks: DataFrame, content: DataFrame, articles: DataFrame) -> None:
        """Append a batch. tasks: id, url; content: content_id, url; articles: content_id, text, what the pages hold
        without furniture and residue. A task's articles are those fetched for its url as written. Batches come in
        order of id; adding one again under its name replaces it."""
        t = tasks.select(F.col("id").cast("bigint").alias("id"), "url").where("id IS NOT NULL")
        self.pages.put(t.select(page_key(F.col("url")).alias("k"), "id").where("k IS NOT NULL"), run)
        own = settle(t.join(content.select(F.col("content_id").cast("bigint").alias("content_id"), "url"), "url").select("id", "content_id"), "own")
        mine = F.broadcast(own) if own.count() <= BROADCAST_IDS else own
        cut = settle(articles.select("content_id", "text").join(mine, "content_id").select("id", "content_id", "text").mapInArrow(_cut, _CUT), "cut")
        heads = cut.groupBy("whole").agg(F.min(F.struct("id", "content_id")).alias("head"))
        before = [r for r in self.wholes.runs() if r != run]
        if before:  # a text already held, by an earlier task, is not stored again
            held = self.wholes.read(before).groupBy("whole").agg(F.min("id").alias("held"))
            heads = heads.join(held, "whole", "left").where("held IS NULL OR held > head.id")
        fresh = settle(heads.select("whole", "head.id", "head.content_id"), "fresh")
        n = fresh.count()
        new = cut.join(F.broadcast(fresh) if n <= BROADCAST_IDS else fresh, ["whole", "id", "content_id"], "left_semi")
        self.wholes.put(cut.select("whole", "id").distinct(), run)
        self.texts.put(new.select("whole", "id", "n", "text", "parts"), run)
        parts = self.texts.read([run]).select("id", "whole", "n", F.explode("parts").alias("p")).select("p.h", "id", "whole", "n", "p.w")
        if n > SPREAD:  # else no sentence can stand in so many
            hot = parts.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SPREAD).select("h", F.ceil(F.col("n") / SPREAD).cast("int").alias("s"))
        else:
            hot = self.spark.createDataFrame([], "h bigint, s int")
        self.spread.put(hot, run)  # few: each stands in more than SPREAD articles
        salted = parts.join(F.broadcast(self.spread.read([run]).select("h", "s")), "h", "left")
        salt = F.pmod("id", F.coalesce("s", F.lit(1)))
        self.parts.put(salted.select(F.when(salt == 0, F.col("h")).otherwise(F.xxhash64("h", salt)).alias("k"), "h", "id", "whole", "n", "w"), run)

    def repeats(self, run: str) -> DataFrame:
        """id_a, id_b: each task of the run that repeats an earlier one (of any run), with the first it repeats."""
        by_page = self._first_of(self.pages, run, "k")
        by_whole = self._first_of(self.wholes, run, "whole")
        self.find(run)
        near = self.found.read().where("id_a IS NOT NULL").join(self.wholes.read([run]).select("whole", "id"), "whole").where("id_a < id").select("id_a", F.col("id").alias("id_b"))
        every = by_page.unionByName(by_whole).unionByName(near)
        return every.groupBy("id_b").agg(F.min("id_a").alias("id_a")).select("id_a", "id_b")

    @staticmethod
    def _first_of(table: Runs, run: str, key: str) -> DataFrame:
        mine = table.read([run]).select(key, "id")
        first = table.read().join(mine.select(key).distinct(), key, "left_semi").groupBy(key).agg(F.min("id").alias("id_a"))
        return mine.join(first, key).where("id_a < id").select("id_a", F.col("id").alias("id_b"))

    def _holders(self, hs: DataFrame) -> DataFrame:
        """The stored parts whose hash is among `hs` (h, distinct), met bucket by bucket."""
        s = self.spread.read().groupBy("h").agg(F.max("s").alias("s"))
        keys = hs.join(F.broadcast(s), "h", "left").select("h", F.explode(F.sequence(F.lit(0), F.coalesce("s", F.lit(1)) - 1)).alias("salt"))
        keys = keys.select(F.when(F.col("salt") == 0, F.col("h")).otherwise(F.xxhash64("h", F.col("salt").cast("bigint"))).alias("k"))
        return self.parts.read().join(keys.hint("shuffle_hash"), "k", "left_semi")

    def find(self, run: str) -> None:
        """Store, for every text of the run of which it is not known yet, the first earlier task whose article it keeps."""
        todo = self.wholes.read([run]).select("whole").distinct()
        if self.found.runs():
            todo = todo.join(self.found.read([r for r in self.found.runs() if r != run]).select("whole"), "whole", "left_anti")
        todo = settle(todo, "todo")
        ids = self.wholes.read().join(todo, "whole", "left_semi").groupBy("whole").agg(F.min("id").alias("id"))
        asked = self.texts.read().drop("id", "run").join(_some(todo, todo.count()), "whole", "left_semi").join(ids, "whole")
        m = F.aggregate("parts", F.lit(0), lambda t, p: t + p["w"])
        asked = settle(asked.select("whole", "id", "n", m.alias("m"), F.explode("parts").alias("p")).select("whole", "id", "n", "m", "p.h", "p.w"), "asked")
        # a sentence of one article alone meets nothing
        held = self._holders(asked.select("h").distinct()).groupBy("k", "h").agg(F.count(F.lit(1)).alias("df"))
        wide = F.broadcast(self.spread.read().select("h", F.lit(True).alias("wide")).distinct())
        held = held.join(wide, "h", "left").where((F.col("df") > 1) | F.col("wide"))
        held = settle(held.groupBy("h").agg(F.sum("df").alias("df")).where("df > 1"), "held")
        probes = asked.join(F.broadcast(held) if held.count() <= BROADCAST_IDS else held, "h")
        order = Window.partitionBy("whole").orderBy("df", "h")  # of one article
        before = F.col("m") - F.sum("w").over(Window.partitionBy("whole")) + F.sum("w").over(order) - F.col("w")
        probes = settle(probes.withColumn("ask", before <= F.col("m") * (1 - KEPT_PARTS)), "probes")
        best = self._by_rounds(probes)
        self.found.put(todo.join(best, "whole", "left").select("whole", "id_a"), run)

    def _by_rounds(self, probes: DataFrame) -> DataFrame:
        """whole, id_a: the first article that each keeps. probes: whole, id, n, m, h, w, df, ask."""
        few, more = ROUNDS
        holders = self._holders(probes.select("h").distinct()).select("h", F.col("id").alias("id_a"), F.col("whole").alias("whole_a"), F.col("n").alias("n_a"), "w")
        holders = settle(holders, "holders")
        # the shared sentences of each side, of one article in a row
        self.mine = settle(probes.groupBy("whole").agg(F.max("m").alias("m"), F.collect_list(F.struct("h", "w")).alias("hw")), "mine")
        self.theirs = settle(holders.groupBy("whole_a").agg(F.min("id_a").alias("id_a"), F.max("n_a").alias("n_a"), F.sum("w").alias("w_a"), F.collect_set("h").alias("hs")), "theirs")
        ask = probes.where("ask")
        rank = F.row_number().over(Window.partitionBy("h").orderBy("id_a", "whole_a"))
        # every task's share of a sentence is cut to the first holders before it is shuffled
        first = holders.drop("w").join(ask.select("h").distinct(), "h", "left_semi").withColumn("rank", rank)
        first = settle(first.where(F.col("rank") <= more + 1), "first")
        ask = ask.select("whole", "id", "n", "h")
        limit = F.coalesce("best", "id")
        # the first holders
        tried = settle(self._fitting(ask.join(first.where(F.col("rank") <= few), "h").where("id_a < id")), "tried")
        best = self._best([self._kept(tried)])
        edge = first.where(F.col("rank") == few + 1).select("h", F.col("id_a").alias("edge"))
        left = ask.join(edge, "h").where("edge < id").join(best.select("whole", F.col("id_a").alias("best")), "whole", "left")
        left = settle(left.withColumn("limit", limit).where("edge < limit").select("whole", "id", "n", "h", "limit"), "left")
        if left.isEmpty():
            return best
        # the next ones, of articles for which an earlier one may stand there
        next_ = self._fitting(left.join(first.where((F.col("rank") > few) & (F.col("rank") <= more)), "h").where("id_a < limit"))
        next_ = next_.join(tried, ["whole", "whole_a", "id_a"], "left_anti")
        best = self._best([best, self._kept(next_)])
        edge = first.where(F.col("rank") == more + 1).select("h", F.col("id_a").alias("edge"))
        left = left.drop("limit").join(edge, "h").join(best.select("whole", F.col("id_a").alias("best")), "whole", "left").withColumn("limit", limit)
        left = settle(left.where("edge < limit").select("whole", "n", "h", "edge", "limit"), "left")
        if left.isEmpty():
            return best
        # all others, among articles rich enough in shared sentences
        rich = self.theirs.where(F.col("w_a") >= F.col("n_a") * KEPT_PARTS * KEPT_WORDS).select("whole_a", "id_a", "n_a", F.explode("hs").alias("h"))
        return self._best([best, self._kept(self._fitting(left.join(rich, "h").where("id_a >= edge AND id_a < limit")))])

    @staticmethod
    def _fitting(met: DataFrame) -> DataFrame:
        """The pairs whose lengths let one keep the other."""
        fits = (F.col("n_a") * KEPT_WORDS <= F.col("n")) & (F.col("n") * OWN_WORDS <= F.col("n_a")) & (F.col("whole") != F.col("whole_a"))
        return met.where(fits).select("whole", "whole_a", "id_a").distinct()

    @staticmethod
    def _best(found: list[DataFrame]) -> DataFrame:
        every = found[0]
        for f in found[1:]:
            every = every.unionByName(f)
        return settle(every.groupBy("whole").agg(F.min("id_a").alias("id_a")), "best")

    def _kept(self, pairs: DataFrame) -> DataFrame:
        """whole, id_a of the pairs that share KEPT_PARTS of the later one's words in sentences, and whose texts keep
        enough of each other."""
        shared = F.aggregate(F.filter("hw", lambda x: F.array_contains(F.col("hs"), x["h"])), F.lit(0).cast("bigint"), lambda s, x: s + x["w"])
        both = pairs.join(self.mine, "whole").join(self.theirs.select("whole_a", "hs"), "whole_a")
        pairs = settle(both.where(shared >= F.col("m") * KEPT_PARTS).select("whole", "whole_a", "id_a"), "pairs")
        ids = settle(pairs.select("whole").unionByName(pairs.select(F.col("whole_a").alias("whole"))).distinct(), "ids")
        texts = settle(self.texts.read().join(_some(ids, ids.count()), "whole", "left_semi").select("whole", "text"), "met")
        both = pairs.join(texts.select(F.col("whole").alias("whole_a"), F.col("text").alias("a")), "whole_a").join(texts.withColumnRenamed("text", "b"), "whole")
        return both.select("whole", "id_a", "a", "b").mapInArrow(_decide, "whole bigint, id_a bigint, kept boolean").where("kept").select("whole", "id_a")


def repeated_tasks(tasks: DataFrame, content: DataFrame, articles: DataFrame | None = None, batches: bool = False) -> DataFrame:
    """id_a, id_b: each task of batch 1 or later that repeats an earlier task, with the first it repeats.

    tasks: id, url, batch_no (null counts as history); content: content_id, url, title, text; articles: content_id,
    text, by default the content cleaned by what all of it holds. Null urls lead nowhere; a task without article can only
    repeat a page. batches: add and look up one batch after the other, as they would arrive; by default all later
    batches are one run, which gives the same rows, as a task is only held against smaller ids.
    """
    spark = tasks.sparkSession
    no = F.coalesce(F.col("batch_no"), F.lit(0))
    if articles is None:
        rows = content.select("content_id", "url", "title", "text")
        own = settle(rows.select("content_id", "url").join(tasks.select("url"), "url").select("content_id").distinct(), "fetched")
        fetched = rows.join(F.broadcast(own) if own.count() <= BROADCAST_IDS else own, "content_id", "left_semi")
        articles = residue.Cleaner.fit(rows).real_text(fetched)
    articles = settle(articles.select("content_id", "text"), "articles")
    history = History(spark, buckets=buckets_for(spark, tasks.count(), TASKS_EACH))
    history.add("history", tasks.where(no < 1), content, articles)
    if not batches:
        history.add("later", tasks.where(no >= 1), content, articles)
        return history.repeats("later")
    found = None
    for n in [r[0] for r in tasks.where(no >= 1).select("batch_no").distinct().orderBy("batch_no").collect()]:
        history.add(f"batch{n}", tasks.where(no == n), content, articles)
        one = settle(history.repeats(f"batch{n}"), "repeats")
        found = one if found is None else found.unionByName(one)
    return found if found is not None else spark.createDataFrame([], "id_a bigint, id_b bigint")
