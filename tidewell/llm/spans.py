"""Long exact spans shared between records (problem 10), by parsing texts relative to each other.

1. Equal texts form a class; only its record of smallest id goes on.
2. Every text is indexed by content-defined blocks: of each run of 201 windows of 100 characters the one of least hash.
   Any span of 300 characters holds such a block, and equal spans hold equal blocks. About one block per 100 characters
   is shuffled. Blocks of one text only are dropped.
3. A text is the reference of all earlier ones it shares a block with. Its windows are indexed once, its partners are
   factored against them one after the other as they stream by, and it against them: from each window that the index
   holds the match is followed in both texts, character by character, to the end of the factor, and the parse goes on
   behind it. No factor rests on a hash, and as the parse continues with the windows that reach past a factor, the
   factors of a text cover all that it shares.
4. A block in more than `HOT` texts is not compared text by text, as it may be a notice in a third of all records. Its
   contexts (what lies around it within reach of a span) are compared instead, equal ones once: two contexts share a
   span that holds the block if they have a window of `least` characters in common. Coarser windows sort out those that
   cannot. A record and its contexts, a context and its windows are rows, so this grows with the text, not with pairs.

`pairs`, whose result is pairs by definition, lists those of equal texts and of hot windows, too; `groups` gives the same
links in rows that grow with the records.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settle
from .arrays import anchors, chunks, code_points, int64, window_hashes

BLOCK = 100
#: A block in more texts than this is compared by contexts, not by texts.
HOT = 40
#: Windows shorter by this much than a span sort out contexts first.
GRID = 50
#: Ids are broadcast up to this many.
BROADCAST_IDS = 200_000


def _blocks(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in chunks(b.column("id").to_pylist(), b.column("text").to_pylist()):
                points, starts = code_points(texts)
                at, h = anchors(points, starts, BLOCK, least - BLOCK + 1)
                doc = np.searchsorted(starts, at, "right") - 1
                order = np.lexsort((h, doc))
                doc, h = doc[order], h[order]
                new = np.ones(len(h), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
                yield pa.RecordBatch.from_arrays([int64(h[new]), pa.array(np.asarray(ids, np.int64)[doc[new]])], ["h", "id"])

    return run


def _contexts(least: int):
    """The contexts of a text's hot blocks: where they begin and end, and a hash of what they hold and where in it the
    block stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reach = least - BLOCK
        for b in batches:
            for i, text, hs in zip(b.column("id").to_pylist(), b.column("text").to_pylist(), b.column("hs").to_pylist()):
                points, starts = code_points([text])
                at, h = anchors(points, starts, BLOCK, reach + 1)
                at = at[np.isin(h.view(np.int64), np.asarray(hs, np.int64))]
                if not len(at):
                    continue
                lo, hi = np.maximum(at - reach, 0), np.minimum(at + BLOCK + reach, len(points))
                ctx = np.asarray([hash_of(text[s:e], p - s) for s, e, p in zip(lo.tolist(), hi.tolist(), at.tolist())], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(ctx), pa.array(np.full(len(at), i, np.int64)), pa.array(lo.astype(np.int32)), pa.array(hi.astype(np.int32)), pa.array(at.astype(np.int32))], ["ctx", "id", "start", "stop", "pos"])

    return run


def hash_of(text: str, at: int) -> int:
    import xxhash

    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"), seed=at)
    return h - (1 << 64) if h >> 63 else h


def _windows(least: int, length: int, step: int):
    """w, ctx, off of the windows of `length` characters that begin at a multiple of `step` before a context's block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, places in zip(b.column("text").to_pylist(), b.column("places").to_pylist()):
                h = window_hashes(code_points([text])[0], length)
                w, ctx, off = [], [], []
                for p in places:
                    at = np.arange(p["pos"] - (least - BLOCK) + (GRID if step > 1 else 0), p["pos"] + 1, step)
                    at = at[(at >= 0) & (at < len(h)) & (at + length <= p["stop"])]
                    w.append(h[at])
                    ctx.append(np.full(len(at), p["ctx"], np.int64))
                    off.append(at - p["start"])
                cat = lambda x, kind: np.concatenate(x) if x else np.zeros(0, kind)
                yield pa.RecordBatch.from_arrays([int64(cat(w, np.uint64)), pa.array(cat(ctx, np.int64)), pa.array(cat(off, np.int64).astype(np.int32))], ["w", "ctx", "off"])

    return run


class Index:
    """The hashes of a text's windows; in order, and marked by their low bits, once they are looked up."""

    def __init__(self, text: str, least: int):
        self.text, self.least = text, least
        self.h = window_hashes(code_points([text])[0], least)

    @cached_property
    def order(self) -> np.ndarray:
        return np.argsort(self.h, kind="stable")

    @cached_property
    def sorted(self) -> np.ndarray:
        return self.h[self.order]

    @cached_property
    def marks(self) -> np.ndarray:
        """Whether a window's hash has these low bits: most windows of other texts are ruled out by one look."""
        bits = max(10, int(len(self.h) * 16).bit_length())
        marks = np.zeros(1 << bits, bool)
        marks[(self.h & np.uint64(len(marks) - 1)).view(np.int64)] = True
        return marks

    def hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are held, and where in order each begins."""
        if not len(h) or not len(self.h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        maybe = np.flatnonzero(self.marks[(h & np.uint64(len(self.marks) - 1)).view(np.int64)])
        at = np.searchsorted(self.sorted, h[maybe])
        at[at == len(self.h)] = 0
        good = self.sorted[at] == h[maybe]
        return maybe[good], at[good]


def _length(a: str, b: str, i: int, j: int) -> int:
    """How many characters of a from i on equal those of b from j on; slices are compared, doubling, then halving."""
    n, step = 0, 64
    while step:
        if i + n + step <= len(a) and j + n + step <= len(b) and a[i + n : i + n + step] == b[j + n : j + n + step]:
            n += step
            step *= 2
        else:
            step //= 2
    return n


def factors(of: Index, ref: Index) -> list[tuple[int, int, int]]:
    """Greedy factors of a text relative to a reference: (start, start in the reference, length), each `least` long or
    longer. Together they cover every span of that length that the reference holds."""
    hits, at = ref.hits(of.h)
    out, k = [], 0
    while k < len(hits):
        i, s, n, j = int(hits[k]), int(at[k]), 0, 0
        while s < len(ref.h) and ref.sorted[s] == of.h[i] and n < of.least:  # the first place that holds the window itself
            j = int(ref.order[s])
            n = _length(of.text, ref.text, i, j)
            s += 1
        if n >= of.least:
            out.append((i, j, n))
            k = int(np.searchsorted(hits, i + n - of.least + 1))
        else:
            k += 1
    return out


_FACTORS = "id bigint, other bigint, start int, stop int"


def _parsed(least: int):
    """Rows come as a reference (other null) followed by its partners; gives the factors of both sides."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, None
        for b in batches:
            out = []
            for key, other, text in zip(b.column("key").to_pylist(), b.column("other").to_pylist(), b.column("text").to_pylist()):
                if other is None:
                    held, index = key, Index(text, least)
                elif held == key:
                    part = Index(text, least)
                    found = factors(part, index)
                    if found:  # else the reference holds nothing of it either
                        out.extend((other, key, i, i + n) for i, _, n in found)
                        out.extend((key, other, i, i + n) for i, _, n in factors(index, part))
            cols = zip(*out) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], ["id", "other", "start", "stop"])

    return run


def _clean(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("id").cast("bigint").alias("id"), "text").where("id IS NOT NULL AND text IS NOT NULL")


def _classes(docs: DataFrame, least: int) -> DataFrame:
    """id, rep: of texts long enough that occur more than once, every record with the smallest id of its text."""
    keyed = docs.where(F.length("text") >= least).select("id", F.sha2("text", 256).alias("k"))
    many = keyed.groupBy("k").agg(F.min("id").alias("rep"), F.max("id").alias("hi")).where("rep < hi").select("k", "rep")
    return keyed.join(many, "k").select("id", "rep").distinct()


def _sides(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


class Shared:
    """What the records share, each table written once.

    classes: id, rep of equal texts. factors: id, other, start, stop of cold blocks' texts. members: ctx, id, start, stop
    of hot contexts that share a span. windows: w, ctx, off of the windows that hot contexts have in common."""

    def __init__(self, docs: DataFrame, least: int = 300):
        self.least = least
        docs = _clean(docs)
        self.classes = settle(_classes(docs, least), "classes")
        copies = self.classes.where("id <> rep").select("id")
        self.long = docs.where(F.length("text") >= least)
        blocks = self.long.mapInArrow(_blocks(least), "h bigint, id bigint")
        blocks = settle(blocks.join(_sides(copies), "id", "left_anti"), "blocks")
        groups = blocks.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("n")).where("lo < hi")
        repeated = settle(blocks.join(groups.select("h", "n"), "h").select("h", "id", (F.col("n") > HOT).alias("hot")), "repeated")
        cold = repeated.where("NOT hot").groupBy("h").agg(F.array_sort(F.collect_set("id")).alias("ids"))  # at most HOT
        a = cold.select("ids", F.posexplode("ids").alias("k", "id_a"))
        pairs = a.select("id_a", F.explode(F.slice("ids", F.col("k") + 2, F.size("ids"))).alias("id_b")).distinct()
        self.factors = settle(self._factor(settle(pairs, "candidates")), "factors")
        self._hot(repeated.where("hot").select("id", "h"))

    def _texts(self, ids: DataFrame) -> DataFrame:
        return self.long.join(_sides(settle(ids.distinct(), "ids")), "id", "left_semi")

    def _factor(self, pairs: DataFrame) -> DataFrame:
        """The factors of the pairs' texts. A reference's text goes to one place once, its partners' texts follow."""
        texts = settle(self._texts(pairs.select(F.col("id_a").alias("id")).unionByName(pairs.select(F.col("id_b").alias("id")))), "texts")
        refs = texts.join(pairs.select(F.col("id_b").alias("id")).distinct(), "id", "left_semi").select(F.col("id").alias("key"), F.lit(None).cast("bigint").alias("other"), "text")
        partners = pairs.join(texts, F.col("id_a") == F.col("id")).select(F.col("id_b").alias("key"), F.col("id_a").alias("other"), "text")
        rows = refs.unionByName(partners).repartition("key").sortWithinPartitions("key", F.asc_nulls_first("other"))
        return rows.mapInArrow(_parsed(self.least), _FACTORS)

    def _hot(self, at: DataFrame) -> None:
        least = self.least
        hs = at.groupBy("id").agg(F.collect_set("h").alias("hs"))  # of one text
        contexts = settle(self._texts(at.select("id")).join(hs, "id").select("id", "text", "hs").mapInArrow(_contexts(least), "ctx bigint, id bigint, start int, stop int, pos int"), "contexts")
        classes = contexts.groupBy("ctx").agg(F.min(F.struct("id", "pos", "start", "stop")).alias("r"), F.min("id").alias("lo"), F.max("id").alias("hi"))
        classes = settle(classes.where(F.col("r.stop") - F.col("r.start") >= least).select("ctx", "r.*", "lo", "hi"), "context-classes")

        def windows(of: DataFrame, length: int, step: int) -> DataFrame:
            places = of.groupBy("id").agg(F.collect_list(F.struct("ctx", "pos", "start", "stop")).alias("places"))  # of one text
            listed = self._texts(of.select("id")).join(places, "id").select("text", "places").mapInArrow(_windows(least, length, step), "w bigint, ctx bigint, off int")
            return listed.join(_sides(of.select("ctx", "lo", "hi")), "ctx")

        def common(listed: DataFrame) -> DataFrame:
            met = listed.groupBy("w").agg(F.min("lo").alias("a"), F.max("hi").alias("b"), F.min("ctx").alias("c"), F.max("ctx").alias("d")).where("a < b AND c < d").select("w")
            return listed.join(met, "w", "left_semi")

        # a span with the block holds one of these shorter windows, whatever its place
        coarse = common(settle(windows(classes, least - GRID, GRID), "coarse")).select("ctx").distinct()
        near = settle(classes.join(_sides(settle(coarse, "near")), "ctx", "left_semi"), "context-classes")
        self.windows = settle(common(settle(windows(near, least, 1), "hot")).select("w", "ctx", "off"), "windows")
        # contexts that several records have, and those with a window in common
        used = classes.where("lo < hi").select("ctx").unionByName(self.windows.select("ctx")).distinct()
        self.whole = settle(classes.where("lo < hi").select("ctx"), "whole")
        self.members = settle(contexts.join(used, "ctx", "left_semi").select("ctx", "id", "start", "stop").distinct(), "members")

    def spans(self) -> DataFrame:
        """id, start, stop: what of the records' texts stands elsewhere; they may overlap. Copies of a text are left to
        `classes`."""
        own = self.factors.select("id", "start", "stop")
        whole = self.members.join(self.whole, "ctx", "left_semi").select("id", "start", "stop")
        n = F.row_number().over(Window.partitionBy("ctx").orderBy("off"))  # of one context
        runs = self.windows.select("ctx", "off").distinct().select("ctx", "off", (F.col("off") - n).alias("run"))
        runs = runs.groupBy("ctx", "run").agg(F.min("off").alias("a"), (F.max("off") + self.least).alias("b"))
        parts = self.members.select("ctx", "id", "start").join(runs, "ctx").select("id", (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b")).alias("stop"))
        return own.unionByName(whole).unionByName(parts).distinct()

    def hot_groups(self) -> DataFrame:
        """g, id: the records that share a hot span, a row each; sets of records that are equal come once."""
        sides = self.windows.select("w", "ctx").unionByName(self.whole.select(F.col("ctx").alias("w"), "ctx")).distinct()
        marks = sides.groupBy("w").agg(F.sum(F.xxhash64("ctx").cast("decimal(38,0)")).alias("m1"), F.sum(F.hash("ctx").cast("bigint")).alias("m2"), F.count(F.lit(1)).alias("n"))
        one = marks.groupBy("m1", "m2", "n").agg(F.min("w").alias("w")).select("w")
        return sides.join(one, "w", "left_semi").join(self.members.select("ctx", "id").distinct(), "ctx").select(F.col("w").alias("g"), "id").distinct()


def pairs(docs: DataFrame, least: int = 300) -> DataFrame:
    """doc_id_a, doc_id_b (a < b): the records that share a span of at least `least` characters.

    docs: id bigint, text string. Null ids and texts, and texts shorter than `least`, share nothing; rows that repeat an
    id count as one record, whose texts all count.
    """
    s = Shared(docs, least)
    kept = settle(s.hot_groups(), "groups")
    hot = kept.withColumnRenamed("id", "id_a").join(kept.withColumnRenamed("id", "id_b"), "g").where("id_a < id_b").select("id_a", "id_b")
    cold = s.factors.where("id < other").select(F.col("id").alias("id_a"), F.col("other").alias("id_b"))
    reps = cold.unionByName(hot).distinct()
    # each side stands for all records of its class
    members = s.classes.select(F.col("rep"), F.col("id").alias("member"))
    wide = reps.join(members.select(F.col("rep").alias("id_a"), F.col("member").alias("m_a")), "id_a", "left").join(members.select(F.col("rep").alias("id_b"), F.col("member").alias("m_b")), "id_b", "left")
    wide = wide.select(F.coalesce("m_a", "id_a").alias("x"), F.coalesce("m_b", "id_b").alias("y"))
    within = s.classes.select("rep", F.col("id").alias("x")).join(s.classes.select("rep", F.col("id").alias("y")), "rep").where("x < y").select("x", "y")
    both = wide.unionByName(within).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))
    return both.where("doc_id_a < doc_id_b").distinct()


def groups(docs: DataFrame, least: int = 300) -> DataFrame:
    """kind, g, id: the links of `pairs` in rows that grow with the records. `copy`: all records with the text of record
    g. `span`: records, one for each text, that share a span; g names it. Two records are linked if they, or the
    representatives of their copies, stand in one group."""
    s = Shared(docs, least)
    copy = s.classes.select(F.lit("copy").alias("kind"), F.col("rep").cast("string").alias("g"), "id")
    cold = s.factors.where("id < other").select("id", "other").distinct()
    name = F.concat_ws("-", "id", "other")
    cold = cold.select(F.lit("span").alias("kind"), name.alias("g"), F.explode(F.array("id", "other")).alias("id"))
    hot = s.hot_groups().select(F.lit("span").alias("kind"), F.concat(F.lit("w"), F.col("g").cast("string")).alias("g"), "id")
    return copy.unionByName(cold).unionByName(hot)


def report(docs: DataFrame, least: int = 300) -> DataFrame:
    """id, n_chars, shared_chars, shared_share, n_spans: one row per record, how much of it stands in other records.

    A record's shared text is the union of its spans of at least `least` characters that stand in another record. A
    record that shares nothing has 0; a null text has n_chars 0.
    """
    s = Shared(docs, least)
    ordered = s.spans().groupBy("id").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("s"))  # of one text

    def merge(acc, x):
        fresh = F.greatest(F.lit(0), x["stop"] - F.greatest(x["start"], acc["end"]))
        return F.struct((acc["sum"] + fresh).alias("sum"), (acc["n"] + (x["start"] > acc["end"]).cast("int")).alias("n"), F.greatest(acc["end"], x["stop"]).alias("end"))

    zero = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"), F.lit(-1).alias("end"))
    merged = ordered.select("id", F.aggregate("s", zero, merge).alias("m")).select("id", F.col("m.sum").alias("shared"), F.col("m.n").alias("spans"))
    every = docs.where("id IS NOT NULL").groupBy(F.col("id").cast("bigint").alias("id")).agg(F.max(F.coalesce(F.length("text"), F.lit(0))).alias("n_chars"))
    copies = s.classes.select("id", F.lit(True).alias("copied"))
    shared = F.when(F.col("copied"), F.col("n_chars")).otherwise(F.coalesce("shared", F.lit(0)))
    return every.join(copies, "id", "left").join(merged, "id", "left").select(
        "id",
        F.col("n_chars").cast("bigint").alias("n_chars"),
        shared.cast("bigint").alias("shared_chars"),
        F.when(F.col("n_chars") > 0, shared / F.col("n_chars")).otherwise(F.lit(0.0)).alias("shared_share"),
        F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("bigint").alias("n_spans"),
    )
