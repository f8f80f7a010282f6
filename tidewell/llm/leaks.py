"""Evaluation passages inside training text (problem 8), by greedy string tiling.

Texts are compared by their letters and digits alone, lower-cased. A run of `tile` characters that a document shares
with an item holds, at any alignment, a whole window of `SEED` characters that begins at a multiple of
`tile - SEED + 1` in the document. So the document contributes one seed per so many characters, the items one at every
position, and their join finds every candidate. Each candidate pair is tiled: the longest common run that no tile
covers yet is marked, again and again, until none of `tile` characters is left. A run's length is found by halving: two
texts share a run of k characters if their rolling (Karp-Rabin) hashes of k characters meet, so a step is linear in the
texts, however often they repeat themselves. Runs may stand in another order than in the item.

A document holds an item's passage if one run is `least` long, or if the tiles cover `cover` of the item, which catches
passages whose short pieces were put in another order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .arrays import Rolling, chunks, code_points, window_hashes

SEED, TILE, COVER = 32, 48, 0.5
#: Items are sent to every task up to so many characters in all; larger sets are searched for in blocks of that size.
BROADCAST_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")


def letters(text: str | None) -> str:
    """Letters and digits, lower-cased."""
    return _OTHER.sub("", text.lower()) if text else ""


class _Side:
    """One side of a tiling: code points, rolling hashes, and what is taken."""

    def __init__(self, points: np.ndarray):
        self.points, self.rolling = points, Rolling(points)
        self.taken = np.zeros(len(points) + 1, np.int64)  # running count

    def free(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the windows of k characters begin that no tile covers, and their hashes."""
        at = np.flatnonzero(self.taken[k:] == self.taken[: len(self.taken) - k]) if k < len(self.taken) else np.zeros(0, np.int64)
        return at, self.rolling.windows(k)[at]

    def take(self, start: int, k: int) -> None:
        mark = np.diff(self.taken)
        mark[start : start + k] = 1
        np.cumsum(mark, out=self.taken[1:])


def _met(a: _Side, b: _Side, k: int) -> tuple[int, int] | None:
    """The first place in a, and in b, of a common run of k free characters."""
    (at, ha), (bt, hb) = a.free(k), b.free(k)
    for i in at[np.isin(ha, hb)]:
        j = int(bt[np.argmax(hb == ha[np.searchsorted(at, i)])])
        if np.array_equal(a.points[i : i + k], b.points[j : j + k]):
            return int(i), j
    return None


def tiles(doc: str, item: str, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two normalised texts: (start in doc, start in item, length), longest first."""
    points, other = code_points([doc])[0], _Side(code_points([item])[0])
    if min(len(points), len(item)) < least:
        return []
    # of the document only what lies in windows that the item holds, apart from each other
    hit = np.flatnonzero(np.isin(window_hashes(points, least), other.rolling.windows(least)))
    if not len(hit):
        return []
    cut = np.flatnonzero(np.diff(hit) > least) + 1
    pieces = [(int(p[0]), int(p[-1]) + least) for p in np.split(hit, cut)]
    own, where = [], []
    for n, (s, e) in enumerate(pieces):
        own += [points[s:e], np.asarray([0x110000 + n], np.uint32)]
        where += [np.arange(s, e), [-1]]
    side, where = _Side(np.concatenate(own)), np.concatenate(where)
    out, most = [], min(len(side.points), len(item))
    while (met := _met(side, other, least)) is not None:
        lo, hi = least, most + 1
        while hi - lo > 1:
            k = (lo + hi) // 2 if hi <= most else min(hi - 1, lo * 2)  # doubling until it fails once
            found = _met(side, other, k)
            if found is None:
                hi = most = k
            else:
                lo, met = k, found
                if k == most:
                    break
        most = lo
        side.take(met[0], lo)
        other.take(met[1], lo)
        out.append((int(where[met[0]]), met[1], lo))
    return out


class _Items:
    """Items by the hashes of their seeds, as sorted arrays."""

    def __init__(self, held: list[tuple[int, str]]):
        self.held = held
        hs = [np.unique(window_hashes(code_points([t])[0], SEED)) for _, t in held]
        h = np.concatenate(hs) if hs else np.zeros(0, np.uint64)
        which = np.repeat(np.arange(len(hs)), [len(x) for x in hs])
        order = np.argsort(h, kind="stable")
        self.known, self.first = np.unique(h[order], return_index=True)
        self.which = which[order]
        self.last = np.append(self.first[1:], len(order))

    def of(self, norm: str, stride: int) -> list[int]:
        """The items that share a seed with a text."""
        h = window_hashes(code_points([norm])[0], SEED)[::stride]
        if not len(h) or not len(self.known):
            return []
        slot = np.minimum(np.searchsorted(self.known, h), len(self.known) - 1)
        slot = np.unique(slot[self.known[slot] == h])
        return np.unique(np.concatenate([self.which[self.first[s] : self.last[s]] for s in slot])).tolist() if len(slot) else []


_OUT = "doc_id bigint, item_id bigint, n_tiles int, longest int, covered int, item_chars int"


def _rows(found: list[tuple]) -> pa.RecordBatch:
    cols = zip(*found) if found else [[]] * 6
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], [x.split()[0] for x in _OUT.split(", ")])


def leaks(docs: DataFrame, items: DataFrame, least: int = 80, tile: int = TILE, cover: float = COVER) -> DataFrame:
    """doc_id, item_id, n_tiles, longest, covered, item_chars: each document that holds a run of at least `least`
    letters and digits of an item, or tiles of `tile` or more that cover `cover` of it. covered: characters of the item
    under tiles.

    docs: doc_id, text; items: item_id, text. Null and empty texts match nothing, nor does an item shorter than `tile`;
    rows that repeat an id are each compared and their rows collapse to the one covered most.
    """
    if not SEED <= tile <= least:
        raise ValueError(f"tile must lie between {SEED} and least")
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    i = items.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    chars = i.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-chars // max(1, BROADCAST_CHARS)))
    if blocks == 1:
        rows = _searched(d, [(r.item_id, r.text) for r in i.collect()], least, tile, cover)  # bounded by the sum just taken
    else:
        rows = spark.createDataFrame([], _OUT)
        for n in range(blocks):
            block = i.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == n).collect()  # about BROADCAST_CHARS
            rows = rows.unionByName(settle(_searched(d, [(r.item_id, r.text) for r in block], least, tile, cover), "leaks"))
    best = F.max(F.struct("covered", "longest", "n_tiles", "item_chars")).alias("v")
    return rows.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "v.n_tiles", "v.longest", "v.covered", "v.item_chars")


def _searched(d: DataFrame, items: list[tuple[int, str]], least: int, tile: int, cover: float) -> DataFrame:
    held = [(n, t) for n, t in ((n, letters(t)) for n, t in items) if len(t) >= tile]
    shared = d.sparkSession.sparkContext.broadcast(held)
    made: dict = {}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not made:
            made["items"] = _Items(shared.value)
        index = made["items"]
        for b in batches:
            found: list[tuple] = []
            for ids, texts in chunks(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                for doc_id, norm in zip(ids, map(letters, texts)):
                    for m in index.of(norm, tile - SEED + 1):
                        item_id, item = index.held[m]
                        t = tiles(norm, item, tile)
                        covered = sum(x[2] for x in t)
                        if t and (t[0][2] >= least or covered >= cover * len(item)):
                            found.append((doc_id, item_id, len(t), t[0][2], covered, len(item)))
            yield _rows(found)

    return d.mapInArrow(scan, _OUT)


def report(docs: DataFrame, items: DataFrame, least: int = 80, tile: int = TILE, cover: float = COVER) -> DataFrame:
    """item_id, n_docs, n_reordered, longest, most_covered: one row per item, leaked or not. n_docs: documents that hold
    a run of `least`; n_reordered: those whose tiles cover `cover` without one. longest: the longest run of the item in
    any of these documents. most_covered: the largest share of its letters and digits that one of them holds; 0 where
    none does."""
    found = leaks(docs, items, least, tile, cover)
    whole = F.count_if(F.col("longest") >= least)
    hits = found.groupBy("item_id").agg(whole.alias("n"), (F.count(F.lit(1)) - whole).alias("o"), F.max("longest").alias("l"), F.max(F.col("covered") / F.col("item_chars")).alias("m"))
    every = items.select(F.col("item_id").cast("bigint").alias("item_id")).where("item_id IS NOT NULL").distinct()
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return every.join(hits, "item_id", "left").select("item_id", zero("n").alias("n_docs"), zero("o").alias("n_reordered"), zero("l").alias("longest"), F.coalesce("m", F.lit(0.0)).alias("most_covered"))
