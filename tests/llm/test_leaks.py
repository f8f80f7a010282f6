import random
from difflib import SequenceMatcher

from pyspark.sql import functions as F

from tidewell.llm import leaks


def _data():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(3, 8)))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(6)] + [(90, "short"), (91, None), (92, "")]
    cut = lambda t, a, b: t[a:b]
    docs = [
        (1, "x " + items[0][1].upper().replace(" ", "--") + " y"),
        (2, " ".join(word() for _ in range(100))),
        (3, cut(items[1][1], 0, 95) + " zzz " + cut(items[2][1], 60, 180)),
        (4, cut(items[3][1], 100, 200) + " " + cut(items[3][1], 0, 98)),
        (5, cut(items[4][1], 0, 60)),
        (6, None),
        (7, ""),
        (8, items[5][1] * 40),
    ]
    return docs, items


def _brute(docs, items, least):
    out = set()
    for d, t in docs:
        for i, s in items:
            a, b = leaks.letters(t), leaks.letters(s)
            if a and b and SequenceMatcher(None, a, b, autojunk=False).find_longest_match().size >= least:
                out.add((d, i))
    return out


def test_equals_brute_force(spark, monkeypatch):
    docs, items = _data()
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("h", F.lit(1))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(7))
    want = _brute(docs, items, 80)
    assert len(want) >= 5
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(d, i).where("longest >= 80").collect()} == want
    monkeypatch.setattr(leaks, "BROADCAST_CHARS", 500)
    assert {(r.doc_id, r.item_id) for r in leaks.leaks(d, i).where("longest >= 80").collect()} == want


def test_reordered_passage_has_two_tiles():
    item = leaks.letters("".join(chr(97 + (i * i + i // 7) % 23) for i in range(260)))
    found = leaks.tiles(item[130:240] + "zzz" + item[:110], item, 80)
    assert len(found) == 2 and sum(x[2] for x in found) >= 220


def _tiled(a, b, least):
    """Greedy string tiling, written down as it is defined."""
    free_a, free_b, out = [True] * len(a), [True] * len(b), []
    while True:
        best = (least - 1, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and free_a[i + n] and free_b[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        if best[0] < least:
            return out
        n, i, j = best
        free_a[i : i + n] = [False] * n
        free_b[j : j + n] = [False] * n
        out.append((i, j, n))


def test_tiles_equal_their_definition():
    r = random.Random(9)
    for _ in range(60):
        pool = ["".join(r.choice("abc") for _ in range(r.randint(5, 20))) for _ in range(4)] + ["a" * 15]
        a, b = ["".join(r.choice(pool) for _ in range(r.randint(0, 6))) for _ in range(2)]
        assert leaks.tiles(a, b, 6) == _tiled(a, b, 6)


def test_shuffled_pieces_are_caught_by_coverage(spark):
    r = random.Random(6)
    item = "".join(r.choice("abcdefghijklmnop") for _ in range(700))
    pieces = [item[k : k + 70] for k in range(0, 700, 70)]
    r.shuffle(pieces)
    d = spark.createDataFrame([(1, " - ".join(pieces)), (2, item[:70] + " other"), (3, item[100:190])], "doc_id long, text string")
    i = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {x.doc_id: x for x in leaks.leaks(d, i).collect()}
    assert set(got) == {1, 3} and got[1].longest < 80 * 2 and got[1].covered == 700
    row = leaks.report(d, i).first()
    assert row.n_docs + row.n_reordered == 2 and row.most_covered == 1.0


def test_repetitive_text_is_linear():
    assert leaks.tiles("a" * 400_000, "a" * 1000, 80) == [(0, 0, 1000)]
    assert [x[2] for x in leaks.tiles("ab" * 100_000, "ab" * 200 + "c" + "ba" * 200, 80)] == [400, 400]


def test_report_and_empty(spark):
    docs, items = _data()
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = {r.item_id: r for r in leaks.report(d, i).collect()}
    assert got[0].most_covered == 1.0 and got[90].n_docs == 0 and len(got) == len(items)
    assert leaks.leaks(d.limit(0), i).count() == 0 and leaks.leaks(d, i.limit(0)).count() == 0
