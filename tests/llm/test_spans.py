import random

from pyspark.sql import functions as F

from tidewell.llm import spans


def _text(r, n):
    return "".join(r.choice("abcdefghij klmnop") for _ in range(n))


def _corpus():
    r = random.Random(3)
    shared, long = _text(r, 300), _text(r, 900)
    docs = [(1, _text(r, 200) + shared + _text(r, 150)), (2, shared + _text(r, 400)), (3, _text(r, 500) + shared[:299]), (4, long), (5, long), (6, _text(r, 50) + long[200:700]), (7, ""), (8, None), (9, "x" * 5000), (10, "y" + "x" * 400)]
    return docs + [(i, _text(r, 700)) for i in range(11, 30)]


def _brute(docs, least):
    found = set()
    for i, a in docs:
        for j, b in docs:
            if i is not None and j is not None and i < j and a and b:
                windows = {a[k : k + least] for k in range(len(a) - least + 1)}
                if any(b[k : k + least] in windows for k in range(len(b) - least + 1)):
                    found.add((i, j))
    return found


def test_pairs_equal_brute_force(spark):
    docs = _corpus()
    df = spark.createDataFrame(docs, "id long, text string").withColumns({"h": F.lit(1), "pos": F.lit("x"), "rep": F.lit(2)})
    assert {tuple(r) for r in spans.pairs(df).collect()} == _brute(docs, 300)


def test_hot_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(spans, "HOT", 1)
    docs = _corpus()
    df = spark.createDataFrame(docs, "id long, text string")
    assert {tuple(r) for r in spans.pairs(df).collect()} == _brute(docs, 300)


def test_report(spark):
    docs = _corpus()
    got = {r.id: r for r in spans.report(spark.createDataFrame(docs, "id long, text string")).collect()}
    assert len(got) == len(docs)
    assert got[1].shared_chars >= 300 and got[4].shared_share == 1.0 and got[6].shared_chars == 500
    assert got[3].shared_chars == 0 and got[7].n_chars == 0 and got[8].shared_chars == 0


def _covered(docs, least):
    """By brute force: how much of each text lies in windows that another record holds."""
    out = {}
    for i, a in docs:
        other = {b[k : k + least] for j, b in docs if j != i and b for k in range(len(b) - least + 1)}
        mark = [False] * len(a or "")
        for k in range(len(a or "") - least + 1):
            if a[k : k + least] in other:
                mark[k : k + least] = [True] * least
        out[i] = sum(mark)
    return out


def _woven(r, n=24):
    """Texts woven of few passages: repeated within one text, cut anywhere, side by side, nested in each other."""
    pool = [_text(r, r.randint(200, 700)) for _ in range(6)] + ["ab" * 400]
    docs = []
    for i in range(n):
        bits = []
        for _ in range(r.randint(1, 5)):
            p = r.choice(pool)
            a = r.randint(0, len(p) // 2)
            bits.append(p[a : a + r.randint(100, len(p))] + (_text(r, r.randint(0, 120)) if r.random() < 0.6 else ""))
        docs.append((i, "".join(bits)))
    return docs


def test_woven_texts_equal_brute_force(spark, monkeypatch):
    for hot in (40, 2, 0):
        monkeypatch.setattr(spans, "HOT", hot)
        docs = _woven(random.Random(11))
        df = spark.createDataFrame(docs, "id long, text string")
        assert {r.id: r.shared_chars for r in spans.report(df).collect()} == _covered(docs, 300), hot
        assert {tuple(r) for r in spans.pairs(df).collect()} == _brute(docs, 300), hot


def test_groups_hold_the_same_links(spark, monkeypatch):
    monkeypatch.setattr(spans, "HOT", 2)
    docs = _woven(random.Random(13)) + [(100, "z" + "q" * 350), (101, "z" + "q" * 350)]
    rows = spans.groups(spark.createDataFrame(docs, "id long, text string")).collect()
    rep = {r.id: int(r.g) for r in rows if r.kind == "copy"}
    spans_of = {}
    for r in rows:
        if r.kind == "span":
            spans_of.setdefault(r.g, set()).add(r.id)
    linked = {(a, b) for g in spans_of.values() for a in g for b in g}
    of = lambda i: rep.get(i, i)
    ids = [i for i, _ in docs]
    got = {(i, j) for i in ids for j in ids if i < j and (of(i) == of(j) or (of(i), of(j)) in linked)}
    assert got == _brute(docs, 300)


def test_long_repetitive_text_is_linear():
    a, b = spans.Index("x" * 300_000, 300), spans.Index("y" + "x" * 200_000, 300)
    assert spans.factors(a, b)[0] == (0, 1, 200_000) and spans.factors(b, a) == [(1, 0, 200_000)]


def test_empty(spark):
    assert spans.pairs(spark.createDataFrame([], "id long, text string")).count() == 0
    assert spans.report(spark.createDataFrame([], "id long, text string")).count() == 0
