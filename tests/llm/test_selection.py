import math
import random

import pytest
from pyspark.sql import functions as F

from tidewell.llm import cutoffs, mixing, sitelines


def _scores():
    r = random.Random(1)
    rows, content = [], []
    for c in range(600):
        content.append((c, None if c % 50 == 0 else "hot" if c % 3 else f"s{c % 4}"))
        for k in range(r.randint(0, 2)):
            rows.append((c, r.choice([None, math.nan, 1.5, -0.1, 0.5, 0.5, round(r.random(), 2)]), r.choice([None, "2025-01-01", f"2025-01-{r.randint(1, 9):02d}"]), len(rows)))
    return rows + [(9999, 0.9, None, 100_000)], content


def test_cutoffs_equal_brute_force(spark):
    rows, content = _scores()
    targets = [("hot", 10), ("s0", 50), ("s1", 100), ("s2", 0), ("none", 20), ("s3", None), (None, 5)]
    s = spark.createDataFrame(rows, "content_id long, final_score double, scored_ts string, score_id long").withColumns({"source": F.lit("clash"), "n": F.lit(1)})
    c = spark.createDataFrame(content, "content_id long, source string").withColumn("score", F.lit(0))
    kept, cuts = cutoffs.select(s, c, spark.createDataFrame(targets, "source string, keep_percent int"))
    best: dict = {}
    for cid, score, ts, sid in rows:
        if score is not None and not math.isnan(score) and 0 <= score <= 1:
            key = (ts or "", sid)
            if cid not in best or key > best[cid][0]:
                best[cid] = (key, score)
    owner = dict(content)
    want = set()
    for source, percent in targets:
        mine = sorted((v[1] for k, v in best.items() if source and owner.get(k) == source), reverse=True)
        if mine and percent is not None:
            cut = mine[max(1, -(-percent * len(mine) // 100)) - 1]
            want |= {k for k, v in best.items() if owner.get(k) == source and v[1] >= cut}
    assert {r.content_id for r in kept.collect()} == want
    assert {r.source: r.n_kept for r in cuts.collect()} == {src: sum(owner[k] == src for k in want) for src in ("hot", "s0", "s1", "s2")}
    empty = cutoffs.select(s.limit(0), c, spark.createDataFrame(targets, "source string, keep_percent int"))
    assert empty[0].count() == 0 and empty[1].count() == 0


LINES = [(i, "a" if i < 40 else "b", f"  SHARE   this\nbody {i}\n\nfoot" if i % 2 else f"Body {i}\nshare this\nshare this") for i in range(60)]
ODD = [(100, None, "share this"), (101, "a", None), (102, "a", ""), (103, "c", "x\n" * 3), (101, "a", None)]


def test_site_lines(spark):
    df = spark.createDataFrame(LINES + ODD, "id long, source string, text string").withColumns({"h": F.lit(1), "named_lines": F.lit("x"), "row": F.lit(0), "n": F.lit(3)})
    named = sitelines.repeated_lines(df)
    got = {(r.id, r.line_no) for r in sitelines.marked(df, named, "id").collect()}
    count: dict = {}
    for _, s, t in set(LINES + ODD):
        for x in {" ".join(y.split()).lower() for y in (t or "").split("\n")} - {""}:
            count[s, x] = count.get((s, x), 0) + 1
    size = {s: sum(r[1] == s for r in LINES + ODD) for s in "abc"}
    want = {(i, k) for i, s, t in LINES + ODD if s for k, y in enumerate((t or "").split("\n"), 1) if (x := " ".join(y.split()).lower()) and count[s, x] >= 5 and count[s, x] >= 0.05 * size[s]}
    assert got == want and len(want) > 60
    clean = sitelines.cleaned(df, named)
    assert clean.columns == df.columns and clean.count() == df.count()
    texts = {r.id: r.text for r in clean.collect()}
    assert texts[1] == "body 1\n" and texts[0] == "Body 0" and texts[100] == "share this" and texts[101] is None
    assert sitelines.marked(df.limit(0), sitelines.repeated_lines(df.limit(0)), "id").count() == 0


def test_lone_source(spark):
    df = spark.createDataFrame([(i, "only", f"menu\nline {i}") for i in range(20)], "id long, source string, text string")
    assert {r.line for r in sitelines.marked(df, sitelines.repeated_lines(df), "id").collect()} == {"menu"}


def test_mixing(spark):
    r = random.Random(2)
    docs = [(i, "big" if i % 3 else "small", r.randint(1, 900)) for i in range(3000)] + [(None, "small", 5), (5000, "small", 0), (5001, "other", 9), (5002, None, 9)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens long").withColumns({"cap": F.lit(1), "rate": F.lit(2), "run": F.lit(3)})
    targets = spark.createDataFrame([("big", 0.4, 1), ("small", 0.6, 3), ("absent", 0.0, 2)], "source string, target_weight double, max_repeats int")
    used = mixing.copies(df, targets)
    got = used.collect()
    assert len(got) == 3002 and max(x.copies for x in got if x.source == "big") <= 1 and max(x.copies for x in got) <= 3
    share = {x.source: x.share for x in mixing.shares(used, targets).collect()}
    assert share["big"] == pytest.approx(0.4, abs=0.005) and share["small"] == pytest.approx(0.6, abs=0.005) and share["absent"] == 0
    assert mixing.copies(df.limit(0), targets).count() == 0
    half = mixing.copies(df, targets, total=200_000.0)
    assert sum(x.copies * x.n_tokens for x in half.collect()) == pytest.approx(200_000, rel=0.01)


def _solved(sizes, cap, want):
    """By bisection over plain numbers: the multiplier at which the tilted rates give the tokens wanted."""
    base, mean = min(1.0, cap / 2), sum(sizes) / len(sizes)
    rate = lambda lam, t: cap / (1 + (cap / base - 1) * math.exp(max(-700, min(700, -lam * t / mean))))
    lo, hi = -60.0, 60.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if sum(t * rate(mid, t) for t in sizes) < want else (lo, mid)
    return lo, [rate(lo, t) for t in sizes]


def test_rates_solve_the_dual(spark):
    r = random.Random(3)
    docs = [(i, f"s{i % 3}", r.randint(1, 400)) for i in range(90)]
    goals = [("s0", 0.2, 1), ("s1", 0.3, 2), ("s2", 0.5, 4)]
    sizes = {s: [t for _, x, t in docs if x == s] for s, _, _ in goals}
    total = min(c * sum(sizes[s]) / w for s, w, c in goals)
    got = mixing.copies(spark.createDataFrame(docs, "doc_id long, source string, n_tokens long"), spark.createDataFrame(goals, "source string, target_weight double, max_repeats int")).collect()
    for s, w, cap in goals:
        want = total * w
        if want < cap * sum(sizes[s]) * (1 - 1e-9):
            rates = dict(zip([i for i, x, _ in docs if x == s], _solved(sizes[s], cap, want)[1]))
            assert all(x.rate == pytest.approx(rates[x.doc_id], abs=1e-6) for x in got if x.source == s)
        assert all(math.floor(x.rate + 1e-9) <= x.copies <= math.ceil(x.rate - 1e-9) for x in got if x.source == s)
        # thirty documents: off by far less than one of them
        assert sum(x.copies * x.n_tokens for x in got if x.source == s) == pytest.approx(want, abs=20)


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "a", "Hello world"), (2, "a", None), (3, None, "")], "doc_id long, source string, text string")
    assert {r.doc_id: r.n_tokens for r in mixing.token_counts(df).collect()} == {1: 2, 2: 0, 3: 0}
