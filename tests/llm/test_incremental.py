import random

from pyspark.sql import functions as F

from tidewell.llm import incremental


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def test_common_is_the_longest_common_subsequence():
    r = random.Random(1)
    for _ in range(50):
        a, b = [r.choices("abcde", k=r.randint(0, 30)) for _ in range(2)]
        assert incremental.common(a, b) == _lcs(a, b)


def _article(r, n=8):
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
    return [" ".join(word() for _ in range(12)) + "." for _ in range(n)]


def _case():
    r = random.Random(7)
    base, other, third = _article(r), _article(r), _article(r)
    edited = list(base)
    edited[2] = edited[2].replace(edited[2].split()[3], "changed")
    texts = {1: base, 2: other, 10: edited, 11: base, 12: other[:2] + third, 13: third[:4] + ["More text of its own here. " * 3] + third[4:], 14: ["Too short."], 15: ["Too short."]}
    tasks = [(1, "https://s.example/a", 0), (2, "https://s.example/b", None), (3, "https://s.example/q?id=1", 0), (10, "https://s.example/c", 1), (11, "https://t.example/d", 2), (12, "https://s.example/e", 2), (13, "https://s.example/f", 3), (14, "https://s.example/g", 3), (15, "https://s.example/h", 3), (16, "http://www.s.example/q/?utm_source=x&id=1#top", 4), (17, None, 4), (18, "junk", 4), (19, "https://s.example/q?id=2", 4)]
    content = [(100 + i, dict((t[0], t[1]) for t in tasks)[i]) for i in texts] + [(300, None), (301, "https://nowhere.example")]
    articles = [(100 + i, "\n".join(x)) for i, x in texts.items()] + [(300, None), (301, "")]
    return tasks, content, articles


WANT = {(1, 10), (1, 11), (3, 16), (12, 13)}


def _run(spark):
    tasks, content, articles = _case()
    t = spark.createDataFrame(tasks, "id long, url string, batch_no int").withColumns({"h": F.lit(1), "run": F.lit("x")})
    c = spark.createDataFrame(content, "content_id long, url string").withColumn("id", F.lit(5))
    return t, c, spark.createDataFrame(articles, "content_id long, text string")


def test_repeats(spark):
    assert {tuple(r) for r in incremental.repeated_tasks(*_run(spark)).collect()} == WANT


def test_rounds_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(incremental, "ROUNDS", (0, 1))
    monkeypatch.setattr(incremental, "SPREAD", 1)
    assert {tuple(r) for r in incremental.repeated_tasks(*_run(spark)).collect()} == WANT


def test_batch_by_batch_gives_the_same(spark):
    assert {tuple(r) for r in incremental.repeated_tasks(*_run(spark), batches=True).collect()} == WANT


def _copies(n, share_whole=8, of=20):
    """An article, and copies of which 8 of 20 sentences are untouched, each of the others with one word changed."""
    r = random.Random(n)
    base = _article(r, of)
    made = [base]
    for k in range(1, n):
        made.append([x if j < share_whole else x.replace(x.split()[r.randrange(11)], f"new{k}x{j}", 1) for j, x in enumerate(base)])
    return [(i + 1, f"https://s.example/{i}", min(i, 1)) for i in range(n)], [(i + 1, f"https://s.example/{i}") for i in range(n)], [(i + 1, "\n".join(x)) for i, x in enumerate(made)]


def _frames(spark, tasks, content, articles):
    return spark.createDataFrame(tasks, "id long, url string, batch_no int"), spark.createDataFrame(content, "content_id long, url string"), spark.createDataFrame(articles, "content_id long, text string")


def test_many_edited_copies_are_all_found(spark):
    for n in (90, 150):
        got = {tuple(r) for r in incremental.repeated_tasks(*_frames(spark, *_copies(n))).collect()}
        assert got == {(1, i) for i in range(2, n + 1)}, n


def test_stock_sentences_do_not_hide_a_repeat(spark):
    """100 articles of which a third is stock, and late copies of one in their midst with every own sentence touched."""
    r = random.Random(12)
    stock = _article(r, 4)
    texts = [[*stock, *_article(r, 8)] for _ in range(100)]
    late = [[*stock, *(x.replace(x.split()[k], f"other{k}") for x in texts[80][4:])] for k in range(3)]
    every = texts + late
    tasks = [(i + 1, f"https://s.example/{i}", int(i >= 100)) for i in range(103)]
    content = [(i + 1, t[1]) for i, t in enumerate(tasks)]
    got = {tuple(x) for x in incremental.repeated_tasks(*_frames(spark, tasks, content, [(i + 1, "\n".join(x)) for i, x in enumerate(every)])).collect()}
    assert got == {(81, 101), (81, 102), (81, 103)}


def test_history_is_opened_anew(spark, tmp_path):
    tasks, content, articles = _run(spark)
    path = f"file://{tmp_path}/history"
    first = incremental.History(spark, path, buckets=3)
    first.add("history", tasks.where("coalesce(batch_no, 0) = 0"), content, articles)
    got = set()
    for n in (1, 2, 3, 4):
        again = incremental.History(spark, path)
        again.add(f"batch{n}", tasks.where(f"batch_no = {n}"), content, articles)
        again.add(f"batch{n}", tasks.where(f"batch_no = {n}"), content, articles)  # delivered twice
        got |= {tuple(r) for r in again.repeats(f"batch{n}").collect()}
    assert got == WANT


def test_empty(spark):
    t, c, a = _run(spark)
    assert incremental.repeated_tasks(t.limit(0), c.limit(0), a.limit(0)).count() == 0
    assert {tuple(r) for r in incremental.repeated_tasks(t, c.limit(0), a.limit(0)).collect()} == {(3, 16)}
    assert incremental.repeated_tasks(t.where("batch_no > 0"), c, a).count() >= 2
