import itertools
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidewell.llm import boilerplate, incremental, residue

PROSE = "The company said that revenue rose in the second quarter while costs in the north fell and {} customers renewed contracts for another year."


def _page(i, body, extra=""):
    lines = ["Home", "About", "Contact", f"Headline number {i}", *body, "Share this story with a friend", "Copyright Site. All rights reserved."]
    p = "".join(f"<p>{b}</p>" for b in body)
    raw = f"<!doctype html><html><head><title>x</title><script>var a='<p>no</p>';</script></head><body><nav><a href='/'>Home</a><a href='/a'>About</a><a>Contact</a></nav><main><h1>Headline number {i}</h1>{p}</main><div>Share this story with a friend</div><footer><p>Copyright Site. All rights reserved.</p></footer></body></html>"
    return (i, f"https://site.example/{i}", "site", "T", "\n".join(lines), raw)


def _pages(n=40):
    r = random.Random(0)
    return [_page(i, [PROSE.format(r.randint(1, 10**6)) + f" Case {k} of {i}." for k in range(4)]) for i in range(n)]


SCHEMA = "content_id long, url string, source string, title string, text string, raw string"


def test_article_lines_stay(spark):
    odd = [(900, None, None, None, None, None), (901, None, None, "t", "", "<html></html>"), (902, None, None, "t", "plain text", "plain text"), (903, None, None, None, "x " * 200_000, "<html><body><p>" + "x " * 200_000 + "</p>"), (904, None, None, None, "a\n\nb", "<html><<<><p>")]
    df = spark.createDataFrame(_pages() + odd, SCHEMA).withColumn("line_no", F.lit(1))
    got = {(r.content_id, r.line_no) for r in boilerplate.boilerplate_lines(df).collect() if r.content_id < 900}
    assert got == {(i, k) for i in range(40) for k in (1, 2, 3, 9, 10)}
    texts = {r.content_id: r.text for r in boilerplate.main_text(df).collect()}
    assert texts[0].startswith("Headline number 0\n") and texts[0].count("\n") == 4 and texts[902] == "plain text" and texts[900] is None and len(texts) == 45
    assert boilerplate.boilerplate_lines(df.limit(0)).count() == 0


def test_minimum_cut_is_minimal():
    r = random.Random(4)
    for _ in range(60):
        n = r.randint(1, 8)
        u = [round(r.uniform(-2, 2), 2) for _ in range(n)]
        edges = [(a, b, round(r.uniform(0, 1.5), 2)) for a in range(n) for b in range(a) if r.random() < 0.5]
        cost = lambda lab: sum(x for x, l in zip(u, lab) if x > 0 and not l) - sum(x for x, l in zip(u, lab) if x < 0 and l) + sum(w for a, b, w in edges if lab[a] != lab[b])  # noqa: B023, E731, E741
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(boilerplate.minimum_cut(u, edges)) - best) < 1e-9


def test_residue(spark):
    # natural text is learnt from the table: it must hold ordinary words
    more = [f"A late delivery had cost it many orders, but the team fixed it before the summer. Page {i} of the report that said so was sent to partners." for i in range(60)]
    rows = _pages() + [_page(300 + i, more[i : i + 1]) for i in range(60)]
    bad = [
        (100, "https://site.example/100", "site", "404 Not Found", "The page you requested could not be found.", None),
        (101, "https://site.example/101", "site", "T", rows[0][4] + "\n{{first_paragraph}}", None),
        (102, "https://site.example/102", "site", "T", "Lorem ipsum dolor sit amet, consectetur adipiscing elit.", None),
        (103, None, None, "T", "Please enable JavaScript to continue.", None),
        (104, None, None, "${headline}", rows[1][4], None),
    ]
    good = [
        (200, "https://site.example/200", "site", "T", PROSE.format(3) + " An error page that said 404 not found had cost it many orders, but the team fixed it before the summer.", None),
        (201, None, None, None, None, None),
        (202, None, None, "T", "", None),
    ]
    df = spark.createDataFrame(rows + bad + good, SCHEMA).withColumns({"source_x": F.lit(1), "h": F.lit(2)})
    assert {r.content_id for r in residue.residue_rows(df).collect()} == {100, 101, 102, 103, 104}
    assert {r.content_id for r in residue.sound(df).collect()} == {r[0] for r in rows + good}
    assert (104, 0) in {tuple(r) for r in residue.residue_lines(df).collect()}
    assert "first_paragraph" not in {r.content_id: r.text for r in residue.real_text(df).collect()}[101]
    assert residue.residue_rows(df.limit(0)).count() == 0


def test_fragments_are_pages(spark):
    r = random.Random(5)
    rows = []
    for i in range(60):
        word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
        body = [" ".join(word() for _ in range(25)) + "." for _ in range(5)]
        lines = [f"{word()} {word()} {word()}", f"By {word()} {word()}", f"Viewed {r.randint(1, 10**6)} times", *body, "Follow Site for daily news", "Privacy Terms Site"]
        inner = f"<h1>{lines[0]}</h1><span>{lines[1]}</span><small>{lines[2]}</small>" + "".join(f"<p>{x}</p>" for x in body)
        inner = [f'<div id="c">{inner}</div>', f"<table><tr><td>{inner}</td></tr></table>", f"<main>{inner}</main>"][i % 3]
        rows.append((i, f"https://site.example/{i}", "site", "T", "\n".join(lines), f"{inner}<div>{lines[-2]}</div><div><span>{lines[-1]}</span></div>"))
    same = "A post that says <p> and <div> of itself.\nFollow Site for daily news"
    df = spark.createDataFrame([*rows, (900, None, "site", "T", same, same), (901, None, "site", "T", "a < b", "a < b, c > d")], SCHEMA)
    assert {tuple(x) for x in boilerplate.boilerplate_lines(df).collect()} == {(i, k) for i in range(60) for k in (2, 3, 9, 10)}
    texts = {x.content_id: x.text for x in boilerplate.main_text(df).collect()}
    assert texts[0].count("\n") == 5 and texts[900] == same and texts[901] == "a < b" and len(texts) == 62


def _sited(r, i, body=None):
    word = lambda: "".join(r.choice("abcdefghijkl") for _ in range(6))
    body = body or [" ".join(word() for _ in range(25)) + "." for _ in range(5)]
    return (i, f"https://site.example/{i}", "site", f"{word()} {word()}", "\n".join(["Home", "About", *body, "All rights reserved by the site and its partners."]), None)


def test_copies_are_no_furniture(spark):
    r = random.Random(8)
    rows = [_sited(r, i) for i in range(100)]
    body = rows[0][4].split("\n")[2:-1]
    same = [_sited(r, 200 + k, body) for k in range(60)]
    other = rows[1][4].split("\n")[2:-1]
    edited = [_sited(r, 300 + k, [x if j != k % 5 else x.replace(x.split()[k], f"changed{k}") for j, x in enumerate(other)]) for k in range(20)]
    df = spark.createDataFrame(rows + same + edited, SCHEMA)
    texts = {x.content_id: x.text for x in residue.real_text(df).collect()}
    assert all(texts[x[0]] == "\n".join(x[4].split("\n")[2:-1]) for x in rows + same + edited)
    tasks = df.select(F.col("content_id").alias("id"), "url", (F.col("content_id") >= 100).cast("int").alias("batch_no"))
    got = {tuple(x) for x in incremental.repeated_tasks(tasks, df.select("content_id", "url"), residue.real_text(df)).collect()}
    assert got == {(0, x[0]) for x in same} | {(1, x[0]) for x in edited}


def test_articles_are_cleaned_without_history(spark):
    r = random.Random(10)
    rows = [_sited(r, i, [PROSE.format(r.randint(1, 10**6)) for _ in range(4)]) for i in range(30)]
    rows += [_sited(r, 100 + k, rows[k][4].split("\n")[2:-1]) for k in range(3)]
    df = spark.createDataFrame(rows, SCHEMA)
    tasks = df.select(F.col("content_id").alias("id"), "url", F.when(F.col("content_id") < 100, 1).otherwise(2).alias("batch_no"))
    assert {tuple(x) for x in incremental.repeated_tasks(tasks, df).collect()} == {(k, 100 + k) for k in range(3)}


def test_notices_that_recur_are_found(spark):
    r = random.Random(9)
    rows = [_sited(r, i) for i in range(300)]
    bad = [_sited(r, 400 + k, ["Please enable JavaScript to view this page."]) for k in range(12)]
    bad += [(500 + k, f"https://other.example/{k}", "other", f"Report {k}", "Loading...", None) for k in range(12)]
    df = spark.createDataFrame(rows + bad, SCHEMA)
    assert {x.content_id for x in residue.residue_rows(df).collect()} == {x[0] for x in bad}
    assert {(400, 3), (500, 1)} <= {tuple(x) for x in residue.residue_lines(df).collect()}


def test_natural_model_counts_all_rows(spark):
    r = random.Random(3)
    texts = [None, "", "\n \n", *(f"Report {i} of {r.choice('abcdefgh')}{i * 7919}\n\nCosts rose by {i} in March." for i in range(4000))]
    df = spark.createDataFrame(list(enumerate(texts)), "content_id long, text string").repartition(5)
    lines = [residue._flat(x) for t in texts for x in (t or "").split("\n") if x.strip()]
    wanted = residue._ratio(residue._residue_counts(), residue._counted(lines))
    assert all((a == b).all() for a, b in zip(residue.fit(df), wanted, strict=True))


HELD_OUT = [
    "We're sorry, but this page isn't available right now.", "HTTP ERROR 451 Unavailable For Legal Reasons", "Your session has timed out. Please sign in to go on.", "This website needs scripts to work properly; allow them in your settings.",
    "Gateway error: the upstream host did not answer.", "Hmm, that link does not lead anywhere.", "Security check in progress, wait a few seconds.", "You have been rate limited. Come back in an hour.", "Cookies must be enabled to view this page.",
    "Forbidden: you do not have access to this resource.", "{{ post.headline }} by {{ post.author }}", "${summary_text}", "<%= article.body %>", "[Insert quote here]", "%LAST_NAME%, your order %ORDER_ID% is ready", "TODO: write the introduction",
    "This is placeholder copy for the layout.", "Diese Seite ist leider nicht verfügbar.", "Cette page n'existe plus ou a été déplacée.", "Lo sentimos, la página no está disponible.", "抱歉,您要查看的页面暂时无法访问。", "请先开启JavaScript再浏览本页。",
]
PLAIN = [
    "The minister said the budget would be revised in May.", "Enable teams to ship twice a week, the founder wrote.", "A page of the contract was not found until March, auditors said.", "Zwei Werke in Bayern liefern ab Juni.",
    "La société a levé douze millions d'euros en avril.", "公司表示第二季度收入增长了百分之十二。", "Her title, body of work and date of birth were listed in the filing.", "Traffic on the site rose after the error was fixed, the company said.",
]


def test_wordings_that_are_not_in_the_list(spark):
    table = Path("/root/testdata/sf0.01/fetched_content.parquet")
    if not table.exists():
        pytest.skip("the natural model needs ordinary texts")
    model = residue.fit(spark.read.parquet(str(table)).select("content_id", "text"))
    listed = residue.PLACEHOLDERS + residue.FILLER + residue.NOTICES
    assert not any(x in listed for x in HELD_OUT)
    share = lambda x: residue.line_shares([x], model)[0][0]
    assert sum(share(x) >= residue.COVERAGE for x in HELD_OUT) >= 0.85 * len(HELD_OUT)
    assert not any(share(x) >= residue.COVERAGE for x in PLAIN)
