"""Template residue, filler and error notices in place of content (problem 6), by likelihood-ratio windows.

Character n-gram models are fitted for residue (unfilled placeholders, filler text; error, block and script notices) and
for natural text. Each n-gram has a log-likelihood ratio of the two; windows whose mean ratio lies above `WINDOW_MEAN`
mark their characters, and a line (the title is one) whose characters are covered to `COVERAGE` or more is residue. A
row is excluded if it has such a line. An article that mentions an error page or quotes a placeholder has a marked
stretch inside a long line of prose, too little of it to count.

Short furniture ("About", "Read on") is made of the same words as notices. Lines that come back within their site (in
`FURNITURE_ROWS` rows and `FURNITURE_SHARE` of its rows, by the operator for repeated lines) are furniture if they stand
so often in otherwise different texts (`furniture`); the paragraphs of an article copied many times, and a notice that
is all its pages hold, come back as well and are none. All lines are scored, and furniture does not count as residue on
a row with a body of its own.

The residue models are fitted on the phrases below, written down as what such texts say in general, the natural model
on all rows of the table itself: each task adds up its n-grams in tables of a fixed size, and the driver gets their sum,
a number for each slot. Fitting and scoring are a few array operations per character over whole texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import host_of
from ..session import settle
from . import sitelines
from .arrays import chunks, code_points, window_hashes

#: n-gram length, bits of its table, smoothing, whether of shapes (letters alike) instead of characters.
ORDERS = ((3, 16, 2e-4, False), (5, 18, 4e-5, False), (4, 14, 2e-4, True))
WINDOW, WINDOW_MEAN, COVERAGE = 12, 0.35, 0.68
FURNITURE_ROWS, FURNITURE_SHARE = 5, 0.01
#: The least share of the rows with a line that are otherwise different texts, for furniture.
FURNITURE_OTHERS = 0.3
#: Bytes from which on a row is more than short lines and a line is of a body; characters of a window to tell texts apart.
LONG_ROW, LONG_LINE, SIGN = 300, 60, 24
CLIP = 3.0

# Phrases that stand in place of content.
PLACEHOLDERS = """{{title}} {{ title }} {{headline}} {{first_name}} {{ user.name }} {{author}} {{date}} {{{body}}} {{#if items}} {{/if}} {{#each items}} {{/each}} {{this}} {{> partial}}
${title} ${name} ${user.name} ${article.title} ${date} ${content} $title$ #{name} #{title}
<%= title %> <%= yield %> <%= render 'content' %> <% end %> <%- content %> <?php echo $title; ?> <?= $title ?>
{% block content %} {% endblock %} {% include 'header.html' %} {% if user %} {% endif %} {% for item in items %} {% endfor %} {% extends "base.html" %}
%(name)s %(title)s %(body)s %s %d %1$s {0} {1} {2} {name} {title}: {value} %NAME% %TITLE% %BODY% %%TITLE%% %%BODY%% @@TITLE@@ @@NAME@@ __TITLE__ ##TITLE## ###CONTENT###
[[title]] [[name]] [[content]] [[image_1]] [[section]] [TITLE] [YOUR NAME] [COMPANY NAME] [[author_name]]
TITLE_PLACEHOLDER TEXT_PLACEHOLDER PLACEHOLDER BODY_PLACEHOLDER IMAGE_PLACEHOLDER placeholder_text article_body_placeholder
[Insert title here] [insert text here] [Insert name] [Add text here] [Add a description here] [Your text here] [Enter summary of 50 words here] [Add a short description here] [Write introduction here]
<insert name> <insert company> <insert date here> <insert figure> <your name here> <title goes here> <company name>
Your text goes here. Your headline here. Text goes here. Title goes here. Content goes here. Add your text here. Insert your content here. Type your text here. Click to edit this text.
Untitled Untitled document Untitled template Untitled page New page Template title Page title Headline goes here Enter title here Default title
TODO: write text TODO: add content TODO replace this copy before publishing FIXME: missing copy TBD: add copy to come copy goes here replace with final text before launch to be replaced before going live
Dear {{name}}, Dear {{first_name}}, Dear [name], Hello {name}, Hi %FIRSTNAME%, said [[name]]. by ${author} on ${date}. Published by {{author}} on {{date}}
{{company}} raised {{amount}} from {{investor}} to build {{product}}. {0} said {1} about {2}. announced <insert amount> of funding.
undefined undefined null null NaN undefined [object Object] [object Object] #REF! #VALUE! #NAME?
[在此插入标题] [在此输入正文] 此处填写标题 请在此处输入内容 [标题] 在此添加文字 {{标题}} {{正文}} 待补充 待填写 标题占位符
[Titel hier einfügen] [Text hier einfügen] Hier steht Ihr Text. Titel hier eingeben. [Insérer le titre ici] Votre texte ici. [Insertar título aquí] Su texto va aquí. Escriba su texto aquí."""
FILLER = """Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. Duis aute irure dolor in reprehenderit in voluptate velit esse cillum dolore eu fugiat nulla pariatur. Excepteur sint occaecat cupidatat non proident, sunt in culpa qui officia deserunt mollit anim id est laborum. Sed ut perspiciatis unde omnis iste natus error sit voluptatem accusantium doloremque laudantium, totam rem aperiam, eaque ipsa quae ab illo inventore veritatis et quasi architecto beatae vitae dicta sunt explicabo. Nemo enim ipsam voluptatem quia voluptas sit aspernatur aut odit aut fugit.
Lorem ipsum lorem ipsum dolor. Vestibulum ante ipsum primis in faucibus. Curabitur pretium tincidunt lacus. Nulla gravida orci a odio. Nullam varius, turpis et commodo pharetra, est eros bibendum elit. Integer in mauris eu nibh euismod gravida. Pellentesque habitant morbi tristique senectus et netus et malesuada fames ac turpis egestas.
Sample text. Sample paragraph text. Sample paragraph. This is sample text. This is dummy text. Dummy text. Placeholder text. This is placeholder text. Filler text. Example paragraph text. Test text. This is a test. test test test Some text here. Some example text. Paragraph text. Body text. Blah blah blah. foo bar baz asdf asdf asdf qwerty qwerty
Dies ist ein Blindtext. Blindtext. Dies ist ein Typoblindtext. Hier steht ein Blindtext. Beispieltext. Mustertext. Platzhaltertext. Ceci est un texte factice. Texte factice. Texte d'exemple. Faux texte. Este es un texto de ejemplo. Texto de ejemplo. Texto de relleno. Texto de prueba. Texto simulado.
这是一段示例文本。 示例文字 示例文字示例文字示例文字示例文字 占位文字 占位文字占位文字占位文字占位文字 这里是占位文本。 测试文本 测试测试测试 此处为示例内容。 这是测试内容。 段落文本 此处是正文内容占位。
xxxx xxxxx xxx xxxxxx xxxxxxxx xx xxxx xxxxxxx xxx xxxxxxxxx xxxxxx XXXXX XXXX XXXXXX xxxxxxxxxx xxx xxxx ........ ------ ______ aaaa aaaa bbbb abc abc abc 0000 0000"""
NOTICES = """404 Not Found 404 - Page not found 403 Forbidden 401 Unauthorized 500 Internal Server Error 502 Bad Gateway 502 bad gateway 503 Service Unavailable 504 Gateway Timeout 410 Gone 400 Bad Request 429 Too Many Requests nginx nginx/0.0.0 Apache Server at port 443 Error Error 404 Error 500 HTTP Error 403 HTTP 503
Page not found Page not found - The page you requested could not be found. The page you are looking for does not exist. The page you asked for was not found on this server. The requested URL was not found on this server. We could not find the page. We can't find that page. We could not find this article. This page may have moved or been removed. It may have moved or expired. The article has been removed. This article is no longer available. This content is not available in your country. This content is not available in your region. This video is unavailable. Not available in your location. Sorry, that page is not here. The link may be broken or the page may have been deleted.
Access denied Access to this page has been denied. You don't have permission to access this server. You do not have permission to view this page. Your IP address has been blocked. Request blocked. Your request was blocked by our security service. Forbidden. Unusual traffic detected. We have detected unusual activity from your network. Too many requests. Please slow down and try again later. Slow down and retry later. Rate limit exceeded. Reference id=000abc000 Reference #00.0abc Incident 0abc00de0 incident ID: 0a0b0c0d Ray ID: 0abc00de request id 00000 error id 0a0b0c proxy 0a0b0c0d id=00ab00cd
Attention required Attention Required! Just a moment... One moment, please... Checking your browser before accessing this site. This takes a few seconds. Checking your browser before you continue. This may take 5 seconds. Please wait while we verify your browser. Verify you are human. Verifying you are human. Please verify that you are not a robot. Complete the captcha to continue. Please complete the security check to access this site. DDoS protection. Performance and security. Are you a robot? Press and hold to confirm you are human.
Please enable JavaScript to view this page. Please enable JavaScript to continue. Please enable JavaScript and cookies. Please turn on JavaScript in your browser. You need to enable JavaScript to run this app. You need to turn on scripts in your browser. This site requires JavaScript. JavaScript is disabled in your browser. JavaScript is required. Scripts must be enabled to use this app. Switch on scripting and reload the page. If nothing happens, turn scripting on and reload. Your browser does not support scripts. Your browser is out of date. Your browser is not supported. Enable cookies and reload the page. Enable scripts to continue reading.
Loading Loading... Loading… Please wait... Redirecting... Redirecting you shortly. If you are not redirected automatically, click here. If the page does not load, refresh. If nothing happens, reload the page.
Something went wrong. Oops! Something went wrong. Oops, something went wrong on our side. An error occurred. An unexpected error occurred. An error has occurred while processing your request. Sorry, something went wrong. Please try again later. Please try again in a few minutes. Try again in 5 minutes. Our servers are busy. The server is temporarily unable to service your request. The service is temporarily unavailable. Service unavailable. We are down for maintenance. Site under maintenance. Scheduled maintenance. We'll be back soon. The request timed out. Connection timed out. Connection refused. Session expired. Please log in again. Unable to connect to the database. Error establishing a database connection.
Traceback (most recent call last): KeyError: 'title' TypeError: 'NoneType' object is not subscriptable ValueError: NullPointerException at line 00 template render failed at line 0 template error in line 00 Fatal error: Uncaught exception in index.php on line 00 Warning: include(header.php): failed to open stream Undefined variable: title Undefined index: body SyntaxError: unexpected token Exception in thread stack trace
Fehler 404 Seite nicht gefunden. Die Seite wurde nicht gefunden. Die angeforderte Seite wurde nicht gefunden. Diese Seite existiert nicht mehr. Zugriff verweigert. Bitte aktivieren Sie JavaScript. Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen. Bitte aktivieren Sie JavaScript, um fortzufahren. Dienst nicht verfügbar. Der Dienst ist vorübergehend nicht verfügbar, bitte versuchen Sie es später erneut. Bitte versuchen Sie es in 5 Minuten erneut. Es ist ein Fehler aufgetreten. Einen Moment bitte. Interner Serverfehler. Wird geladen
Erreur 404 Page introuvable. La page demandée est introuvable. La page que vous cherchez n'existe pas. Accès refusé. Veuillez activer JavaScript. Veuillez activer JavaScript pour continuer. Veuillez activer JavaScript pour afficher cette page. Service indisponible. Service temporairement indisponible, réessayez plus tard. Réessayez dans 5 minutes. Une erreur est survenue. Un instant, s'il vous plaît. Erreur interne du serveur. Chargement en cours
Error 404 Página no encontrada. La página solicitada no existe. No se encontró la página. La página que busca no está disponible. Acceso denegado. Active JavaScript para continuar. Active JavaScript para ver esta página. Por favor, habilite JavaScript. Servicio no disponible. Servicio no disponible temporalmente, inténtelo más tarde. Inténtelo de nuevo en 5 minutos. Se ha producido un error. Un momento, por favor. Error interno del servidor. Cargando
页面不存在 404 页面不存在 您访问的页面不存在 您访问的页面已被删除 您访问的页面已被移除。 该内容已被删除 该内容已被发布者删除 该文章已被删除 访问受限 访问受限,错误编号 访问被拒绝 没有访问权限 请启用 JavaScript 后继续 请启用浏览器脚本后再访问。 请开启浏览器脚本功能 您的浏览器不支持脚本 请完成验证 请完成安全验证后继续访问 环境异常,完成验证后即可继续访问。 当前环境异常 服务暂时不可用 服务器繁忙,请稍后再试。 服务器错误 系统错误,请稍后重试 加载中 正在加载 网络错误 出错了 错误 请求过于频繁,请稍后再试。 此内容在您所在的地区不可用 页面找不到了 系统维护中"""

_SPACES = re.compile(r"[^\S\n]{2,}|[\t\r\f\v\xa0\u3000]")


def _flat(text: str) -> str:
    """A text as the models see it: lower case, single spaces, line ends kept. `_points` makes digits alike."""
    return _SPACES.sub(" ", text.lower())


def _points(lines: str) -> np.ndarray:
    points = code_points([lines])[0].copy()
    points[(points >= 48) & (points <= 57)] = 48
    return points


def _grams(points: np.ndarray, order: int, bits: int) -> np.ndarray:
    """The table slot of the n-gram that ends at each code point from `order - 1` on."""
    n = len(points) - order + 1
    h = np.zeros(max(n, 0), np.uint64)
    p = points.astype(np.uint64)
    for k in range(order):
        h = h * np.uint64(0x100000001B3) + p[k : k + n] * np.uint64(0x9E3779B1)
    h ^= h >> np.uint64(29)
    return ((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).astype(np.int64)


def _within(points: np.ndarray, order: int) -> np.ndarray:
    """Whether an n-gram lies within one line: a line end is at most its first or last character."""
    seen = np.concatenate([[0], np.cumsum(points == 10)])
    return seen[order - 1 : -1] == seen[1 : len(seen) - order + 1]


def _shapes(points: np.ndarray) -> np.ndarray:
    """Letters of any alphabet alike, Han characters alike; digits, punctuation and line ends as they are."""
    out = points.copy()
    out[((points >= 97) & (points <= 122)) | ((points >= 0xC0) & (points < 0x2000))] = 97
    out[(points >= 0x3400) & (points < 0xA000)] = 0x4E00
    return out


def _counted(lines: list[str]) -> list[np.ndarray]:
    """n-gram counts of lines, each between line ends, for every order."""
    points = _points("\n" + "\n".join(lines) + "\n")
    shapes = _shapes(points)
    return [np.bincount(_grams(shapes if shaped else points, order, bits)[_within(points, order)], minlength=1 << bits).astype(np.float64) for order, bits, _, shaped in ORDERS]


def _marks(shapes: np.ndarray, order: int) -> np.ndarray:
    """Whether an n-gram holds punctuation: the shape of mere words tells nothing."""
    plain = (shapes == 97) | (shapes == 0x4E00) | (shapes == 48) | (shapes == 32) | (shapes == 10)
    seen = np.concatenate([[0], np.cumsum(~plain)])
    return seen[order:] > seen[:-order]


Model = list[np.ndarray]


def _ratio(residue: list[list[np.ndarray]], natural: list[np.ndarray]) -> Model:
    """For each order the log-likelihood ratio of the residue model that explains an n-gram best to the natural one."""
    out = []
    for k, (_, _, eps, _) in enumerate(ORDERS):
        best = np.max([r[k] / max(1.0, r[k].sum()) for r in residue], axis=0)
        out.append(np.clip(np.log((best + eps) / (natural[k] / max(1.0, natural[k].sum()) + eps)), -CLIP, CLIP).astype(np.float32))
    return out


def _seed_lines(text: str) -> list[str]:
    """Seed phrases line by line, and each sentence of them on its own, as they may begin and end a line."""
    lines = [_flat(x) for x in text.split("\n")]
    return lines + [s for x in lines for s in re.split(r"(?<=[.!?。]) ", x) if s != x]


def _residue_counts() -> list[list[np.ndarray]]:
    return [_counted(_seed_lines(t)) for t in (PLACEHOLDERS, FILLER, NOTICES)]


def coverage(points: np.ndarray, ends: np.ndarray, model: Model) -> np.ndarray:
    """For flattened text that begins and ends with a line end: whether each code point lies in a window that a residue
    model explains better than the natural one by WINDOW_MEAN a character. Windows do not cross line ends."""
    n = len(points)
    score = np.zeros(n, np.float32)
    shapes = _shapes(points)
    for (order, bits, _, shaped), table in zip(ORDERS, model):
        if n >= order:
            ratio = table[_grams(shapes if shaped else points, order, bits)]
            counts = _within(points, order)
            score[order - 1 :] += ratio * (counts & _marks(shapes, order) if shaped else counts)
    total = np.zeros(n + 1, np.float64)
    np.cumsum(score, out=total[1:])
    sizes = np.diff(np.concatenate([[-1], ends]))
    at = np.arange(n)
    stop = np.minimum(at + WINDOW, np.repeat(ends + 1, sizes))
    begin = np.maximum(np.repeat(ends + 1 - sizes, sizes), stop - WINDOW)
    good = np.flatnonzero((total[stop] - total[begin]) > WINDOW_MEAN * len(ORDERS) * (stop - begin))
    delta = np.bincount(begin[good], minlength=n + 1) - np.bincount(stop[good], minlength=n + 1)
    return np.cumsum(delta[:-1]) > 0


def line_shares(texts: list[str], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """The covered share of every line of the texts in a row, and the number of lines of each text."""
    flat = [_flat(t) for t in texts]
    points = _points("\n" + "\n".join(flat) + "\n")
    ends = np.flatnonzero(points == 10)
    marked = coverage(points, ends, model)
    solid = (points > 32) & (points != 0xA0)
    done = np.concatenate([[0], np.cumsum(marked & solid)])
    size = np.concatenate([[0], np.cumsum(solid)])
    got, full = done[ends[1:]] - done[ends[:-1]], size[ends[1:]] - size[ends[:-1]]
    return got / np.maximum(full, 1), np.asarray([t.count("\n") + 1 for t in flat])


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least hash of all windows of each rest, by which near copies meet; null for none."""
    for b in batches:
        signs = []
        for rest in b.column("rest").to_pylist():
            h = window_hashes(code_points([" ".join(rest.lower().split())])[0], SIGN) if rest else ()
            signs.append(int(h.min() >> np.uint64(1)) if len(h) else None)
        yield pa.RecordBatch.from_arrays([b.column("source"), b.column("hs"), pa.array(signs, pa.int64())], ["source", "hs", "sign"])


def furniture(sited: DataFrame) -> DataFrame:
    """source, h: the lines that come back within their site in otherwise different texts. sited: source, text.

    A row counts for its recurring lines if what it holds besides is at least half of it, and rows whose rest has the
    same least window hash (copies, edited or not) count once. Of the long rows with a line `FURNITURE_OTHERS` must be
    different in this way, so that the paragraphs of much copied articles stay.
    """
    named = settle(sitelines.repeated_lines(sited, FURNITURE_ROWS, FURNITURE_SHARE), "recurring")
    held = sitelines.with_named(sited.select("source", "text"), named).where("named_lines IS NOT NULL")
    lines = F.transform(F.split(F.col("row.text"), "\n", -1), lambda x: F.struct(x.alias("line"), F.xxhash64(sitelines.norm(x)).alias("h")))
    held = held.select("row.source", "row.text", "named_lines", lines.alias("lines")).where(F.octet_length("text") >= LONG_ROW)
    again = lambda x: F.array_contains(F.col("named_lines"), x["h"])
    rest = F.array_join(F.transform(F.filter("lines", lambda x: ~again(x)), lambda x: x["line"]), "\n")
    cut = held.select("source", F.array_distinct(F.transform(F.filter("lines", again), lambda x: x["h"])).alias("hs"), rest.alias("rest"), "text")
    cut = cut.select("source", "hs", F.when(F.octet_length("rest") * 2 >= F.octet_length("text"), F.col("rest")).alias("rest"))
    signed = cut.where(F.size("hs") > 0).mapInArrow(_signed, "source string, hs array<bigint>, sign bigint")
    groups = signed.select("source", F.explode("hs").alias("h"), "sign").groupBy("source", "h", "sign").agg(F.count(F.lit(1)).alias("n"))
    beside = groups.groupBy("source", "h").agg(F.sum("n").alias("n"), F.count("sign").alias("others"))
    enough = (F.col("others") >= FURNITURE_ROWS) & (F.col("others") >= F.col("n_source") * FURNITURE_SHARE - 1e-9) & (F.col("others") >= F.col("n") * FURNITURE_OTHERS)
    return beside.join(named.select("source", "h", "n_source"), ["source", "h"]).where(enough).select("source", "h")


def _furnished(rows: DataFrame, lines: DataFrame | None = None) -> DataFrame:
    """content_id, title, text, furniture: the rows with the places (from 0) of their lines of furniture. The site is
    the host of the url, as a source may be missing."""
    sited = rows.select(F.col("content_id").cast("bigint").alias("content_id"), host_of(F.col("url")).alias("source"), "title", "text")
    numbered = F.transform(F.split(F.col("row.text"), "\n", -1), lambda x, i: F.when(F.array_contains(F.col("named_lines"), F.xxhash64(sitelines.norm(x))), i))
    places = F.filter(numbered, lambda i: i.isNotNull())
    return sitelines.with_named(sited, furniture(sited) if lines is None else lines).select("row.content_id", "row.title", "row.text", places.alias("furniture"))


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's n-gram counts, by slots numbered through all orders; those it has."""
    total = np.zeros(sum(1 << bits for _, bits, _, _ in ORDERS), np.int64)
    for b in batches:
        for _, texts in chunks([None] * b.num_rows, b.column("text").to_pylist()):
            total += np.concatenate(_counted([_flat(x) for t in texts for x in t.split("\n") if x.strip()])).astype(np.int64)
    held = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held], pa.int64())], ["slot", "n"])


def fit(rows: DataFrame) -> Model:
    """The likelihood ratios of residue (the best of three models: placeholders, filler, notices) to natural text.

    rows: text; all of them are counted, a null text as empty. Residue among them hardly counts: each phrase stays below
    the smoothing.
    """
    summed = rows.select("text").mapInArrow(_summed, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()  # a row a slot at most, whatever the input
    natural = np.zeros(sum(1 << bits for _, bits, _, _ in ORDERS), np.float64)
    natural[summed.column("slot").to_numpy()] = summed.column("n").to_numpy()
    return _ratio(_residue_counts(), np.split(natural, np.cumsum([1 << bits for _, bits, _, _ in ORDERS])[:-1]))


def _scan(rows: DataFrame, model: Model | None, run_row: Callable[[int, str, np.ndarray, set[int]], list[tuple]], schema: str, lines: DataFrame | None = None) -> DataFrame:
    model = fit(rows) if model is None else model
    shared = rows.sparkSession.sparkContext.broadcast(model)  # two MB, whatever the input
    names = [x.split()[0] for x in schema.split(", ")]
    types = [{"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[x.split()[1]] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            whole = [f"{(t or '').replace(chr(10), ' ')}\n{x or ''}" for t, x in zip(b.column("title").to_pylist(), b.column("text").to_pylist())]
            places = dict(enumerate(b.column("furniture").to_pylist()))
            own = b.column("content_id").to_pylist()
            for at_row, texts in chunks(list(range(len(own))), whole):
                share, sizes = line_shares(texts, shared.value)
                hit = share >= COVERAGE
                at = np.concatenate([[0], np.cumsum(sizes)])
                out = [x for k, t, s, e in zip(at_row, texts, at[:-1], at[1:]) for x in run_row(own[k], t, hit[s:e], {p + 1 for p in places[k] or ()})]
                cols = zip(*out) if out else [[]] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, types)], names)

    return _furnished(rows, lines).mapInArrow(run, schema)


def _counted_hits(t: str, hit: np.ndarray, furniture: set[int]) -> np.ndarray:
    """The lines of residue, without furniture if the row has a body: a long line that is neither, nor the title."""
    if not furniture or not hit.any():
        return hit
    lines = t.split("\n")
    body = any(k and k not in furniture and not hit[k] and len(x.encode("utf-8", "replace")) >= LONG_LINE and x.strip() != lines[0].strip() for k, x in enumerate(lines))
    if not body:
        return hit
    return hit & ~np.isin(np.arange(len(hit)), list(furniture))


def residue_rows(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """content_id of the rows to exclude. rows: content_id, url, title, text; null title and text count as empty, and an
    empty text with a sound title is no case."""
    return _scan(rows, model, lambda i, t, hit, f: [(i,)] if _counted_hits(t, hit, f).any() else [], "content_id bigint")


def residue_lines(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """content_id, line_no: the lines of residue; line_no counts from 1, the title is line 0."""
    return _scan(rows, model, lambda i, t, hit, f: [(i, int(k)) for k in np.flatnonzero(_counted_hits(t, hit, f))], "content_id bigint, line_no int")


class Cleaner:
    """What residue and furniture are, learnt once and kept: texts cleaned later, in other sessions too, are cleaned
    alike whatever has arrived since."""

    def __init__(self, model: Model, lines: DataFrame):
        self.model, self.lines = model, lines

    @classmethod
    def fit(cls, rows: DataFrame) -> Cleaner:
        """rows: content_id, url, text."""
        sited = rows.select(host_of(F.col("url")).alias("source"), "text")
        return cls(fit(rows), settle(furniture(sited), "furniture"))

    def save(self, path: str) -> None:
        spark = self.lines.sparkSession
        spark.createDataFrame([(k, t.tobytes()) for k, t in enumerate(self.model)], "k int, ratios binary").coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
        self.lines.write.mode("overwrite").parquet(f"{path}/furniture")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Cleaner:
        kept = spark.read.parquet(f"{path}/model").orderBy("k").collect()  # one row an n-gram order
        return cls([np.frombuffer(bytes(r.ratios), np.float32) for r in kept], spark.read.parquet(f"{path}/furniture"))

    def real_text(self, rows: DataFrame) -> DataFrame:
        """content_id, text: every row's text without lines of residue and without its site's furniture.
        rows: content_id, url, title, text."""

        def keep(i: int, t: str, hit: np.ndarray, places: set[int]) -> list[tuple]:
            return [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k and x and not hit[k] and k not in places))]

        return _scan(rows, self.model, keep, "content_id bigint, text string", self.lines)


def real_text(rows: DataFrame) -> DataFrame:
    """content_id, text of the rows, cleaned by what they hold themselves."""
    return Cleaner.fit(rows).real_text(rows)


def sound(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows, all columns kept, without those to exclude."""
    bad = settle(residue_rows(rows, model), "residue")
    return rows.join(bad, rows["content_id"] == bad["content_id"], "left_anti")
