"""Main text against a plain cut of the article on the given pages, and against pages with all that is not the article."""

import html
import re

import pytest
from pyspark.sql import types as T

from fieldglean.llm.main_text import extract, main_text
from fieldglean.llm.queries import QUERIES


def by_force(page):
    """The given pages hold one article of headings and paragraphs."""
    article = page[page.index("<article>") + 9:page.index("</article>")]
    blocks = (html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))) for b in re.split("</?(?:p|h1)>", article))
    return "\n".join(b for b in (" ".join(b.split()) for b in blocks) if b)


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    want = sorted((r["page_id"], r["url"], by_force(r["html"]), len(by_force(r["html"]))) for r in pages)
    assert sorted(tuple(r) for r in QUERIES["op13_main_text"](spark, sf_dir).select("page_id", "url", "text", "n_chars").collect()) == want


BODY = ["A title", "First paragraph, with commas, and more.", "Second one.", "one", "two", "Quoted words, said.", "Last & least <b>."]
MARKED = ("<h1>{0}</h1><p>{1}<p>{2}</p><ul><li>{3}<li>{4}</ul><blockquote><p>{5}</p></blockquote><p>{6}</p>").format(*map(html.escape, BODY))
AROUND = {
    "nav": '<nav><ul><li><a href="/">Home</a></li><li><a href="/a">News</a></li></ul></nav>',
    "menu": '<div class="top-menu"><a href="/">Home</a> <a href="/b">Sport</a></div>',
    "header": "<header><h1>The Site, daily</h1><p>All news, all day, every day.</p></header>",
    "site header": '<div id="siteHeader"><p>The Site, daily, since long ago.</p></div>',
    "footer": "<footer><p>&copy; The Site, all rights, reserved.</p></footer>",
    "sidebar": '<div class="left-sidebar"><h3>Most read</h3><p>Another story, about, something else, entirely.</p></div>',
    "aside": "<aside><p>By the way, this is beside, the point, really.</p></aside>",
    "cookies": '<div id="cookie-consent"><p>We use cookies, and more cookies, to store cookies.</p><button>Fine</button></div>',
    "notice": '<p class="notice">This site moves, on Monday, to a new place.</p>',
    "advert": '<div class="ad">Buy now, pay later, buy more, pay more.</div>',
    "form": '<form action="/s"><label>Name, please</label><input name="n"><p>Send us, your thoughts, today.</p></form>',
    "script": '<script>document.write("<p>Written, by a script, here.</p>")</script>',
    "style": "<style>p{color:red}</style>",
    "noscript": "<noscript><p>Turn on scripts, please, now.</p></noscript>",
    "comments": '<section class="comments"><h2>Comments</h2><p>Great article, thanks, a lot, really, I mean it.</p></section>',
    "hidden": '<div style="display: none"><p>Not seen, by anyone, ever.</p></div>',
    "comment mark": "<!-- <p>left, out, by hand</p> -->",
    "links": '<div><a href="/1">One story</a> <a href="/2">Two stories</a> <a href="/3">Three</a></div>',
}
FRAMES = {"article": "<article>{0}{1}</article>{2}", "plain": '<div class="wrap">{0}<div class="content">{1}</div>{2}</div>',
          "main": "<main>{0}<div>{1}</div>{2}</main>", "table": "<table><tr><td>{0}</td><td>{1}</td><td>{2}</td></tr></table>"}


@pytest.mark.parametrize("frame", FRAMES)
@pytest.mark.parametrize("part", AROUND)
def test_around(frame, part):
    for before, after in ((AROUND[part], ""), ("", AROUND[part]), (AROUND[part], AROUND[part])):
        inner = FRAMES[frame].format(before, MARKED, after)
        if part == "header" and frame in ("article", "main"):  # within an article, the headings of a header are its own
            inner = before + FRAMES[frame].format("", MARKED, "") + after
        page = f"<html><head><title>T, t, t</title></head><body>{inner}</body></html>"
        assert main_text(page) == "\n".join(BODY)


@pytest.mark.parametrize("frame", FRAMES)
def test_all_around(frame):
    every, inner = "".join(AROUND.values()), "".join(v for k, v in AROUND.items() if k != "header")
    assert main_text(f"<body>{every}{FRAMES[frame].format(inner, MARKED, inner)}{every}") == "\n".join(BODY)


def test_own_header():
    assert main_text("<article><header><h1>T</h1><p>By someone, today</p></header><p>a, b</p></article>") == "T\na, b"


def test_parts_of_an_article():
    assert main_text("<article><section><p>a, b</p></section><section><p>c</p></section></article>") == "a, b\nc"
    assert main_text("<body><p>Only one.</p></body>") == "Only one."
    assert main_text("Just text,\n of a   page") == "Just text, of a page"
    assert main_text('<div class="has-sidebar"><p>x</p></div>') == "x"
    assert main_text('<form id="all"><article><p>in a form</p></article></form>') == "in a form"


def test_nothing():
    for page in (None, "", " ", "<", "<p>", "</p>", "<!--", "<p", "<nav><a href=a>x</a></nav>", "<div class=ad>buy, buy</div>"):
        assert main_text(page) in ("", "<")


def test_references():
    assert main_text("<p>&#" + "9" * 5000 + "; &#00000000000000000065; &lt;b&gt; &copy 1&nbsp;2 &#xD800; &unknown;") == "� A <b> © 1 2 � &unknown;"


@pytest.mark.parametrize("page", ["<div>" * 200_000 + "x", "<p>a, b" * 200_000, "<!--" * 200_000, '<a href="' * 200_000, "<p class='x' title=\">" * 100_000,
                                  "</div>" * 200_000, "<p>" + "<b>" * 100_000 + "x", "<table>" * 2000 + "<td>x" * 20_000, "<script>" * 100_000,
                                  "<p><button>" + "<div>" * 100_000, "&#" * 300_000, "<p>" + "y " * 2_000_000])
def test_long_and_broken(page):
    assert isinstance(main_text(page), str)


def test_edges(spark):
    schema = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
    df = spark.createDataFrame([(1, "u", None), (None, None, ""), (2, "u", "<p>é</p>"), (2, "u", "<p>é</p>")], schema)
    df = df.selectExpr(*df.columns, "1 as x", "2 as y").toDF(*df.columns, "HTML", "text")
    assert sorted(map(str, extract(df).collect())) == sorted(map(str, [
        *spark.createDataFrame([(1, "u", "", 0), (None, None, "", 0), (2, "u", "é", 1), (2, "u", "é", 1)], "page_id long, url string, text string, n_chars long").collect()]))
    assert extract(spark.createDataFrame([], schema)).collect() == []
