"""Pages past the pattern for plain markup against the parser alone, and how often a job parses its pages."""

import random

from pagebuilder import Page

from fieldglean.operators import html
from fieldglean.plans import listing_jobs, listings

PIECES = ["<div>", '<div id="x">', "<div id=x>", "</div>", "<p>", "</p>", '<b id="">', "</b>", "text", "a &amp; b", "a & b", "&lt", "&am", "<br>", "<br/>", "<li>",
          "</li>", "<ul>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<!-- c -->", "<!--", "<!DOCTYPE html>", "<!doctype x", "<?pi?>", "<script>",
          'var a="</p>";', "</script>", "<title>", "</title>", "< ", "<", ">", '"', '<a href="u?a=1&amp;b=2" ID="X">', '<A CLASS="c"  id="x">', "</ p>", "</p x>",
          "</>", "<![odd[", "\n", '<P Id="x"\n>', '<span a="<b>">', "<x:y>", "<i/>", "<textarea>", "\x00", '<p a="1" a="2" id="">']


def nodes(page, paths, parser_only, monkeypatch):
    with monkeypatch.context() as m:
        if parser_only:
            m.setattr(html._Reader, "read", lambda self, text: (self.feed(text), self.close(), self.close_to(0)))
        try:
            return list(html._nodes(page, lambda tag: tag in ("p", "b", "div"), lambda tag: tag != "b", html._Paths(paths) if paths else None))
        except (AssertionError, ValueError, LookupError, NotImplementedError) as e:
            return type(e).__name__


def test_plain_markup_gives_what_the_parser_gives(monkeypatch):
    rng = random.Random(8)
    for _ in range(3000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 25)))
        paths = rng.choice([None, {"": ["div/p", "div", "table/tr/td"], "x": ["", "b", "div/p"]}])
        assert nodes(page, paths, False, monkeypatch) == nodes(page, paths, True, monkeypatch), page


def test_paths_of_many_deep_elements():
    page = "<i>" * 60 + "".join(f"<b><u id='{n}'>{n}</u></b>" for n in range(3000))
    rows = list(html._nodes(page, lambda tag: tag == "u", lambda tag: False))
    assert [(len(r[3]), r[4][-2], r[5][-2], r[6]) for r in rows] == [(62, n + 1, 3000 - n, [{"id": str(n), "depth": 62}]) for n in range(3000)]


def parses(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")


def test_a_listing_page_is_parsed_once(spark):
    pages = spark.createDataFrame([("l", "<p>x</p>")], "page_id string, html string")
    assert parses(listings.murphy_listings(pages)) == 1
    assert parses(listings.labelled_blocks(pages)) == 1
    given = pages.withColumnRenamed("page_id", "url")
    assert parses(listing_jobs.site_records(given, given, "murphybusiness", 2024)) == 2


def test_rows_without_text_and_text_without_rows(spark):
    """Labels hold over a row, from one to the next: rows that show no field are none, rows without a paragraph have no blocks."""
    base = '//*[@id="list_div"]/div[1]/div'
    p = Page()
    for n, title in ((4, "Bakery"), (5, "Bar"), (6, None)):
        if title:
            p.put(f"{base}[{n}]/h2[1]/a[1]", title, href=f"/m{n}")
    p.put(f"{base}[4]/div[4]/p[1]", "first").put(f"{base}[4]/div[4]/strong[1]", "Category").put(f"{base}[6]/div[4]/p[1]", "alone")
    for n in (1, 2, 3):
        p.at(f"{base}[4]/div[{n}]")
    got = listings.murphy_listings(spark.createDataFrame([("l", p.html()), (None, p.html())], "page_id string, html string")).orderBy("page_id", "row").collect()
    assert [(r.page_id, r.title, r.description, r.category) for r in got] == [
        (None, "Bakery", None, None), (None, "Bar", None, None), ("l", "Bakery", "first", ""), ("l", "Bar", None, None)]
