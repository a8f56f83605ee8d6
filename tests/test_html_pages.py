"""Large, deep and broken pages in the step that reads them."""

from pyspark.sql import functions as F

from fieldglean.operators import html
from fieldglean.rules.sites import rule


def test_a_page_that_cannot_be_read_leaves_the_others_alone(spark):
    pages = spark.createDataFrame([(1, "<p>one</p>"), (2, "<p>x</p><![odd[ y"), (3, None), (4, ""), (5, "<p>five</p>")], "page_id int, html string")
    got = {r.page_id: r.text for r in html.html_nodes(pages, tags=["p"]).collect()}
    assert got == {1: "one", 5: "five"}
    assert [(r.page_id, "odd" in r.error) for r in html.page_errors(pages).collect()] == [(2, True)]
    fields = html.page_fields(html.matched_nodes(pages, [rule("any", "p", "/p")], site="any"), ["page_id"], ["p"], F.col("value"))
    assert sorted((r.page_id, r.p) for r in fields.collect()) == [(1, "one"), (5, "five")]


def test_a_page_of_many_elements_leaves_in_batches(spark):
    n = 3 * html.BATCH_NODES + 5
    pages = spark.createDataFrame([(1, "<ul>" + "".join(f"<li>{i}</li>" for i in range(n)) + "</ul>"), (2, "<ul><li>z</li></ul>")], "page_id int, html string")
    found = html.html_nodes(pages, tags=["li"])
    rows = found.groupBy("page_id").agg(F.count("*").alias("n"), F.max(F.element_at("idx", -1)).alias("last"),
                                        F.min(F.element_at("from_end", -1)).alias("end")).collect()
    assert sorted((r.page_id, r.n, r.last, r.end) for r in rows) == [(1, n, n, 1), (2, 1, 1, 1)]


def test_open_tags_in_great_depth_and_ends_without_a_start():
    none = lambda tag: False
    assert list(html._nodes("<span>" * 30_000 + "</b>" * 30_000, none, none)) == []
    rows = list(html._nodes("<i>" * 3_000 + "<b id='x'>t</b>", lambda tag: tag == "b", lambda tag: True))
    assert len(rows) == 1 and len(rows[0][3]) == 3_001 and rows[0][6] == [{"id": "x", "depth": 3_001}] and rows[0][9] == "t"


def test_paths_below_ids_and_from_the_root():
    paths = html._Paths({"": ["div/p"], "x": ["", "b"]})
    page = "<div><p>1</p><b>2</b></div><div id=x>3<b>4</b><p>5<b id=x>6</b></p></div>"
    rows = list(html._nodes(page, None, lambda tag: True, paths))
    assert [(r[2], r[9]) for r in rows] == [("p", "1"), ("div", "3456"), ("b", "4"), ("p", "56"), ("b", "6")]
