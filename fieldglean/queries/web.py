"""Web pages to nodes and fields."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldglean.functions import scalars as S
from fieldglean.operators import html
from fieldglean.plans import registry
from fieldglean.queries import query
from fieldglean.rules.sites import rule
from fieldglean.session import spread
from fieldglean.sources.readers import table, web_pages

_UNESCAPE = "replace(replace(replace(replace(replace({}, '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#x27;', ''''), '&amp;', '&')"


def _pages(spark, sf):
    return spread(web_pages(table(spark, sf, "pages")).select("page_id", "html"))


@query("html_title_h1", f"""
    SELECT page_id, trim({_UNESCAPE.format("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title,
           trim({_UNESCAPE.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) AS h1 FROM pages""")
def html_title_h1(spark, sf):
    rules = [rule("any", "title", "/html/head/title"), rule("any", "h1", "/html/body/article/h1")]
    return _fields(spark, sf, rules, ["title", "h1"])


def _fields(spark, sf, rules, fields):
    return html.page_fields(html.matched_nodes(_pages(spark, sf), rules, site="any"), ["page_id"], fields, F.col("value"))


@query("html_links", f"""
    SELECT page_id, CAST(n AS INTEGER) AS link_no, 'https://example.com' || {_UNESCAPE.format("hrefs[n]")} AS href
    FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages), unnest(generate_series(1, len(hrefs))) AS u(n)""")
def html_links(spark, sf):
    nodes = html.html_nodes(_pages(spark, sf), tags=["a"])
    found = html.links(nodes, ["page_id"], "https://example.com")
    # The links of one page: a small group whatever the number of pages.
    parts = F.sort_array(F.collect_list(F.struct("node_id", "href")))
    per_page = found.groupBy("page_id").agg(parts.alias("l"))
    return per_page.select("page_id", F.posexplode("l").alias("n", "l")).select(
        "page_id", (F.col("n") + 1).alias("link_no"), F.col("l.href").alias("href"))


@query("html_nav_labels", f"""
    SELECT page_id, CAST(n AS INTEGER) AS item, {_UNESCAPE.format("labels[n]")} AS label
    FROM (SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>([^<]*)</a></li>', 1) AS labels FROM pages),
         unnest(generate_series(1, len(labels))) AS u(n)""")
def html_nav_labels(spark, sf):
    nodes = html.html_nodes(_pages(spark, sf), tags=["a"])
    step = F.array_position("tags", "li").cast("int")
    items = nodes.filter(F.array_join("tags", "/") == "html/body/nav/ul/li/a")
    return items.select("page_id", F.element_at("idx", step).alias("item"), S.strip("text").alias("label"))


@query("html_fallback_owner", f"""
    WITH t AS (SELECT page_id, trim({_UNESCAPE.format("regexp_extract(html, '<h1>(.*?)</h1>', 1)")}) AS h1,
                      trim({_UNESCAPE.format("regexp_extract(html, '<title>(.*?)</title>', 1)")}) AS title FROM pages)
    SELECT page_id, coalesce(nullif(h1, ''), nullif(title, ''), 'NOT FOUND') AS result,
           CASE WHEN title = '' THEN 'NOT IMPLEMENTED' ELSE split_part(title, '//', 1) END AS franchise_found FROM t""")
def html_fallback_owner(spark, sf):
    """The entity with its owner: the heading, or the title where there is none."""
    rules = [rule("any", "entity", "/html/head/title"), rule("any", "owner", "/html/body/article/h1"),
             rule("any", "owner", "/html/head/title", priority=2)]
    found = table(spark, sf, "pages").select("page_id").join(_fields(spark, sf, rules, ["entity", "owner"]), "page_id", "left")
    text = F.concat_ws("//", "entity", F.coalesce("owner", F.lit("NOT FOUND")))
    return found.select("page_id", S.pair(text).alias("p")).select("page_id", "p.result", "p.franchise_found")


@query("html_presence", """
    SELECT page_id, contains(html, 'class="ad"') AS has_ad, NOT contains(lower(html), 'listing not found or unavailable') AS available
    FROM pages""")
def html_presence(spark, sf):
    pages = _pages(spark, sf)
    nodes = html.html_nodes(pages, tags=["div"], content=[])
    marked = nodes.filter(F.col("attrs")["class"] == "ad").select("page_id").distinct().withColumn("has_ad", F.lit(True))
    gone = F.contains(F.lower("html"), F.lit("listing not found or unavailable"))
    return pages.join(marked, "page_id", "left").select(
        "page_id", F.coalesce("has_ad", F.lit(False)).alias("has_ad"), F.coalesce(~gone, F.lit(True)).alias("available"))


@query("page_language", """
    SELECT page_id, regexp_extract(html, '<html lang="([^"]*)"', 1) AS value FROM pages WHERE contains(html, '<html lang="')""")
def page_language(spark, sf):
    return registry.attribute(_pages(spark, sf), "/html", "lang").filter("value is not null")


@query("page_script_value", """
    SELECT page_id, regexp_extract(html, 'track\\(([0-9]+)\\)', 1) AS value FROM pages WHERE regexp_matches(html, 'track\\([0-9]+\\)')""")
def page_script_value(spark, sf):
    """A number that a script of the page passes on."""
    return registry.script_value(_pages(spark, sf), r"track\(([0-9]+)\)")


@query("pages_with_heading", """
    SELECT page_id FROM pages WHERE contains(html, '<article><h1>')""")
def pages_with_heading(spark, sf):
    return registry.has_node(_pages(spark, sf), "/html/body/article/h1").select("page_id")


@query("listing_availability", """
    SELECT p_partkey, p_size <= 40 AS available FROM part""")
def listing_availability(spark, sf):
    """Detail pages of parts; those of large ones show in their first heading that they are gone, or show no heading."""
    p = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_size"))
    head = F.when(F.col("p_size") > 40, F.lit(S.GONE)).when(F.col("p_size") > 5, F.col("p_name"))
    markup = F.concat(F.lit("<html><body>"), F.coalesce(F.concat(F.lit("<h1> "), head, F.lit("</h1>")), F.lit("")), F.lit("<p>text</p></body></html>"))
    pages = p.select(F.col("p_partkey").alias("page_id"), markup.alias("html"))
    first = html.page_fields(html.matched_nodes(pages, [rule("any", "head", "/html/body/h1")], site="any"), ["page_id"], ["head"], F.col("value"))
    return p.join(first, F.col("p_partkey") == F.col("page_id"), "left").select("p_partkey", S.available("head").alias("available"))
