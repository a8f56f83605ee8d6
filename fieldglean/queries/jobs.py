"""Listing jobs over two runs of pages that Spark derives from the given tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldglean.plans import listing_jobs, listings
from fieldglean.queries import query
from fieldglean.rules.sites import BIZMLS_DETAIL
from fieldglean.session import spread
from fieldglean.sources.readers import table


def _text(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _gather(rows, page, order: str, before: str, after: str):
    """Pages of rows: ``page`` names the page of a row, which bounds their number on a page."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("k"), F.col("row").alias("v"))))
    body = F.array_join(F.transform(parts, lambda p: p["v"]), "")
    return rows.groupBy(page.alias("url")).agg(_text(before, body, after).alias("html"))


def _flippers_pages(parts, price: Column):
    """Listing pages of 50 parts each, and a detail page per part."""
    key = F.col("p_partkey")
    row = _text('<tr id="', key, '" onclick="go(\'u/', key, '\')"><td></td><td><a>', F.col("p_name"), "</a></td><td>", F.col("p_brand"), "</td><td>$",
                F.format_number(price, 0), "</td><td></td><td>", F.col("p_type"), "</td><td>S", F.col("p_size"), "</td></tr>")
    page = _text("list/", F.floor(key / 50))
    listed = _gather(parts.withColumn("row", row), page, "p_partkey",
                     '<html><body><div id="listing-tables"><div><div><table><tbody>', "</tbody></table></div></div></div></body></html>")
    markup = _text('<html><body><div id="listings-details-top"><div><div></div><div></div><div></div><div></div><div><div><h4>Annual Gross Revenue</h4>'
                   "<h4>Is it a seasonal business</h4><h5>$", F.col("p_size"), "K</h5><h5>", F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("No"),
                   "</h5></div></div><div></div><div><div><div><p>", F.col("p_size"), ' weeks</p></div></div></div></div></div><div id="contents-listings"><p>About ',
                   F.col("p_name"), "</p></div></body></html>")
    return listed, parts.select(_text("u/", key).alias("url"), markup.alias("html"))


@query("listing_job_runs", """
    WITH p AS (SELECT CAST(p_partkey AS VARCHAR) AS listing_number, p_name AS title, p_brand AS category, p_type AS county,
                      'S' || CAST(p_size AS VARCHAR) AS state, CAST(floor(p_retailprice) AS BIGINT) AS price, p_size FROM part),
         v AS (SELECT *, price AS asking_price, 1 AS version_no, 1 AS run, p_size > 10 AND p_size <= 25 AS on_sale FROM p WHERE p_size <= 40
               UNION ALL SELECT *, price + 1, CASE WHEN p_size <= 40 THEN 2 ELSE 1 END, 2, true FROM p WHERE p_size > 25)
    SELECT listing_number, title, category, county, state, asking_price, '$' || CAST(p_size AS VARCHAR) || 'K' AS annual_gross_revenue,
           CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS seasonal_business, CAST(p_size AS VARCHAR) || ' weeks' AS training,
           'About ' || title AS description, CAST(NULL AS VARCHAR) AS employees, CAST(NULL AS VARCHAR) AS value_of_inventory,
           CAST(NULL AS VARCHAR) AS value_of_assets, CAST(NULL AS VARCHAR) AS business_category, CAST(NULL AS VARCHAR) AS business_operates_from,
           CAST(NULL AS VARCHAR) AS years, CAST(NULL AS VARCHAR) AS annual_net_profit, version_no, run, on_sale FROM v""")
def listing_job_runs(spark, sf):
    """Two runs of a listing site: small parts go, large ones come, and the price of those above the middle changes."""
    parts = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))
    price = F.floor("p_retailprice")
    first = _flippers_pages(parts.filter("p_size <= 40"), price)
    store = listing_jobs.run_site(None, *first, "franchiseflippers", 1, 2024)
    second = _flippers_pages(parts.filter("p_size > 10"), F.when(F.col("p_size") > 25, price + 1).otherwise(price))
    return listing_jobs.run_site(store, *second, "franchiseflippers", 2, 2024).drop("checksum")


def _murphy_pages(parts, status: Column):
    """Listing pages of 50 parts each, three blocks before the rows, and a detail page per part."""
    key, size = F.col("p_partkey"), F.col("p_size")
    cell = lambda *x: _text("<li><span>", *x, "</span></li>")
    row = _text('<div><h2><a href="m/', key, '">', F.col("p_name"), "</a></h2><div></div><div><ul>", cell(status), "<li></li></ul><ul>", cell(F.col("p_type")),
                cell("$", F.format_number("p_retailprice", 2)), cell("M", key), "</ul><ul><li></li><li></li>", cell("$", size, ",000"),
                "</ul></div><div></div><div><strong>Business Category</strong><p>", F.col("p_brand"), "</p><strong>About</strong><p>Size ", size,
                "</p><p> now</p></div></div>")
    listed = _gather(parts.withColumn("row", row), _text("list/", F.floor(key / 50)), "p_partkey",
                     '<html><body><div id="list_div"><div><div></div><div></div><div></div>', "</div></div></body></html>")
    markup = _text("<html><body><div></div><div></div><div><div><div><div></div><div><div></div><div><div></div><div></div><div></div><div><ul><li><ul>",
                   cell("$", size, ".50"), cell("Yes"), "</ul></li><li></li><li></li><li><ul><li></li><li></li>", cell("$", key), cell(F.col("p_brand")),
                   "</ul></li></ul></div></div></div></div></div></div></body></html>")
    return listed, parts.select(_text("m/", key).alias("url"), markup.alias("html"))


_MURPHY_TEXT = ["relocatable", "account_rec_incl", "inventory_incl", "liabilities_incl", "real_estate_incl", "ff_and_e_incl", "other_incl", "leasehold_incl"]
_MURPHY_MONEY = ["down_payment", "discretionary_earnings", "inventory", "liabilities", "real_estate", "ff_and_e", "other", "leasehold"]


@query("murphy_job_runs", f"""
    WITH v AS (SELECT *, 'Open' AS status, 1 AS version_no, 1 AS run, p_size > 10 AND p_size <= 25 AS on_sale FROM part WHERE p_size <= 40
               UNION ALL SELECT *, 'Sold', CASE WHEN p_size <= 40 THEN 2 ELSE 1 END, 2, true FROM part WHERE p_size > 25)
    SELECT 'M' || CAST(p_partkey AS VARCHAR) AS listing_number, p_name AS title, status, p_type AS state, round(p_retailprice, 2) AS price,
           p_size * 1000.0 AS total_sales, p_brand AS category, 'Size ' || CAST(p_size AS VARCHAR) || 'now' AS description, p_size + 0.5 AS account_rec,
           CAST(p_partkey AS DOUBLE) AS total_assets, p_brand AS total_assets_incl, {", ".join(
               ["'Yes' AS account_rec_incl" if c == "account_rec_incl" else f"CAST(NULL AS VARCHAR) AS {c}" for c in _MURPHY_TEXT]
               + [f"CAST(NULL AS DOUBLE) AS {c}" for c in _MURPHY_MONEY])}, version_no, run, on_sale FROM v""")
def murphy_job_runs(spark, sf):
    """Two runs of a site whose rows hold labelled text blocks: small parts go, large ones come, those above the middle are sold."""
    parts = spread(table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"))
    store = listing_jobs.run_site(None, *_murphy_pages(parts.filter("p_size <= 40"), F.lit("Open")), "murphybusiness", 1, 2024)
    second = _murphy_pages(parts.filter("p_size > 10"), F.when(F.col("p_size") > 25, "Sold").otherwise("Open"))
    return listing_jobs.run_site(store, *second, "murphybusiness", 2, 2024).drop("checksum")


def _resales_pages(suppliers, lines, flag: str, town: Column):
    """A page per supplier with a link per flag its lines show, and a page per link."""
    sold = lines.groupBy("l_suppkey", flag).agg(F.count("*").alias("n"), F.max("l_quantity").cast("int").alias("most"))
    sold = sold.withColumn("url", _text("u/", F.col("l_suppkey"), "/", F.col(flag)))
    links = sold.withColumn("row", _text("<div><div></div><div><span></span><span></span><span></span><span><a href=\"", F.col("url"), "\">more</a></span></div></div>"))
    # A handful of flags per supplier, whatever the number of its lines.
    per = F.sort_array(F.collect_list(F.struct(flag, "row")))
    links = links.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.array_join(F.transform(per, lambda p: p["row"]), "").alias("links"))
    s = suppliers.join(links, "s_suppkey", "left")
    parents = s.select(_text("s/", F.col("s_suppkey")).alias("url"), _text(
        '<html><body><b id="span-175-52363">', F.col("s_name"), '</b><div id="code_block-64-52363"><div><blockquote><ul><li>Founded: 1990</li><li>Locations: ',
        F.col("s_nationkey"), "</li><li>x: 1</li><li>Headquarters: ", town, '</li></ul></blockquote></div></div><div id="shortcode-190-52363"><div>',
        F.coalesce("links", F.lit("")), "</div></div></body></html>").alias("html"))
    children = sold.select("url", _text('<html><body><b id="shortcode-9-52280">Outlet ', F.col(flag), '</b><b id="shortcode-19-52280">', F.col("n"),
                                        '</b><b id="shortcode-317-52379">', F.col("most"), "</b></body></html>").alias("html"))
    return parents, children


@query("parent_child_runs", """
    WITH s AS (SELECT s_suppkey, s_name, s_acctbal >= 0 AS a, s_acctbal < 5000 AS b, s_acctbal < 2500 AS moved,
                      CAST(s_nationkey AS VARCHAR) AS n FROM supplier WHERE s_acctbal >= 0 OR s_acctbal < 5000),
         i AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY md5(s_name), s_name) + CASE WHEN a THEN 0 ELSE (SELECT count(*) FROM s WHERE a) END AS id FROM s),
         c AS (SELECT l_suppkey, l_returnflag AS f, true AS old, count(*) AS c, CAST(max(l_quantity) AS INTEGER) AS m FROM lineitem GROUP BY 1, 2
               UNION ALL SELECT l_suppkey, l_linestatus, false, count(*), CAST(max(l_quantity) AS INTEGER) FROM lineitem GROUP BY 1, 2)
    SELECT id, s_name AS title, CASE WHEN b AND moved THEN 'City ' ELSE 'Town ' END || n AS headquarters, n AS locations,
           CASE WHEN a AND b AND moved THEN 2 ELSE 1 END AS version_no, b AS on_sale, 'u/' || CAST(l_suppkey AS VARCHAR) || '/' || f AS url,
           'Outlet ' || f AS outlet, CAST(c AS VARCHAR) AS asking_price, CAST(m AS VARCHAR) AS employees
    FROM i LEFT JOIN c ON l_suppkey = s_suppkey AND old = NOT b""")
def parent_child_runs(spark, sf):
    """Two runs over franchises and the outlets they link: ids stay, outlets of those seen again are replaced, some have moved."""
    s = spread(table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"))
    lines = table(spark, sf, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus", "l_quantity")
    town = _text("Town ", F.col("s_nationkey"))
    first = _resales_pages(s.filter("s_acctbal >= 0"), lines, "l_returnflag", town)
    store = listing_jobs.run_resales(None, *first, 1, 2024)
    moved = F.when(F.col("s_acctbal") < 2500, _text("City ", F.col("s_nationkey"))).otherwise(town)
    store = listing_jobs.run_resales(store, *_resales_pages(s.filter("s_acctbal < 5000"), lines, "l_linestatus", moved), 2, 2024)
    latest = store.parents.groupBy("title").agg(F.max("version_no").alias("version_no"))
    parents = store.parents.join(latest, ["title", "version_no"]).join(store.ids, "title")
    outlets = store.children.select(F.col("parent_id").alias("id"), "url", F.col("title").alias("outlet"), "asking_price", "employees")
    return parents.select("id", "title", "headquarters", "locations", "version_no", "on_sale").join(outlets, "id", "left")


@query("member_list", """
    SELECT 'm/' || CAST(floor(s_suppkey / 50) AS BIGINT) AS page_id,
           CAST(row_number() OVER (PARTITION BY floor(s_suppkey / 50) ORDER BY s_suppkey) AS INTEGER) AS pos,
           s_name AS member, CASE WHEN s_acctbal > 0 THEN 'Gold' END AS member_type FROM supplier""")
def member_list(spark, sf):
    """Members of a directory, 50 suppliers a page; some show no type."""
    key = F.col("s_suppkey")
    kind = F.when(F.col("s_acctbal") > 0, "<span>Gold</span>").otherwise("")
    rows = table(spark, sf, "supplier").withColumn("row", _text("<li><div></div><div><div><a>", F.col("s_name"), "</a></div><div></div><div>", kind, "</div></div></li>"))
    pages = _gather(rows, _text("m/", F.floor(key / 50)), "s_suppkey", '<html><body><ul id="members-list">', "</ul></body></html>")
    return listings.member_names(pages.withColumnRenamed("url", "page_id"))


@query("last_pages", """
    SELECT c_custkey AS page_id, CAST(c_nationkey AS VARCHAR) AS last_page FROM customer""")
def last_pages(spark, sf):
    """The last but one item of a page list is its last page, a link or a plain number."""
    c = spread(table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    tag = F.when(F.col("c_acctbal") > 0, "a").otherwise("span")
    markup = _text("<ul><li><span>0</span></li><li><", tag, ">", F.col("c_nationkey"), "</", tag, "></li><li><a>next</a></li></ul>")
    return listings.list_last_page(c.select(F.col("c_custkey").alias("page_id"), markup.alias("html")))


@query("handler_links", f"""
    SELECT p_partkey, '{BIZMLS_DETAIL[0]}' || CAST(p_partkey AS VARCHAR) || '{BIZMLS_DETAIL[1]}' AS link FROM part""")
def handler_links(spark, sf):
    """Addresses of detail pages out of click handlers."""
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    handler = _text("open('x.asp?name=", F.col("p_name"), "&LIST_NUMBER=", F.col("p_partkey"), "&gen_hp=1&gen_hp=2')")
    return p.select("p_partkey", listings.bizmls_link(handler).alias("link"))
