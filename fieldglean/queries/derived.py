"""Whole jobs over document and web pages that Spark derives from the given tables.

The derived pages grow with the tables: a document holds the contacts of 60 customers, so more
customers make more documents, not longer ones.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import functions as F

from fieldglean.operators import snapshots
from fieldglean.plans import contacts, listings, registry, surface_area
from fieldglean.queries import query
from fieldglean.rules.contacts import CONTACT_COLUMNS
from fieldglean.session import parallelism, spread
from fieldglean.sources.readers import table

_HOW_TO = "What's it like to be a franchisee? Exhibit F lists current ones. What else should I know?"
_CONTENTS = "Table of Contents\nExhibit A Agreement\nExhibit F List of Franchisees"
_HEADING = "Exhibit F\nCurrent outlets"


# One layout of each family: entry on a page, with {i} the customer, {n} its nation, {z} its zip code, {p} four digits, and what the
# layout reads from it, in the same terms.
_LAYOUTS = [
    ("special_regex_16", "Shop{i}\n{i} MainStreet\nTown{n}, IL {z}\ncontact: Bob{i}\nphone: (555) 555-{p}\n",
     {"franchise_name": "Shop{i}", "address": "{i} MainStreet", "city": "Town{n}", "state": "IL", "zipcode": "{z}", "owner_name": " Bob{i}", "phone": "(555) 555-{p}"}),
    ("table_columns_3", "Owner{i}\n{i}MainStreet\nTown{n}\nIL\n{z}\n(555) 555-{p}\n",
     {"address": "{i}MainStreet", "city": "Town{n}", "state": "IL", "zipcode": "{z}", "phone": "(555) 555-{p}"}),
    ("blocks_14", "Owner{i} Foods\n{i} MainStreet\nTown{n}, IL {z} \nBob{i} Example \n(555) 555-{p}\nbob{i}@example.com\n",
     {"franchise_name": "", "address": "Owner{i} Foods@{i} MainStreet", "city": "Town{n},", "state": "IL", "zipcode": "{z}", "owner_name": "Bob{i} Example ",
      "phone": "(555) 555-{p}", "email": "bob{i}@example.com"}),
    ("columns_6", "IL\nTown{n}\n{i} Title\n{i} MainStreet\n{z}\n(555) 555-{p}\nShop{i}\n",
     {"franchise_name": "Shop{i}", "address": "{i} MainStreet", "city": "Town{n}", "state": "IL", "zipcode": "{z}", "title": "Title", "phone": "(555) 555-{p}"}),
    ("paragraphs_3", "Bob{i}, (Shop{i}) {i} MainStreet, Town{n}, IL {z}, (555) 555-{p}\n",
     {"franchise_name": "(Shop{i})", "address": "{i} MainStreet", "city": "Town{n}", "state": "IL", "zipcode": "{z}", "phone": "(555) 555-{p}"}),
    ("table_blocks_3", "Town{n} IL \n(555) 555-{p} \nOwner: Bob{i} \n", {"city": "Town{n}", "state": "IL", "phone": "(555) 555-{p}"}),
    ("lines_2", "Bob{i}\nTown{n}, IL \nShop{i}\n(555) 555-{p}\n", {"franchise_name": "Shop{i}", "city": "Town{n}", "state": "IL", "phone": "(555) 555-{p}"}),
    ("table_without_lines_3", "Shop{i}\n{i} MainStreet\nTown{n}\nIL \n{z}\nUSA\n(555) 555-{p} \nbob@example.com\n",
     {"address": "{i} MainStreet", "city": "Town{n}", "state": "IL", "phone": "(555) 555-{p}", "email": "bob@example.com"}),
]
_TERMS = {"i": "CAST(c_custkey AS VARCHAR)", "n": "CAST(c_nationkey AS VARCHAR)", "z": "CAST(10000 + c_custkey % 80000 AS VARCHAR)",
          "p": "lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')"}


def _filled(template: str) -> str:
    """A template as an SQL expression that Spark and the SQL text share."""
    parts = re.split(r"\{(\w)\}", template)
    return " || ".join(_TERMS[x] if k % 2 else "'" + x.replace("\n", "\\n") + "'" for k, x in enumerate(parts) if k % 2 or x) or "''"


def _contact_pages(spark, sf):
    """60 customers per document, 20 per page, behind a how-to page, the contents and a heading page; a layout family per document."""
    c = spread(table(spark, sf, "customer")).select("c_custkey", "c_name", "c_nationkey", F.floor(F.col("c_custkey") / 60).alias("number"))
    entries = [F.expr(_filled(text).replace("VARCHAR", "STRING")) for _, text, _ in _LAYOUTS]
    entry = reduce(lambda chain, e: chain.when(F.pmod("number", F.lit(len(_LAYOUTS))) == e[0], e[1]), enumerate(entries), F)
    c = c.select(F.concat(F.lit("d"), F.col("number").cast("string"), F.lit("-fdd.pdf")).alias("doc"),
                 (F.floor(F.pmod("c_custkey", F.lit(60)) / 20) + 6).cast("int").alias("page"), "c_custkey", entry.alias("entry"))
    parts = F.sort_array(F.collect_list(F.struct(F.col("c_custkey").alias("k"), F.col("entry").alias("e"))))
    listed = c.groupBy("doc", "page").agg(F.array_join(F.transform(parts, lambda p: p["e"]), "").alias("text"))
    front = [(0, _HOW_TO), (1, _CONTENTS), (2, "body"), (3, "body"), (4, "body"), (5, _HEADING), (9, "The end")]
    fixed = F.array(*[F.struct(F.lit(p).alias("page"), F.lit(t).alias("text")) for p, t in front])
    pages = c.select("doc").distinct().select("doc", F.inline(fixed)).unionByName(listed)
    return pages.repartition(parallelism(spark), "doc", "page")


def _contacts_sql() -> str:
    number = f"(c_custkey // 60) % {len(_LAYOUTS)}"
    case = lambda values: " ".join(f"WHEN {number} = {i} THEN {v}" for i, v in enumerate(values) if v is not None)
    columns = {"fdd_name": "'d' || CAST(c_custkey // 60 AS VARCHAR) || '-fdd.pdf'", "method": "'regex'",
               "regex": f"CASE {case([repr(name) for name, _, _ in _LAYOUTS])} END"}
    for c in CONTACT_COLUMNS:
        values = [_filled(fields[c]) if c in fields else None for _, _, fields in _LAYOUTS]
        columns.setdefault(c, f"CASE {case(values)} END" if any(v is not None for v in values) else "CAST(NULL AS VARCHAR)")
    return "SELECT " + ", ".join(f"{columns[c]} AS {c}" for c in CONTACT_COLUMNS) + " FROM customer"


@query("contact_list_rows", _contacts_sql())
def contact_list_rows(spark, sf):
    """Locate the exhibit, the list page and the layout, then read the contacts: all stored columns, a layout of each family."""
    rows, _ = contacts.extract_contacts(_contact_pages(spark, sf))
    return rows.select(*CONTACT_COLUMNS)


# Pages of documents that end in each of the other outcomes.
_OTHER_ENDS = {1: ["body", "table of contents\nnothing listed"], 2: ["abc", "def"],
               3: [_HOW_TO, _CONTENTS, "body", "body", "body", _HEADING + " " + "no contacts at all " * 8, "The end"]}


@query("contact_outcomes", """
    SELECT CASE (c_custkey // 60) % 4 WHEN 0 THEN 'regex' WHEN 1 THEN 'exceptions' WHEN 2 THEN 'franchisees not found' ELSE 'invalid methods' END AS outcome,
           CAST(count(DISTINCT c_custkey // 60) AS BIGINT) AS count FROM customer GROUP BY 1""")
def contact_outcomes(spark, sf):
    """Every fourth document holds a list; the others break off, name no list, or name one that no layout reads."""
    pages = _contact_pages(spark, sf).withColumn("end", F.pmod(F.regexp_extract("doc", r"d(\d+)-", 1).cast("bigint"), F.lit(4)))
    docs = pages.select("doc", "end").distinct()
    others = [docs.filter(F.col("end") == e).select("doc", F.posexplode(F.array(*map(F.lit, texts))).alias("page", "text")) for e, texts in _OTHER_ENDS.items()]
    both = reduce(lambda a, b: a.unionByName(b), others, pages.filter("end = 0").select("doc", "page", "text"))
    _, outcome = contacts.extract_contacts(both)
    return outcome.groupBy("outcome").agg(F.count("*").alias("count"))


@query("surface_area_per_document", """
    WITH a AS (SELECT o_orderkey, o_custkey + 100 AS lo, o_orderstatus AS s, o_orderpriority = '1-URGENT' AS more, o_custkey AS k FROM orders),
         v AS (SELECT o_orderkey, CASE WHEN s = 'P' THEN CASE WHEN more THEN k + 300 ELSE k + 900 END ELSE lo END AS lo,
                      CASE WHEN s <> 'P' AND NOT more THEN CASE WHEN s = 'F' THEN k + 1200 ELSE lo END
                           WHEN s = 'F' THEN k + 1200 ELSE k + 900 END AS hi FROM a)
    SELECT CAST(o_orderkey AS VARCHAR) AS doc, CAST(lo AS VARCHAR) || ' sq. ft.' AS area_min, CAST(hi AS VARCHAR) || ' sq. ft.' AS area_max,
           CAST((lo + hi) // 2 AS VARCHAR) || CASE WHEN (lo + hi) % 2 = 0 THEN '.0' ELSE '.5' END || ' sq. ft.' AS area_mid, 'done' AS outcome
    FROM v""")
def surface_area_per_document(spark, sf):
    """Four pages per order: text, an area by status, another one for urgent orders, a last one."""
    k = lambda n: F.format_number(F.col("o_custkey") + n, 0)
    first = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("from "), k(100), F.lit(" to\n"), k(1200), F.lit(" square feet")))
             .when(F.col("o_orderstatus") == "O", F.concat(k(100), F.lit(" sq. ft."))).otherwise("none"))
    second = F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("or "), k(300), F.lit(" square foot"))).otherwise("stop")
    texts = F.array(F.lit("intro"), first, second, F.concat(k(900), F.lit(" sq. ft.")))
    pages = spread(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")).select(F.col("o_orderkey").cast("string").alias("doc"), F.posexplode(texts).alias("page", "text"))
    return surface_area.surface_areas(pages)


def _listing_pages(spark, sf):
    """A listing page per part."""
    n = lambda c: F.format_number(c, 0)
    markup = F.concat(
        F.lit("<html><head></head><body><div></div><div><div></div><div><div><h1>"), F.col("p_name"),
        F.lit("</h1><div></div><div></div><div><div></div><div><b>Asking Price:</b><b>$"), n(F.floor("p_retailprice")),
        F.lit("</b><b>Gross Revenue:</b><b>"), F.col("p_size").cast("string"), F.lit("K</b></div></div><dl><dt>Location:</dt><dd>Town "),
        F.col("p_size").cast("string"), F.lit(", "), F.col("p_type"), F.lit("</dd><dt>Number of Employees:</dt><dd>"),
        n(F.col("p_size") * 100), F.lit(" people</dd><dt>Other:</dt><dd>x</dd></dl><dl><dt>ID:</dt><dd>"), F.col("p_partkey").cast("string"),
        F.lit("</dd><dt>Relocatable:</dt><dd>"), F.when(F.col("p_size") < 25, "Yes").otherwise("No"), F.lit("</dd></dl></div></div></div></body></html>"))
    return spread(table(spark, sf, "part")).select(F.col("p_partkey").alias("page_id"), markup.alias("html"))


@query("listing_page_records", """
    SELECT p_partkey AS page_id, p_name AS title, CAST(floor(p_retailprice) AS BIGINT) AS asking_price, CAST(p_size AS BIGINT) * 1000 AS gross_revenue,
           'Town ' || CAST(p_size AS VARCHAR) AS city, p_type AS state, CAST(p_size AS BIGINT) * 100 AS number_of_employees,
           CAST(p_partkey AS VARCHAR) AS listing_number, CASE WHEN p_size < 25 THEN 'Yes' ELSE 'No' END AS relocatable,
           CAST(NULL AS DOUBLE) AS ebitda FROM part""")
def listing_page_records(spark, sf):
    """Detail pages of a site to clean records by paths and label tables."""
    rec = listings.detail_records(_listing_pages(spark, sf), "bizquest", 2024)
    return rec.select("page_id", "title", "asking_price", "gross_revenue", "city", "state", "number_of_employees", "listing_number",
                      "relocatable", F.col("ebitda").cast("double").alias("ebitda"))


@query("listing_page_versions", """
    WITH r AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS run, CAST(count(*) AS BIGINT) // 20 AS asking_price FROM lineitem GROUP BY 1, 2),
         c AS (SELECT *, lag(asking_price) OVER w AS p, row_number() OVER w AS rn FROM r WINDOW w AS (PARTITION BY l_suppkey ORDER BY run))
    SELECT CAST(l_suppkey AS VARCHAR) AS listing_number, run, asking_price,
           CAST(row_number() OVER (PARTITION BY l_suppkey ORDER BY run) AS INTEGER) AS version_no
    FROM c WHERE rn = 1 OR p IS DISTINCT FROM asking_price""")
def listing_page_versions(spark, sf):
    """A page per supplier and year (the run), read by the rules of a site, versioned by checksum."""
    # The pages are few bytes but much parsing, so they are spread by number, not by size.
    per_run = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("run")).agg(F.floor(F.count("*") / 20).alias("price"))
    per_run = per_run.repartition(parallelism(spark), "l_suppkey", "run")
    markup = F.concat(F.lit('<html><body><div id="wrap"><section></section><section><div><div><div><div><div></div><div><h2>Shop</h2><div></div><div></div>'
                            "<div><div><div><ul><li>Listing: "), F.col("l_suppkey").cast("string"), F.lit("</li><li>Price: $"),
                      F.format_number("price", 0), F.lit("</li></ul></div></div></div></div></div></div></div></div></section></div></body></html>"))
    # The site shows its sections directly under the body.
    markup = F.replace(F.replace(markup, F.lit('<div id="wrap">'), F.lit("")), F.lit("</section></div></body>"), F.lit("</section></body>"))
    pages = per_run.select((F.col("l_suppkey") * 10000 + F.col("run")).alias("page_id"), markup.alias("html"))
    rec = listings.detail_records(pages, "wesellrestaurants", 2024)
    runs = rec.select(F.col("listing_number").cast("string"), F.pmod("page_id", F.lit(10000)).cast("int").alias("run"), "asking_price", "title")
    return snapshots.versions(runs, "listing_number", "run", ["title", "asking_price"]).select("listing_number", "run", "asking_price", "version_no")


@query("register_owners", """
    WITH s AS (SELECT s_suppkey, s_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT s_suppkey AS page_id, 'Michigan' AS state, 'Shop ' || CAST(s_suppkey AS VARCHAR) AS franchise_found, s_name AS result FROM s WHERE r_name = 'AFRICA'
    UNION ALL SELECT s_suppkey, 'Texas', 'NOT IMPLEMENTED', s_name FROM s WHERE r_name = 'AMERICA'
    UNION ALL SELECT s_suppkey, 'Idaho', 'Shop ' || CAST(i AS VARCHAR), s_name || CAST(i AS VARCHAR) FROM s, range(1, 4) t(i) WHERE r_name = 'ASIA'
    UNION ALL SELECT s_suppkey, 'Hawaii', 'Shop', s_name FROM s WHERE r_name = 'EUROPE'""")
def register_owners(spark, sf):
    """Result pages of five states to (entity, owner) pairs; the fifth is inactive and gives nothing."""
    s = (table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    name, key = F.col("s_name"), F.col("s_suppkey").cast("string")
    row = lambda i: F.concat(F.lit(f"<tr><td><div><span>Shop {i}</span></div></td><td></td><td></td><td><span>"), name, F.lit(f"{i}</span></td></tr>"))
    pages = {
        "AFRICA": ("Michigan", F.concat(F.lit('<b id="MainContent_lblEntityNameHeader">Shop '), key, F.lit('</b><b id="MainContent_lblResidentAgentName"> '), name, F.lit("</b>"))),
        "AMERICA": ("Texas", F.concat(F.lit('<table><tbody id="trDetailsBody"><tr><td><b>Date</b></td><td>x</td></tr><tr><td><b>Registered Agent Name</b></td><td>'),
                                      name, F.lit("</td></tr></tbody></table>"))),
        "ASIA": ("Idaho", F.concat(F.lit('<div id="root"><div><div><div><main><div></div><div><table><tbody>'), *[row(i) for i in range(1, 5)],
                                   F.lit("</tbody></table></div></main></div></div></div></div>"))),
        "EUROPE": ("Hawaii", F.concat(F.lit('<div id="body-container"><main><div><div><h1>Shop</h1></div></div></main></div><div id="general"><section><div></div><div><div></div><div>'
                                            "<dl><dt>STATUS</dt><dd>ok</dd><dt>AGENT NAME</dt><dd>"), name, F.lit("</dd></dl></div></div></section></div>"))),
        "MIDDLE EAST": ("Louisiana", F.concat(F.lit('<i id="ctl00_cphContent_lblStatus">Inactive</i><i id="ctl00_cphContent_lblName">'), name, F.lit("</i>"))),
    }
    state = markup = None
    for region, (st, m) in pages.items():
        hit = F.col("r_name") == region
        state = F.when(hit, st) if state is None else state.when(hit, st)
        markup = F.when(hit, m) if markup is None else markup.when(hit, m)
    src = s.select(F.col("s_suppkey").alias("page_id"), state.alias("state"), F.concat(F.lit("<html><body>"), markup, F.lit("</body></html>")).alias("html"))
    return registry.owner_pairs(src).drop("pos")
