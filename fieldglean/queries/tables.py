"""Profiling, joins, keyed updates, windows and snapshots over the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldglean.functions.scalars import row_total, to_bool_null_true, to_int, to_number
from fieldglean.operators import ordered, profile, relational, snapshots
from fieldglean.queries import query
from fieldglean.sources.readers import table


def dec(c):
    """Exact sums: two decimals are what the price columns hold."""
    return F.col(c).cast("decimal(18,2)")


@query("join_filter_explode_top10", """
    SELECT token, CAST(count(*) AS BIGINT) AS count FROM (
        SELECT unnest(string_split(p_name, ' ')) AS token
        FROM lineitem LEFT JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag = 'R' AND year(l_shipdate) >= 1996 AND year(l_shipdate) < 2000)
    WHERE token IS NOT NULL GROUP BY token ORDER BY count DESC, token LIMIT 10""")
def join_filter_explode_top10(spark, sf):
    """Left join, filter by flag and half-open year range, explode, count, top 10."""
    lines = table(spark, sf, "lineitem")
    # A bound of the column's own type keeps the column bare, so the range reaches the parquet scan.
    day = lambda text: F.lit(text).cast(lines.schema["l_shipdate"].dataType)
    lines = lines.filter((F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= day("1996-01-01"))
                         & (F.col("l_shipdate") < day("2000-01-01"))).select("l_partkey")
    # Counting per key before the join shrinks what meets the dimension to one row per part.
    per_part = lines.groupBy("l_partkey").agg(F.count("*").alias("n"))
    named = per_part.join(table(spark, sf, "part").select("p_partkey", "p_name"),
                          F.col("l_partkey") == F.col("p_partkey"), "left")
    tokens = named.select("n", F.explode(F.split("p_name", " ")).alias("token"))
    counts = tokens.groupBy("token").agg(F.sum("n").alias("count"))
    return profile.top_k(counts, 10, F.desc("count"), "token")


@query("title_ratings_left_join", """
    SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS priority_no,
           TRY_CAST(o_orderpriority AS DOUBLE) AS priority_bad,
           coalesce(TRY_CAST(n_lines AS DOUBLE) <> 0, true) AS flag,
           CAST(n_lines AS DOUBLE) AS n_lines, CAST(qty AS DOUBLE) AS qty
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty FROM lineitem
                           WHERE l_returnflag = 'A' GROUP BY 1) ON o_orderkey = l_orderkey""")
def title_ratings_left_join(spark, sf):
    totals = (table(spark, sf, "lineitem").filter("l_returnflag = 'A'").groupBy("l_orderkey")
              .agg(F.count("*").alias("n_lines"), F.sum("l_quantity").cast("bigint").alias("qty")))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return orders.join(totals, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        "o_orderkey", to_number(F.split_part("o_orderpriority", F.lit("-"), F.lit(1))).alias("priority_no"),
        to_number("o_orderpriority").alias("priority_bad"), to_bool_null_true("n_lines").alias("flag"),
        F.col("n_lines").cast("double").alias("n_lines"), F.col("qty").cast("double").alias("qty"))


@query("value_counts", """
    SELECT event_type, CAST(count(*) AS BIGINT) AS count FROM events
    WHERE event_type IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1""")
def value_counts(spark, sf):
    return profile.value_counts(table(spark, sf, "events"), "event_type")


@query("counts_by_year", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS count FROM orders
    WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 1996 AND year(o_orderdate) < 2001 GROUP BY 1 ORDER BY 1""")
def counts_by_year(spark, sf):
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    kept = o.filter((F.col("o_orderstatus") == "F") & (F.col("year") >= 1996) & (F.col("year") < 2001))
    return profile.counts_in_order(kept, "year")


@query("explode_top_k", """
    SELECT token, CAST(count(*) AS BIGINT) AS count FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part)
    GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")
def explode_top_k(spark, sf):
    counts = profile.explode_counts(table(spark, sf, "part"), F.split("p_name", " "), "token")
    return profile.top_k(counts, 10, F.desc("count"), "token")


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("describe_numeric", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, CAST(count({c}) AS BIGINT) AS cnt, round(avg({c}), 4) AS mean,
           round(stddev_samp({c}), 4) AS std, round(min({c}), 4) AS min, round(quantile_cont({c}, 0.25), 4) AS q25,
           round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75,
           round(max({c}), 4) AS max FROM lineitem""" for c in _NUMERIC))
def describe_numeric(spark, sf):
    return profile.describe(table(spark, sf, "lineitem").select(*_NUMERIC), _NUMERIC, digits=4)


_CUST_ORD = ["c_custkey", "c_name", "o_orderkey", "o_orderstatus", "o_totalprice"]
_CUST_ORD_SQL = "FROM customer LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'P') ON c_custkey = o_custkey"


def _customers_with_orders(spark, sf):
    orders = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    return table(spark, sf, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(*_CUST_ORD)


@query("null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count(*) - count({c}) AS BIGINT) AS nulls {_CUST_ORD_SQL}" for c in _CUST_ORD))
def null_counts(spark, sf):
    return profile.null_counts(_customers_with_orders(spark, sf))


@query("table_info", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS data_type, CAST(count({c}) AS BIGINT) AS non_null, "
    f"CAST(count(*) AS BIGINT) AS total {_CUST_ORD_SQL}"
    for c, t in zip(_CUST_ORD, ("bigint", "string", "bigint", "string", "double"))))
def table_info(spark, sf):
    return profile.table_info(_customers_with_orders(spark, sf))


@query("histogram_50", """
    WITH e AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
         c AS (SELECT CAST(least(floor((o_totalprice - lo) / (hi - lo) * 50), 49) AS INTEGER) AS bin,
                      count(*) AS n FROM orders, e GROUP BY 1)
    SELECT CAST(b AS INTEGER) AS bin, CAST(coalesce(n, 0) AS BIGINT) AS count
    FROM range(50) r(b) LEFT JOIN c ON b = bin""")
def histogram_50(spark, sf):
    return profile.histogram(table(spark, sf, "orders"), "o_totalprice", 50)


@query("snapshot_versions", """
    WITH r AS (SELECT user_id, CAST(day(ts) AS INTEGER) AS run, arg_max(event_type, (ts, event_id)) AS event_type,
                      arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2),
         l AS (SELECT *, lag(event_type) OVER w AS pt, lag(value) OVER w AS pv, row_number() OVER w AS rn FROM r
               WINDOW w AS (PARTITION BY user_id ORDER BY run))
    SELECT user_id, run, event_type, value,
           CAST(row_number() OVER (PARTITION BY user_id ORDER BY run) AS INTEGER) AS version_no
    FROM l WHERE rn = 1 OR pt IS DISTINCT FROM event_type OR pv IS DISTINCT FROM value""")
def snapshot_versions(spark, sf):
    return snapshots.versions(_listing_runs(spark, sf), "user_id", "run", ["event_type", "value"]).drop("checksum")


def _listing_runs(spark, sf):
    """A user is a listing, a day is a run, the day's last event is the record."""
    e = table(spark, sf, "events").select("user_id", F.dayofmonth("ts").alias("run"), "event_type", "value",
                                          F.struct("ts", "event_id").alias("at"))
    return snapshots.one_per_run(e, "user_id", "run", "at").drop("at")


@query("snapshot_current", """
    WITH r AS (SELECT user_id, CAST(day(ts) AS INTEGER) AS run, arg_max(event_type, (ts, event_id)) AS event_type,
                      arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1, 2),
         l AS (SELECT *, lag(event_type) OVER w AS pt, lag(value) OVER w AS pv, row_number() OVER w AS rn FROM r
               WINDOW w AS (PARTITION BY user_id ORDER BY run)),
         v AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY run) AS version_no FROM l
               WHERE rn = 1 OR pt IS DISTINCT FROM event_type OR pv IS DISTINCT FROM value),
         seen AS (SELECT user_id, max(run) AS last_seen FROM r GROUP BY 1)
    SELECT user_id, arg_max(v.run, version_no) AS run, arg_max(event_type, version_no) AS event_type,
           arg_max(value, version_no) AS value, CAST(max(version_no) AS INTEGER) AS version_no,
           any_value(last_seen) = (SELECT max(run) FROM r) AS on_sale
    FROM v JOIN seen USING (user_id) GROUP BY 1""")
def snapshot_current(spark, sf):
    return snapshots.current(_listing_runs(spark, sf), "user_id", "run", ["event_type", "value"]).drop("checksum")


@query("latest_per_key", """
    SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey,
           arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS o_orderstatus FROM orders GROUP BY 1""")
def latest_per_key(spark, sf):
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return snapshots.versions_from_store(o, "o_custkey", "o_orderdate", "o_orderkey").select(
        "o_custkey", "o_orderkey", "o_orderstatus")


@query("first_n_active", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R'
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) <= 3""")
def first_n_active(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    order = ["l_linenumber", "l_partkey", "l_suppkey"]
    return ordered.first_n(lines, ["l_orderkey"], order, 3, F.col("l_returnflag") == "R").drop("l_returnflag")


@query("first_n_then_active", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (
        SELECT * FROM lineitem
        QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) <= 5)
    WHERE l_returnflag = 'R'""")
def first_n_then_active(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_returnflag"]
    return ordered.first_n(lines, ["l_orderkey"], order, 5, F.col("l_returnflag") == "R",
                           limit_first=True).drop("l_returnflag")


@query("first_active_position", """
    SELECT l_orderkey, CAST(coalesce(min(CASE WHEN l_returnflag = 'R' THEN l_linenumber END), -1) AS INTEGER) AS line
    FROM lineitem GROUP BY 1""")
def first_active_position(spark, sf):
    return ordered.first_position(table(spark, sf, "lineitem"), ["l_orderkey"], "l_linenumber",
                                  F.col("l_returnflag") == "R", "line")


@query("header_lookup_pivot", """
    SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS lines,
           CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1, 2""")
def header_lookup_pivot(spark, sf):
    """Yearly figures laid out as table cells under a header of years, read back by header: all years of the data, a row each."""
    per_year = (table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("y"))
                .agg(F.count("*").alias("lines"), F.sum("l_quantity").cast("bigint").alias("quantity")))
    cell = lambda row, text: F.struct(F.lit(row).alias("row_no"), F.col("y").alias("col_no"),
                                      text.cast("string").alias("text"))
    cells = per_year.select("l_suppkey", F.inline(F.array(
        cell(0, F.col("y")), cell(1, F.format_number("lines", 0)), cell(2, F.format_number("quantity", 0)))))
    found = ordered.header_lookup(cells, ["l_suppkey"])
    return found.groupBy("l_suppkey", F.col("title").cast("int").alias("year")).agg(
        *[F.max(F.when(F.col("row_no") == i, to_int("text"))).alias(m) for i, m in ((1, "lines"), (2, "quantity"))])


@query("promote_header", """
    SELECT l_suppkey, l_returnflag AS flag, CAST(count(*) AS VARCHAR) AS lines,
           CAST(CAST(sum(l_quantity) AS BIGINT) AS VARCHAR) AS quantity FROM lineitem GROUP BY 1, 2""")
def promote_header(spark, sf):
    """Tables of cells, one per supplier, whose first row holds the column names."""
    body = (table(spark, sf, "lineitem").groupBy("l_suppkey", "l_returnflag")
            .agg(F.count("*").alias("n"), F.sum("l_quantity").cast("bigint").alias("q")))
    names = ["flag", "lines", "quantity"]
    cells = lambda row, texts: F.inline(F.array(*[
        F.struct(row.alias("row_no"), F.lit(i).alias("col_no"), t.cast("string").alias("text")) for i, t in enumerate(texts)]))
    head = body.select("l_suppkey").distinct().select("l_suppkey", cells(F.lit(0), [F.lit(n) for n in names]))
    rows = body.select("l_suppkey", cells(F.ascii("l_returnflag"), [F.col("l_returnflag"), F.col("n"), F.col("q")]))
    return relational.promote_header(head.unionByName(rows), "l_suppkey", names).drop("row_no")


@query("upsert_contacts", """
    WITH ex AS (SELECT c_mktsegment AS fdd_name, CAST(c_custkey AS VARCHAR) AS phone, c_name AS owner_name, '' AS title
                FROM customer WHERE c_acctbal > 0),
         inc AS (SELECT c_mktsegment AS fdd_name, CASE WHEN o_orderstatus = 'P' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS phone,
                        'order ' || CAST(o_orderkey AS VARCHAR) AS owner_name, o_orderpriority AS title, o_orderkey AS row_no
                 FROM orders JOIN customer ON o_custkey = c_custkey),
         upd AS (SELECT i.fdd_name, i.phone, arg_max(i.owner_name, row_no) AS owner_name, arg_max(i.title, row_no) AS title
                 FROM inc i JOIN ex USING (fdd_name, phone) WHERE i.phone <> '' GROUP BY 1, 2)
    SELECT fdd_name, phone, coalesce(u.owner_name, e.owner_name) AS owner_name, coalesce(u.title, e.title) AS title
    FROM ex e LEFT JOIN upd u USING (fdd_name, phone)
    UNION ALL
    SELECT fdd_name, phone, owner_name, title FROM inc i
    WHERE phone = '' OR NOT EXISTS (SELECT 1 FROM ex e WHERE e.fdd_name = i.fdd_name AND e.phone = i.phone)""")
def upsert_contacts(spark, sf):
    cust = table(spark, sf, "customer")
    seg, key = F.col("c_mktsegment").alias("fdd_name"), F.col("c_custkey").cast("string").alias("phone")
    existing = cust.filter("c_acctbal > 0").select(seg, key, F.col("c_name").alias("owner_name"), F.lit("").alias("title"))
    orders = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    incoming = orders.select(
        seg, F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("phone"),
        F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("owner_name"),
        F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("row_no"))
    return relational.upsert(existing, incoming, ["fdd_name", "phone"], "row_no", F.col("phone") != "")


@query("keyed_update", """
    SELECT d.doc_id, d.lang, CASE WHEN l.doc_id IS NULL THEN 'No' ELSE 'Yes' END AS labelled,
           CASE WHEN l.doc_id IS NULL THEN 'No' WHEN l.quality = 1 THEN 'Yes' ELSE 'No' END AS good
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def keyed_update(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    results = table(spark, sf, "labels").select(
        "doc_id", F.lit("Yes").alias("hit"), F.when(F.col("quality") == 1, "Yes").otherwise("No").alias("good"), "quality")
    return relational.update_columns(docs, results, "doc_id", {"labelled": "hit", "good": "good"}, "quality", "No")


@query("set_flags", """
    SELECT o_orderkey, CASE WHEN hit THEN 'Yes' ELSE o_orderstatus END AS has_contacts,
           CASE WHEN hit THEN 'No' ELSE o_orderpriority END AS scrape_contacts
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, true AS hit FROM lineitem WHERE l_returnflag = 'R')
      ON o_orderkey = l_orderkey""")
def set_flags(spark, sf):
    flags = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderstatus").alias("has_contacts"),
                                              F.col("o_orderpriority").alias("scrape_contacts"))
    keys = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return relational.set_flags(flags, keys, "o_orderkey", {"has_contacts": "Yes", "scrape_contacts": "No"})


@query("process_status", """
    SELECT user_id AS process_group, event_type AS process, arg_max(props, (ts, event_id)) AS details,
           strftime(max(ts), '%Y-%m-%d') AS last_day FROM events GROUP BY 1, 2""")
def process_status(spark, sf):
    runs = table(spark, sf, "events").select(
        F.col("user_id").alias("process_group"), F.col("event_type").alias("process"), F.col("props").alias("details"),
        F.struct("ts", "event_id").alias("at"))
    half = F.lit("2024-01-15").cast(table(spark, sf, "events").schema["ts"].dataType)
    merged = relational.latest_status(runs.filter(F.col("at.ts") < half), runs.filter(F.col("at.ts") >= half),
                                      ["process_group", "process"], "at")
    return merged.select("process_group", "process", "details", F.date_format("at.ts", "yyyy-MM-dd").alias("last_day"))


@query("lookup_enrich", """
    SELECT s_suppkey, s_name, coalesce(n_name, '') AS n_name FROM supplier
    LEFT JOIN (SELECT n_nationkey, n_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name <> 'ASIA')
      ON s_nationkey = n_nationkey""")
def lookup_enrich(spark, sf):
    known = table(spark, sf, "nation").join(
        table(spark, sf, "region").filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
    supp = table(spark, sf, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("n_nationkey"))
    return relational.lookup(supp, known.select("n_nationkey", "n_name"), "n_nationkey", "n_name", "n_name").select(
        "s_suppkey", "s_name", "n_name")


@query("parent_child_replace", """
    WITH p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'),
         m AS (SELECT l_orderkey AS parent_id, l_partkey AS child FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM p)
               UNION ALL SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'P')
    SELECT parent_id, CAST(count(*) AS BIGINT) AS children, CAST(sum(child) AS BIGINT) AS child_sum FROM m GROUP BY 1""")
def parent_child_replace(spark, sf):
    parents = table(spark, sf, "orders").filter("o_orderstatus = 'P'")
    children = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("parent_id"), F.col("l_partkey").alias("child"))
    fresh = parents.select(F.col("o_orderkey").alias("parent_id"), F.col("o_custkey").alias("child"))
    merged = relational.replace_children(children, fresh, fresh, "parent_id")
    return merged.groupBy("parent_id").agg(F.count("*").alias("children"), F.sum("child").alias("child_sum"))


@query("skip_processed", """
    SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = toxic)""")
def skip_processed(spark, sf):
    yn = lambda c: F.when(F.col(c) == 1, "Yes").otherwise("No")
    flags = table(spark, sf, "labels").select("doc_id", yn("quality").alias("has_contacts"), yn("toxic").alias("scrape_contacts"))
    return relational.skip_processed(table(spark, sf, "documents").select("doc_id", "source"), flags, "doc_id")


@query("exists_in_table", """
    SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def exists_in_table(spark, sf):
    done = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf, "customer").select("c_custkey", "c_name").join(done, "c_custkey", "left_semi")


@query("union_by_name_index", """
    SELECT CAST(row_number() OVER (ORDER BY src, k) - 1 AS BIGINT) AS "#", name, segment, balance_cents FROM (
        SELECT 'customer' AS src, c_custkey AS k, c_name AS name, c_mktsegment AS segment,
               CAST(round(c_acctbal * 100) AS BIGINT) AS balance_cents FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_name, NULL, CAST(round(s_acctbal * 100) AS BIGINT) FROM supplier)""")
def union_by_name_index(spark, sf):
    cents = lambda c: F.round(F.col(c) * 100).cast("bigint").alias("balance_cents")
    cust = table(spark, sf, "customer").select(F.lit("customer").alias("src"), F.col("c_custkey").alias("k"),
                                               F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"), cents("c_acctbal"))
    supp = table(spark, sf, "supplier").select(cents("s_acctbal"), F.lit("supplier").alias("src"),
                                               F.col("s_name").alias("name"), F.col("s_suppkey").alias("k"))
    merged = relational.union_by_name(cust, supp)
    numbered = relational.number_rows(merged, ["src"], F.col("k"), 1_000_000, "#")
    return numbered.select("#", "name", "segment", "balance_cents")


@query("contiguous_ids", """
    SELECT CAST(row_number() OVER (ORDER BY source, doc_id) - 1 + 1000 AS BIGINT) AS id, source, doc_id FROM documents""")
def contiguous_ids(spark, sf):
    docs = table(spark, sf, "documents").select("source", "doc_id")
    return relational.number_rows(docs, ["source"], F.col("doc_id"), 1_000_000, "id", offset=1000)


@query("move_rows", """
    SELECT CASE WHEN event_type = 'error' THEN 'discarded' ELSE 'active' END AS kept_in, event_type,
           CAST(count(*) AS BIGINT) AS count FROM events GROUP BY 1, 2""")
def move_rows(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    active, discarded = relational.move_rows(events, events.limit(0), F.col("event_type") == "error")
    both = active.withColumn("kept_in", F.lit("active")).unionByName(discarded.withColumn("kept_in", F.lit("discarded")))
    return both.groupBy("kept_in", "event_type").agg(F.count("*").alias("count"))


@query("seeded_sample", """
    SELECT doc_id FROM documents ORDER BY md5('seed-7' || CAST(doc_id AS VARCHAR)), doc_id LIMIT 100""")
def seeded_sample(spark, sf):
    return relational.pick_random(table(spark, sf, "documents").select("doc_id"), "doc_id", "seed-7", 100)


@query("row_totals", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
           CAST(coalesce(CASE WHEN l_returnflag <> 'N' THEN l_quantity END, 0) + coalesce(CASE WHEN l_linestatus = 'O' THEN l_linenumber END, 0)
                + coalesce(NULL, 0) AS BIGINT) AS total,
           (SELECT CASE WHEN count(CASE WHEN l_returnflag <> 'N' THEN l_quantity END) = 0 THEN 1 ELSE 0 END + 1 FROM lineitem) AS all_null
    FROM lineitem""")
def row_totals(spark, sf):
    line = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity").cast("bigint")).alias("a"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("bigint")).alias("b"),
        F.lit(None).cast("bigint").alias("c"))
    empty = profile.all_null_columns(line, ["a", "c"]).scalar()
    return line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", row_total("a", "b", "c").alias("total"),
                       empty.alias("all_null"))


@query("rule_lookup", """
    SELECT n_name, r_name, CASE r_name WHEN 'ASIA' THEN 'table' WHEN 'EUROPE' THEN 'label' ELSE 'path' END AS extractor
    FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('ASIA', 'EUROPE', 'AMERICA')
    ORDER BY r_name, n_name""")
def rule_lookup(spark, sf):
    rules = spark.createDataFrame([("ASIA", "table"), ("EUROPE", "label"), ("AMERICA", "path")], "r_name string, extractor string")
    nations = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    known = nations.filter(F.col("r_name").isin("ASIA", "EUROPE", "AMERICA"))
    return known.join(F.broadcast(rules), "r_name").select("n_name", "r_name", "extractor").orderBy("r_name", "n_name")


@query("exhibit_choice", """
    WITH b AS (SELECT DISTINCT p_size, p_brand FROM part),
         a AS (SELECT p_size, list(p_brand ORDER BY length(p_brand), p_brand) AS brands FROM b GROUP BY 1)
    SELECT p_size, CASE WHEN list_contains(brands, 'Brand#' || CAST(p_size AS VARCHAR)) THEN 'Brand#' || CAST(p_size AS VARCHAR)
                        ELSE brands[1] END AS chosen, array_to_string(brands, ',') AS sorted FROM a""")
def exhibit_choice(spark, sf):
    """The wanted value if the list holds it, else its first entry by (length, text)."""
    lists = table(spark, sf, "part").groupBy("p_size").agg(
        F.collect_set(F.struct(F.length("p_brand").alias("n"), F.col("p_brand").alias("x"))).alias("s"))
    brands = F.transform(F.array_sort("s"), lambda s: s["x"])
    wanted = F.concat(F.lit("Brand#"), F.col("p_size").cast("string"))
    return lists.withColumn("brands", brands).select(
        "p_size", F.when(F.array_contains("brands", wanted), wanted).otherwise(F.get("brands", F.lit(0))).alias("chosen"),
        F.array_join("brands", ",").alias("sorted"))


@query("listing_detail", """
    SELECT o_orderkey, o_orderpriority AS category, CAST(round(o_totalprice * 100) AS BIGINT) AS price_cents,
           l_linenumber, l_partkey, l_suppkey FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY')""")
def listing_detail(spark, sf):
    """Listing columns carried into the detail rows of the listed keys."""
    keys = table(spark, sf, "customer").filter("c_mktsegment = 'MACHINERY'").select(F.col("c_custkey").alias("o_custkey"))
    listing = table(spark, sf, "orders").join(keys, "o_custkey", "left_semi").select(
        "o_orderkey", F.col("o_orderpriority").alias("category"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("price_cents"))
    detail = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey")
    return listing.join(detail, "o_orderkey")


@query("forward_fill_category", """
    WITH d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag FROM lineitem),
         f AS (SELECT *, last_value(CASE WHEN l_returnflag = 'R' THEN l_partkey END IGNORE NULLS) OVER (
                   PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS head FROM d)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(head AS DOUBLE) AS head FROM f WHERE l_returnflag <> 'R'""")
def forward_fill_category(spark, sf):
    """Rows flagged R head a group; the rows after them carry their part number."""
    d = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag").alias("at"))
    filled = ordered.fill_forward(d, ["l_orderkey"], "at", F.when(F.col("l_returnflag") == "R", F.col("l_partkey")), "head",
                                  bucket=[F.col("l_linenumber"), F.floor(F.col("l_partkey") / 100_000)])
    return filled.filter("l_returnflag <> 'R'").drop("at", "l_returnflag").withColumn("head", F.col("head").cast("double"))


@query("outcome_totals", """
    SELECT event_type AS outcome, CAST(count(*) AS BIGINT) AS count,
           (SELECT CAST(count(*) AS BIGINT) FROM events WHERE event_type <> 'view') AS total
    FROM events WHERE event_type <> 'view' GROUP BY 1""")
def outcome_totals(spark, sf):
    kept = table(spark, sf, "events").filter(~F.contains("event_type", F.lit("view")))
    counts = kept.groupBy(F.col("event_type").alias("outcome")).agg(F.count("*").alias("count"))
    return counts.withColumn("total", counts.agg(F.sum("count")).scalar())
