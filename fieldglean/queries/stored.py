"""Queries that write tables of the given rows to the shared folder and read them back through the library's readers and stores."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldglean.operators import relational, snapshots
from fieldglean.queries import query
from fieldglean.session import cut, scratch
from fieldglean.sources import csv_folder, stores, writers
from fieldglean.sources.readers import file_inventory, from_manifest, number_folder_rows, of_type, read_csv_folder, read_delimited, read_keys, read_log, table


def _orders_folder(spark, sf):
    """Orders as CSV files of three layouts: unquoted with some rows of a field too many, with quoted line breaks, with columns missing."""
    folder = scratch(spark, "csv-folder")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    key, customer = F.col("o_orderkey").alias("order_key"), F.col("o_custkey").alias("customer")
    status = lambda s: o.filter(F.col("o_orderstatus") == s)
    loose = F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 7 == 0, ",extra").otherwise("")).alias("customer")
    status("F").select(key, loose).write.option("header", True).option("quote", "\u0000").csv(folder)
    note = F.concat(F.lit('first "'), "o_orderpriority", F.lit('"\nsecond, '), F.col("o_custkey").cast("string")).alias("note")
    writers.write_csv(status("O").select(note, key, customer), folder, "append")
    writers.write_csv(status("P").select(key, F.col("o_orderpriority").alias("note")), folder, "append")
    return folder


@query("csv_folder_rows", """
    SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey AS VARCHAR) END AS customer,
           CASE o_orderstatus WHEN 'O' THEN 'first "' || o_orderpriority || '"' || chr(10) || 'second, ' || CAST(o_custkey AS VARCHAR)
                              WHEN 'P' THEN o_orderpriority END AS note
    FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 7 <> 0""")
def csv_folder_rows(spark, sf):
    return read_csv_folder(spark, _orders_folder(spark, sf))[0].drop(*csv_folder.MARKS)


@query("csv_folder_left_out", """
    SELECT 'row with another number of fields than the header' AS reason, CAST(count(*) AS BIGINT) AS n
    FROM orders WHERE o_orderstatus = 'F' AND o_orderkey % 7 = 0 HAVING count(*) > 0""")
def csv_folder_left_out(spark, sf):
    return read_csv_folder(spark, _orders_folder(spark, sf))[1].groupBy("reason").agg(F.sum("n").alias("n"))


@query("csv_folder_numbers", """
    SELECT row_number() OVER (ORDER BY o_orderkey) + 99 AS id FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 7 <> 0""")
def csv_folder_numbers(spark, sf):
    """Contiguous numbers over the rows of all files, whichever row has which. Counts and numbers both read the rows, so they are written once."""
    return number_folder_rows(cut(read_csv_folder(spark, _orders_folder(spark, sf))[0]), "id", 100).select("id")


@query("snapshot_log_runs", """
    WITH r AS (SELECT user_id, least(CAST(floor((day(ts) - 1) / 10) AS INTEGER) + 1, 3) AS run, arg_max(event_type, (ts, event_id)) AS event_type
               FROM events GROUP BY 1, 2),
         l AS (SELECT *, lag(event_type) OVER w AS p, row_number() OVER w AS rn FROM r WINDOW w AS (PARTITION BY user_id ORDER BY run)),
         v AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY run) AS n FROM l WHERE rn = 1 OR p <> event_type),
         s AS (SELECT user_id, max(run) = 3 AS seen FROM r GROUP BY 1), m AS (SELECT user_id, max(n) AS last FROM v GROUP BY 1)
    SELECT user_id, CAST(n AS INTEGER) AS version_no, run, event_type, seen AND n = last AS on_sale
    FROM v JOIN s USING (user_id) JOIN m USING (user_id)""")
def snapshot_log_runs(spark, sf):
    """Three runs, a third of a month each, into a log of versions: a user is a listing, the last event of a run its record."""
    e = table(spark, sf, "events").select("user_id", F.least(F.floor((F.dayofmonth("ts") - 1) / 10) + 1, F.lit(3)).cast("int").alias("run"), "event_type",
                                          F.struct("ts", "event_id").alias("at"))
    runs = cut(snapshots.one_per_run(e, "user_id", "run", "at").drop("at"))
    root = scratch(spark, "snapshot-log")
    for n in (1, 2, 3):
        stores.log_run(root, runs.filter(F.col("run") == n).drop("run"), "user_id", n, ["event_type"])
    return stores.logged_versions(spark, root, "user_id").drop("checksum")


@query("upsert_table_batches", """
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
def upsert_table_batches(spark, sf):
    """Contacts of customers, then those of all orders, into a table of files."""
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name", "c_acctbal")
    seg, phone = F.col("c_mktsegment").alias("fdd_name"), F.col("c_custkey").cast("string").alias("phone")
    key, live, root = ["fdd_name", "phone"], F.col("phone") != "", scratch(spark, "upsert-table")
    existing = cust.filter("c_acctbal > 0").select(seg, phone, F.col("c_name").alias("owner_name"), F.lit("").alias("title"), F.lit(0).alias("row_no"))
    stores.upsert_table(root, existing.repartitionByRange("fdd_name", F.col("phone").cast("long")), key, "row_no", live, "customers")
    orders = table(spark, sf, "orders").join(cust, F.col("o_custkey") == F.col("c_custkey"))
    incoming = orders.select(seg, F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_custkey").cast("string")).alias("phone"),
                             F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("owner_name"),
                             F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("row_no"))
    stores.upsert_table(root, incoming, key, "row_no", live, "orders")
    return stores.read_table(spark, root)


@query("log_messages", """
    SELECT event_type || ' - user ' || CAST(user_id AS VARCHAR) AS message, count(*) AS n FROM events GROUP BY 1""")
def log_messages(spark, sf):
    """A log with a line per event, read back without what precedes the first separator."""
    path = scratch(spark, "log")
    e = table(spark, sf, "events").select("ts", "event_type", "user_id")
    e.select(F.concat_ws(" - ", F.col("ts").cast("string"), "event_type", F.concat(F.lit("user "), F.col("user_id").cast("string")))).write.text(path)
    return read_log(spark, path).groupBy("message").agg(F.count("*").alias("n"))


@query("key_list_lookup", """
    SELECT p_partkey, p_name FROM part WHERE p_brand IN (SELECT p_brand FROM part WHERE p_size > 45)""")
def key_list_lookup(spark, sf):
    """Parts of the brands on a list of keys, a CSV with a header."""
    path, part = scratch(spark, "keys"), table(spark, sf, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    writers.write_csv(part.filter("p_size > 45").select("p_brand").distinct(), path)
    return part.join(read_keys(spark, path), "p_brand", "left_semi").select("p_partkey", "p_name")


@query("manifest_files", """
    SELECT o_orderstatus AS status, o_orderstatus <> 'P' AS listed FROM orders GROUP BY 1""")
def manifest_files(spark, sf):
    """Files of a folder by status, and whether a manifest names them."""
    folder = scratch(spark, "inventory")
    writers.write_csv(table(spark, sf, "orders").select("o_orderstatus", "o_orderkey"), folder, by=["o_orderstatus"])
    files = of_type(file_inventory(spark, folder), "csv").withColumn("status", F.regexp_extract("path", "o_orderstatus=([^/]*)/", 1))
    # A task writes files of one name in each status; the name of this list holds the status, too.
    files = files.withColumn("name", F.concat_ws("/", "status", "name"))
    manifest = files.filter("status <> 'P'").select(F.lit(1).alias("id"), "name")
    named = from_manifest(files, manifest).select("status").distinct().withColumn("listed", F.lit(True))
    return files.select("status").distinct().join(named, "status", "left").select("status", F.coalesce("listed", F.lit(False)).alias("listed"))


@query("state_files", """
    SELECT 'S' || CAST(c_nationkey AS VARCHAR) AS state, c_custkey, c_name FROM customer""")
def state_files(spark, sf):
    """Customers in a folder per state; a batch that is written again adds nothing."""
    path, c = scratch(spark, "states"), table(spark, sf, "customer")
    rows = c.select(F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state"), "c_custkey", "c_name", (F.col("c_acctbal") > 0).alias("rich"))
    writers.write_by_state(rows.filter("rich").drop("rich"), path, "rich")
    writers.write_by_state(rows.filter("not rich").drop("rich"), path, "poor")
    writers.write_by_state(rows.filter("rich").drop("rich"), path, "rich")
    return writers.read_batches(spark, path, "csv").select("state", F.col("c_custkey").cast("long").alias("c_custkey"), "c_name")


@query("outcome_files", """
    SELECT CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'error' ELSE 'N/A' END AS outcome, o_custkey,
           string_agg(CAST(o_orderkey AS VARCHAR), ' ' ORDER BY o_orderkey) AS pages FROM orders GROUP BY 1, 2""")
def outcome_files(spark, sf):
    """Orders of a customer routed by outcome, their keys as a list of pages."""
    path, o = scratch(spark, "outcomes"), table(spark, sf, "orders").select("o_orderstatus", "o_custkey", "o_orderkey")
    outcome = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "O", "error").otherwise("N/A").alias("outcome")
    # A customer's orders are few.
    writers.write_by_outcome(o.groupBy(outcome, "o_custkey").agg(F.sort_array(F.collect_list("o_orderkey")).alias("pages")), path)
    back = spark.read.option("header", True).option("inferSchema", False).csv(path)
    return back.select("outcome", F.col("o_custkey").cast("long").alias("o_custkey"), F.col("pages").cast("string").alias("pages"))


@query("exported_notes", """
    SELECT CAST(doc_id AS VARCHAR) AS id, nullif(lang, '') AS lang, 'a "' || coalesce(source, '') || '"' || chr(10) || 'b' AS note FROM documents""")
def exported_notes(spark, sf):
    """An export with quotes and line breaks in its fields, read back: missing text is an empty field."""
    path, d = scratch(spark, "export"), table(spark, sf, "documents").select("doc_id", "lang", "source")
    note = F.concat(F.lit('a "'), F.coalesce("source", F.lit("")), F.lit('"\nb'))
    writers.export_csv(d.select(F.col("doc_id").cast("string").alias("id"), "lang", note.alias("note")), path)
    return read_delimited(spark, path, "id string, lang string, note string", sep=",", null="", quoted_breaks=True)


@query("table_versions", """
    SELECT 1 AS v, count(*) AS n FROM part WHERE p_size > 25 UNION ALL SELECT 2, count(*) FROM part""")
def table_versions(spark, sf):
    """Two versions of a table beside each other: the first stays as it was."""
    root, part = scratch(spark, "versions"), table(spark, sf, "part").select("p_partkey", "p_size")
    first = writers.write_version(part.filter("p_size > 25"), root, 1)
    second = writers.write_version(spark.read.parquet(first).unionByName(part.filter("not p_size > 25")), root, 2)
    count = lambda path, v: spark.read.parquet(path).agg(F.lit(v).alias("v"), F.count("*").alias("n"))
    return count(first, 1).unionByName(count(second, 2))


@query("merged_columns", """
    SELECT c_custkey, concat_ws(' ', c_name, c_mktsegment) AS label FROM customer""")
def merged_columns(spark, sf):
    return relational.merge_matching_columns(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), "name|SEGMENT", "label")
