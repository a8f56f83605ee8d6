"""Patterns, page runs and scalar cleaning over documents, conversations and texts built from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldglean.functions import scalars as S
from fieldglean.operators import documents, ordered, relational
from fieldglean.plans import logs
from fieldglean.plans.surface_area import half_text
from fieldglean.queries import query
from fieldglean.session import spread
from fieldglean.sources.readers import table

# The part before the '@' cannot contain one, so it never needs to give back: possessive.
_JAVA = {"has_digit": "[0-9]", "has_dollar": r"\$", "has_mail": r"[A-Za-z0-9._%+-]++@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}
_FLAGS = {"has_digit": "[0-9]", "has_dollar": r"\$", "has_mail": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"}


def _docs(spark, sf):
    return spread(table(spark, sf, "documents").select("doc_id", "text"))


@query("pattern_flags", "SELECT doc_id, " + ", ".join(
    f"regexp_matches(text, '{p}') AS {n}" for n, p in _FLAGS.items()) + " FROM documents")
def pattern_flags(spark, sf):
    return _docs(spark, sf).select("doc_id", *documents.pattern_flags("text", _JAVA))


@query("pattern_counts", " UNION ALL ".join(
    f"SELECT doc_id, '{n}' AS pattern, CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS matches FROM documents"
    for n, p in _FLAGS.items()))
def pattern_counts(spark, sf):
    return _docs(spark, sf).select("doc_id", F.inline(documents.pattern_counts(F.col("text"), _JAVA)))


@query("include_exclude_filter", """
    SELECT doc_id FROM documents WHERE length(replace(text, ' ', '')) > 100
      AND regexp_matches(text, '(?i)(the|und|les)') AND NOT regexp_matches(text, '(?i)(license|\\$)')
      AND NOT (contains(text, '@') OR contains(text, '###'))""")
def include_exclude_filter(spark, sf):
    text = F.col("text")
    keep = documents.include_exclude(text, "(?i)(the|und|les)", r"(?i)(license|\$)", 100)
    return _docs(spark, sf).filter(keep & ~documents.contains_any(text, ["@", "###"])).select("doc_id")


_MAIL = r"([A-Za-z0-9._%+-]+)@([A-Za-z0-9.-]+\.[A-Za-z]{2,})"


@query("email_contacts", f"""
    SELECT doc_id, CAST(n AS INTEGER) AS match_no, 'regex' AS method, users[n] AS owner_name, domains[n] AS website,
           CAST(NULL AS VARCHAR) AS phone
    FROM (SELECT doc_id, regexp_extract_all(text, '{_MAIL}', 1) AS users, regexp_extract_all(text, '{_MAIL}', 2) AS domains FROM documents),
         unnest(generate_series(1, len(users))) AS u(n)""")
def email_contacts(spark, sf):
    docs = spread(table(spark, sf, "documents").select("doc_id", "text").filter(F.contains("text", F.lit("@"))))
    found = docs.select(
        "doc_id", F.inline(documents.match_rows(F.col("text"), _MAIL.replace("]+)@", "]++)@"), {"owner_name": 1, "website": 2})))
    tagged = found.select("*", F.lit("regex").alias("method"))
    return relational.reindex(tagged, ["doc_id", "match_no", "method", "owner_name", "website", "phone"])


@query("numbers_min_max_mid", """
    WITH v AS (SELECT doc_id, unnest(regexp_extract_all(text, '([0-9]+)', 1)) AS n FROM documents),
         a AS (SELECT doc_id, min(CAST(n AS HUGEINT)) AS lo, max(CAST(n AS HUGEINT)) AS hi FROM v GROUP BY 1)
    SELECT doc_id, CAST(lo AS VARCHAR) AS lo, CAST(hi AS VARCHAR) AS hi, CAST((lo + hi) // 2 AS VARCHAR) || CASE WHEN (lo + hi) % 2 = 0 THEN '.0' ELSE '.5' END || ' sq. ft.' AS mid
    FROM a""")
def numbers_min_max_mid(spark, sf):
    found = F.regexp_extract_all("text", F.lit("([0-9]+)"), F.lit(1))
    # Numbers of any length go by their length without leading zeros, then as text.
    plain = F.transform(found, lambda x: F.regexp_replace(x, "^0+(?=[0-9])", ""))
    n = F.transform(plain, lambda x: F.struct(F.length(x).alias("digits"), x.alias("number")))
    per_page = _docs(spark, sf).select("doc_id", F.array_min(n).alias("lo"), F.array_max(n).alias("hi"))
    area = per_page.filter("lo is not null").groupBy("doc_id").agg(F.min("lo")["number"].alias("lo"), F.max("hi")["number"].alias("hi"))
    total = F.expr("try_cast(lo as decimal(30,0))") + F.expr("try_cast(hi as decimal(30,0))")
    half = F.when(F.length("hi") <= 30, half_text(total)).otherwise(_half_of_long("lo", "hi"))
    return area.select("doc_id", "lo", "hi", F.format_string("%s sq. ft.", half).alias("mid"))


def _half_of_long(lo: str, hi: str):
    """Half the sum of two texts of digits of any length, as text: sums of 17 digits from the right, then halves from the left."""
    step = 10**17
    parts = F.floor(F.length(hi) / 17).cast("int") + 1
    digits = lambda c, i: F.substring(F.lpad(c, parts * 17, "0"), i * 17 - 16, F.lit(17)).cast("bigint")
    pairs = F.transform(F.sequence(parts, F.lit(1)), lambda i: digits(lo, i) + digits(hi, i))
    none = F.array().cast("array<bigint>")

    def add(s, x):
        v = x + s["carry"]
        return F.struct(F.when(v >= step, 1).otherwise(0).cast("bigint").alias("carry"), F.concat(F.array(v % step), s["out"]).alias("out"))

    def halve(s, x):
        v = x + s["rest"] * step
        return F.struct((v % 2).alias("rest"), F.concat(s["out"], F.lpad(F.shiftright(v, 1).cast("string"), 17, "0")).alias("out"))

    sums = F.aggregate(pairs, F.struct(F.lit(0).cast("bigint").alias("carry"), none.alias("out")), add)["out"]
    half = F.aggregate(sums, F.struct(F.lit(0).cast("bigint").alias("rest"), F.lit("").alias("out")), halve)
    return F.concat(F.regexp_replace(half["out"], "^0+(?=[0-9])", ""), F.when(half["rest"] == 0, ".0").otherwise(".5"))


_SCORED = {"the": "the", "und": "und", "les": "les", "ment": "ment"}


@query("best_pattern", "WITH c AS (" + " UNION ALL ".join(
    f"SELECT doc_id, {i} AS ord, '{n}' AS pattern, CAST(len(regexp_extract_all(text, '{p}')) AS BIGINT) AS matches FROM documents"
    for i, (n, p) in enumerate(_SCORED.items())) + """)
    SELECT doc_id, pattern, matches FROM c WHERE matches > 0
    QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY matches DESC, ord) = 1""")
def best_pattern(spark, sf):
    best = documents.best_of(F.col("text"), _SCORED)
    return (_docs(spark, sf).select("doc_id", best.alias("b")).filter("b is not null")
            .select("doc_id", "b.pattern", "b.matches"))


def _turns(spark, sf):
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")


@query("take_while_pages", """
    WITH m AS (SELECT conv_id, turn, length(text) > 100 AS ok FROM conversations),
         s AS (SELECT conv_id, min(turn) AS from_page FROM m WHERE ok GROUP BY 1),
         e AS (SELECT m.conv_id, from_page, min(CASE WHEN NOT ok THEN turn END) AS stop, max(turn) AS last
               FROM m JOIN s ON m.conv_id = s.conv_id AND turn >= from_page GROUP BY 1, 2)
    SELECT conv_id, from_page, coalesce(stop - 1, last) AS to_page, coalesce(stop - 1, last) - from_page + 1 AS pages FROM e""")
def take_while_pages(spark, sf):
    pages = _turns(spark, sf).select("conv_id", "turn", (F.length("text") > 100).alias("ok"))
    runs = ordered.first_run(pages, "conv_id", "turn", F.col("ok"))
    return runs.withColumn("pages", F.col("to_page") - F.col("from_page") + 1)


@query("first_match_lookahead", """
    WITH st AS (SELECT conv_id, turn FROM conversations WHERE role = 'user' AND length(text) > 120),
         v AS (SELECT conv_id, turn, CASE WHEN regexp_matches(text, '[0-9]') THEN 'table' ELSE 'regex' END AS method
               FROM conversations WHERE regexp_matches(text, '[0-9]') OR length(text) > 600)
    SELECT st.conv_id, v.turn, st.turn AS start_page, method FROM st
    JOIN v ON st.conv_id = v.conv_id AND v.turn BETWEEN st.turn AND st.turn + 2
    QUALIFY row_number() OVER (PARTITION BY st.conv_id ORDER BY st.turn, v.turn) = 1""")
def first_match_lookahead(spark, sf):
    t = _turns(spark, sf)
    starts = t.filter((F.col("role") == "user") & (F.length("text") > 120)).select("conv_id", "turn")
    by_table = t.filter(F.col("text").rlike("[0-9]")).select("conv_id", "turn", F.lit("table").alias("method"), F.lit(1).alias("rank"))
    by_regex = t.filter(F.length("text") > 600).select("conv_id", "turn", F.lit("regex").alias("method"), F.lit(2).alias("rank"))
    valid = ordered.first_method(by_table.unionByName(by_regex), ["conv_id", "turn"], "rank").drop("rank")
    return ordered.first_in_lookahead(starts, valid, "conv_id", "turn")


@query("concat_pages", """
    SELECT conv_id, turn // 4 AS block, CAST(count(*) AS BIGINT) AS pages, md5(string_agg(text, '' ORDER BY turn)) AS digest
    FROM conversations GROUP BY 1, 2""")
def concat_pages(spark, sf):
    return ordered.text_blocks(_turns(spark, sf), "conv_id", "turn", "text", 4).select(
        "conv_id", "block", "pages", F.md5("text").alias("digest"))


@query("paired_positions", """
    WITH n AS (SELECT conv_id, role, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n, md5(text) AS d FROM conversations)
    SELECT u.conv_id, u.n, u.d AS label_digest, a.d AS value_digest FROM n u JOIN n a ON u.conv_id = a.conv_id AND u.n = a.n
    WHERE u.role = 'user' AND a.role = 'assistant'""")
def paired_positions(spark, sf):
    t = _turns(spark, sf).select("conv_id", "turn", "role", F.md5("text").alias("d"))
    n = relational.number_rows(t, ["conv_id", "role"], F.col("turn"), 1000, "n", offset=1, restart=True)
    side = lambda role, name: n.filter(F.col("role") == role).select("conv_id", "n", F.col("d").alias(name))
    return ordered.pair_positions(side("user", "label_digest"), side("assistant", "value_digest"), ["conv_id"], "n")


_AMOUNT_SQL = """CASE o_orderstatus WHEN 'F' THEN '$' || format('{:,}', CAST(floor(o_totalprice) AS BIGINT))
    WHEN 'O' THEN CAST(CAST(floor(o_totalprice / 1000) AS BIGINT) AS VARCHAR) || 'K - ' || CAST(o_custkey AS VARCHAR) || 'M'
    ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'Call' ELSE '$' || CAST(o_custkey AS VARCHAR) || '.5M' END END"""
_CLEAN_SQL = "replace(replace(replace(replace(raw, '$', ''), ',', ''), 'K', '000'), 'M', '000000')"


@query("amount_parse", f"""
    WITH t AS (SELECT o_orderkey, {_AMOUNT_SQL} AS raw FROM orders),
         a AS (SELECT o_orderkey, raw, CAST(regexp_extract_all({_CLEAN_SQL}, '([0-9]+)', 1) AS BIGINT[]) AS n FROM t)
    SELECT o_orderkey, raw, CAST(n[1] AS DOUBLE) AS amount, CAST(n[1] AS DOUBLE) AS low, CAST(coalesce(n[2], n[1]) AS DOUBLE) AS high,
           CAST(n[1] AS VARCHAR) || ' - ' || CAST(coalesce(n[2], n[1]) AS VARCHAR) AS range,
           CASE WHEN NOT regexp_matches(lower(raw), '[/ns]|call|email')
                THEN TRY_CAST(replace(replace(lower(raw), '$', ''), ',', '') AS DOUBLE) END AS money,
           CAST(CASE WHEN raw LIKE '%.5M' THEN CAST(split_part(substr(raw, 2), '.', 1) AS BIGINT) * 1000000 + 500000 ELSE n[1] END AS DOUBLE) AS exact
    FROM a""")
def amount_parse(spark, sf):
    whole = lambda c: F.floor(c).cast("bigint")
    key = F.col("o_custkey").cast("string")
    raw = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("$"), F.format_number(whole(F.col("o_totalprice")), 0)))
           .when(F.col("o_orderstatus") == "O", F.concat(whole(F.col("o_totalprice") / 1000).cast("string"), F.lit("K - "), key, F.lit("M")))
           .when(F.col("o_orderpriority") == "5-LOW", "Call").otherwise(F.concat(F.lit("$"), key, F.lit(".5M"))))
    t = spread(table(spark, sf, "orders").drop("o_orderdate")).select("o_orderkey", raw.alias("raw"))
    r = t.withColumn("r", S.amount_range("raw"))
    num = lambda c, name: c.cast("double").alias(name)
    return r.select("o_orderkey", "raw", num(S.amount("raw"), "amount"), num(F.col("r.min"), "low"), num(F.col("r.max"), "high"),
                    F.col("r.range").alias("range"), S.usable_money("raw").alias("money"), num(S.amount("raw", exact=True), "exact"))


@query("location_split", """
    WITH t AS (SELECT c_custkey, n_name || ', ' || r_name || ' ' || CAST(10000 + c_custkey AS VARCHAR) AS loc,
                      'x, ' || n_name || ', ' || r_name AS tail
               FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT c_custkey, trim(split_part(loc, ',', 1)) AS city, trim(split_part(loc, ',', 2)) AS state,
           regexp_extract(loc, '^(.*), (.*) ([0-9]+)', 1) AS city2, regexp_extract(loc, '^(.*), (.*) ([0-9]+)', 2) AS state2,
           regexp_extract(loc, '^(.*), (.*) ([0-9]+)', 3) AS zip2,
           split_part(tail, ',', 1) AS county3, split_part(tail, ',', 2) AS state3, split_part(tail, ',', 3) AS country3 FROM t""")
def location_split(spark, sf):
    c = (table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
         .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")))
    loc = F.concat("n_name", F.lit(", "), "r_name", F.lit(" "), (F.col("c_custkey") + 10000).cast("string"))
    tail = F.concat(F.lit("x, "), "n_name", F.lit(", "), "r_name")
    t = c.select("c_custkey", S.city_state(loc).alias("a"), S.city_state_zip(loc).alias("b"), S.county_state_country(tail).alias("d"))
    return t.select("c_custkey", "a.city", "a.state", F.col("b.city").alias("city2"), F.col("b.state").alias("state2"),
                    F.col("b.zip").alias("zip2"), F.col("d.county").alias("county3"), F.col("d.state").alias("state3"),
                    F.col("d.country").alias("country3"))


@query("yes_no_flags", """
    SELECT p_partkey, CASE WHEN contains(lower(p_name), 'ring') THEN 'Yes' ELSE 'No' END AS franchise,
           CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_size < 30 THEN 'Yes' ELSE 'No' END AS absentee,
           CASE WHEN p_size < 1000 THEN 2024 - p_size END AS founded,
           CASE WHEN p_brand = 'Brand#7' THEN '' ELSE CAST(p_size AS VARCHAR) END AS real_estate_value FROM part""")
def yes_no_flags(spark, sf):
    hours = F.when(F.col("p_type") != "ECONOMY", F.col("p_size"))
    age = F.concat(F.col("p_size").cast("string"), F.lit(" years"))
    return table(spark, sf, "part").select(
        "p_partkey", S.yes_no(F.contains(F.lower("p_name"), F.lit("ring"))).alias("franchise"), S.absentee(hours).alias("absentee"),
        S.year_from_age(age, 2024).cast("int").alias("founded"),
        F.when(F.col("p_brand") == "Brand#7", "").otherwise(F.col("p_size").cast("string")).alias("real_estate_value"))


@query("label_values", """
    WITH t AS (SELECT p_partkey, p_size, CAST(floor(p_retailprice) AS BIGINT) AS price, p_name, p_type FROM part)
    SELECT p_partkey, CAST(p_size AS VARCHAR) AS size, CAST(NULL AS VARCHAR) AS absent,
           CASE WHEN p_type = 'ECONOMY' THEN 'Y' ELSE 'N' END AS economy, '$' || CAST(price AS VARCHAR) AS price_text,
           price AS price_no, CAST(price AS VARCHAR) AS loan, CAST(p_partkey AS VARCHAR) AS listing_number, p_name AS clean_name FROM t""")
def label_values(spark, sf):
    p = table(spark, sf, "part").withColumn("price", F.floor("p_retailprice").cast("bigint"))
    shown = F.format_number("price", 0)
    text = F.concat(F.lit("Size:  "), F.col("p_size").cast("string"), F.lit("\nEconomy: "),
                    F.when(F.col("p_type") == "ECONOMY", "Y").otherwise("N"))
    priced = S.after_colon(F.concat(F.lit("Price: $"), shown, F.lit("\n")))
    return p.select(
        "p_partkey", S.labelled_value(text, "Size").alias("size"), S.labelled_value(text, "Weight").alias("absent"),
        S.labelled_value(text, "Economy").alias("economy"), priced.alias("price_text"),
        S.to_int(S.cut_prefix(priced, 1)).alias("price_no"), S.first_token_plain(F.concat(shown, F.lit(" USD"))).alias("loan"),
        S.nth_token(F.concat(F.lit("Listing No "), F.col("p_partkey").cast("string"), F.lit(" x")), 3).alias("listing_number"),
        S.collapse_space(F.concat(F.lit("  "), F.replace("p_name", F.lit(" "), F.lit("\n  ")), F.lit("  "))).alias("clean_name"))


@query("phrase_cleanup", """
    SELECT s_suppkey, replace(replace(s_name, 'Supplier', ''), '#', '') AS bare, lower(s_name) AS seller,
           s_name AS plain, '"' || s_name || '"' AS quoted,
           CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal) AS DOUBLE) END AS amount FROM supplier""")
def phrase_cleanup(spark, sf):
    s = table(spark, sf, "supplier")
    curly = F.concat(F.lit("“"), F.col("s_name"), F.lit("’"))
    raw = F.when(F.col("s_acctbal") < 0, F.lit("Email us")).otherwise(F.concat(F.lit(" $"), F.format_number(F.floor("s_acctbal"), 0)))
    return s.select(
        "s_suppkey", S.remove_phrase("s_name", "Supplier", "#").alias("bare"),
        S.seller_text(F.concat(F.lit("Seller:\n"), F.col("s_name"), F.lit(" Phone 555-0100"))).alias("seller"),
        S.plain_quotes(curly).alias("plain"), S.double_quotes(curly).alias("quoted"), S.usable_money(raw).alias("amount"))


@query("url_stem", r"""
    SELECT page_id, parts[len(parts)] AS name, split_part(parts[len(parts)], '.', 1) AS stem
    FROM (SELECT page_id, regexp_split_to_array(url, '[/\\]') AS parts FROM pages)""")
def url_stem(spark, sf):
    return table(spark, sf, "pages").select("page_id", S.base_name("url").alias("name"), S.file_stem("url").alias("stem"))


@query("constant_flags", " UNION ALL ".join(f"""
    SELECT doc_id, '{n}' AS pattern, 'Yes' AS has_contacts, 'No' AS scrape_contacts,
           {"regexp_extract(text, '" + p + "')" if n == "has_mail" else "replace(regexp_extract(text, '" + p + "'), '@', '')"} AS first_match
    FROM documents WHERE regexp_matches(text, '{p}')""" for n, p in _FLAGS.items()))
def constant_flags(spark, sf):
    """Documents by the patterns of a table, constant flags, '@' dropped unless the pattern is a mail."""
    rows = F.array(*[F.when(F.col("text").rlike(p), F.struct(
        F.lit(n).alias("pattern"), F.lit("Yes").alias("has_contacts"), F.lit("No").alias("scrape_contacts"),
        (F.regexp_substr("text", F.lit(p)) if n == "has_mail" else F.replace(F.regexp_substr("text", F.lit(p)), F.lit("@"), F.lit(""))).alias("first_match")))
        for n, p in _JAVA.items()])
    return _docs(spark, sf).select("doc_id", F.inline(F.array_compact(rows)))


_LOG_SQL = """(SELECT CASE o_orderstatus
        WHEN 'F' THEN 'x-' || y || '-fdd.pdf: invalid methods'
        WHEN 'O' THEN 'x-' || y || '-fdd.pdf: list of franchisees not found'
        ELSE CASE WHEN o_orderpriority = '5-LOW' THEN 'Processing page-' || y
                  WHEN o_orderpriority = '1-URGENT' THEN 'Exported with errors to: ./test/results_errors/x-' || y || '-fdd.csv'
                  ELSE 'Exported to: ./test/results/x-' || y || '-fdd.csv' END END AS message, y
    FROM (SELECT *, CASE WHEN year(o_orderdate) < 1998 THEN '2022' ELSE '2023' END AS y FROM orders))"""


@query("outcome_by_year", f"""
    WITH m AS (SELECT CASE WHEN message LIKE '%invalid methods' THEN 'invalid methods' WHEN message LIKE '%not found' THEN 'franchisees not found'
                           WHEN message LIKE '%errors to%' THEN 'exported with errors' WHEN message LIKE 'Exported to%' THEN 'exported correctly' END AS class, y
               FROM {_LOG_SQL})
    SELECT class, CAST(count(*) FILTER (y = '2022') AS BIGINT) AS y2022, CAST(count(*) FILTER (y = '2023') AS BIGINT) AS y2023
    FROM m WHERE class IS NOT NULL GROUP BY 1""")
def outcome_by_year(spark, sf):
    return logs.outcome_by_year(_messages(spark, sf))


def _messages(spark, sf):
    """Log lines built from the orders, read back without their time stamps and noise."""
    y = F.when(F.year("o_orderdate") < 1998, "2022").otherwise("2023")
    exported = (F.when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("Processing page-"), y))
                .when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("Exported with errors to: ./test/results_errors/x-"), y, F.lit("-fdd.csv")))
                .otherwise(F.concat(F.lit("Exported to: ./test/results/x-"), y, F.lit("-fdd.csv"))))
    message = (F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("x-"), y, F.lit("-fdd.pdf: invalid methods")))
               .when(F.col("o_orderstatus") == "O", F.concat(F.lit("x-"), y, F.lit("-fdd.pdf: list of franchisees not found")))
               .otherwise(exported))
    lines = spread(table(spark, sf, "orders").select("o_orderdate", "o_orderstatus", "o_orderpriority")).select(
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"), F.lit(" - "), message).alias("value"))
    return logs.drop_noise(lines.select(S.log_message("value").alias("message")))


@query("log_result_lines", f"""
    SELECT CASE WHEN message LIKE 'Exported with%' THEN 'x-' || y || '-fdd,csv,Exported with errors'
                WHEN message LIKE 'Exported to%' THEN 'x-' || y || '-fdd,csv,Exported correctly'
                WHEN message LIKE '%invalid%' THEN 'x-' || y || '-fdd,pdf,invalid methods'
                ELSE 'x-' || y || '-fdd,pdf,list of franchisees not found' END AS line
    FROM {_LOG_SQL} WHERE message NOT LIKE 'Processing%' ORDER BY 1""")
def log_result_lines(spark, sf):
    return logs.result_lines(_messages(spark, sf))
