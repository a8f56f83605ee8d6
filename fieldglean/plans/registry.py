"""State registers: result pages to (entity, owner) pairs, search hits, answers per request.

The rules of all states are one broadcast table, so pages of all states run in one job with one
shuffle, on the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglean.functions.scalars import collapse_space, no_space, pair
from fieldglean.operators.documents import contains_any
from fieldglean.operators.html import html_nodes, matched_nodes
from fieldglean.operators.ordered import header_lookup
from fieldglean.rules import registry as R
from fieldglean.rules.sites import rule

_SETTING_FIELDS = {"owner_label": "string", "agent_label": "string", "entity_label": "string", "status": "string", "drop": "string",
                   "fallback": "string", "limit": "int", "guard": "array<string>", "owner_guard": "array<string>",
                   "needs_entity": "boolean", "joined": "boolean", "compact": "boolean"}


def _settings(spark) -> DataFrame:
    schema = "state string, " + ", ".join(f"s_{n} {t}" for n, t in _SETTING_FIELDS.items())
    return spark.createDataFrame([(s, *[v.get(n) for n in _SETTING_FIELDS]) for s, v in R.SETTINGS.items()], schema)


def owner_pairs(pages: DataFrame) -> DataFrame:
    """``(page_id, state, pos, franchise_found, result)`` from ``pages(page_id, state, html)``.

    The rows of one page (its table of officers or hits) become one array per page, which a page
    bounds; the filters, limits and fallbacks of the state are then array expressions.
    """
    rules = R.owner_rules()
    nodes = matched_nodes(pages.withColumnRenamed("state", "site"), rules).repartition("page_id")
    block = F.when(F.col("depth") > 0, F.col("anchor")).otherwise(F.concat(F.lit("#"), F.col("anchor")))
    pick = lambda f: F.min_by(F.when(F.col("field") == f, F.coalesce("value", F.lit(""))),
                              F.when(F.col("field") == f, F.col("node_id")))
    texts = lambda f: F.sort_array(F.collect_list(F.when(
        (F.col("field") == f) & F.col("value").isNotNull(), F.struct("node_id", "value"))))
    rows = nodes.groupBy("page_id", "site", "part", block.alias("block"), "row").agg(
        F.min("node_id").alias("at"), texts("owner").alias("owner"), texts("agent").alias("agent"),
        *[pick(f).alias(f) for f in ("owner_label", "agent_label", "status", "row_entity", "entity", "guard", "owner_guard")],
        F.max(F.col("field") == "none").alias("none"), F.max(F.col("field") == "no_agent").alias("no_agent"))
    of_page = lambda f: F.min_by(f, F.when(F.col(f).isNotNull(), F.col("at")))
    row = F.struct("at", "owner", "agent", "owner_label", "agent_label", "status", "row_entity")
    per_page = rows.groupBy("page_id", F.col("site").alias("state")).agg(
        F.sort_array(F.collect_list(row)).alias("rows"), of_page("entity").alias("entity"), of_page("guard").alias("guard"),
        of_page("owner_guard").alias("owner_guard"), F.max("none").alias("none"), F.max("no_agent").alias("no_agent"))
    p = per_page.join(F.broadcast(_settings(pages.sparkSession)), "state")

    allowed = lambda want, have: want.isNull() | F.coalesce(have == want, F.lit(False))
    owners = F.filter("rows", lambda r: (F.size(r["owner"]) > 0) & allowed(F.col("s_owner_label"), r["owner_label"])
                      & allowed(F.col("s_status"), r["status"]))
    owners = F.when(F.col("s_owner_guard").isNull() | F.coalesce(F.array_contains("s_owner_guard", F.col("owner_guard")), F.lit(False)),
                    F.slice(owners, F.lit(1), F.coalesce("s_limit", F.lit(2147483647)))).otherwise(F.array().cast(
                        per_page.schema["rows"].dataType))
    agents = F.filter("rows", lambda r: (F.size(r["agent"]) > 0) & allowed(F.col("s_agent_label"), r["agent_label"]))
    named = F.filter("rows", lambda r: (F.size(r["owner"]) > 0) & F.coalesce(r["owner_label"] == F.col("s_entity_label"), F.lit(False)))
    entity = F.when(F.col("s_entity_label").isNotNull(), F.element_at(F.get(named, F.size(named) - 1)["owner"], -1)["value"]).otherwise(F.col("entity"))
    p = p.withColumns({"owners": owners, "agents": agents, "entity": entity})

    clean = lambda v: F.when(F.coalesce("s_compact", F.lit(False)), no_space(v)).otherwise(collapse_space(v))
    line = lambda ent, v: F.when(F.coalesce("s_joined", F.lit(False)), F.concat_ws("//", F.coalesce(ent, F.lit("")), clean(v))).otherwise(clean(v))
    keep = lambda o: F.col("s_drop").isNull() | (o["value"] != F.col("s_drop"))
    from_rows = F.flatten(F.transform("owners", lambda r: F.transform(
        F.filter(r["owner"], keep), lambda o: line(F.coalesce(r["row_entity"], F.col("entity")), o["value"]))))
    # A labelled row read twice (entity and owner of one state) gives its last text.
    from_rows = F.when(F.col("s_entity_label").isNotNull(), F.slice(from_rows, F.greatest(F.size(from_rows), F.lit(1)), F.lit(1))).otherwise(from_rows)
    first_agent = F.get(F.get("agents", F.lit(0))["agent"], F.lit(0))["value"]
    spare = (F.when(first_agent.isNotNull() & ~F.coalesce("no_agent", F.lit(False)), F.array(line(F.col("entity"), first_agent)))
             .when(F.col("s_fallback").isNotNull(), F.array(line(F.col("entity"), F.col("s_fallback")))))
    shown = F.when(F.size(from_rows) > 0, from_rows).otherwise(spare)
    blocked = (F.coalesce("none", F.lit(False))
               | (F.col("s_guard").isNotNull() & ~F.coalesce(F.array_contains("s_guard", F.col("guard")), F.lit(False)))
               | (F.coalesce("s_needs_entity", F.lit(False)) & F.col("entity").isNull()))
    found = p.filter(~blocked).select("page_id", "state", F.posexplode(F.filter(shown, lambda x: x != "//")).alias("pos", "text"))
    return found.withColumn("p", pair("text")).select("page_id", "state", "pos", "p.franchise_found", "p.result")


def search_hits(pages: DataFrame) -> DataFrame:
    """``(page_id, state, row_no, href)`` of the hits that count, from result pages of all states."""
    nodes = matched_nodes(pages.withColumnRenamed("state", "site"), R.hit_rules())
    text = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    rows = nodes.groupBy("page_id", F.col("site").alias("state"), "row").agg(
        F.min("node_id").alias("at"), text("status").alias("status"), text("href").alias("href"))
    rows = rows.withColumn("row_no", F.element_at("row", -1))
    settings = pages.sparkSession.createDataFrame(
        [(s, v.get("status"), v.get("limit"), v.get("first", False)) for s, v in R.HITS.items()],
        "state string, want string, top int, before boolean")
    fits = F.col("want").isNull() | F.coalesce(F.col("status") == F.col("want"), F.lit(False))
    rows = rows.join(F.broadcast(settings), "state").withColumn("fits", fits)
    # The window holds the hits of one page. Its limit counts all rows or the accepted ones, per state.
    among = Window.partitionBy("page_id", F.col("before") | F.col("fits")).orderBy("at")
    kept = rows.withColumn("n", F.row_number().over(among)).filter("fits and (top is null or n <= top)")
    return kept.select("page_id", "state", "row_no", "href")


def first_active(pages: DataFrame, state: str) -> DataFrame:
    """``(page_id, row_no)``: first accepted row of each result page, -1 when none is."""
    hits = search_hits(pages.filter(F.col("state") == state))
    first = hits.groupBy("page_id").agg(F.min("row_no").alias("row_no"))
    return pages.filter(F.col("state") == state).select("page_id").join(first, "page_id", "left").fillna({"row_no": -1})


def hit_counts(pages: DataFrame) -> DataFrame:
    """``(page_id, state, options)``: rows of the result table, 0 without a table."""
    counts = search_hits(pages).groupBy("page_id").agg(F.count("*").alias("options"))
    return pages.select("page_id", "state").join(counts, "page_id", "left").fillna({"options": 0})


def colorado_hits(pages: DataFrame) -> DataFrame:
    """``(page_id, row_no, href)``: columns are found by their titles, rows by their standing."""
    rules = [rule("Colorado", "head", f"{R.COLORADO_HITS}[1]/th/a[1]/b[1]", mode="own", depth=4),
             rule("Colorado", "text", f"{R.COLORADO_HITS}/td", mode="own", depth=4, skip_at=3, skip_first=1),
             rule("Colorado", "href", f"{R.COLORADO_HITS}/td/a[1]", mode="@href", depth=4, skip_at=3, skip_first=1)]
    nodes = matched_nodes(pages, rules, site="Colorado")
    at = lambda i: F.get("row", F.lit(i))
    value = lambda f: F.max(F.when(F.col("field") == f, F.col("value")))
    cells = nodes.groupBy("page_id", at(2).alias("tr"), at(3).alias("col_no")).agg(
        value("head").alias("head"), value("text").alias("own"), value("href").alias("href"))
    cells = cells.select("page_id", "col_no", (F.col("tr") - 1).alias("row_no"), F.coalesce("head", "own").alias("text"), "href")
    found = header_lookup(cells, ["page_id"], R.COLORADO_TITLES)
    rows = found.groupBy("page_id", "row_no").agg(
        F.max(F.when(F.col("title") == "Status", collapse_space("text"))).alias("status"),
        F.max(F.when(F.col("title") == "ID Number", F.col("href"))).alias("href"))
    return rows.filter(F.col("status") == R.COLORADO_STATUS).select("page_id", "row_no", "href")


def refused(text: Column) -> Column:
    """The page refuses the visitor."""
    return contains_any(text, R.REFUSALS)


def dialog_open(pages: DataFrame) -> DataFrame:
    """``(page_id, open)``: the dialog of the page is shown unless its style hides it."""
    state, xpath, hidden = R.DIALOG
    found = matched_nodes(pages, [rule(state, "style", xpath, mode="@style")], site=state)
    return found.select("page_id", (~F.contains(F.coalesce("value", F.lit("")), F.lit(hidden))).alias("open"))


def has_node(pages: DataFrame, xpath: str) -> DataFrame:
    """Pages that show the node."""
    return pages.join(matched_nodes(pages, [rule("any", "x", xpath, mode="@@")], site="any").select("page_id"), "page_id", "left_semi")


def attribute(pages: DataFrame, xpath: str, name: str) -> DataFrame:
    """``(page_id, value)`` of an attribute of the first node on the path."""
    found = matched_nodes(pages, [rule("any", "x", xpath, mode="@" + name)], site="any")
    return found.groupBy("page_id").agg(F.min_by("value", "node_id").alias("value"))


def script_value(pages: DataFrame, pattern: str) -> DataFrame:
    """``(page_id, value)``: group 1 of a pattern in the scripts of a page."""
    scripts = html_nodes(pages, tags=["script"], content=[]).filter(F.col("text").rlike(pattern))
    return scripts.groupBy("page_id").agg(F.min_by(F.regexp_extract("text", pattern, 1), "node_id").alias("value"))


def answers(requests: DataFrame, results: DataFrame) -> DataFrame:
    """One row per owner of each request ``(franchise, state)``, NOT FOUND where there is none.

    ``results`` carries franchise, state, franchise_found and result. States without an active rule
    are never searched and so are not found.
    """
    asked = requests.select("franchise", F.trim("state").alias("state"))
    known = results.filter(F.col("state").isin(R.STATES))
    out = asked.join(known, ["franchise", "state"], "left")
    gone = F.col("result").isNull() & F.col("franchise_found").isNull()
    fill = lambda c: F.when(gone, "NOT FOUND").otherwise(F.col(c)).alias(c)
    return out.select("state", "franchise", fill("franchise_found"), fill("result"))
