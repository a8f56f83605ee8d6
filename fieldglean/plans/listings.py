"""Listing sites: detail pages to records, listing pages to rows and links, versioned snapshots.

A page is parsed once. Its matched nodes are shuffled once, on the page, and both aggregates (label
beside value, then fields of the record) reuse that partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglean.functions import scalars as S
from fieldglean.operators import ordered, snapshots
from fieldglean.operators.html import matched_nodes, page_fields
from fieldglean.operators.relational import last_per_key, update_columns
from fieldglean.rules import sites as R


def _label_field(site: str) -> Column:
    """Field of a record for (part, label); NULL for labels no table lists."""
    label, part = F.col("label"), F.col("part")
    if site == "bizquest":
        label = F.when(F.contains(label, F.lit("Market Outlook/")), "Market Outlook/Competition:").otherwise(label)
    chain = F.when(part == "page", F.col("field"))
    for (s, p), labels in R.LABELS.items():
        if s == site:
            known = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
            chain = chain.when(part == p, F.try_element_at(known, label))
    for (s, p), labels in R.LABELS_CONTAINED.items():
        if s == site:
            for text, field in labels.items():
                chain = chain.when((part == p) & F.contains(F.lower(label), F.lit(text)), F.lit(field))
    return chain


def raw_fields(pages: DataFrame, site: str) -> DataFrame:
    """``page_id`` and every field of the site as shown, NULL where absent. ``pages(page_id, html)``."""
    rules = R.detail_rules(site)
    direct = {r["field"] for r in rules if r["part"] == "page"}
    labelled = {f for table in (R.LABELS, R.LABELS_CONTAINED) for (s, _), m in table.items() if s == site for f in m.values()}
    nodes = matched_nodes(pages, rules, site=site).filter("part <> 'yearly'").repartition("page_id")
    value = F.nullif("value", F.lit(""))
    order = F.struct("priority", "node_id")
    block = F.when(F.col("depth") > 0, F.col("anchor")).otherwise(F.lit(""))
    parts = nodes.groupBy("page_id", "part", "field", block.alias("block"), "row").agg(
        F.min_by(F.when(F.col("role") == "label", value), F.when(F.col("role") == "label", order)).alias("label"),
        F.min_by(value, F.when((F.col("role") != "label") & value.isNotNull(), order)).alias("value"),
        F.min(F.when(F.col("role") != "label", order)).alias("at"))
    found = parts.withColumn("value", F.when(F.col("part") == "benefits", "Yes").otherwise(F.col("value")))
    found = found.withColumn("field", _label_field(site)).filter("field is not null and value is not null")
    # Of several rows with one label the last one stays; a field of the page has one row.
    rank = F.struct(F.coalesce(-F.col("at.priority"), F.lit(0)), F.coalesce(F.col("at.node_id"), F.lit(0)))
    fields = sorted(direct | labelled)
    return found.groupBy("page_id").agg(*[
        F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, rank)).alias(f) for f in fields])


def _with(df: DataFrame, fn, *fields: str) -> DataFrame:
    return df.withColumns({f: fn(f) for f in fields})


def _split_location(df: DataFrame, exact: bool) -> DataFrame:
    """City and state of the location. Legacy runs lose a listing without a comma; ``exact`` keeps it."""
    at = S.city_state(F.col("location"), exact)
    df = df.withColumns({"city": at["city"], "state": at["state"]})
    return df if exact else df.filter(F.contains(F.coalesce("location", F.lit("")), F.lit(",")))


def clean_bizbuysell(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    money = lambda c: S.amount(c, exact)
    df = _with(df, money, "asking_price", "cash_flow", "gross_revenue", "ebitda", "ff_e", "inventory", "rent", "established",
               "real_estate_value")
    df = _with(df, S.first_digits, "employees", "building_sf")
    seller = S.seller_text("seller")
    df = df.withColumns({"category": F.replace("category", F.lit("Businesses for Sale"), F.lit("")), "seller": seller,
                         "company": seller, "listing_number": S.cut_prefix("listing_number", 4)})
    return _split_location(df, exact)


def clean_bizquest(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    money = lambda c: S.amount(c, exact)
    df = _with(df, money, "asking_price", "gross_revenue", "cash_flow", "ebitda", "inventory", "ff_e", "min_liquid_capital",
               "min_franchise_fee", "total_units", "franchising_since", "company_units", "average_unit_revenue", "royalty_fee",
               "ad_fund_fee", "net_worth_required")
    df = _with(df, S.first_digits, "year_established", "number_of_employees", "building_sq_ft")
    invest = S.amount_range("initial_investment", exact)
    crumb = S.remove_phrase("state", "Businesses for Sale")
    df = df.withColumns({
        "category": S.remove_phrase("category", F.coalesce(crumb, F.lit("")), "Businesses for Sale"),
        "company": F.col("seller"), "initial_investment": invest["range"], "initial_investment_min": invest["min"],
        "initial_investment_max": invest["max"]})
    return _split_location(df, exact)


def clean_business_for_sale(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    place = S.county_state_country("address")
    df = df.withColumns({"county": place["county"], "state": place["state"], "country": place["country"]})
    for field, prefix in (("asking_price", "asking_price"), ("sales_revenue", "sales_revenue"), ("cash_flow", "cash_flow")):
        r = S.amount_range(field, exact)
        df = df.withColumns({f"{prefix}_min": r["min"], f"{prefix}_max": r["max"], field: r["range"]})
    df = df.withColumnRenamed("cash_flow", "cash_flow_range")
    df = _with(df, S.first_digits, "furniture_fixtures_value", "inventory_stock_value", "size_in_square_feet")
    return df.withColumns({"year_established": S.year_from_age("year_established", run_year),
                           "franchise": S.yes_no(F.contains(F.lower("title"), F.lit("franchise")))})


def clean_bizben(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    df = _with(df, S.usable_money, "asking_price", "cash_flow", "revenue")
    return df.withColumns({"agent_phone_1": F.replace(F.lower("agent_phone_1"), F.lit("text"), F.lit("")),
                           "agent_phone_2": F.replace(F.lower("agent_phone_2"), F.lit("cell"), F.lit(""))})


def clean_bizmls(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    org = F.concat(text("organization_3"), F.lit("   |  "), text("organization_4"))
    number = lambda label, c=org: S.labelled_value(c, label).try_cast("int")
    yes = lambda label: S.yes_no(S.labelled_value("business", label) == "Y")
    lender = yes("Is Lender P/Q")
    contact = {f"contact_{n}": F.when(lender == "No", F.col(f"contact_{n}_8")).otherwise(F.col(f"contact_{n}_11"))
               for n in sorted({c[len("contact_"):-2] for c in df.columns if c.startswith("contact_") and c.endswith("_8")})}
    place = S.city_state_zip(F.coalesce(contact["contact_city"], F.lit("")))
    loans = {c: S.first_token_plain(c) for c in df.columns if c.startswith("loan_")}
    hours = number("Hours Owner Works")
    out = df.withColumns({
        **loans, **contact, "organization_type": org, "listing_number": S.nth_token("listing_number", 3),
        "sic": S.to_int("sic"), "adj_net": S.to_int("adj_net"), "sales": S.to_int("sales"), "inventory": S.to_int("inventory"),
        "seller_financing": F.when(text("price") == text("down"), "No").otherwise("Yes"),
        "real_state_value": F.when(text("real_state_included") == "N*", F.lit(None)).otherwise(S.to_int("real_state_value")),
        "founding_year": run_year - number("Years Established"),
        "number_of_employees": S.row_total(number("Mgrs"), number("Emp FT"), number("Emp PT")),
        "weeks_of_training": S.labelled_value("non_compete", "Weeks Training"), "hours_owner_works": hours,
        "absentee_owner": S.absentee(hours), "relocatable": yes("Is Relocatable"), "franchise": yes("Is a Franchise"),
        "lender_pq": lender, "contact_city": place["city"], "contact_state": place["state"], "contact_zip_code": place["zip"],
        "is_a_franchise": F.when(F.contains(text("business"), F.lit("Is a Franchise: Y")), "Y").otherwise("N"),
        **{c: F.lit("N/A") for c in ("city", "real_estate_leased_or_owned", "building_square_feet", "business_website", "facebook",
                                     "youtube", "accounting_or_bookkeeping_software", "earnings_source")}})
    out = out.withColumns({"price": S.to_int("price"), "down": S.to_int("down")})
    return out.drop(*[c for c in out.columns if c.endswith(("_8", "_11"))], "organization_3", "organization_4", "real_state_included")


def clean_murphy(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    return _with(df, S.money, "account_rec", "real_estate", "inventory", "ff_and_e", "liabilities", "other", "leasehold", "total_assets")


def clean_resales(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    return _with(df, S.after_colon, "locations", "initial_investment", "headquarters", "category", "founded").drop("description")


def clean_wesell(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    df = _with(df, S.after_colon, "asking_price", "listing_number", "location", "lease_term", "monthly_rent", "indoor_seating",
               "inside_sq_ft", "hood_system", "hour_open", "part_time_emp", "full_time_emp", "net_sales", "owner_benefit")
    return df.withColumns({"asking_price": S.to_int(S.cut_prefix("asking_price", 1)), "listing_number": S.to_int("listing_number")})


def _unchanged(df: DataFrame, exact: bool, run_year: int) -> DataFrame:
    return df


CLEANERS = {
    "bizben": clean_bizben, "bizbuysell": clean_bizbuysell, "bizmls": clean_bizmls, "bizquest": clean_bizquest,
    "businessForSale": clean_business_for_sale, "franchiseflippers": _unchanged, "franchiseresales": clean_resales,
    "franchiseresales_franchisee": _unchanged, "murphybusiness": clean_murphy, "wesellrestaurants": clean_wesell,
}


def detail_records(pages: DataFrame, site: str, run_year: int, exact: bool = False) -> DataFrame:
    """Clean record per detail page of a site. ``run_year`` makes ages repeatable."""
    return CLEANERS[site](raw_fields(pages, site), exact, run_year)


def yearly_financials(pages: DataFrame) -> DataFrame:
    """``page_id`` and metric_year columns, the column of a year found by its header cell.

    The cells of a page are a long table; each cell meets the header of its column in a join.
    """
    rules = [r for r in R.detail_rules("bizmls") if r["part"] == "yearly"]
    cells = matched_nodes(pages, rules, site="bizmls").select(
        "page_id", F.get("row", F.size("row") - 2).alias("tr"), F.get("row", F.size("row") - 1).alias("td"), "value")
    year = F.regexp_extract("value", "(" + "|".join(map(str, R.FINANCIAL_YEARS)) + ")", 1)
    header = cells.filter((F.col("tr") == 2) & F.col("td").between(2, 4) & (year != "")).select("page_id", "td", year.alias("year"))
    # A year named by two columns is read from the first.
    header = header.groupBy("page_id", "year").agg(F.min("td").alias("td"))
    names = {2: "cash_flow", **dict(enumerate(R.YEARLY_METRICS, start=3))}
    body = cells.filter(F.col("tr").between(2, 2 + len(R.YEARLY_METRICS))).join(header, ["page_id", "td"])
    out = []
    for tr, metric in names.items():
        for y in R.FINANCIAL_YEARS:
            v = F.max(F.when((F.col("tr") == tr) & (F.col("year") == str(y)), F.col("value")))
            out.append((v if metric == "cash_flow" else S.to_int(v)).alias(f"{metric}_{y}"))
    return body.groupBy("page_id").agg(*out)


# --- listing pages ------------------------------------------------------------------------------

def listing_rows(pages: DataFrame, site: str) -> DataFrame:
    """One record per row of the listing pages of a site: ``page_id``, ``row`` and its fields."""
    rules = R.listing_rules(site)
    fields = list(dict.fromkeys(r["field"] for r in rules))
    if site == "bizben":
        pages = pages.filter(~F.contains(F.lower("html"), F.lit(R.NO_POSTINGS)))
    rows = page_fields(matched_nodes(pages, rules, site=site), ["page_id", "row"], fields, F.col("value"))
    if site == "bizben":
        rows = rows.filter(~F.contains(F.coalesce("row_class", F.lit("")), F.lit("bannerWrapper"))).drop("row_class")
    if site == "wesellrestaurants":
        rows = rows.filter("row_id is not null").drop("row_id")
    if site == "franchiseflippers":
        rows = rows.withColumns({"url": F.substr("onclick", F.lit(5), F.length("onclick") - 6),
                                 "asking_price": S.to_int(S.cut_prefix("price", 1))}).drop("onclick", "price")
    if site == "nationalfranchisesales":
        rows = rows.withColumn("listing_number", S.strip(F.split_part("data_href", F.lit("/"), F.lit(3)))).drop("data_href")
    if "href" in fields:
        rows = rows.filter("href is not null").withColumn("href", F.concat(F.lit(R.BASE_URLS.get(site, "")), "href"))
    return rows


def bizmls_link(onclick: Column | str) -> Column:
    """Detail address from the click handler: the text between LIST_NUMBER= and &gen_hp."""
    number = F.regexp_extract(S.col(onclick), "LIST_NUMBER=(.*?)&gen_hp", 1)
    return F.concat(F.lit(R.BIZMLS_DETAIL[0]), number, F.lit(R.BIZMLS_DETAIL[1]))


def last_page(pages: DataFrame, site: str) -> DataFrame:
    """``(page_id, last_page)``: page number shown last, or the number of items where the site counts."""
    rules = [R.rule(s, "n", x) for s, x in R.LAST_PAGE if s == site]
    if rules:
        found = matched_nodes(pages, rules, site=site)
        return found.groupBy("page_id").agg(F.max(S.first_digits("value")).alias("last_page"))
    rules = [R.rule(s, "n", x, mode="own") for s, x in R.ITEM_COUNT if s == site]
    return matched_nodes(pages, rules, site=site).groupBy("page_id").agg(F.count("*").alias("last_page"))


def list_last_page(pages: DataFrame) -> DataFrame:
    """``(page_id, last_page)`` of bare page lists: text of the last but one item, a link or a plain number."""
    rules = [R.rule("list", "n", f"/ul/li[last()-1]/{t}[1]", priority=p) for p, t in ((1, "a"), (2, "span"))]
    return page_fields(matched_nodes(pages, rules, site="list"), ["page_id"], ["n"], F.col("value")).withColumnRenamed("n", "last_page")


def next_item(pages: DataFrame) -> DataFrame:
    """``(page_id, next_item)``: item after the first one that carries a class; -1 if that one is active and last."""
    rules = [R.rule("murphybusiness", "c", '//*[@id="list_div"]/div[1]/div[1]/ul/li', mode="@class", depth=4)]
    items = matched_nodes(pages, rules, site="murphybusiness").filter("value is not null").select(
        "page_id", F.get("row", F.lit(3)).alias("item"), F.element_at("rel_end", -1).alias("left"), "value")
    first = items.groupBy("page_id").agg(F.min_by(F.struct("item", "left", "value"), "item").alias("i"))
    done = F.contains("i.value", F.lit("active")) & (F.col("i.left") == 1)
    return first.select("page_id", F.when(done, -1).otherwise(F.col("i.item") + 1).alias("next_item"))


def category_tree(pages: DataFrame) -> DataFrame:
    """``(page_id, industry, category, index)`` of flat buttons whose group headers apply downwards."""
    fields = {"title": "@title", "class": "@class"}
    rules = [R.rule("bizben", f, R.CATEGORY_BUTTONS, part="rows", mode=m, depth=R.steps(R.CATEGORY_BUTTONS)) for f, m in fields.items()]
    rows = page_fields(matched_nodes(pages, rules, site="bizben"), ["page_id", "row"], list(fields), F.col("value"))
    rows = rows.withColumn("index", F.element_at("row", -1)).filter(
        ~F.contains(F.coalesce("class", F.lit("")), F.lit("multiselect-all")))
    indented = F.contains(F.coalesce("class", F.lit("")), F.lit("multiselect-group-option-indented"))
    filled = ordered.fill_forward(rows, ["page_id"], "index", F.when(~indented, F.col("title")), "industry",
                                  bucket=[F.floor(F.col("index") / 1000)])
    return filled.filter(indented).select("page_id", F.coalesce("industry", F.lit("not found")).alias("industry"),
                                          F.col("title").alias("category"), "index")


def _block_rules() -> list[dict]:
    """Rules of the free text under strong labels."""
    return [R.rule("murphybusiness", tail.rsplit("/", 1)[-1], f"{R.MURPHY_TEXTS}/{tail}", part="blocks", mode="own", depth=2, skip_first=3)
            for tail in ("p", "strong", "p/strong", "div/p", "div/strong", "div/p/strong", "span/p", "span/strong")]


def _with_labels(nodes: DataFrame) -> DataFrame:
    """``in_category`` beside each node: whether the last label before it in its row names a category. A window sees one row of a page."""
    label = F.when((F.col("part") == "blocks") & (F.col("field") == "strong"), F.contains(F.lower(F.coalesce("value", F.lit(""))), F.lit("category")))
    so_far = Window.partitionBy("page_id", "row").orderBy("node_id").rowsBetween(Window.unboundedPreceding, 0)
    return nodes.withColumn("label", label).withColumn("in_category", F.coalesce(F.last("label", True).over(so_far), F.lit(False))).drop("label")


#: Paragraphs under a label.
_IS_TEXT = "part = 'blocks' and field = 'p' and value is not null"


def _block_columns() -> list[Column]:
    """Category and description of a row out of its nodes, '' where no paragraph is of that kind."""
    text, inside = F.expr(_IS_TEXT), F.col("in_category")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(text & ~inside, F.struct("node_id", "value")))), lambda s: s["value"]), "")
    return [F.coalesce(F.max_by("value", F.when(text & inside, F.col("node_id"))), F.lit("")).alias("category"), joined.alias("description")]


def labelled_blocks(pages: DataFrame) -> DataFrame:
    """``(page_id, row, category, description)`` of free text under strong labels.

    Paragraphs after a label naming a category are the category, the others are joined.
    """
    nodes = matched_nodes(pages, _block_rules(), site="murphybusiness").select("page_id", "row", "node_id", "part", "field", "value")
    return _with_labels(nodes).filter(_IS_TEXT).groupBy("page_id", "row").agg(*_block_columns())


def murphy_listings(pages: DataFrame) -> DataFrame:
    """Listing rows with their text blocks and amounts. A page is parsed once, and its nodes are shuffled once, on the row."""
    rules = R.listing_rules("murphybusiness")
    fields = list(dict.fromkeys(r["field"] for r in rules))
    nodes = matched_nodes(pages, [*rules, *_block_rules()], site="murphybusiness")
    nodes = nodes.select("page_id", "row", "node_id", "part", "field", "value", "priority")
    shown, order = F.nullif("value", F.lit("")), F.struct("priority", "node_id")
    found = {f: (F.col("part") == "rows") & (F.col("field") == f) & shown.isNotNull() for f in fields}
    rows = _with_labels(nodes).groupBy("page_id", "row").agg(
        *[F.min_by(F.when(here, shown), F.when(here, order)).alias(f) for f, here in found.items()],
        *_block_columns(), F.count(F.when(F.expr(_IS_TEXT), 1)).alias("texts"))
    # A row that shows no field is none; one without text, or on a page without an address, has no blocks.
    rows = rows.filter(F.coalesce(*fields).isNotNull())
    has_texts = (F.col("texts") > 0) & F.col("page_id").isNotNull()
    rows = rows.withColumns({c: F.when(has_texts, F.col(c)) for c in ("category", "description")}).drop("texts")
    return _with(rows, S.money, "price", "down_payment", "discretionary_earnings", "total_sales")


def with_listing(listing: DataFrame, details: DataFrame, key: str) -> DataFrame:
    """Detail records with the columns their listing row carried."""
    return listing.join(details, key)


# --- members directory --------------------------------------------------------------------------

def contact_cards(pages: DataFrame) -> DataFrame:
    """``(page_id, contact, email, url, phone, address, franchise_name)`` of member pages in two layouts."""
    rules = [R.rule("members", "item", x, part=f"card{i}", depth=R.steps(x))
             for i, x in enumerate(R.CARD_LISTS)]
    rules += [{**r, "field": "mail", "path": r["path"] + "/a[1]"} for r in rules]
    rules += [R.rule("members", "person", R.CARD_PERSON), R.rule("members", "franchise", R.CARD_FRANCHISE)]
    nodes = matched_nodes(pages, rules, site="members")
    items = nodes.groupBy("page_id", "part", "row").agg(
        *[F.min_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, F.col("node_id"))).alias(f)
          for f in ("item", "mail", "person", "franchise")])
    label = F.regexp_extract("item", r"^([^:]*:)", 1)
    rest = S.strip(F.split_part("item", F.concat(F.lit(""), label), F.lit(2)))
    items = items.withColumns({"label": F.when(F.col("item").isNotNull(), label), "text": F.when(label != "", rest)})
    # The second layout counts only on pages without the first.
    pick = lambda cond, v, part: F.max(F.when((F.col("part") == part) & cond, v))

    def both(cond: Column, v: Column) -> Column:
        has_first = F.max(F.when(F.col("part") == "card0", 1)) == 1
        return F.coalesce(F.when(has_first, pick(cond, v, "card0")).otherwise(pick(cond, v, "card1")), F.lit(""))

    is_ = lambda t: F.col("label") == t
    person = F.max(F.when(F.col("part") == "page", F.col("person")))
    named = both(is_("Contact Person:"), F.col("text"))
    first_layout = F.max(F.when(F.col("part") == "card0", 1)) == 1
    second_layout = F.max(F.when(F.col("part") == "card1", 1)) == 1
    franchise = F.max(F.when(F.col("part") == "page", F.col("franchise")))
    return items.groupBy("page_id").agg(
        F.when(named != "", named).when(~F.coalesce(first_layout, F.lit(False)) & second_layout, person).otherwise("").alias("contact"),
        both(F.contains("label", F.lit("Email")), F.coalesce("mail", "text")).alias("email"), both(is_("URL:"), F.col("text")).alias("url"),
        both(is_("Phone:"), F.col("text")).alias("phone"),
        both(is_("Address:"), F.replace("text", F.lit("\n"), F.lit(" "))).alias("address"),
        F.coalesce(F.when(named != "", franchise), F.lit("")).alias("franchise_name"))


def member_names(pages: DataFrame) -> DataFrame:
    """``(page_id, pos, member, member_type)`` of the members list in page order."""
    rules = [R.rule("members", f, x, part="rows", depth=1) for f, x in (("member", R.MEMBER_NAMES), ("member_type", R.MEMBER_TYPES))]
    found = page_fields(matched_nodes(pages, rules, site="members"), ["page_id", "row"], ["member", "member_type"], F.col("value"))
    return found.filter("member is not null").select("page_id", F.get("row", F.lit(0)).alias("pos"), "member", "member_type")


# Columns added to the franchise list and to the list of owners.
VISA_COLUMNS = ["Eligible for E-2 Visa?", "Works with Franchise Consultants/ Brokers?"]
CONTACT_FIELDS = {"Contact Name": "contact", "Contact Email": "email", "Contact URL": "url", "Contact Phone": "phone",
                  "Contact Address": "address", "Member Type": "member_type", "Franchise Name": "franchise_name"}


def visa_flags(franchises: DataFrame, eligible: DataFrame, brokers: DataFrame) -> DataFrame:
    """The franchise list with both flags, 'No' unless the franchise is in the matching table."""
    out = franchises
    for column, hits in zip(VISA_COLUMNS, (eligible, brokers)):
        yes = hits.select("franchise", F.lit("Yes").alias("yes"), F.lit(1).alias("n"))
        out = update_columns(out, yes, "franchise", {column: "yes"}, "n", "No")
    return out


def owner_contacts(owners: DataFrame, cards: DataFrame, order: str) -> DataFrame:
    """The owner list with seven contact columns, '' without a card; the last card of an owner wins."""
    return update_columns(owners, cards, "owner", CONTACT_FIELDS, order)


# --- snapshots ----------------------------------------------------------------------------------

def load_run(store: DataFrame | None, records: DataFrame, site: str, run_id: int, payload: list[str],
             order: str = "page_id") -> DataFrame:
    """Stored versions after a run of the site. Of a listing seen twice in a run the last page counts."""
    key = R.SNAPSHOT_KEYS[site]
    batch = last_per_key(records.select(key, order, *[c for c in payload if c not in (key, order)]), [key], order).drop(order)
    if store is None:
        return batch.withColumns({"checksum": snapshots.checksum(payload), "version_no": F.lit(1), "run": F.lit(run_id),
                                  "on_sale": F.lit(True)})
    return snapshots.apply_run(store, batch, key, run_id, payload, reset=site not in R.NEVER_RESET)
