"""What each listing site shows where: paths of fields, label tables, listing rows.

All values in this file are fixed by the pages themselves. Rows become a broadcast rule table, see
``operators.html``; the loan, contact and yearly tables of one site follow a rule and are generated.
"""

from __future__ import annotations

import re
from functools import cache
from importlib.resources import files

RULE_SCHEMA = """site string, part string, role string, field string, priority int, anchor string, path string,
    mode string, depth int, skip_at int, skip_first int, skip_last int, path_tags array<string>, path_idx array<int>, path_end array<int>"""


def steps(xpath: str) -> int:
    """Number of steps of a path below its anchor."""
    return len([s for s in re.sub(r'^//\*\[@id="[^"]+"\]', "", xpath).split("/") if s])


def rule(site: str, field: str, xpath: str, *, part: str = "page", role: str = "field", priority: int = 1,
         mode: str = "content", depth: int = 0, skip_at: int | None = None, skip_first: int = 0, skip_last: int = 0) -> dict:
    """``//*[@id="x"]/a/b`` is anchored at the id, anything else starts at the root.

    ``depth`` steps of the path below the anchor identify the row of a repeated part; ``skip_first``
    and ``skip_last`` drop siblings at the ends of step ``skip_at`` (the row step unless given).
    """
    anchored = re.match(r'//\*\[@id="([^"]+)"\]/?(.*)$', xpath)
    anchor, path = (anchored.group(1), anchored.group(2)) if anchored else ("", xpath.lstrip("/"))
    return {"site": site, "part": part, "role": role, "field": field, "priority": priority, "anchor": anchor, "path": path,
            "mode": mode, "depth": depth, "skip_at": skip_at or depth, "skip_first": skip_first, "skip_last": skip_last}


@cache
def site_paths() -> tuple[tuple[str, str, str], ...]:
    lines = files(__package__).joinpath("site_paths.txt").read_text(encoding="utf-8").splitlines()
    return tuple(tuple(line.split("\t")) for line in lines if not line.startswith("#"))


# Label tables: label shown -> field. 'contains' labels are matched in lower case anywhere in the text.
LABELS = {
    ("bizbuysell", "financials"): {
        "Gross Revenue:": "gross_revenue", "EBITDA:": "ebitda", "FF&E:": "ff_e", "Inventory:": "inventory",
        "Rent:": "rent", "Established:": "established", "Real Estate:": "real_estate_value",
    },
    ("bizbuysell", "details"): {
        "Location:": "location", "Inventory:": "inventory_included", "Real Estate:": "real_estate",
        "Building SF:": "building_sf", "Lease Expiration:": "lease_expiration", "Employees:": "employees",
        "Franchise:": "franchise", "Facilities:": "facilities", "Competition:": "competition",
        "Financing:": "financing", "Support & Training:": "support_training", "Home-Based:": "home_based",
        "Business Website:": "business_website", "Furniture, Fixtures, & Equipment (FF&E):": "ff_e_included",
        "Growth & Expansion:": "growth_expansion", "Reason for Selling:": "reason_for_selling",
    },
    ("bizquest", "details"): {
        "Location:": "location", "Year Established:": "year_established", "Number of Employees:": "number_of_employees",
        "Franchise:": "franchise", "Real Estate:": "real_estate", "Building Sq. Ft.:": "building_sq_ft",
        "Facilities:": "facilities", "Website:": "website", "Growth & Expansion:": "growth_expansion", "Rent:": "rent",
        "Market Outlook/Competition:": "market_outlook_competition", "Reason For Selling:": "reason_for_selling",
        "Training/Support:": "training_support", "Seller Financing:": "seller_financing", "ID:": "listing_number",
        "Ad Detail Views:": "ad_detail_views", "Lease Expiration:": "lease_expiration", "Home Based:": "home_based",
        "Relocatable:": "relocatable",
    },
    ("bizquest", "benefits"): {
        "Training and Support": "training_support", "Financing Available": "financing_available", "Mobile": "mobile",
        "Multi Units": "multi_units", "SBA Approved": "sba_approved",
    },
    ("businessForSale", "details"): {
        "Reasons for selling:": "reason_for_selling", "Employees:": "number_of_employees",
        "Years established:": "year_established", "Support & training:": "support_training",
        "Owner financing:": "owner_financing", "Financing available:": "financing_available",
        "Furniture / Fixtures value:": "furniture_fixtures_value", "Inventory / Stock value:": "inventory_stock_value",
        "Relocatable:": "relocatable", "Home based:": "home_based", "Lease Terms:": "lease_terms",
        "Leasehold Rent:": "leasehold_rent", "Living Accommodation:": "living_accommodation", "Location:": "location",
        "Premises Details:": "premises_details", "Size in square feet:": "size_in_square_feet",
        "Planning Consent:": "planning_consent", "Trading hours:": "trading_hours", "Real Estate:": "real_state",
        "Franchise terms:": "franchise_terms", "Distressed:": "distressed", "Franchise opportunity:": "franchise_opportunity",
    },
}
LABELS_CONTAINED = {
    ("franchiseflippers", "details"): {
        "annual gross revenue": "annual_gross_revenue", "value of inventory": "value_of_inventory",
        "value of assets": "value_of_assets", "business category": "business_category",
        "business operates from": "business_operates_from", "year established": "years",
        "seasonal business": "seasonal_business", "annual net profit": "annual_net_profit",
    },
}
YEARLY_METRICS = ["gross_revenue", "cost_of_goods", "gross_profit", "expenses", "net", "owner_salary", "benefits",
                  "interest_expense", "depreciation", "other", "owner_benefit"]
FINANCIAL_YEARS = [2017, 2018, 2019, 2020, 2021, 2022, 2023]

_BIZBUYSELL = '//*[@id="aspnetForm"]/div[2]/div[2]/div/div/div/div/div[3]/div[1]'
_BIZBUYSELL_LIST = '//*[@id="ctl00_ctl00_Content_ContentPlaceHolder1_wideProfile_listingDetails_dlDetailedInformation"]'
_BIZQUEST = "/html/body/div[2]/div[2]/div[1]"
_BIZQUEST_BENEFITS = '//*[@id="franchise-details-container"]/div[2]/div[1]/div[9]/div/ul/li'
_BIZMLS = "/html/body/section/div/table/tbody/tr/td"
_FLIPPERS = '//*[@id="listings-details-top"]/div/div[5]/div'


def _detail_rules() -> list[dict]:
    seen: dict = {}
    rules = []
    for site, field, xpath in site_paths():
        seen[site, field] = seen.get((site, field), 0) + 1
        rules.append(rule(site, field, xpath, priority=seen[site, field]))
    pair = lambda site, part, label, value, depth, **kw: rules.extend([
        rule(site, "", label, part=part, role="label", depth=depth), rule(site, "", value, part=part, role="value", depth=depth, **kw)])

    for i, priority in ((3, 1), (2, 2)):
        block = f"{_BIZBUYSELL}/div[{i}]/div/div[1]"
        rules.append(rule("bizbuysell", "asking_price", f"{block}/div[1]/p/b", priority=priority))
        rules.append(rule("bizbuysell", "cash_flow", f"{block}/div[2]/p/b", priority=priority))
        for j in (1, 2):
            p = f"{_BIZBUYSELL}/div[{i}]/div/div[2]/div[{j}]/p"
            pair("bizbuysell", "financials", f"{p}/span", f"{p}/b", steps(p), priority=priority)
    pair("bizbuysell", "details", f"{_BIZBUYSELL_LIST}/dt/strong", f"{_BIZBUYSELL_LIST}/dd", 1)
    depth = steps(_BIZQUEST) + 2
    for j in (1, 2, 3):
        pair("bizquest", "details", f"{_BIZQUEST}/dl[{j}]/dt", f"{_BIZQUEST}/dl[{j}]/dd", depth)
    rules.append(rule("bizquest", "", f"{_BIZQUEST_BENEFITS}/span[2]", part="benefits", role="label", depth=steps(_BIZQUEST_BENEFITS)))
    for block in ("business-operation", "other-information", "property-information", "franchise-terms"):
        dl = f'//*[@id="{block}"]/dl'
        pair("businessForSale", "details", f"{dl}/dt", f"{dl}/dd/p", 1)
        rules.append(rule("businessForSale", "", f"{dl}/dd", part="details", role="value", priority=2, depth=1))
    pair("franchiseflippers", "details", f"{_FLIPPERS}/h4", f"{_FLIPPERS}/h5", 4)

    for i in (3, 4):
        rules.append(rule("bizmls", f"organization_{i}", f"{_BIZMLS}/table[4]/tbody/tr[{i}]/td[3]/span"))
    for i, kind in enumerate(("assumable", "seller", "other"), start=1):
        for j, what in enumerate(("amt", "mos", "rate", "mo_pmt"), start=3):
            rules.append(rule("bizmls", f"loan_{kind}_{what}", f"{_BIZMLS}/table[7]/tbody/tr[{i}]/td[{j}]/span"))
    left = ("name", "role", "office_name", "street", "city", "country")
    right = ("office", "agent_direct", "fax", "cell", "email_name", "home_page")
    for table in (8, 11):
        for i in range(6):
            tail = "span/a" if i >= 4 else "span"
            rules.append(rule("bizmls", f"contact_{left[i]}_{table}", f"{_BIZMLS}/table[{table}]/tbody/tr[{i + 1}]/td[1]/span/b"))
            rules.append(rule("bizmls", f"contact_{right[i]}_{table}", f"{_BIZMLS}/table[{table}]/tbody/tr[{i + 1}]/td[5]/{tail}"))
    # Yearly figures: one cell per (row, column); the header row tr[2] names the year.
    cell = f"{_BIZMLS}/table[5]/tbody/tr/td"
    rules.append(rule("bizmls", "cell", cell, part="yearly", depth=steps(cell)))
    return rules


# Listing pages: fields of a repeated row. skip_first / skip_last drop rows at the ends.
def _listing_rules() -> list[dict]:
    rules = []

    def row(site: str, container: str, step: str, fields: dict, **kw) -> None:
        for field, (tail, mode) in fields.items():
            rules.append(rule(site, field, f"{container}/{step}/{tail}".rstrip("/"), part="rows", mode=mode, depth=steps(container) + 1, **kw))

    row("businessForSale", '//*[@id="searchFilterForm"]/section/div/div[1]', "div",
        {"href": ("table[1]/caption[1]/h2[1]/a[1]", "@href")}, skip_first=1, skip_last=2)
    row("bizquest", '//*[@id="results"]', "div", {"href": ("a[1]", "@href")})
    row("bizbuysell", '//*[@id="search-results"]/app-bfs-listing-container/div', "app-listing-diamond", {"href": ("a[1]", "@href")})
    row("wesellrestaurants", "/html/body/section[2]/div/div/div[1]/div/div/div/div[2]/div[1]", "div",
        {"href": ("div[1]/a[1]", "@href"), "row_id": ("", "@id")})
    row("bizben", "/html/body/div[2]/section[4]/div/div[1]/div[2]", "div",
        {"href": ("div[1]/div[1]/div[1]/a[1]", "@href"), "row_class": ("", "@class")})
    row("franchiseflippers", '//*[@id="listing-tables"]/div/div/table/tbody', "tr", {
        "onclick": ("", "@onclick"), "listing_number": ("", "@id"), "title": ("td[2]/a[1]", "own"), "category": ("td[3]", "own"),
        "price": ("td[4]", "own"), "county": ("td[6]", "own"), "state": ("td[7]", "own")})
    row("nationalfranchisesales", '//*[@id="listings-table"]/tbody', "tr", {
        "brand": ("td[1]/a[2]", "own"), "sales": ("td[2]", "own"), "cash_flow": ("td[3]", "own"), "updated": ("td[4]", "own"),
        "status": ("td[5]/span[1]", "own"), "additional_info": ("td[6]/span[1]", "own"), "data_href": ("td[1]", "@data-href")})
    item = lambda ul, li: f"div[2]/ul[{ul}]/li[{li}]/span[1]"
    row("murphybusiness", '//*[@id="list_div"]/div[1]', "div", {
        "title": ("h2[1]/a[1]", "own"), "link": ("h2[1]/a[1]", "@href"), "status": (item(1, 1), "own"), "relocatable": (item(1, 2), "own"),
        "state": (item(2, 1), "own"), "price": (item(2, 2), "own"), "listing_number": (item(2, 3), "own"), "down_payment": (item(3, 1), "own"),
        "discretionary_earnings": (item(3, 2), "own"), "total_sales": (item(3, 3), "own")}, skip_first=3)
    rules.append(rule("franchiseresales", "href", '//*[@id="div_block-14-52357"]/div/div[1]/div[1]/a', part="rows", mode="@href",
                      depth=4, skip_at=1, skip_first=3))
    rules.append(rule("franchiseresales_franchisee", "href", '//*[@id="shortcode-190-52363"]/div/div/div[2]/span[4]/a[1]', part="rows",
                      mode="@href", depth=2))
    return rules


# Where a listing page shows its last page number.
LAST_PAGE = [
    ("bizquest", '//*[@id="results"]/nav/ul/li[9]/a'),
    ("bizbuysell", '//*[@id="pagination-breadcrumbs-block"]/app-pagination/div/pagination-template/ul/li[6]/a'),
    ("nationalfranchisesales", '//*[@id="listings-table_paginate"]/ul/li[last()-1]/a[1]'),
    ("bizben", "/html/body/div[2]/section[4]/div/div[1]/div[1]/div[2]/ul/li[1]"),
]
ITEM_COUNT = [("wesellrestaurants", "/html/body/section[2]/div/div/div[1]/div/div/div/div[2]/div[2]/div[2]/ul/li")]
CATEGORY_BUTTONS = '//*[@id="filter-form-cell"]/div/div[2]/div/div[2]/div[2]/div/span/div/div/button'
MURPHY_TEXTS = '//*[@id="list_div"]/div[1]/div/div[4]'
NO_POSTINGS = "no postings found searching on your criteria"
BASE_URLS = {"bizbuysell": "https://www.bizbuysell.com", "bizben": "https://www.bizben.com"}
BIZMLS_DETAIL = ("https://bizmls.com/cgi-bin/a-bus-d.asp?LIST_NUMBER=", "&more_details=go")
# Members directory: contact card in two layouts, member list.
CARD_LISTS = [
    "/html/body/div[5]/div[3]/div[1]/div/div/div/div/div/div/div/article/div/div/div[1]/ul[2]/li",
    '//*[@id="item-header-content"]/div[2]/ul/li',
]
CARD_PERSON = '//*[@id="item-header-content"]/div[1]/h1'
CARD_FRANCHISE = "/html/body/div[5]/div[3]/div[1]/div/div/div/div/div/div/div[1]/article/header/h1"
MEMBER_NAMES = '//*[@id="members-list"]/li/div[2]/div[1]/a'
MEMBER_TYPES = '//*[@id="members-list"]/li/div[2]/div[3]/span'

# Snapshot key per site; bizben never clears the on-sale flag.
SNAPSHOT_KEYS = {
    "bizben": "listing_number", "bizbuysell": "listing_number", "bizmls": "listing_number", "bizquest": "listing_number",
    "businessForSale": "listing_number", "franchiseflippers": "listing_number", "franchiseresales": "title",
    "murphybusiness": "listing_number", "nationalfranchisesales": "listing_number", "wesellrestaurants": "listing_number",
}
NEVER_RESET = {"bizben"}


@cache
def detail_rules(site: str) -> tuple[dict, ...]:
    return tuple(r for r in _detail_rules() if r["site"] == site)


@cache
def listing_rules(site: str) -> tuple[dict, ...]:
    return tuple(r for r in _listing_rules() if r["site"] == site)
