"""Field extraction from pages: every path of every site, label tables, rows, state registers."""

import pytest
from pagebuilder import Page

from pyspark.sql import functions as F

from fieldglean.operators import html
from fieldglean.plans import listings, registry
from fieldglean.rules import registry as RR
from fieldglean.rules import sites as R


def pages(spark, docs, **extra):
    rows = [(i, d, *[v[i] for v in extra.values()]) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "page_id bigint, html string" + "".join(f", {k} string" for k in extra))


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def test_nodes_paths_text_and_repair(spark):
    doc = '<html><body><p id="a">one<br>two<p>three <b>bold</b> end<script>var t="</p>";</script><ul><li>x<li>y</ul></body></html>'
    rows = {("/".join(r.tags), tuple(r.idx)): r for r in html.html_nodes(pages(spark, [doc])).collect()}
    first, second = rows["html/body/p", (1, 1, 1)], rows["html/body/p", (1, 1, 2)]
    assert (first.text, first.content) == ("one", "onetwo")
    assert second.text == "three " and second.content.startswith("three bold end")
    assert rows["html/body/p/b", (1, 1, 2, 1)].content == "bold"
    assert [r.content for k, r in sorted(rows.items()) if k[0].endswith("li")] == ["x", "y"]
    assert [(a.id, a.depth) for a in first.anchors] == [("a", 3)]


@pytest.mark.parametrize("site", sorted({s for s, _, _ in R.site_paths()}))
def test_every_path_of_a_site(spark, site):
    page, want = Page(), {}
    used = {}
    for s, field, xpath in R.site_paths():
        if s == site and field not in want:
            # Two fields of one site share a path, and so a text.
            want[field] = used.setdefault(xpath, f"text of {field} {len(want)}")
            page.put(xpath, want[field])
    got = one(listings.raw_fields(pages(spark, [page.html()]), site))
    # Elements that contain others also show the text of those, so compare the beginning.
    assert {f: (got[f] or "")[: len(t)] for f, t in want.items()} == want


def test_fallback_path_and_label_tables_bizquest(spark):
    p = Page()
    paths = [x for s, f, x in R.site_paths() if (s, f) == ("bizquest", "title")]
    p.put(paths[1], "Second title")
    base = "/html/body/div[2]/div[2]/div[1]"
    for i, (k, v) in enumerate([("Location:", "Town, ST"), ("Number of Employees:", "1,200 people"), ("ID:", "L7"),
                                ("Market Outlook/", "good"), ("Unknown:", "zzz")], start=1):
        p.put(f"{base}/dl[1]/dt[{i}]", k).put(f"{base}/dl[1]/dd[{i}]", v)
    p.put(f"{base}/dl[2]/dt[1]", "Relocatable:").put(f"{base}/dl[2]/dd[1]", "Yes")
    p.put('//*[@id="franchise-details-container"]/div[2]/div[1]/div[9]/div/ul/li[2]/span[2]', "Mobile")
    p.put('//*[@id="franchise-details-container"]/div[2]/div[1]/div[8]/div[1]/p', "$10K - $20K")
    p.put('//*[@id="crumbs"]/li[2]/a/span', "Ohio Businesses for Sale").put('//*[@id="crumbs"]/li[4]/a/span', "Ohio Food Businesses for Sale")
    got = one(listings.detail_records(pages(spark, [p.html()]), "bizquest", 2024))
    assert got["title"] == "Second title" and (got["city"], got["state"]) == ("Town", "ST")
    assert got["number_of_employees"] == 1200 and got["listing_number"] == "L7"
    assert got["market_outlook_competition"] == "good" and got["relocatable"] == "Yes" and got["mobile"] == "Yes"
    assert got["sba_approved"] is None and got["category"] == "Food"
    assert (got["initial_investment"], got["initial_investment_min"], got["initial_investment_max"]) == ("10000 - 20000", 10000, 20000)


def test_location_without_comma(spark):
    p = Page().put("/html/body/div[2]/div[2]/div[1]/dl[1]/dt[1]", "Location:").put("/html/body/div[2]/div[2]/div[1]/dl[1]/dd[1]", "Town")
    src = pages(spark, [p.html()])
    assert listings.detail_records(src, "bizquest", 2024).count() == 0
    got = one(listings.detail_records(src, "bizquest", 2024, exact=True))
    assert (got["city"], got["state"]) == ("Town", None)


def test_bizbuysell_pairs(spark):
    p = Page()
    fin = '//*[@id="aspnetForm"]/div[2]/div[2]/div/div/div/div/div[3]/div[1]/div[2]/div'
    p.put(f"{fin}/div[1]/div[1]/p/b", "$95,000").put(f"{fin}/div[1]/div[2]/p/b", "10K")
    p.put(f"{fin}/div[2]/div[1]/p[1]/span", "Gross Revenue:").put(f"{fin}/div[2]/div[1]/p[1]/b", "$1.5M")
    p.put(f"{fin}/div[2]/div[2]/p[3]/span", "Inventory:").put(f"{fin}/div[2]/div[2]/p[3]/b", "$2,500")
    dl = '//*[@id="ctl00_ctl00_Content_ContentPlaceHolder1_wideProfile_listingDetails_dlDetailedInformation"]'
    for i, (k, v) in enumerate([("Location:", "Town, ST"), ("Inventory:", "Included"), ("Employees:", "12 FT")], start=1):
        p.put(f"{dl}/dt[{i}]/strong", k).put(f"{dl}/dd[{i}]", v)
    p.put('//*[@id="contactForm"]/div/div[2]/div[3]/h3', "Listed by:\n Ann Example Phone 555-0100")
    p.put('//*[@id="premiumListingDetails"]/div[2]/p[1]/b', "ID: 77")
    src = pages(spark, [p.html()])
    got = one(listings.detail_records(src, "bizbuysell", 2024))
    assert (got["asking_price"], got["cash_flow"], got["gross_revenue"], got["inventory"]) == (95000, 10000, 1, 2500)
    assert (got["inventory_included"], got["employees"], got["city"], got["seller"]) == ("Included", 12, "Town", "ann example")
    assert got["listing_number"] == "77"
    assert one(listings.detail_records(src, "bizbuysell", 2024, exact=True))["gross_revenue"] == 1500000


def test_business_for_sale(spark):
    p = Page().put('//*[@id="address"]', "Town,County,ST,US").put('//*[@id="title-address"]/div[1]/h1', "A Franchise for you")
    p.put('//*[@id="main-listing-content"]/div[1]/dl[1]/dd/span', "$10K - $12K").put('//*[@id="business-operation"]/dl[1]/dt', "Years established:")
    p.put('//*[@id="business-operation"]/dl[1]/dd', "12").put('//*[@id="business-operation"]/dl[2]/dt', "Employees:")
    p.put('//*[@id="business-operation"]/dl[2]/dd/p', "7").put('//*[@id="franchise-terms"]/dl[1]/dt', "Franchise terms:")
    p.put('//*[@id="franchise-terms"]/dl[1]/dd', "10 years")
    got = one(listings.detail_records(pages(spark, [p.html()]), "businessForSale", 2024))
    assert (got["county"], got["state"], got["country"], got["franchise"]) == ("County", "ST", "US", "Yes")
    assert (got["asking_price"], got["asking_price_min"], got["asking_price_max"]) == ("10000 - 12000", 10000, 12000)
    assert (got["year_established"], got["number_of_employees"], got["franchise_terms"]) == (2012, "7", "10 years")


def test_bizmls_record_and_yearly(spark):
    t = "/html/body/section/div/table/tbody/tr/td"
    p = Page().put(f"{t}/table[1]/tbody/tr/td[1]/span", "Listing Number 4711 x").put(f"{t}/table[2]/tbody/tr[2]/td[7]/span", "120,000")
    p.put(f"{t}/table[2]/tbody/tr[3]/td[7]/span", "120,000").put(f"{t}/table[4]/tbody/tr[3]/td[3]/span", "Years Established: 12 Mgrs: 1 Emp PT: 2")
    p.put(f"{t}/table[4]/tbody/tr[4]/td[3]/span", "Emp FT: 3 Hours Owner Works: 20").put(f"{t}/table[4]/tbody/tr[8]/td[3]/span", "Is Relocatable: Y Is a Franchise: N")
    p.put(f"{t}/table[6]/tbody/tr[1]/td[5]", "5,000").put(f"{t}/table[6]/tbody/tr[1]/td[6]", "N*").put(f"{t}/table[7]/tbody/tr[2]/td[3]/span", "1,500 USD")
    p.put(f"{t}/table[8]/tbody/tr[5]/td[1]/span/b", "Some Town, ST 33101")
    for i, y in ((2, "FY 2019"), (4, "2021 est")):
        p.put(f"{t}/table[5]/tbody/tr[2]/td[{i}]", y).put(f"{t}/table[5]/tbody/tr[3]/td[{i}]", f"{i},000").put(f"{t}/table[5]/tbody/tr[13]/td[{i}]", "n/a")
    src = pages(spark, [p.html()])
    got = one(listings.detail_records(src, "bizmls", 2024))
    assert (got["listing_number"], got["price"], got["seller_financing"], got["founding_year"]) == ("4711", 120000, "No", 2012)
    assert (got["number_of_employees"], got["absentee_owner"], got["relocatable"], got["franchise"]) == (6, "Yes", "Yes", "No")
    assert got["real_state_value"] is None and got["loan_seller_amt"] == "1500"
    assert (got["contact_city"], got["contact_state"], got["contact_zip_code"]) == ("Some Town", "ST", "33101")
    y = one(listings.yearly_financials(src))
    assert (y["gross_revenue_2019"], y["gross_revenue_2021"], y["gross_revenue_2020"]) == (2000, 4000, None)
    assert y["cash_flow_2019"] == "FY 2019" and y["owner_benefit_2021"] is None


def test_other_sites(spark):
    p = Page().put('//*[@id="p-info"]/div/p[1]', "Lease: 5,5 years\n: x")
    p.put("/html/body/section[2]/div/div/div[1]/div/div[2]/div[3]/div/div/ul/li[2]", "Asking Price: $95,000")
    p.put("/html/body/section[2]/div/div/div[1]/div/div[2]/div[3]/div/div/ul/li[1]", "Listing: 7,001")
    got = one(listings.detail_records(pages(spark, [p.html()]), "wesellrestaurants", 2024))
    assert (got["asking_price"], got["listing_number"], got["lease_term"]) == (95000, 7001, "55 years")
    q = Page().put('//*[@id="listings-details-top"]/div/div[5]/div[1]/h4[1]', "Annual Gross Revenue").put('//*[@id="listings-details-top"]/div/div[5]/div[1]/h5[1]', "9")
    q.put('//*[@id="listings-details-top"]/div/div[5]/div[2]/h4[2]', "The year established is").put('//*[@id="listings-details-top"]/div/div[5]/div[2]/h5[2]', "1999")
    got = one(listings.detail_records(pages(spark, [q.html()]), "franchiseflippers", 2024))
    assert (got["annual_gross_revenue"], got["years"], got["training"]) == ("9", "1999", None)
    b = Page().put("/html/body/div[2]/div/div[2]/div/p[1]", "Call us").put("/html/body/div[2]/section/div/div[1]/div/div[4]/ol[1]/li[3]/p/span", "$12,500.50")
    b.put("/html/body/div[2]/section/div/div[1]/div/div[3]/ol/li[3]/span[2]", "Text 555-0101")
    got = one(listings.detail_records(pages(spark, [b.html()]), "bizben", 2024))
    assert (got["asking_price"], got["cash_flow"], got["agent_phone_1"]) == (None, 12500.5, " 555-0101")


def test_listing_rows(spark):
    p = Page()
    base = '//*[@id="searchFilterForm"]/section/div/div[1]/div'
    for i in range(1, 7):
        p.put(f"{base}[{i}]/table[1]/caption[1]/h2[1]/a[1]", f"t{i}", href=f"/l{i}")
    rows = listings.listing_rows(pages(spark, [p.html()]), "businessForSale")
    assert sorted(r.href for r in rows.collect()) == ["/l2", "/l3", "/l4"]
    tr = '//*[@id="listing-tables"]/div/div/table/tbody/tr'
    p = Page().put(f"{tr}[1]", id="F1", onclick="go('https://e.example/1')").put(f"{tr}[1]/td[2]/a", "Shop").put(f"{tr}[1]/td[4]", "$5,000").put(f"{tr}[1]/td[7]", "ST")
    got = one(listings.listing_rows(pages(spark, [p.html()]), "franchiseflippers"))
    assert (got["listing_number"], got["title"], got["asking_price"], got["county"], got["state"]) == ("F1", "Shop", 5000, None, "ST")
    assert got["url"] == "https://e.example/1"
    tr = '//*[@id="listings-table"]/tbody/tr'
    p = Page().put(f"{tr}[2]/td[1]", data_href="/listing/881 ").put(f"{tr}[2]/td[1]/a[2]", "Brand").put(f"{tr}[2]/td[5]/span", "Open")
    got = one(listings.listing_rows(pages(spark, [p.html()]), "nationalfranchisesales"))
    assert (got["listing_number"], got["brand"], got["status"]) == ("881", "Brand", "Open")
    base = "/html/body/div[2]/section[4]/div/div[1]/div[2]/div"
    p = Page()
    for i, cls in ((1, "item"), (2, "x bannerWrapper"), (3, "item")):
        p.put(f"{base}[{i}]", **{"class": cls}).put(f"{base}[{i}]/div/div/div/a", "t", href=f"/b{i}")
    empty = Page().put("/html/body/div[2]", "No postings found searching on your criteria").put(f"{base}[1]/div/div/div/a", href="/no")
    rows = listings.listing_rows(pages(spark, [p.html(), empty.html()]), "bizben")
    assert sorted(r.href for r in rows.collect()) == ["https://www.bizben.com/b1", "https://www.bizben.com/b3"]
    p = Page()
    for i in range(1, 6):
        p.put(f'//*[@id="div_block-14-52357"]/div[{i}]/div[1]/div[1]/a[1]', href=f"/r{i}").put(f'//*[@id="div_block-14-52357"]/div[{i}]/div[1]/div[1]/a[2]', href=f"/s{i}")
    rows = listings.listing_rows(pages(spark, [p.html()]), "franchiseresales")
    assert sorted(r.href for r in rows.collect()) == ["/r4", "/r5", "/s4", "/s5"]


def test_murphy_rows_and_blocks(spark):
    d = '//*[@id="list_div"]/div[1]/div[4]'
    p = Page().put(f"{d}/h2/a", "Bakery", href="/m1").put(f"{d}/div[2]/ul[2]/li[2]/span", "$1,000").put(f"{d}/div[2]/ul[2]/li[3]/span", "M1")
    p.put(f"{d}/div[4]/strong[1]", "Business Category").put(f"{d}/div[4]/p[1]", "Food")
    p.at(f"{d}/div[4]").child("strong", 2).text = "About"
    p.at(f"{d}/div[4]").child("p", 2).text = "Old"
    p.at(f"{d}/div[4]").child("p", 3).text = "Town"
    got = one(listings.murphy_listings(pages(spark, [p.html()])))
    assert (got["title"], got["link"], got["price"], got["listing_number"]) == ("Bakery", "/m1", 1000.0, "M1")
    assert got["category"] == "Food" and got["description"] == "OldTown"


def test_categories_pagination_links(spark):
    p = Page()
    for i, (c, t) in enumerate([("multiselect-all", "All"), ("group", "Food"), ("multiselect-group-option-indented", "Bakery"),
                                ("multiselect-group-option-indented", "Deli"), ("group", "Auto"), ("multiselect-group-option-indented", "Wash")], start=1):
        p.put(f"{R.CATEGORY_BUTTONS}[{i}]", t, title=t, **{"class": c})
    rows = listings.category_tree(pages(spark, [p.html()])).orderBy("index").collect()
    assert [(r.industry, r.category, r["index"]) for r in rows] == [("Food", "Bakery", 3), ("Food", "Deli", 4), ("Auto", "Wash", 6)]
    q = Page()
    for i in range(1, 5):
        q.put(f'//*[@id="listings-table_paginate"]/ul/li[{i}]/a', str(i * 10))
    assert one(listings.last_page(pages(spark, [q.html()]), "nationalfranchisesales"))["last_page"] == 30
    bare = "<ul><li><a>1</a></li><li><span> 8 </span></li><li><a>next</a></li></ul>"
    assert one(listings.list_last_page(pages(spark, [bare])))["last_page"] == "8"
    ul = '//*[@id="list_div"]/div[1]/div[1]/ul/li'
    mid = Page().put(f"{ul}[1]/a", "1").put(f"{ul}[2]", **{"class": "active"}).put(f"{ul}[3]/a", "3")
    end = Page().put(f"{ul}[1]/a", "1").put(f"{ul}[2]", **{"class": "active"})
    got = listings.next_item(pages(spark, [mid.html(), end.html()])).orderBy("page_id").collect()
    assert [r.next_item for r in got] == [3, -1]
    link = spark.createDataFrame([("open('x?LIST_NUMBER=55&gen_hp=1')",)], "o string").select(listings.bizmls_link("o").alias("u")).first().u
    assert link == "https://bizmls.com/cgi-bin/a-bus-d.asp?LIST_NUMBER=55&more_details=go"


def test_contact_cards(spark):
    p, q = Page(), Page()
    ul = R.CARD_LISTS[0]
    for i, (k, v) in enumerate([("Contact Person:", "Ann Example"), ("Email Address:", ""), ("Phone:", "555-0100"), ("Address:", "1 Main\nTown")], start=1):
        p.put(f"{ul}[{i}]/b", k)
        li = p.at(f"{ul}[{i}]")
        if v:
            li.child("i", 1).text = " " + v
    p.put(f"{ul}[2]/a", "ann@example.com").put(R.CARD_FRANCHISE, "Example Franchise")
    ul = R.CARD_LISTS[1]
    q.put(R.CARD_PERSON, "Bob Example").put(f"{ul}[1]/b", "Email:").at(f"{ul}[1]").child("i", 1).text = " bob@example.com"
    q.put(f"{ul}[2]/b", "URL:").at(f"{ul}[2]").child("i", 1).text = "http://x.example"
    a, b = listings.contact_cards(pages(spark, [p.html(), q.html()])).orderBy("page_id").collect()
    assert (a.contact, a.email, a.phone, a.address, a.franchise_name) == ("Ann Example", "ann@example.com", "555-0100", "1 Main Town", "Example Franchise")
    assert (b.contact, b.email, b.url, b.franchise_name) == ("Bob Example", "bob@example.com", "http://x.example", "")
    m = Page()
    for i in (1, 2):
        m.put(f'//*[@id="members-list"]/li[{i}]/div[2]/div[1]/a', f"Member {i}").put(f'//*[@id="members-list"]/li[{i}]/div[2]/div[3]/span', "Supplier")
    got = listings.member_names(pages(spark, [m.html()])).orderBy("pos").collect()
    assert [(r.member, r.member_type) for r in got] == [("Member 1", "Supplier"), ("Member 2", "Supplier")]
    owners = spark.createDataFrame([("o1",), ("o2",)], "owner string")
    cards = listings.contact_cards(pages(spark, [p.html()])).withColumns({"owner": F.lit("o1"), "member_type": F.lit("Franchisor")})
    rows = {r.owner: r.asDict() for r in listings.owner_contacts(owners, cards, "page_id").collect()}
    assert rows["o1"]["Contact Name"] == "Ann Example" and rows["o1"]["Member Type"] == "Franchisor" and rows["o2"]["Contact Email"] == ""
    names = spark.createDataFrame([("F1",), ("F2",)], "franchise string")
    flags = listings.visa_flags(names, spark.createDataFrame([("F1",), ("F1",)], "franchise string"), spark.createDataFrame([("zz",)], "franchise string"))
    assert sorted(tuple(r) for r in flags.collect()) == [("F1", "Yes", "No"), ("F2", "No", "No")]


def state_page(state, **texts):
    """A page of a state: field=text or list of texts per row, put on the paths of its rules."""
    p = Page()
    for r in RR.owner_rules():
        if r["site"] != state or r["field"] not in texts:
            continue
        base = (f'//*[@id="{r["anchor"]}"]/' if r["anchor"] else "/") + r["path"]
        value = texts[r["field"]]
        if isinstance(value, str):
            p.put(base.rstrip("/"), value or "")
            continue
        steps = r["path"].split("/")
        for n, text in enumerate(value, start=1 + r["skip_first"]):
            if text is None:
                continue
            if r["depth"]:
                name = steps[r["depth"] - 1].split("[")[0]
                path = "/".join([*steps[: r["depth"] - 1], f"{name}[{n}]", *steps[r["depth"]:]])
                p.put((f'//*[@id="{r["anchor"]}"]/' if r["anchor"] else "/") + path, text)
            elif r["priority"] == n:
                p.put(base.rstrip("/"), text)
    return p.html()


CASES = [
    ("Alabama", dict(owner=["x", "Ann"], owner_label=["Other", "Registered Agent Name"]), [("NOT IMPLEMENTED", "Ann")]),
    ("Arkansas", dict(owner=["x", "Ann"], owner_label=["Other", "Reg. Agent"]), [("NOT IMPLEMENTED", "Ann")]),
    ("Arizona", dict(owner="Ann"), [("NOT IMPLEMENTED", "Ann")]),
    ("California", dict(owner=list("abcdefg")), [("NOT IMPLEMENTED", c) for c in "abcde"]),
    ("Colorado", dict(owner=["x", "Ann"], owner_label=["Date", "Name"], guard="Registered Agent"), [("NOT IMPLEMENTED", "Ann")]),
    ("Colorado", dict(owner=["x", "Ann"], owner_label=["Date", "Name"], guard="Other"), []),
    ("Connecticut", dict(owner=["a", "b", "c"], status=["ACTIVE", "GONE", "ACTIVE"]), [("NOT IMPLEMENTED", "a"), ("NOT IMPLEMENTED", "c")]),
    ("Florida", dict(owner="Ann"), [("NOT IMPLEMENTED", "Ann")]),
    ("Texas", dict(owner=["x", "Ann"], owner_label=["Other", "Registered Agent Name"]), [("NOT IMPLEMENTED", "Ann")]),
    ("Illinois", dict(owner=["x", "Ann"], owner_label=["Other", "Agent Information"]), [("NOT IMPLEMENTED", "Ann")]),
    ("New York", dict(owner="Ann", entity="Shop"), [("Shop", "Ann")]),
    ("North Carolina", dict(owner=["Ann", "Bob"], entity="Shop", agent="Cy"), [("Shop", "Ann"), ("Shop", "Bob")]),
    ("North Carolina", dict(entity="Shop", agent="Cy"), [("Shop", "Cy")]),
    ("North Carolina", dict(agent="Cy"), []),
    ("Michigan", dict(entity="Shop", owner="Ann"), [("Shop", "Ann")]),
    ("Delaware", dict(entity="Shop"), [("Shop", "")]),
    ("Hawaii", dict(entity="Shop", owner=["Ann", "Bob"], owner_guard="Officers", agent=["x"], agent_label=["AGENT NAME"]), [("Shop", "Ann"), ("Shop", "Bob")]),
    ("Hawaii", dict(entity="Shop", owner=["Ann"], owner_guard="Trade names", agent=["x", "Cy"], agent_label=["STATUS", "AGENT NAME"]), [("Shop", "Cy")]),
    ("Hawaii", dict(entity="Shop"), [("Shop", "NOT FOUND")]),
    ("Idaho", dict(owner=list("abcd"), row_entity=["A", "B", "C", "D"]), [("A", "a"), ("B", "b"), ("C", "c")]),
    ("Indiana", dict(entity="Shop", owner=["Ann", "Bob"]), [("Shop", "Ann"), ("Shop", "Bob")]),
    ("Indiana", dict(entity="Shop", agent=[None, "Cy"], agent_label=[None, "Registered Agent Information"]), [("Shop", "Cy")]),
    ("Iowa", dict(entity="Shop", owner="Ann"), [("Shop", "Ann")]),
    ("Kansas", dict(entity="Shop", owner="Ann", guard="Current Status: ACTIVE AND IN GOOD STANDING"), [("Shop", "Ann")]),
    ("Kansas", dict(entity="Shop", owner="Ann", guard="Current Status: FORFEITED"), []),
    ("Kentucky", dict(owner=["Shop", "x", "Ann"], owner_label=["Name", "Date", "Registered Agent"]), [("Shop", "Ann")]),
    ("Louisiana", dict(entity="Shop", guard="Active", no_agent="", owner=["Ann", "Bob"], agent="Cy"), [("Shop", "Ann"), ("Shop", "Bob")]),
    ("Louisiana", dict(entity="Shop", guard="Active", agent="Cy"), [("Shop", "Cy")]),
    ("Louisiana", dict(entity="Shop", guard="Inactive", agent="Cy"), []),
    ("Maine", dict(entity="Shop", owner="Ann"), [("Shop", "Ann")]),
    ("Mississippi", dict(entity="Shop", owner=["Ann B", "Bob C"]), [("Shop", "AnnB"), ("Shop", "BobC")]),
    ("Massachusetts", dict(entity="Shop", owner="Ann"), [("Shop", "Ann")]),
    ("Montana", dict(entity="Shop", owner="Ann"), [("Shop", "Ann")]),
    ("Montana", dict(entity="Shop", owner="Ann", none="No results"), []),
]


def test_state_owners(spark):
    src = pages(spark, [state_page(s, **t) for s, t, _ in CASES], state=[c[0] for c in CASES])
    got = {}
    for r in registry.owner_pairs(src).orderBy("page_id", "pos").collect():
        got.setdefault(r.page_id, []).append((r.franchise_found, r.result))
    for i, (state, _, want) in enumerate(CASES):
        assert got.get(i, []) == want, (i, state)


def test_answers(spark):
    asked = spark.createDataFrame([("A", " Texas "), ("B", "Texas"), ("C", "Ohio")], "franchise string, state string")
    found = spark.createDataFrame([("A", "Texas", "Shop", "Ann"), ("A", "Texas", "Shop", "Bob"), ("C", "Ohio", "x", "y")],
                                  "franchise string, state string, franchise_found string, result string")
    got = sorted(tuple(r) for r in registry.answers(asked, found).collect())
    assert got == [("Ohio", "C", "NOT FOUND", "NOT FOUND"), ("Texas", "A", "Shop", "Ann"), ("Texas", "A", "Shop", "Bob"),
                   ("Texas", "B", "NOT FOUND", "NOT FOUND")]


def hit_page(state, statuses, hrefs=True):
    p = Page()
    for r in RR.hit_rules():
        if r["site"] != state:
            continue
        steps = r["path"].split("/")
        for n, s in enumerate(statuses, start=1 + r["skip_first"]):
            name = steps[r["depth"] - 1].split("[")[0]
            path = "/".join([*steps[: r["depth"] - 1], f"{name}[{n}]", *steps[r["depth"]:]])
            xp = (f'//*[@id="{r["anchor"]}"]/' if r["anchor"] else "/") + path
            if r["field"] == "href":
                p.put(xp, href=f"/h{n}")
            elif r["field"] == "status":
                p.put(xp, s)
            else:
                p.put(xp)
    return p.html()


def test_search_hits(spark):
    A, X = "Active", "Gone"
    cases = [("Florida", [X, A, A, X, A, A]), ("Iowa", [X, A, A, X, A, A]), ("Kentucky", [X] * 5), ("Maine", [X] * 4),
             ("Massachusetts", [X] * 2), ("Indiana", [X, A, A]), ("Indiana", [X]), ("Mississippi", [X, "Good Standing"]), ("Texas", [X] * 7),
             ("New York", [X] * 2)]
    src = pages(spark, [hit_page(*c) for c in cases], state=[c[0] for c in cases])
    got = {}
    for r in registry.search_hits(src).orderBy("page_id", "row_no").collect():
        got.setdefault(r.page_id, []).append(r.row_no)
    assert [got.get(i, []) for i in range(len(cases))] == [
        [2, 3, 5], [3, 4, 6], [2, 3, 4], [6, 7, 8], [2, 3], [2], [], [2], list(range(1, 8)), [1, 2]]
    assert [r.row_no for r in registry.first_active(src, "Indiana").orderBy("page_id").collect()] == [2, -1]
    assert {r.page_id: r.options for r in registry.hit_counts(src.filter("state in ('Texas', 'New York')")).collect()} == {8: 7, 9: 2}


def test_colorado_hits(spark):
    t = RR.COLORADO_HITS
    p = Page()
    for i, title in enumerate(["#", "ID Number", "Name", "Status"], start=1):
        p.put(f"{t}[1]/th[{i}]/a/b", title)
    for n, s in ((2, "Good Standing"), (3, "Delinquent"), (4, "Good Standing")):
        p.put(f"{t}[{n}]/td[2]/a", "id", href=f"/c{n}").put(f"{t}[{n}]/td[4]", s)
    got = registry.colorado_hits(pages(spark, [p.html()])).orderBy("row_no").collect()
    assert [r.href for r in got] == ["/c2", "/c4"]


def test_node_tests(spark):
    shown = Page().put('//*[@id="editModal"]', style="color: red").put('//*[@id="k"]/div', data_x="v1").html()
    hidden = Page().put('//*[@id="editModal"]', style="display: none;").html()
    src = pages(spark, [shown, hidden, "<html><body><script>f({'key': 'abc',})</script></body></html>"])
    assert {r.page_id: r.open for r in registry.dialog_open(src).collect()} == {0: True, 1: False}
    assert [r.page_id for r in registry.has_node(src, '//*[@id="k"]/div').collect()] == [0]
    assert one(registry.attribute(src, '//*[@id="k"]/div', "data-x"))["value"] == "v1"
    assert one(registry.script_value(src, "'key':.'(.*)',"))["value"] == "abc"
    flags = spark.createDataFrame([(RR.REFUSALS[1] + " here",), ("fine",)], "t string").select(registry.refused("t").alias("r"))
    assert [r.r for r in flags.collect()] == [True, False]
