"""Listing jobs over several runs, against what a reader of the pages would store."""

from pagebuilder import Page

from fieldglean.plans import listing_jobs as jobs

_TABLE = '//*[@id="listing-tables"]/div/div/table/tbody/tr'


def table(spark, rows):
    return spark.createDataFrame(rows, "url string, html string")


def listing(*rows):
    p = Page()
    for i, (number, title, price, url) in enumerate(rows, start=1):
        p.put(f"{_TABLE}[{i}]", id=number, onclick=f"go('{url}')").put(f"{_TABLE}[{i}]/td[2]/a", title).put(f"{_TABLE}[{i}]/td[4]", price)
    return p.html()


def detail(revenue):
    top = '//*[@id="listings-details-top"]/div/div[5]/div[1]'
    return Page().put(f"{top}/h4[1]", "Annual Gross Revenue").put(f"{top}/h5[1]", revenue).html()


def test_listing_rows_meet_their_detail_pages_over_two_runs(spark):
    first = table(spark, [("p1", listing(("F1", "Cafe", "$1,000", "u1"), ("F2", "Bar", "$2,000", "u2"), ("F3", "Gone", "$3", "missing")))])
    details = table(spark, [("u1", detail("10")), ("u1", detail("10")), ("u2", "<html><body><p>nothing</p></body></html>")])
    store = jobs.run_site(None, first, details, "franchiseflippers", 1, 2024)
    got = {r.listing_number: r for r in store.collect()}
    assert set(got) == {"F1", "F2"}
    assert (got["F1"].title, got["F1"].asking_price, got["F1"].annual_gross_revenue) == ("Cafe", 1000, "10")
    assert (got["F2"].asking_price, got["F2"].annual_gross_revenue, got["F2"].version_no, got["F2"].on_sale) == (2000, None, 1, True)
    second = table(spark, [("p1", listing(("F1", "Cafe", "$1,000", "u1"))), ("p2", listing(("F4", "New", "$7", "u4")))])
    details = table(spark, [("u1", detail("11")), ("u4", detail("4"))])
    rows = jobs.run_site(store, second, details, "franchiseflippers", 2, 2024).collect()
    assert sorted((r.listing_number, r.version_no, r.run, r.annual_gross_revenue, r.on_sale) for r in rows if r.listing_number != "F2") == [
        ("F1", 1, 1, "10", False), ("F1", 2, 2, "11", True), ("F4", 1, 2, "4", True)]
    assert [(r.version_no, r.on_sale) for r in rows if r.listing_number == "F2"] == [(1, False)]


def franchise(title, headquarters, *links):
    p = Page().put('//*[@id="span-175-52363"]', title).put('//*[@id="code_block-64-52363"]/div/blockquote/ul/li[4]', f"HQ: {headquarters}")
    for i, href in enumerate(links, start=1):
        p.put(f'//*[@id="shortcode-190-52363"]/div/div[{i}]/div[2]/span[4]/a[1]', "more", href=href)
    return p.html()


def outlet(title, price):
    return Page().put('//*[@id="shortcode-9-52280"]', title).put('//*[@id="shortcode-19-52280"]', price).html()


def family(store):
    return ({r.title: r.id for r in store.ids.collect()},
            sorted((r.title, r.version_no, r.headquarters, r.on_sale) for r in store.parents.collect()),
            sorted((r.parent_id, r.url, r.title, r.asking_price) for r in store.children.collect()))


def test_parents_keep_their_ids_and_children_are_replaced(spark):
    one = table(spark, [("a", franchise("Alpha", "Rome", "x1", "x2", "lost")), ("b", franchise("Beta", "Oslo", "x3"))])
    kids = table(spark, [("x1", outlet("X1", "1")), ("x2", outlet("X2", "2")), ("x3", outlet("X3", "3"))])
    store = jobs.run_resales(None, one, kids, 1, 2024)
    ids, parents, children = family(store)
    assert sorted(ids.values()) == [1, 2] and family(jobs.run_resales(None, one, kids, 1, 2024))[0] == ids
    assert children == sorted([(ids["Alpha"], "x1", "X1", "1"), (ids["Alpha"], "x2", "X2", "2"), (ids["Beta"], "x3", "X3", "3")])
    # Beta is not seen, Alpha has moved and sells one outlet, Gamma is new; one title stands on two pages, of which the last counts.
    two = table(spark, [("a", franchise("Alpha", "Paris", "x2")), ("c", franchise("Gamma", "Bern", "x1")), ("d", franchise("Gamma", "Kiel", "x4"))])
    kids = table(spark, [("x1", outlet("X1", "1")), ("x2", outlet("X2", "9")), ("x4", outlet("X4", "4"))])
    again = jobs.run_resales(store, two, kids, 2, 2024)
    new, parents, children = family(again)
    assert new == {**ids, "Gamma": 3}
    assert parents == [("Alpha", 1, "Rome", False), ("Alpha", 2, "Paris", True), ("Beta", 1, "Oslo", False), ("Gamma", 1, "Kiel", True)]
    assert children == sorted([(ids["Alpha"], "x2", "X2", "9"), (ids["Beta"], "x3", "X3", "3"), (3, "x4", "X4", "4")])


def test_ids_of_new_keys_follow_the_greatest(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("",)], "k string")
    known = spark.createDataFrame([("gone", 41), ("b", 7)], "k string, id long")
    got = {r.k: r.id for r in jobs.with_new_ids(known, keys, "k").collect()}
    assert (got["gone"], got["b"]) == (41, 7) and sorted(got[k] for k in ("a", "")) == [42, 43] and len(got) == 4
    empty = spark.createDataFrame([], "k string")
    assert jobs.with_new_ids(None, empty, "k").count() == 0
    assert jobs.with_new_ids(known, empty, "k").count() == 2
