"""Surface areas, contact lists, logs: golden documents with a plain Python reading beside Spark."""

import re

import pytest

from pyspark.sql import functions as F

from fieldglean.operators import documents
from fieldglean.plans import contacts, logs, surface_area
from fieldglean.rules import contacts as R


def doc_pages(spark, docs):
    rows = [(d, i, t) for d, ts in docs.items() for i, t in enumerate(ts)]
    return spark.createDataFrame(rows, "doc string, page int, text string")


def test_surface_areas(spark):
    docs = {
        "range": ["nothing", "from 1,200 - 1,500 square feet\nand 900 sq. ft.", "also 2000 square feet", "stop", "5 square feet"],
        "single": ["900 sq.\n ft."], "none": ["abc", "12 feet"], "gap": ["x", None, "901 square foot", None, "700 sq. ft. more", "no"],
        "bad_end": ["100 sq. ft.", None], "all_bad": [None], "odd": ["10 to 15 square feet"], "case": ["10 SQUARE FEET"],
    }
    got = {r.doc: (r.area_min, r.area_max, r.area_mid, r.outcome) for r in surface_area.surface_areas(doc_pages(spark, docs)).collect()}
    na = ("N/A", "N/A", "N/A", "N/A")
    assert got == {
        "range": ("900 sq. ft.", "2000 sq. ft.", "1450.0 sq. ft.", "done"), "single": ("900 sq. ft.", "900 sq. ft.", "900.0 sq. ft.", "done"),
        "none": na, "case": na, "gap": ("700 sq. ft.", "901 sq. ft.", "800.5 sq. ft.", "done"),
        "bad_end": (None, None, None, "error"), "all_bad": (None, None, None, "error"), "odd": ("10 sq. ft.", "15 sq. ft.", "12.5 sq. ft.", "done"),
    }


HOW_TO = ("How to Use This Franchise Disclosure Document. How much can I earn? Item 19. How much will I need to invest? "
          "What’s it like to be a franchisee? See Exhibit “F” for a list. What else should I know?")
CONTENTS = "Table of Contents\nItem 1\nExhibit A Franchise Agreement\nExhibit F List of Franchisees\n"
ROWS = [("Ann Example", "1 Main St", "Springfield", "IL", "62701", "(555) 555-0101"), ("Bob Example", "2 Oak Ave", "Dayton", "OH", "45401", "(555) 555-0102"),
        ("Cy Example", "3 Elm Rd", "Austin", "TX", "73301", "(555) 555-0103")]


def list_text(rows):
    return "".join(f"{n}\n{a}\n{c}, {s} {z} \n{p}\n" for n, a, c, s, z, p in rows)


def catalogue_choice(text):
    """The best layout as a direct reading of the rule: matches, fields, order."""
    best = None
    for lay in R.catalogue():
        rx = re.compile(lay.regex.replace("(?diU)", ""), re.I)
        n = len(rx.findall(text))
        if n and (best is None or (n, len(lay.fields)) > best[0]):
            best = ((n, len(lay.fields)), lay)
    return best[1] if best else None


def fdd(list_pages, front=(HOW_TO, CONTENTS), at=5):
    pages = list(front) + ["body text"] * (at - len(front))
    return pages + list_pages + ["the end"]


def test_contact_lists_end_to_end(spark):
    head = "Exhibit F\nList of current outlets and their contact details as of this year\n"
    docs = {
        "plain-fdd.pdf": fdd([head + list_text(ROWS[:2]), list_text(ROWS[2:])]),
        "later-fdd.pdf": fdd([head + "see overleaf", list_text(ROWS[:2]) + "x" * 100]),
        "totals-fdd.pdf": fdd([head + "total " + list_text(ROWS)]),
        "bad-fdd.pdf": fdd([head + "no contacts at all " + "lorem " * 40]),
        "nothing-fdd.pdf": ["abc", "def"],
        "item20-fdd.pdf": ["body"] * 22 + ["Franchisee locations as of December 2022\n" + list_text(ROWS)] + ["end"],
        "broken-fdd.pdf": ["body", "table of contents\nnothing listed"],
    }
    ids = spark.createDataFrame([("plain-fdd.pdf", "17"), ("plain-fdd.pdf", "99")], "filename string, franchise_id string")
    rows, outcome = contacts.extract_contacts(doc_pages(spark, docs), ids)
    assert {r.doc: r.outcome for r in outcome.collect()} == {
        "plain-fdd.pdf": "regex", "later-fdd.pdf": "regex", "totals-fdd.pdf": "franchisees not found", "bad-fdd.pdf": "invalid methods",
        "nothing-fdd.pdf": "franchisees not found", "item20-fdd.pdf": "regex", "broken-fdd.pdf": "exceptions"}
    got = rows.orderBy("fdd_name", "row_no").collect()
    assert rows.columns == ["row_no", *R.CONTACT_COLUMNS]
    for doc, start in (("plain-fdd.pdf", 5), ("later-fdd.pdf", 6), ("item20-fdd.pdf", 22)):
        lay = catalogue_choice(docs[doc][start].replace("\n", "@"))
        mine = [r for r in got if r.fdd_name == doc]
        assert {r.regex for r in mine} == {lay.name}
        # Rows by hand: pages while the end of the layout matches, then every match.
        text, tail = "", re.compile(lay.tail.replace("(?diU)", ""), re.I)
        for page in docs[doc][start:]:
            page = page.replace("\n", "@")
            if not tail.search(page):
                break
            text += page
        want = []
        for m in re.finditer(lay.regex.replace("(?diU)", ""), text, re.I | re.M):
            value = {f: "".join(m.group(g) or "" for g in gs) for f, gs in lay.fields}
            want.append({f: v if lay.has_email else v.replace("@", "") for f, v in value.items()})
        assert len(want) >= 2 and len(mine) == len(want)
        for r, w in zip(mine, want):
            assert {c: r[c] for c in w if c in R.CONTACT_COLUMNS} == {c: v for c, v in w.items() if c in R.CONTACT_COLUMNS}
        assert {r.franchise_id for r in mine} == ({"17"} if doc == "plain-fdd.pdf" else {""})


def test_start_page_is_taken_as_given(spark):
    docs = {"a.pdf": ["x", list_text(ROWS) + "long enough " * 5, "end"], "b.pdf": ["x", "total " + list_text(ROWS)]}
    starts = spark.createDataFrame([("a.pdf", 1), ("b.pdf", 1)], "doc string, start_page int")
    rows, outcome = contacts.extract_contacts(doc_pages(spark, docs), None, starts)
    assert {r.doc: r.outcome for r in outcome.collect()} == {"a.pdf": "regex", "b.pdf": "franchisees not found"}
    assert rows.count() >= 2


@pytest.mark.parametrize("pages,want", [
    ([HOW_TO, CONTENTS], ("f", 1, False)),
    (["table of contents\nexhibit b list of franchisees", "x"], ("b", 0, False)),
    (["table of contents", "exhibit cc list of franchisees"], ("cc", 0, False)),
    (["table of contents\nto simplify", "exhibit d franchised outlets"], ("d", 0, False)),
    # The contents name nothing: the how-to exhibit counts.
    ([HOW_TO, "table of contents", "nothing", "x"], ("f", 1, False)),
    # Another exhibit in the contents, not longer than the one of the how-to page: the contents win.
    ([HOW_TO, "table of contents\nexhibit g list of franchisees", "x"], ("g", 1, False)),
    # A longer first entry gives way to the how-to page.
    ([HOW_TO, "table of contents\nappendix abc franchisees", "x"], ("f", 1, False)),
])
def test_locate(spark, pages, want):
    r = contacts.locate(doc_pages(spark, {"d": pages})).collect()
    got = [(x.list_regex.split('"?')[1] if x.list_regex else None, x.exhibit_page, x.failed) for x in r]
    assert got == [want]


def test_every_layout_compiles_in_both_and_counts_agree(spark):
    """Counts of all layouts on pages of several shapes: Java against Python."""
    shapes = [list_text(ROWS), list_text(ROWS).replace("\n", " \n"), "A1 \nShop\nAnn\n1 Main\nTown\nIL\n62701\n555-555-0101\n" * 2,
              "Bakery: 1 Main St, Town, IL 62701 – 555-555-0101\n", "1 Shop \n1 Main St \nTown, IL 62701 \n555.555.0101\n",
              "\n \nShop \n1 Main St, Town \n(555)555-0101\n", "Ann\nShop\nann@example.com \nTown, IL 62701 555-555-0101\n",
              "Owners: Ann\nPhone: 555-555-0101 Town, IL 62701\n" * 3, "no digits here\n", "Éva Ünal\n5 Rué\nTown, QC 62701 \n(555) 555-0101\n"]
    df = spark.createDataFrame([(i, s.replace("\n", "@")) for i, s in enumerate(shapes)], "id int, t string")
    counts = df.select("id", "t", F.array(*[F.regexp_count("t", F.lit(lay.regex)) for lay in R.catalogue()]).alias("n"),
                       F.array(*[F.forall(F.array(*[F.lit(p) for p in lay.needs]), lambda p: F.rlike("t", p)) if lay.needs else F.lit(True)
                                for lay in R.catalogue()]).alias("needs"),
                       documents.best_layout(F.col("t"), R.catalogue()).alias("best"))
    hits = 0
    for row in counts.collect():
        for lay, n, needs in zip(R.catalogue(), row.n, row.needs):
            want = len(re.findall(lay.regex.replace("(?diU)", ""), row.t, re.I))
            assert n == want, (lay.name, row.t)
            assert needs or not n, lay.name
            hits += n > 0
        choice = catalogue_choice(row.t)
        assert (row.best and -row.best.neg_ord) == (choice and choice.ord)
    assert hits > 60


def test_store_contacts(spark):
    cols = R.CONTACT_COLUMNS
    mk = lambda doc, phone, owner: (doc, phone, None, owner) + (None,) * (len(cols) - 4)
    schema = ", ".join(f"{c} string" for c in cols)
    stored = spark.createDataFrame([mk("a", "1", "old"), mk("a", "1", "old2"), mk("a", "", "blank"), mk("a", "2", "keep")], schema)
    new = spark.createDataFrame([(0, *mk("a", "1", "n0")), (1, *mk("a", "1", "n1")), (2, *mk("a", "", "n2")), (3, *mk("a", "9", "n3")),
                                 (4, *mk("a", "9", "n4")), (5, *mk("b", "1", "n5")), (6, *mk("a", None, "n6"))], "row_no int, " + schema)
    once = contacts.store_contacts(stored, new)
    got = sorted((r.fdd_name, r.phone or "-", r.owner_name) for r in once.collect())
    assert got == sorted([("a", "1", "n1"), ("a", "1", "n1"), ("a", "-", "blank"), ("a", "-", "n2"), ("a", "-", "n6"), ("a", "2", "keep"),
                          ("a", "9", "n3"), ("a", "9", "n4"), ("b", "1", "n5")])
    # Live keys are settled after the first time.
    live = new.filter("phone <> ''")
    twice = contacts.store_contacts(contacts.store_contacts(stored, live), live)
    assert twice.count() == contacts.store_contacts(stored, live).count()


def test_header_fields(spark):
    names = ["fdd_name", "Owner", "First Name", "E-Mail", "Telephone", "Website", "State", "City", "Mail address", "Zip", "Notes", "Franchise", "Job title", "???"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    got = [r.f for r in df.select("i", documents.header_field(F.col("n")).alias("f")).orderBy("i").collect()]
    assert got == ["fdd_name", "owner_name", "owner_name", "email", "phone", "website", "state", "city", "address", "zipcode",
                   "additional_information", "company_name", "", None]
    names = ["Name", "name of owner", "Business name", "Company", "E-Mail", "City"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "i int, n string")
    both = df.select("i", documents.header_field(F.col("n")).alias("f"), documents.header_field(F.col("n"), exact=True).alias("x")).orderBy("i").collect()
    assert [r.f for r in both] == [None, "owner_name", "company_name", "company_name", "email", "city"]
    assert [r.x for r in both] == ["owner_name", "owner_name", "company_name", "company_name", "email", "city"]


def test_contact_tables(spark):
    def cells(doc, rows):
        return [(doc, r, c, t) for r, row in enumerate(rows) for c, t in enumerate(row)]
    good = [["fdd_name", "method", "regex", "First", "Last", "Telephone", "E-mail", "City", "State", "Zip", "Other"],
            ["g.pdf", "camelot", "", "Ann", "Example", "555-0100", "a@example.com", "Town", "ST", "62701", "n1"],
            ["g.pdf", "camelot", "", None, "Solo", None, None, "X", None, None, "n2"]]
    bad = [["fdd_name", "Telephone", "???"], ["b.pdf", "555-0101", "lost"]]
    df = spark.createDataFrame(cells("g", good) + cells("b", bad), "doc string, row_no int, col_no int, text string")
    got = {(r.doc, r.row_no): r for r in contacts.contact_tables(df).collect()}
    assert (got["g", 1].owner_name, got["g", 2].owner_name, got["g", 1].phone, got["g", 1].zipcode) == ("Ann Example", "Solo", "555-0100", "62701")
    assert (got["g", 1].poor, got["b", 1].poor, got["b", 1].phone, got["b", 1].city) == (False, True, "555-0101", None)


def test_logs(spark):
    lines = ["2023-01-01 10:00:00,1 - x-2022-fdd.pdf: invalid methods", "t - x-2023-1-fdd.pdf: invalid methods",
             "t - x-2022-fdd.pdf: list of franchisees not found", "t - Exported to: ./test/results/b-2023-1-fdd.csv",
             "t - Exported with errors to: ./test/results_errors/c-2022-1-fdd.csv", "t - Processing page-3", "xx2022 fdd.pdf: no", "no separator"]
    raw = spark.createDataFrame([(x,) for x in lines], "value string")
    from fieldglean.functions.scalars import log_message
    msgs = raw.select(log_message("value").alias("message"))
    assert " separator" in [r.message for r in msgs.collect()]
    got = {r["class"]: (r.y2022, r.y2023) for r in logs.outcome_by_year(msgs).collect()}
    assert got == {"invalid methods": (1, 1), "franchisees not found": (1, 0), "exported with errors": (1, 0), "exported correctly": (0, 1)}
    out = [r.line for r in logs.result_lines(msgs).collect()]
    assert out == ["b-2023-1-fdd,csv,Exported correctly", "c-2022-1-fdd,csv,Exported with errors", "x-2022-fdd,pdf,invalid methods",
                   "x-2022-fdd,pdf,list of franchisees not found", "x-2023-1-fdd,pdf,invalid methods"]
    assert logs.drop_noise(msgs).count() == len(lines) - 1
