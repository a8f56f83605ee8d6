"""Matches over a text in parts against the matches of the whole text, for every layout of the catalogue."""

import random
import re

import pytest

from fieldglean.operators.segments import Segments, reach_of
from fieldglean.rules import contacts as R
from fieldglean.plans import contacts

LINES = ["Ann Example", "Example Foods LLC", "12 Main Street", "Springfield, IL 62701", "Springfield", "IL", "62701", "(555) 555-0123", "555-555-0123", "",
         " ", "phone: 555-555-0123 ", "a@example.com", "Owner: (Bob)", "1. Shop (Ann)", "Springfield, IL 62701-0123 ", "Main Rd, Town, ST 12345, 555.555.0123", "no, commas: here)"]


def patterns():
    return [pytest.param(lay.regex.removeprefix(R.FLAGS), id=lay.name) for lay in R.catalogue()]


@pytest.mark.parametrize("pattern", patterns())
def test_parts_give_the_matches_of_the_whole(pattern):
    rng = random.Random(pattern)
    for _ in range(12):
        text = "".join(rng.choice(LINES) + rng.choice(["@", " @", "@ ", ", ", "@@"]) for _ in range(rng.randint(1, 60)))
        if rng.random() < 0.5:
            text += "555-555-0123 @Springfield, IL 62701 @(555) 555-0123" * rng.randint(0, 3)
        want = [(m.group(), m.groups()) for m in re.finditer(pattern, text, re.I)]
        segments, got, at = Segments(pattern, re.I, part=rng.choice([1, 7, 50])), [], 0
        while at < len(text):
            size = rng.randint(1, 60)
            got += [(m.group(), m.groups()) for m in segments.feed(text[at:at + size])]
            at += size
        assert got + [(m.group(), m.groups()) for m in segments.finish()] == want


def test_long_text_in_bounded_memory():
    lay = next(x for x in R.catalogue() if x.name == "table_columns_3")
    pages = 100_000
    segments, n = Segments(lay.regex.removeprefix(R.FLAGS), re.I), 0
    for i in range(pages):
        n += sum(1 for _ in segments.feed(f"Owner {i}@{i} Main Street@Town@IL@62701@(555) 555-0123@" if i % 2 else f"Owner {i}@{i} Main Street@Tow"))
        if not i % 2:
            n += sum(1 for _ in segments.feed("n@IL@62701@(555) 555-0123@"))
    n += sum(1 for _ in segments.finish())
    assert n == pages
    assert segments.most_held < 200_000


def test_reach_never_falls_and_covers_what_a_match_reads():
    rng = random.Random(5)
    text = "".join(rng.choice(LINES) + "@" for _ in range(60))
    for lay in R.catalogue():
        reach = reach_of(lay.regex.removeprefix(R.FLAGS), re.I)
        found = [reach(text, i) for i in range(0, len(text), 7)]
        assert found == sorted(found)
        assert all(reach(text, m.start()) >= m.end() for m in re.finditer(lay.regex.removeprefix(R.FLAGS), text, re.I))


def test_patterns_that_look_around_are_refused():
    for pattern in (r"a(?=b)", r"^a", r"(a)\1", r"\ba"):
        with pytest.raises(ValueError):
            Segments(pattern)


def test_contacts_over_page_breaks_of_a_long_list(spark):
    """Contacts cut anywhere by the ends of 3,000 pages, two documents, rows as from one text."""
    lay = next(x for x in R.catalogue() if x.name == "table_columns_3")
    rows, want = [], []
    for doc, shift in (("a", 13), ("b", 40)):
        text = "".join(f"Owner {doc}{i}@{i} Main Street@Town@IL@{10000 + i}@(555) 555-{i:04d}@" for i in range(4000))
        cuts = list(range(shift, len(text), 70))
        pages = [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]
        rows += [(doc, lay.ord, i, p) for i, p in enumerate(pages)]
        want += [(doc, i, m["name"] if "name" in m.groupdict() else None, m[2], m[6]) for i, m in enumerate(re.finditer(lay.regex.removeprefix(R.FLAGS), text, re.I))]
    df = spark.createDataFrame(rows, "doc string, ord int, page int, text string").repartition(7)
    got = contacts.contact_rows(df).select("fdd_name", "row_no", "address", "phone", "email").collect()
    assert sorted((r[0], r[1], r[2], r[3]) for r in got) == [(d, i, a, p) for d, i, _, a, p in want]
    assert len(got) == 8000 and all(r["email"] is None for r in got)
