"""Contacts of a document: find the exhibit that lists them, the list page, the layout, the rows.

Stages and what each one shuffles:

1. ``locate``: the exhibit name from the first 21 pages of a document (at most 22 short rows each).
2. ``list_pages``: pages that name the exhibit. Only pages that name any exhibit join.
3. ``choose_layout``: the catalogue runs on the candidate pages alone; the winner is a min / max_by.
4. ``run_pages`` and ``contact_rows``: pages of the run read in order as one text, one row per match.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglean.functions.scalars import between, double_quotes, empty_to_null, plain_quotes
from fieldglean.operators.documents import best_layout, header_field, include_exclude, layout_table
from fieldglean.operators.ordered import first_in_lookahead
from fieldglean.operators.relational import lookup, reindex, upsert
from fieldglean.operators.segments import Segments
from fieldglean.rules import contacts as R
from fieldglean.session import cut, parallelism, ship_package

#: Contacts handed on together.
_ROWS = 2000


def exhibit_in(text: Column) -> Column:
    """First exhibit named in a text, NULL if none."""
    return empty_to_null(F.regexp_extract(plain_quotes(text), R.CASED + R.EXHIBIT_NAME, 1))


def page_features(doc_pages: DataFrame) -> DataFrame:
    """Per page of the search range: exhibit of the how-to page, contents flag, exhibits in contents."""
    text = F.lower(F.coalesce("text", F.lit("")))
    hit = F.regexp_substr(text, F.lit(R.CASED + R.EARN_END))
    earn = F.when(text.rlike(R.CASED + R.EARN_PAGE), exhibit_in(F.split_part(text, hit, F.lit(1))))
    like = exhibit_in(between(text, R.CASED + R.LIKE_START, R.CASED + R.LIKE_END))
    plain = plain_quotes(text)
    names = F.concat(*[F.regexp_extract_all(plain, F.lit(R.CASED + p), F.lit(1)) for p in R.EXHIBIT_IN_CONTENTS])
    # Every one of these patterns needs one of the two phrases.
    named = F.when(F.contains(plain, F.lit("franchis")) | plain.rlike(R.CASED + r"list\s+of"), names).otherwise(F.array().cast("array<string>"))
    by_length = F.transform(F.array_sort(F.transform(
        named, lambda x: F.struct(F.length(x).alias("n"), x.alias("x")))), lambda s: s["x"])
    contents = ~text.rlike(R.FLAGS + R.HOW_TO_PAGE) & text.rlike(R.CASED + R.CONTENTS_PAGE)
    # Page 21 is read only as the successor of page 20.
    return doc_pages.filter(F.col("page") <= R.LAST_SEARCH_PAGE + 1).select(
        "doc", "page", F.coalesce(earn, like).alias("how_to"), contents.alias("is_contents"),
        text.rlike(R.CASED + R.SIMPLIFY_PAGE).alias("simplify"), by_length.alias("named"))


def locate(doc_pages: DataFrame) -> DataFrame:
    """``(doc, exhibit_page, first_page, list_regex, by_item, failed)``: what to look for, from where.

    The window holds at most 22 rows per document. ``failed`` marks documents that end on the
    contents page or whose exhibit is no valid pattern.
    """
    w = Window.partitionBy("doc").orderBy("page")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    f = page_features(doc_pages).withColumns({
        "next_named": F.lead("named").over(w), "next_simplify": F.lead("simplify").over(w)})
    f = f.filter(F.col("page") <= R.LAST_SEARCH_PAGE)
    asks = F.col("how_to").isNull()
    opens = asks & F.col("is_contents")
    here = ~F.col("simplify") & (F.size("named") > 0)
    no_next = F.col("next_named").isNull()
    after = F.coalesce(~F.col("next_simplify"), F.lit(False))
    listed = F.when(opens & here, F.col("named")).when(opens & after & (F.size("next_named") > 0), F.col("next_named"))
    absent = (opens & ~here & after & (F.size("next_named") == 0)) | (asks & (F.col("page") >= R.LAST_SEARCH_PAGE))
    f = f.withColumns({
        "listed": listed, "absent": F.max(absent).over(so_far),
        "broken": opens & ~here & no_next,
        "how": F.last("how_to", ignorenulls=True).over(so_far)})
    first = F.get("listed", F.lit(0))
    from_list = (F.when(F.col("how").isNull(), first)
                 .when(F.array_contains("listed", F.col("how")), F.col("how"))
                 .when(F.length(first) - 1 > F.length("how"), F.col("how")).otherwise(first))
    exhibit = F.when(F.col("listed").isNotNull(), from_list).when(F.col("absent"), F.col("how"))
    settled = f.withColumn("exhibit", exhibit).filter(
        F.col("exhibit").isNotNull() | F.col("broken") | (F.col("page") >= R.LAST_SEARCH_PAGE))
    found = settled.groupBy("doc").agg(F.min_by(F.struct("page", "exhibit", "broken"), "page").alias("r")).select("doc", "r.*")
    by_item = F.col("exhibit").isNull()
    bad = F.contains("exhibit", F.lit("[")) & ~F.contains("exhibit", F.lit("]"))
    return found.select(
        "doc", F.col("page").alias("exhibit_page"),
        F.when(by_item, F.col("page")).otherwise(F.col("page") + 2).alias("first_page"),
        F.when(by_item, F.lit(R.CASED + R.ITEM_20)).when(~bad, F.concat(
            F.lit(R.CASED + '(?:exhibit|attachment|appendix)[ ]*"?'), F.col("exhibit"), F.lit('"?'))).alias("list_regex"),
        by_item.alias("by_item"), (F.col("broken") | F.coalesce(bad, F.lit(False))).alias("failed"))


def list_pages(doc_pages: DataFrame, located: DataFrame, start_pages: DataFrame | None = None) -> DataFrame:
    """``(doc, page)`` of pages that may start the list.

    A page can only qualify if it names some exhibit or fits the Item-20 phrases, so the rest is
    dropped before the join.
    """
    text = F.lower("text")
    joined = double_quotes(F.replace(text, F.lit("\n"), F.lit("")))
    can = joined.rlike(R.CASED + "exhibit|attachment|appendix|" + R.ITEM_20) & ~text.rlike(R.CASED + R.NOT_A_LIST_PAGE)
    pages = doc_pages.filter(can).select("doc", "page", joined.alias("joined"),
                                         text.rlike(R.TOTALS_PAGE).alias("totals"))
    found = (pages.join(located.filter("not failed"), "doc").filter(F.col("page") >= F.col("first_page"))
             .filter(F.rlike("joined", "list_regex") & (F.col("by_item") | ~F.col("totals")))
             .select("doc", "page"))
    if start_pages is not None:
        given = start_pages.filter(F.col("start_page").isNotNull()).select("doc", F.col("start_page").alias("page"))
        totals = doc_pages.filter(text.rlike(R.TOTALS_PAGE)).select("doc", "page")
        given = given.join(totals, ["doc", "page"], "left_anti")
        found = found.join(start_pages.filter(F.col("start_page").isNotNull()), "doc", "left_anti").unionByName(given)
    return found


def choose_layout(doc_pages: DataFrame, starts: DataFrame) -> DataFrame:
    """``(doc, page, start_page, ord)``: first list page with a readable page among itself and the next two."""
    near = starts.select("doc", F.explode(F.sequence(F.col("page"), F.col("page") + 2)).alias("page")).distinct()
    pages = doc_pages.join(near, ["doc", "page"]).filter(
        include_exclude(F.col("text"), None, R.FLAGS + R.NOT_A_CONTACT_PAGE, R.MIN_TEXT))
    # Heavy work on few pages: spread by page, so that a large document is spread too.
    pages = pages.repartition(parallelism(doc_pages.sparkSession), "doc", "page")
    best = best_layout(F.replace("text", F.lit("\n"), F.lit("@")), R.catalogue())
    # Generated, not filtered: a filter would be pushed below and run the whole catalogue again.
    scored = pages.select("doc", "page", F.inline(F.array_compact(F.array(best))))
    valid = scored.select("doc", "page", (-F.col("neg_ord")).alias("ord"))
    return first_in_lookahead(starts, valid, "doc", "page")


def run_pages(doc_pages: DataFrame, chosen: DataFrame, layouts: DataFrame) -> DataFrame:
    """``(doc, ord, page, text)``: pages from the chosen one while the end of the layout keeps matching."""
    picked = chosen.select("doc", F.col("page").alias("start"), "ord").join(
        F.broadcast(layouts.select("ord", "tail")), "ord")
    pages = (doc_pages.select("doc", "page", F.replace("text", F.lit("\n"), F.lit("@")).alias("text"))
             .join(picked, "doc").filter(F.col("page") >= F.col("start"))
             .withColumn("match", F.rlike("text", "tail")))
    stop = pages.filter(~F.coalesce("match", F.lit(False))).groupBy("doc").agg(F.min("page").alias("stop"))
    run = pages.filter("match").join(stop, "doc", "left").filter(
        F.col("stop").isNull() | (F.col("page") < F.col("stop")))
    return run.select("doc", "ord", "page", "text")


def contact_rows(pages: DataFrame) -> DataFrame:
    """One row per match over the pages of a run, with the order of the match in its document.

    A contact may run over a page break, so the pages of a list are one text for the layout. It is read page by page, and only what
    a further page could still change is held (``operators.segments``), so a list of any number of pages needs bounded memory. The
    pages of a document are read in order by one task, as a stream.
    """
    ship_package(pages.sparkSession)
    named = [c for c in R.CONTACT_COLUMNS if c not in ("fdd_name", "method", "regex", "franchise_id")]
    names = ["fdd_name", "row_no", "method", "regex", *named]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layouts = {lay.ord: lay for lay in R.catalogue()}
        now, row_no, lay, segments, made = None, 0, None, None, []

        def take(matches) -> Iterator[pa.RecordBatch]:
            nonlocal row_no, made
            fields = dict(lay.fields)
            for found in matches:
                texts = ["".join(found[g] or "" for g in fields[c]) if c in fields else None for c in named]
                made.append((now, row_no, "regex", lay.name, *(t if t is None or lay.has_email else t.replace("@", "") for t in texts)))
                row_no += 1
                if len(made) >= _ROWS:
                    yield given()

        def given() -> pa.RecordBatch:
            nonlocal made
            rows, made = made, []
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int32() if c == "row_no" else pa.string())
                                               for i, c in enumerate(names)], names)

        for batch in batches:
            for doc, ord, text in zip(*(c.to_pylist() for c in batch.columns)):
                if doc != now:
                    if segments:
                        yield from take(segments.finish())
                    now, row_no, lay = doc, 0, layouts[ord]
                    segments = Segments(lay.regex.removeprefix(R.FLAGS), re.I)
                yield from take(segments.feed(text))
        if segments:
            yield from take(segments.finish())
        yield given()

    ordered = pages.repartition("doc").sortWithinPartitions("doc", "page").select("doc", "ord", "text")
    return ordered.mapInArrow(read, ", ".join(f"{c} {'int' if c == 'row_no' else 'string'}" for c in names))


def extract_contacts(doc_pages: DataFrame, di_fdds: DataFrame | None = None,
                     start_pages: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(contacts in the stored schema plus ``row_no``, outcome per document)."""
    layouts = layout_table(doc_pages.sparkSession, R.catalogue())
    # Three small tables (a row per document, a row per candidate page, a row per document) that the
    # rest reads more than once; what they cost is the patterns behind them.
    located = cut(locate(doc_pages))
    starts = cut(list_pages(doc_pages, located, start_pages))
    chosen = cut(choose_layout(doc_pages, starts))
    rows = contact_rows(run_pages(doc_pages, chosen, layouts))
    if di_fdds is not None:
        ids = di_fdds.select(F.col("filename").alias("fdd_name"), "franchise_id")
        rows = lookup(rows, ids, "fdd_name", "franchise_id", "franchise_id")
    # A field the layout lacks stays NULL, a field it has but did not find is ''.
    contacts = reindex(rows, ["row_no", *R.CONTACT_COLUMNS])

    flags = (doc_pages.select("doc").distinct()
             .join(located.filter("failed").select("doc", F.lit(True).alias("failed")), "doc", "left")
             .join(starts.select("doc").distinct().withColumn("listed", F.lit(True)), "doc", "left")
             .join(chosen.select("doc", F.lit(True).alias("valid")), "doc", "left"))
    outcome = (F.when(F.col("failed"), "exceptions").when(F.col("valid"), "regex")
               .when(F.col("listed"), "invalid methods").otherwise("franchisees not found"))
    return contacts, flags.select("doc", outcome.alias("outcome"))


def store_contacts(stored: DataFrame, contacts: DataFrame) -> DataFrame:
    """New version of the contact table: update by (document, phone), insert the rest."""
    return upsert(stored, contacts, ["fdd_name", "phone"], "row_no", F.col("phone") != "")


def contact_tables(cells: DataFrame, exact: bool = False) -> DataFrame:
    """Extracted tables ``(doc, row_no, col_no, text)``, header in row 0, to the contact columns.

    A header decides the column by the first rule it fits. Several owner, mail or address columns are
    joined with a blank in table order, of any other repeated column the last counts. ``poor`` marks
    documents in which more than eight of the seventeen target columns hold nothing.
    """
    header = cells.filter("row_no = 0").select("doc", "col_no", header_field(F.col("text"), exact).alias("field"))
    header = header.filter(F.col("field").isNotNull() & (F.col("field") != ""))
    body = cells.filter("row_no > 0 and text is not null").join(header, ["doc", "col_no"])

    def value(field: str) -> Column:
        mine = F.col("field") == field
        if field in R.JOINED_COLUMNS:
            parts = F.sort_array(F.collect_list(F.when(mine, F.struct("col_no", "text"))))
            return F.nullif(F.array_join(F.transform(parts, lambda p: p["text"]), " "), F.lit(""))
        return F.max_by("text", F.when(mine, F.col("col_no")))

    rows = body.groupBy("doc", "row_no").agg(*[value(f).alias(f) for f in R.TABLE_COLUMNS])
    # Five of the seventeen targets are never filled by a header rule, the company name is none of them.
    targets = [f for f in R.TABLE_COLUMNS if f != "company_name"]
    filled = reduce(lambda a, b: a + b, [F.max(F.col(f).isNotNull()).cast("int") for f in targets])
    poor = rows.groupBy("doc").agg((R.TARGETS - filled > 8).alias("poor"))
    return rows.join(poor, "doc")
