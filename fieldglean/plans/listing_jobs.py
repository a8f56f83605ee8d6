"""Listing jobs end to end: listing pages to rows, rows to their detail pages, records to stored versions, children to parents.

Pages come as tables ``(url, html)``. Everything is joined by address or by title; no step holds more than one page at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.operators.relational import last_per_key, number_rows, replace_children
from fieldglean.plans import listings
from fieldglean.session import cut, parallelism

#: Sites whose listing rows carry fields into the record, with the column that holds the address of the detail page.
DETAIL_URL = {"franchiseflippers": "url", "murphybusiness": "link"}
#: About so many new keys are numbered by one task.
ID_BLOCK = 100_000


def _pages(pages: DataFrame) -> DataFrame:
    """One page per address: a page fetched twice counts with its greatest text. Spread by number for the parser, as pages are few bytes."""
    return pages.repartition(parallelism(pages.sparkSession), "url").groupBy(F.col("url").alias("page_id")).agg(F.max("html").alias("html"))


def site_records(listing_pages: DataFrame, detail_pages: DataFrame, site: str, run_year: int) -> DataFrame:
    """Records of a run: the fields of the listing row beside those of the detail page, which win where both have one.

    A row whose detail page was not fetched makes no record. A detail page that shows none of the fields leaves them NULL. ``page_id``
    is the address of the detail page.
    """
    # Spread by number for the parser, as pages are few bytes; by a digest, as Spark would drop a second shuffle on the address.
    listed = listing_pages.select(F.col("url").alias("page_id"), "html").repartition(parallelism(listing_pages.sparkSession), F.xxhash64("url"))
    rows = listings.murphy_listings(listed) if site == "murphybusiness" else listings.listing_rows(listed, site)
    fetched = _pages(detail_pages)
    details = fetched.select("page_id").join(listings.detail_records(fetched, site, run_year), "page_id", "left")
    url = DETAIL_URL[site]
    own = [c for c in rows.columns if c not in ("page_id", "row", url) and c not in details.columns]
    return listings.with_listing(rows.select(F.col(url).alias("page_id"), *own), details, "page_id")


def run_site(store: DataFrame | None, listing_pages: DataFrame, detail_pages: DataFrame, site: str, run_id: int, run_year: int) -> DataFrame:
    """Stored versions after a run over the pages of a site.

    The records of the run, one row per listing, are written once to the checkpoint folder: new versions and flags both read them, and
    pages should not be parsed for each.
    """
    records = cut(site_records(listing_pages, detail_pages, site, run_year))
    return listings.load_run(store, records, site, run_id, [c for c in records.columns if c != "page_id"])


# --- parents and children ------------------------------------------------------------------------

def with_new_ids(ids: DataFrame | None, keys: DataFrame, key: str, name: str = "id") -> DataFrame:
    """``(key, id)``: the known ids, and for keys not among them the numbers after the greatest id, in the order of their digests.

    An id is never moved and never given again as long as ``ids`` keeps the rows of keys that are gone. The order depends on the keys
    alone, so a repeated run gives the same ids. NULL keys get none. Only the greatest id comes to the driver.
    """
    fresh = keys.select(key).where(F.col(key).isNotNull()).distinct()
    last = 0
    if ids is not None:
        fresh = fresh.join(ids.select(key), key, "left_anti")
        last = ids.agg(F.max(name)).first()[0]
    order = F.struct(F.md5(F.col(key).cast("string")).alias("digest"), F.col(key).alias("key"))
    made = number_rows(fresh, [], order, ID_BLOCK, name, (last or 0) + 1).select(key, F.col(name).cast("long").alias(name))
    return made if ids is None else ids.select(key, F.col(name).cast("long").alias(name)).unionByName(made)


@dataclass(frozen=True)
class Family:
    """What is stored of franchises and the outlets they resell.

    ``ids(title, id)``, ``parents`` as versions by title, ``children(parent_id, pos, url, ...)`` with the place on the parent's page.
    """

    ids: DataFrame
    parents: DataFrame
    children: DataFrame


def run_resales(store: Family | None, parent_pages: DataFrame, child_pages: DataFrame, run_id: int, run_year: int) -> Family:
    """A run over the pages of franchises and of the outlets they link.

    A franchise keeps its id over all runs. Of several pages with one title the last address counts, with its links. The outlets of a
    franchise seen in the run replace those stored; of the others they stay. A link whose page was not fetched gives no outlet. A page
    without a title counts under ''. Records, ids and outlets of the run are written once to the checkpoint folder.
    """
    fetched = _pages(parent_pages)
    found = listings.detail_records(fetched, "franchiseresales", run_year).withColumn("title", F.coalesce("title", F.lit("")))
    payload = [c for c in found.columns if c != "page_id"]
    kept = cut(last_per_key(found, ["title"], "page_id"))
    ids = cut(with_new_ids(store.ids if store else None, kept, "title"))
    seen = kept.select("page_id", "title").join(ids, "title").select("page_id", F.col("id").alias("parent_id"))

    links = listings.listing_rows(fetched, "franchiseresales_franchisee").select("page_id", "row", F.col("href").alias("url"))
    outlets = _pages(child_pages)
    details = outlets.select("page_id").join(listings.detail_records(outlets, "franchiseresales_franchisee", run_year), "page_id", "left")
    children = links.join(seen, "page_id").drop("page_id").join(details.withColumnRenamed("page_id", "url"), "url")
    children = cut(children.select("parent_id", F.col("row").alias("pos"), "url", *[c for c in details.columns if c != "page_id"]))
    if store is not None:
        children = replace_children(store.children, seen, children, "parent_id")
    return Family(ids, listings.load_run(store.parents if store else None, kept, "franchiseresales", run_id, payload), children)
