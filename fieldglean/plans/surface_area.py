"""Surface areas per document: smallest, largest and middle of the areas named on its first run of pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglean.operators.documents import integers_in

# The two ways an area is written, with their number of groups.
AREA_RANGE = r"(\d+,\d+|\d+)\s*(?:[a-z]+|\–|\-)\s*(\d+,\d+|\d+)\s*(?:square|sq\.)\s*(?:f..t|ft\.)"
AREA_SINGLE = r"(\d+,\d+|\d+)\s*(?:square|sq\.)\s*(?:f..t|ft\.)"
AREAS = [("(?dU)" + AREA_RANGE, 2), ("(?dU)" + AREA_SINGLE, 1)]


def half_text(total: Column) -> Column:
    """Half of an integer with one decimal, without passing through a floating point text."""
    return F.concat(F.floor(total / 2).cast("string"), F.when(total % 2 == 0, ".0").otherwise(".5"))


def surface_areas(doc_pages: DataFrame, detail: bool = False) -> DataFrame:
    """``(doc, area_min, area_max, area_mid, outcome)`` from ``doc_pages(doc, page, text)``; with ``detail`` also the ``pages`` that
    were read for it and the ``error`` text of documents that cannot be read.

    Pages are read from the first one with an area while pages keep naming one; a page without
    readable text (NULL) is passed over. Reading up to an unreadable last page is an error.

    The texts are read once, in a narrow step. One shuffle gathers five numbers and flags of each page of a document.
    """
    text = F.replace("text", F.lit("\n"), F.lit(""))
    # Both patterns need 'sq', which is cheap to look for.
    values = F.when(F.contains(text, F.lit("sq")), integers_in(text, AREAS)).otherwise(F.array().cast("array<bigint>"))
    pages = doc_pages.select("doc", "page", F.col("text").isNull().alias("unreadable"), values.alias("values"))
    pages = pages.select("doc", F.struct("page", "unreadable", F.array_min("values").alias("lo"), F.array_max("values").alias("hi"),
                                         (F.size("values") > 0).alias("hit")).alias("p"))
    docs = pages.groupBy("doc").agg(F.sort_array(F.collect_list("p")).alias("all"))
    docs = docs.select("doc", "all", F.get(F.filter("all", lambda p: p["hit"]), F.lit(0))["page"].alias("start"),
                       F.element_at("all", -1)["page"].alias("last"), F.element_at("all", -1)["unreadable"].alias("last_unreadable"))
    stop = F.get(F.filter("all", lambda p: (p["page"] > F.col("start")) & ~p["hit"] & ~p["unreadable"]), F.lit(0))["page"]
    docs = docs.withColumn("to_page", F.when(F.col("start").isNotNull(), F.coalesce(stop - 1, "last")))
    docs = docs.withColumn("run", F.filter("all", lambda p: p["page"].between(F.col("start"), F.col("to_page"))))
    error = F.col("last_unreadable") & (F.col("start").isNull() | (F.col("to_page") == F.col("last")))
    out = docs.select("doc", "run", "last", F.array_min(F.transform("run", lambda p: p["lo"])).alias("area_min"),
                      F.array_max(F.transform("run", lambda p: p["hi"])).alias("area_max"),
                      F.when(error, "error").when(F.col("start").isNull(), "N/A").otherwise("done").alias("outcome"))
    shown = lambda c: F.when(F.col("outcome") == "done", F.concat(c, F.lit(" sq. ft."))).when(
        F.col("outcome") == "N/A", F.lit("N/A"))
    more = [F.transform("run", lambda p: p["page"]).alias("pages"), F.when(F.col("outcome") == "error", F.concat(
        F.lit("no readable text on page "), F.col("last").cast("string"))).alias("error")]
    return out.select(
        "doc", shown(F.col("area_min").cast("string")).alias("area_min"),
        shown(F.col("area_max").cast("string")).alias("area_max"),
        shown(half_text(F.col("area_min") + F.col("area_max"))).alias("area_mid"), "outcome", *(more if detail else []))
