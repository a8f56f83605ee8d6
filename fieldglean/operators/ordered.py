"""Row order inside a key: latest, first N, take-while, look-ahead, forward fill, parallel positions.

Everything that can be an aggregate is one (``min``, ``max_by``), because aggregates combine before
the shuffle. A window is used only where its groups are bounded or where Spark limits each group
before the shuffle (``row_number() <= n`` becomes a partial group limit).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, key: Sequence[str], order: Sequence[Column | str], n: int,
            accept: Column | None = None, limit_first: bool = False) -> DataFrame:
    """First ``n`` rows per key. ``accept`` filters before the limit, or after it on request."""
    w = Window.partitionBy(*key).orderBy(*order)
    src = df if accept is None or limit_first else df.filter(accept)
    out = src.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn")
    return out.filter(accept) if accept is not None and limit_first else out


def first_position(df: DataFrame, key: Sequence[str], pos: str, accept: Column, name: str,
                   default: int = -1) -> DataFrame:
    """Position of the first accepted row per key, else the default."""
    return df.groupBy(*key).agg(F.coalesce(F.min(F.when(accept, F.col(pos))), F.lit(default)).alias(name))


def run_from(pages: DataFrame, doc: str, page: str, match: Column, start: str) -> DataFrame:
    """Per document the page range from ``start`` up to the page before the first without a match.

    ``pages`` carries the start page of its document and the pages are numbered without gaps.
    Documents whose start page does not match have no run.
    """
    seen = pages.filter(F.col(page) >= F.col(start))
    stop = F.min(F.when(~F.coalesce(match, F.lit(False)), F.col(page)))
    ends = seen.groupBy(doc).agg(F.min(start).alias("from_page"), stop.alias("__stop"),
                                 F.max(page).alias("__last"))
    return (ends.select(doc, "from_page", F.coalesce(F.col("__stop") - 1, F.col("__last")).alias("to_page"))
            .filter("to_page >= from_page"))


def first_run(pages: DataFrame, doc: str, page: str, match: Column) -> DataFrame:
    """The run that starts at the first matching page of each document."""
    start = pages.filter(match).groupBy(doc).agg(F.min(page).alias("__start"))
    return run_from(pages.join(start, doc), doc, page, match, "__start")


def first_in_lookahead(starts: DataFrame, valid: DataFrame, doc: str, page: str, span: int = 3) -> DataFrame:
    """First start that has a valid page among itself and the next ``span - 1``, with that page.

    An equi-join on (document, page): each start is expanded to its ``span`` pages.
    """
    near = starts.select(doc, F.col(page).alias("start_page"),
                         F.explode(F.sequence(F.col(page), F.col(page) + (span - 1))).alias(page))
    rest = [c for c in valid.columns if c not in (doc, page)]
    hits = near.join(valid, [doc, page])
    return hits.groupBy(doc).agg(F.min_by(F.struct(page, "start_page", *rest),
                                          F.struct("start_page", page)).alias("__h")).select(doc, "__h.*")


def first_method(candidates: DataFrame, key: Sequence[str], rank: Column | str) -> DataFrame:
    """The valid candidate of the best-ranked method per key."""
    rest = [c for c in candidates.columns if c not in key]
    return (candidates.groupBy(*key).agg(F.min_by(F.struct(*rest), rank).alias("__r"))
            .select(*key, *[F.col("__r")[c].alias(c) for c in rest]))


def text_blocks(df: DataFrame, doc: str, page: str, text: str, size: int, sep: str = "") -> DataFrame:
    """Text of consecutive pages joined in page order, in blocks of ``size`` pages.

    A block is the unit of grouping, so a document of any length is spread over many tasks and no
    string exceeds ``size`` pages.
    """
    parts = F.sort_array(F.collect_list(F.struct(page, text)))
    return (df.groupBy(doc, F.floor(F.col(page) / size).alias("block"))
            .agg(F.array_join(F.transform(parts, lambda p: p[text]), sep).alias("text"),
                 F.count("*").alias("pages")))


def fill_forward(df: DataFrame, key: Sequence[str], order: str, value: Column, name: str,
                 bucket: Sequence[Column]) -> DataFrame:
    """Last non-NULL value at or before each row of its key.

    ``bucket`` columns never decrease along ``order`` and cut a long key into pieces. A piece is
    filled on its own; its first rows take the last value of the pieces before it, found on one
    row per piece. So a key with very many rows is spread over as many tasks as it has pieces.
    """
    cut = [f"__b{i}" for i in range(len(bucket))]
    rows = df.withColumns({"__v": value, **dict(zip(cut, bucket))})
    piece = [*key, *cut]
    inside = Window.partitionBy(*piece).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*key).orderBy(*cut).rowsBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*piece).agg(F.max_by("__v", F.when(F.col("__v").isNotNull(), F.col(order))).alias("__e"))
    carried = ends.select(*[F.col(c).alias(f"__r_{c}") for c in piece], F.last("__e", True).over(earlier).alias("__c"))
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in piece]
    filled = rows.withColumn("__f", F.last("__v", True).over(inside)).join(carried, same)
    return filled.select(*df.columns, F.coalesce("__f", "__c").alias(name))


def header_lookup(cells: DataFrame, key: Sequence[str], titles: Sequence[str] | None = None) -> DataFrame:
    """Cells ``(key, row_no, col_no, text)`` of the columns titled so (of all with a title by default), keyed by the title.

    The header row (row 0) gives the position of each title; the body meets it on the position.
    """
    wanted = F.trim("text") != "" if titles is None else F.trim("text").isin(list(titles))
    header = cells.filter(F.col("row_no") == 0).filter(wanted)
    header = header.select(*key, "col_no", F.trim("text").alias("title"))
    return cells.filter(F.col("row_no") > 0).join(header, [*key, "col_no"])


def pair_positions(left: DataFrame, right: DataFrame, key: Sequence[str], pos: str) -> DataFrame:
    """The n-th row on the left beside the n-th on the right."""
    return left.join(right, [*key, pos])
