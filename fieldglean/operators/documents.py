"""Pattern work over page text: flags, counts, best pattern of a catalogue, rows from matches.

Patterns are literals of the plan, so each is compiled once per task, and all of this is a narrow
projection: no shuffle, and a document with very many pages is as spread out as its pages are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglean.rules.contacts import EXACT_HEADER_RULES, FLAGS, HEADER_RULES, Layout


def pattern_flags(text: Column | str, patterns: Mapping[str, str]) -> list[Column]:
    """One boolean column per pattern; missing text matches nothing."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return [c.rlike(p).alias(name) for name, p in patterns.items()]


def pattern_counts(text: Column, patterns: Mapping[str, str]) -> Column:
    """Array of ``(pattern, matches)`` to be inlined into the long form."""
    return F.array(*[F.struct(F.lit(name).alias("pattern"),
                              F.regexp_count(text, F.lit(p)).cast("bigint").alias("matches"))
                     for name, p in patterns.items()])


def include_exclude(text: Column, include: str | None, exclude: str | None, min_chars: int = 0) -> Column:
    """Matches one pattern and not another, with more than ``min_chars`` characters besides blanks."""
    cond = F.length(F.replace(text, F.lit(" "), F.lit(""))) > min_chars
    if exclude is not None:
        cond = cond & ~text.rlike(exclude)
    if include is not None:
        cond = cond & text.rlike(include)
    return cond


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    cond = F.lit(False)
    for p in phrases:
        cond = cond | F.contains(text, F.lit(p))
    return cond


def best_layout(text: Column, layouts: Sequence[Layout]) -> Column:
    """``(matches, n_keys, neg_ord)`` of the best layout, NULL if none matches.

    Most matches wins, then most fields, then catalogue order. A layout is tried in full only where
    its ends occur in the text at all, which spares most pages the expensive patterns.
    """
    tried = []
    for lay in layouts:
        score = F.struct(F.regexp_count(text, F.lit(lay.regex)).alias("matches"),
                         F.lit(len(lay.fields)).alias("n_keys"), F.lit(-lay.ord).alias("neg_ord"))
        needed = reduce(lambda a, b: a & b, [text.rlike(p) for p in lay.needs], F.lit(True))
        tried.append(F.when(needed, score))
    return F.array_max(F.filter(F.array(*tried), lambda s: s["matches"] > 0))


def best_of(text: Column, patterns: Mapping[str, str]) -> Column:
    """Name and count of the pattern with most matches; the first listed wins a tie."""
    scored = F.array(*[F.struct(F.regexp_count(text, F.lit(p)).cast("bigint").alias("matches"),
                                F.lit(-i).alias("neg_ord"), F.lit(name).alias("pattern"))
                       for i, (name, p) in enumerate(patterns.items())])
    return F.array_max(F.filter(scored, lambda s: s["matches"] > 0))


def match_rows(text: Column, pattern: str, groups: Mapping[str, int]) -> Column:
    """Array of structs, one per match, with ``match_no`` and a field per group."""
    found = F.arrays_zip(*[F.regexp_extract_all(text, F.lit(pattern), F.lit(i)).alias(n) for n, i in groups.items()])
    names = list(groups)
    return F.transform(found, lambda m, i: F.struct((i + 1).alias("match_no"), *[m[n].alias(n) for n in names]))


def layout_table(spark, layouts: Sequence[Layout]) -> DataFrame:
    """The catalogue as a table: name, regex, tail and the group numbers of each field."""
    rows = [(lay.ord, lay.name, lay.regex, lay.tail, lay.has_email,
             [(f, list(g)) for f, g in lay.fields]) for lay in layouts]
    return spark.createDataFrame(
        rows, "ord int, name string, regex string, tail string, has_email boolean, "
              "fields array<struct<field:string,groups:array<int>>>")


def integers_in(text: Column, patterns: Sequence[tuple[str, int]]) -> Column:
    """All groups of all matches of all patterns as one flat array of integers, commas removed."""
    parts = [F.regexp_extract_all(text, F.lit(p), F.lit(i)) for p, groups in patterns for i in range(1, groups + 1)]
    return F.transform(F.concat(*parts), lambda x: F.replace(x, F.lit(","), F.lit("")).try_cast("bigint"))


def header_field(text: Column, exact: bool = False) -> Column:
    """Contact column for a header cell, by the first rule that fits; NULL when none does.

    Legacy runs find no column for a plain "Name"; ``exact`` takes it for the owner's.
    """
    chain = None
    for pattern, name in HEADER_RULES:
        cond = text.rlike(FLAGS + (EXACT_HEADER_RULES.get(name, pattern) if exact else pattern))
        chain = F.when(cond, F.lit(name)) if chain is None else chain.when(cond, F.lit(name))
    return chain
