"""URL filter: host and path rules first, then a weighted vocabulary counted by an Aho-Corasick automaton."""

from __future__ import annotations

import string
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import pick, prepare

#: (verdict, host, path) of the rules of the query.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
STRICT = ("adult", "bets", "casino", "escort", "malware", "phishing", "pills", "poker", "porn", "spam", "viagra", "warez", "xxx")
SOFT = ("ads", "bonus", "cash", "cheap", "click", "deal", "farm", "free", "loan", "lottery", "prize", "promo", "sexy", "slots", "track", "win")
#: A url is rejected from this weight on: one strict term, or two different soft ones.
STRICT_WEIGHT, SOFT_WEIGHT, REJECT = 2, 1, 2
_WORD = frozenset(string.ascii_lowercase + string.digits)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def matcher(weights: dict[str, int]):
    """A function from a lower-cased url to the weight of the distinct terms that stand in it as whole words."""
    import ahocorasick

    automaton = ahocorasick.Automaton()
    for term, weight in weights.items():
        automaton.add_word(term, (term, weight))
    if weights:
        automaton.make_automaton()

    def weigh(url: str) -> int:
        found = {}
        if weights:
            for end, (term, weight) in automaton.iter(url):
                start = end - len(term) + 1
                if (start == 0 or url[start - 1] not in _WORD) and (end + 1 == len(url) or url[end + 1] not in _WORD):
                    found[term] = weight
        return sum(found.values())

    return weigh


def url_weight(url: Column, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT) -> Column:
    weights = {**{t: SOFT_WEIGHT for t in soft}, **{t: STRICT_WEIGHT for t in strict}}

    @F.pandas_udf("int")
    def weigh(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        count = matcher(weights)
        for urls in batches:
            yield pd.Series([0 if u is None else count(u) for u in urls], dtype="int32")

    return weigh(lower_ascii(url))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, strict: Sequence[str] = STRICT,
                soft: Sequence[str] = SOFT) -> DataFrame:
    """Per page: page_id, host, path, rule, weight, verdict.

    Host: after the first `://` up to `/`, `?` or `#`, with A-Z lower-cased; path: from there up to `?` or `#`. A url that is null
    or has no `://` has an empty host and path, and fits no rule. A rule fits its host and all subdomains where the path
    starts with its own; the longest rule wins, and of equally long ones the first. Without a rule, the vocabulary decides:
    terms count where no ASCII letter or digit touches them, each term once. Rows are judged one by one: repeated rows
    and null page_ids stay as they are, an empty table gives an empty result, other columns are not looked at.
    """
    prepare(pages.sparkSession)
    at = F.instr("url", "://")
    rows = pick(pages, "page_id", "url").withColumn("rest", F.when(at > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(""))
    rows = rows.withColumn("rest", F.coalesce("rest", F.lit("")))
    raw = F.regexp_extract("rest", "^[^/?#]*", 0)
    rows = rows.withColumn("host", lower_ascii(raw)).withColumn(
        "path", F.regexp_extract(F.expr("substring(rest, length(host) + 1)"), "^[^?#]*", 0))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The last of the chain is asked first, so the longest rule goes last.
    for what, host, path in sorted(reversed(list(rules)), key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        rule, verdict = F.when(fits, F.lit(host + path)).otherwise(rule), F.when(fits, F.lit(what)).otherwise(verdict)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("weight", url_weight(F.col("url"), strict, soft))
    return rows.select("page_id", "host", "path", "rule", "weight", F.coalesce(
        "by_rule", F.when(F.col("weight") >= REJECT, "block").otherwise("allow")).alias("verdict"))
