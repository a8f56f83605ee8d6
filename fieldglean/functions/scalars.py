"""Scalar cleaning functions, all ``Column -> Column`` and evaluated in the JVM.

Missing values are NULL throughout. Where a legacy behaviour loses information the function takes
``exact=True`` for the corrected reading; the default reproduces the legacy value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The texts pandas reads as missing, which the TSV reader must also treat as missing.
NA_TEXTS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Trim any white space at both ends, not only blanks."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


# --- missing values and casts -------------------------------------------------------------------

def na_to_null(c: Column | str) -> Column:
    c = col(c)
    return F.when(~c.isin(NA_TEXTS), c)


def to_number(c: Column | str) -> Column:
    """Number or NULL. The guard refuses texts only Java reads as numbers, such as ``12d``."""
    c = col(c)
    return F.when(c.rlike(NUMBER_RE), F.trim(c).try_cast("double"))


def to_bool_null_true(c: Column | str) -> Column:
    """Non-zero is true and so is a missing or unreadable value."""
    return F.coalesce(to_number(col(c).cast("string")) != 0, F.lit(True))


def to_int(c: Column | str) -> Column:
    """Integer with thousands commas, or NULL."""
    return F.trim(F.replace(col(c), F.lit(","), F.lit(""))).try_cast("bigint")


# --- amounts ------------------------------------------------------------------------------------

def _expand_suffix(c: Column) -> Column:
    for old, new in (("$", ""), (",", ""), ("K", "000"), ("M", "000000")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def _exact_amounts(c: Column) -> Column:
    """All amounts of a text with decimals and K / M suffixes honoured: ``$1.5M`` is 1500000."""
    text = F.replace(c, F.lit(","), F.lit(""))
    numbers = F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)\s*([KM]?)"), F.lit(1))
    suffixes = F.regexp_extract_all(text, F.lit(r"(\d+(?:\.\d+)?)\s*([KM]?)"), F.lit(2))
    factor = lambda s: F.when(s == "K", 1000).when(s == "M", 1000000).otherwise(1)
    return F.zip_with(
        numbers, suffixes,
        lambda n, s: F.round(n.try_cast("decimal(38,6)") * factor(s)).try_cast("bigint"))


def amounts(c: Column | str, exact: bool = False) -> Column:
    """Array of the whole amounts in a text; empty when it has no digit."""
    c = col(c)
    if exact:
        return _exact_amounts(c)
    return F.transform(F.regexp_extract_all(_expand_suffix(c), F.lit(r"(\d+)"), F.lit(1)),
                       lambda x: x.try_cast("bigint"))


def amount(c: Column | str, exact: bool = False) -> Column:
    """First amount. The default expands K and M before reading digits, so ``$1.5M`` gives 1."""
    c = col(c)
    if exact:
        return F.try_element_at(_exact_amounts(c), F.lit(1))
    return F.regexp_extract(_expand_suffix(c), r"(\d+)", 1).try_cast("bigint")


def amount_range(c: Column | str, exact: bool = False) -> Column:
    """Struct ``(range, min, max)``; a single amount is its own maximum; NULL without digits."""
    found = amounts(c, exact)
    low = F.try_element_at(found, F.lit(1))
    high = F.coalesce(F.try_element_at(found, F.lit(2)), low)
    text = F.concat_ws(" - ", low.cast("string"), high.cast("string"))
    return F.when(low.isNotNull(), F.struct(text.alias("range"), low.alias("min"), high.alias("max")))


def first_digits(c: Column | str) -> Column:
    """First run of digits once commas are gone."""
    return F.regexp_extract(F.replace(col(c), F.lit(","), F.lit("")), r"(\d+)", 1).try_cast("bigint")


def money(c: Column | str) -> Column:
    """``$1,234.50`` to a double."""
    return to_number(F.regexp_replace(strip(c), r"[$,]", ""))


def usable_money(c: Column | str) -> Column:
    """As ``money``; a text that invites a call, a mail or holds '/', 'n' or 's' is no amount."""
    low = F.lower(col(c))
    return F.when(~low.rlike(r"[/ns]|call|email"), money(low))


# --- labelled texts -----------------------------------------------------------------------------

def labelled_value(c: Column | str, label: str) -> Column:
    """Digits or Y / N after ``label:``."""
    return empty_to_null(F.regexp_extract(col(c), label + r":\s*(\d+|Y|N)", 1))


def nth_token(c: Column | str, n: int) -> Column:
    return F.split_part(col(c), F.lit(" "), F.lit(n))


def first_token_plain(c: Column | str) -> Column:
    return F.replace(nth_token(c, 1), F.lit(","), F.lit(""))


def after_colon(c: Column | str) -> Column:
    """Text between the first and second colon, trimmed, without line breaks and commas."""
    return F.regexp_replace(strip(F.split_part(col(c), F.lit(":"), F.lit(2))), r"[\n,]", "")


def cut_prefix(c: Column | str, n: int) -> Column:
    return F.substring(col(c), n + 1, 2147483647)


def remove_phrase(c: Column | str, *phrases: Column | str) -> Column:
    out = col(c)
    for p in phrases:
        out = F.replace(out, F.lit(p) if isinstance(p, str) else p, F.lit(""))
    return strip(out)


def seller_text(c: Column | str) -> Column:
    """Lower-case text after the first colon and before 'phone'; '' without a colon."""
    text = F.replace(F.lower(col(c)), F.lit("\n"), F.lit(" "))
    return strip(F.split_part(F.split_part(text, F.lit(":"), F.lit(2)), F.lit("phone"), F.lit(1)))


def pair(c: Column | str) -> Column:
    """``a//b`` to a struct ``(franchise_found, result)``; one part alone is the result."""
    parts = F.split(col(c), "//")
    single = F.size(parts) == 1
    return F.struct(
        F.when(single, F.lit("NOT IMPLEMENTED")).otherwise(F.get(parts, F.lit(0))).alias("franchise_found"),
        F.when(single, F.get(parts, F.lit(0))).otherwise(F.get(parts, F.lit(1))).alias("result"))


# --- places -------------------------------------------------------------------------------------

def city_state(c: Column | str, exact: bool = False) -> Column:
    """``City, ST`` split on the comma. Without a comma: NULL, or with ``exact`` a city alone."""
    c = col(c)
    comma = F.contains(c, F.lit(","))
    city = F.trim(F.split_part(c, F.lit(","), F.lit(1)))
    out = F.struct(city.alias("city"),
                   F.when(comma, F.trim(F.split_part(c, F.lit(","), F.lit(2)))).alias("state"))
    return F.when(c.isNotNull(), out) if exact else F.when(comma, out)


def county_state_country(c: Column | str) -> Column:
    """Last three comma parts, untrimmed; '' where there are too few."""
    parts = F.split(col(c), ",")
    at = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    return F.struct(at(-3).alias("county"), at(-2).alias("state"), at(-1).alias("country"))


def city_state_zip(c: Column | str) -> Column:
    """``City, ST 12345``, all '' when the text does not start that way."""
    c = col(c)
    pat = r"^(.*), (.*) (\d+)"
    return F.struct(*[strip(F.regexp_extract(c, pat, i)).alias(n)
                      for i, n in ((1, "city"), (2, "state"), (3, "zip"))])


# --- flags, years, totals -----------------------------------------------------------------------

def yes_no(cond: Column) -> Column:
    """'Yes' when true; false and missing are 'No'."""
    return F.when(cond, F.lit("Yes")).otherwise(F.lit("No"))


def absentee(hours: Column | str) -> Column:
    """'Yes' below 30 hours; unknown stays unknown."""
    h = col(hours)
    return F.when(h < 30, F.lit("Yes")).when(h >= 30, F.lit("No"))


def year_from_age(c: Column | str, run_year: Column | int) -> Column:
    """An age of fewer than four digits counts back from the year of the run; a year stays."""
    digits = F.regexp_extract(F.replace(col(c), F.lit(","), F.lit("")), r"(\d+)", 1)
    n = digits.try_cast("bigint")
    year = F.lit(run_year) if isinstance(run_year, int) else run_year
    return F.when(F.length(digits) < 4, year - n).otherwise(n)


def row_total(*cols: Column | str) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce(col(c), F.lit(0)) for c in cols])


# --- names, log lines ---------------------------------------------------------------------------

def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(col(path), r"[/\\]"), -1)


def file_stem(path: Column | str) -> Column:
    """Base name cut at its first dot."""
    return F.substring_index(base_name(path), ".", 1)


def log_message(line: Column | str) -> Column:
    """Text after the first ' - '. Without one the first two characters are dropped (legacy)."""
    c = col(line)
    return F.substr(c, F.instr(c, " - ") + F.lit(3))


# Fixed value: what a site shows in place of a listing that is gone.
GONE = "Listing Not Found or Unavailable"


def available(first_text: Column | str) -> Column:
    """Whether a listing page still shows its listing, by the page's first text. A page without text counts as available."""
    return F.coalesce(strip(first_text) != GONE, F.lit(True))


def plain_quotes(c: Column | str) -> Column:
    """Drop curly quotes and straight apostrophes."""
    return F.translate(col(c), "“”‘’'", "")


def double_quotes(c: Column | str) -> Column:
    """Every curly quote and apostrophe becomes a straight double quote."""
    return F.translate(col(c), "“”‘’'", '"""""')


def collapse_space(c: Column | str) -> Column:
    """Non-breaking spaces and runs of white space to single blanks, trimmed."""
    return F.trim(F.regexp_replace(col(c), r"(?U)\s+", " "))


def no_space(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"[ \n]", "")


def between(text: Column | str, start: str, stop: str) -> Column:
    """Text from the first hit of ``start`` up to the first hit of ``stop``; NULL if either lacks."""
    c = col(text)
    a, b = F.regexp_instr(c, F.lit(start)), F.regexp_instr(c, F.lit(stop))
    return F.when((a > 0) & (b > 0), F.substr(c, a, F.greatest(b - a, F.lit(0))))
