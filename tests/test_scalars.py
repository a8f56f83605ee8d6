"""Cleaning functions on literals."""

import pytest

from pyspark.sql import functions as F

from fieldglean.functions import scalars as S


def ev(spark, fn, values, schema="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, " + schema)
    return [r.o for r in df.select("i", fn(F.col("v")).alias("o")).orderBy("i").collect()]


CASES = [
    (S.na_to_null, ["", "NA", "None", "x", None, "nan", "<NA>", " NA"], [None, None, None, "x", None, None, None, " NA"]),
    (S.to_number, ["1", " 2.5 ", "1e3", "12d", "abc", "", None, "-.5", "0x1"], [1.0, 2.5, 1000.0, None, None, None, None, -0.5, None]),
    (S.to_bool_null_true, ["0", "1", None, "x", "0.0"], [False, True, True, True, False]),
    (S.to_int, ["1,200", " 7 ", "1.5", "", "x", None], [1200, 7, None, None, None, None]),
    (S.amount, ["$12,345", "12K", "1M", "$1.5M", "Call", "", None, "10K - 20K"], [12345, 12000, 1000000, 1, None, None, None, 10000]),
    (lambda c: S.amount(c, exact=True), ["$12,345", "12K", "1M", "$1.5M", "Call", "$2.5"], [12345, 12000, 1000000, 1500000, None, 3]),
    (S.first_digits, ["1,200 people", "none", "a 12 b 13"], [1200, None, 12]),
    (S.money, ["$1,234.50 ", "x", "12"], [1234.5, None, 12.0]),
    (S.usable_money, ["$1,000", "Call", "E-mail", "1/2", "None", "5 USD", "EMAIL us", None], [1000.0, None, None, None, None, None, None, None]),
    (lambda c: S.labelled_value(c, "Mgrs"), ["Mgrs: 2 x", "Mgrs:Y", "none", "Mgrs: Z"], ["2", "Y", None, None]),
    (lambda c: S.nth_token(c, 3), ["a b c d", "a b"], ["c", ""]),
    (S.first_token_plain, ["1,500 USD", ""], ["1500", ""]),
    (S.after_colon, ["Price: $95,000\n", "A:b:c", "none"], ["$95000", "b", ""]),
    (lambda c: S.cut_prefix(c, 4), ["ID: 77", "abc"], ["77", ""]),
    (lambda c: S.remove_phrase(c, "Businesses for Sale"), ["Ohio Businesses for Sale ", "x"], ["Ohio", "x"]),
    (S.seller_text, ["By:\nAnn Phone 1", "none", "a: b: c"], ["ann", "", "b"]),
    (lambda c: S.year_from_age(c, 2024), ["12", "1999", "0012", "x", "3 years"], [2012, 1999, 12, None, 2021]),
    (S.base_name, ["a/b\\c.x.pdf", "c"], ["c.x.pdf", "c"]),
    (S.file_stem, ["a/b/c.x.pdf", "c"], ["c", "c"]),
    (S.log_message, ["ts - msg - x", "none"], ["msg - x", "ne"]),
    (S.plain_quotes, ["“a’s” ‘b'"], ["as b"]),
    (S.double_quotes, ["“a’"], ['"a"']),
    (S.collapse_space, [" a  b\n\tc "], ["a b c"]),
    (S.strip, [" \n a b \t"], ["a b"]),
    (S.no_space, ["a b\nc"], ["abc"]),
    (lambda c: S.between(c, "aa", "zz"), ["xaa1zzy", "zz aa", "aa"], ["aa1", "", None]),
    (lambda c: S.absentee(c.cast("int")), ["29", "30", None], ["Yes", "No", None]),
    (lambda c: S.yes_no(c == "Y"), ["Y", "N", None], ["Yes", "No", "No"]),
    (lambda c: S.pair(c)["franchise_found"], ["a//b", "a"], ["a", "NOT IMPLEMENTED"]),
    (lambda c: S.pair(c)["result"], ["a//b//c", "a", "a//"], ["b", "a", ""]),
    (lambda c: S.amount_range(c)["range"], ["10K - 20K", "$5", "none"], ["10000 - 20000", "5 - 5", None]),
    (lambda c: S.amount_range(c)["max"], ["10K - 20K", "$5", "none"], [20000, 5, None]),
    (lambda c: S.city_state(c)["state"], ["Town, ST", "Town", "A, B, C"], ["ST", None, "B"]),
    (lambda c: S.city_state(c, exact=True)["city"], ["Town", None], ["Town", None]),
    (lambda c: S.county_state_country(c)["county"], ["a,b,c,d", "b,c", "c"], ["b", "", ""]),
    (lambda c: S.county_state_country(c)["country"], ["a,b,c,d", "c"], ["d", "c"]),
    (lambda c: S.city_state_zip(c)["zip"], ["Town, ST 33101", "Town ST"], ["33101", ""]),
    (lambda c: S.city_state_zip(c)["city"], ["A, B, ST 33101"], ["A, B"]),
    (lambda c: S.row_total(c.cast("int"), F.lit(None).cast("int"), F.lit(2)), ["3", None], [5, 2]),
]


@pytest.mark.parametrize("n", range(len(CASES)))
def test_scalar(spark, n):
    fn, values, want = CASES[n]
    assert ev(spark, fn, values) == want
