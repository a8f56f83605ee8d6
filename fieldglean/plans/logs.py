"""Outcome counts from run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Message classes in order of precedence, each with a text all its messages contain.
CLASSES = [
    ("invalid methods", r"{year}.+fdd\.pdf: invalid methods", "fdd.pdf: invalid methods"),
    ("franchisees not found", r"{year}.+fdd\.pdf: list of franchisees not found", "fdd.pdf: list of franchisees not found"),
    ("exported with errors", r"Exported with errors to: \./test/results_errors/.*-{year}.+fdd.csv",
     "Exported with errors to: ./test/results_errors/"),
    ("exported correctly", r"Exported to: \./test/results/.*-{year}.+fdd.csv", "Exported to: ./test/results/"),
]
YEARS = ("2022", "2023")
# Result lines of these classes are cut after the text above and get a label.
LABELS = {"exported with errors": ",Exported with errors", "exported correctly": ",Exported correctly"}
NOISE = "Processing page-"


def classify(message: Column) -> Column:
    """``(class, year)`` of a message, the first that fits; NULL when none does.

    The plain text test in front spares most messages the pattern.
    """
    chain = None
    for name, pattern, text in CLASSES:
        for year in YEARS:
            hit = F.contains(message, F.lit(text)) & message.rlike(pattern.format(year=year))
            value = F.struct(F.lit(name).alias("class"), F.lit(year).alias("year"))
            chain = F.when(hit, value) if chain is None else chain.when(hit, value)
    return chain


def result_line(message: Column, cls: Column) -> Column:
    """``name,extension,output``: exported files are cut to their name, then ': ' and '.' become commas."""
    text = message
    for name, _, prefix in CLASSES:
        if name in LABELS:
            cut = F.substr(message, F.instr(message, prefix) + F.lit(len(prefix)))
            text = F.when(cls == name, F.concat(cut, F.lit(LABELS[name]))).otherwise(text)
    return F.replace(F.replace(text, F.lit(": "), F.lit(",")), F.lit("."), F.lit(","))


def classified(messages: DataFrame) -> DataFrame:
    return messages.select("message", F.inline(F.array_compact(F.array(classify(F.col("message"))))))


def outcome_by_year(messages: DataFrame) -> DataFrame:
    """All classes, also those that never occur, with a column per year."""
    counts = classified(messages).groupBy("class").agg(
        *[F.count_if(F.col("year") == y).alias(f"y{y}") for y in YEARS])
    names = messages.sparkSession.createDataFrame([(n,) for n, _, _ in CLASSES], "class string")
    return names.join(counts, "class", "left").fillna(0)


def result_lines(messages: DataFrame) -> DataFrame:
    """Sorted result lines."""
    return classified(messages).select(result_line(F.col("message"), F.col("class")).alias("line")).orderBy("line")


def drop_noise(messages: DataFrame) -> DataFrame:
    return messages.filter(~F.contains("message", F.lit(NOISE)))


def outcome_totals(outcomes: DataFrame, outcome: str = "outcome") -> DataFrame:
    return outcomes.groupBy(outcome).agg(F.count("*").alias("count"))
