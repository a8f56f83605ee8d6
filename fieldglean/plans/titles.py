"""Title analysis: titles with their ratings, profile, and the mini-series questions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.functions.scalars import to_bool_null_true, to_number
from fieldglean.operators.profile import counts_in_order, explode_counts, top_k


def clean_titles(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"runtimeMinutes": to_number("runtimeMinutes"), "isAdult": to_bool_null_true("isAdult"),
                            "startYear": to_number("startYear").cast("int"), "endYear": to_number("endYear").cast("int")})


def with_ratings(titles: DataFrame, ratings: DataFrame) -> DataFrame:
    typed = ratings.select("tconst", to_number("averageRating").alias("averageRating"),
                           to_number("numVotes").cast("bigint").alias("numVotes"))
    return titles.join(typed, "tconst", "left")


def mini_series(df: DataFrame, first: int = 2000, before: int = 2023) -> DataFrame:
    return df.filter((F.col("titleType") == "tvMiniSeries") & (F.col("startYear") >= first) & (F.col("startYear") < before))


def per_year(df: DataFrame) -> DataFrame:
    return counts_in_order(mini_series(df), "startYear")


def top_genres(df: DataFrame, k: int = 10) -> DataFrame:
    counts = explode_counts(mini_series(df), F.split("genres", ","), "genre")
    return top_k(counts, k, F.desc("count"), "genre")
