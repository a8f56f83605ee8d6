"""Readers: delimited files, file inventories, manifests, logs, stored tables, document and web pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldglean.functions.scalars import base_name, log_message, na_to_null
from fieldglean.operators.relational import number_blocks
from fieldglean.sources import csv_folder

# The two title files.
TITLES_SCHEMA = """tconst string, titleType string, primaryTitle string, originalTitle string, isAdult string,
    startYear string, endYear string, runtimeMinutes string, genres string"""
RATINGS_SCHEMA = "tconst string, averageRating string, numVotes string"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stored_table(spark: SparkSession, path: str | None = None, **jdbc: str) -> DataFrame:
    """A stored table: parquet, or over JDBC at the edge."""
    return spark.read.parquet(path) if path else spark.read.format("jdbc").options(**jdbc).load()


def read_delimited(spark: SparkSession, path: str | Sequence[str], schema: str, sep: str = "\t",
                   null: str = "\\N", header: bool = True, partitions: int | None = None, quoted_breaks: bool = False) -> DataFrame:
    """Delimited text with a null marker; the usual missing-value texts are NULL too.

    With ``quoted_breaks`` a quoted field may hold line breaks, and a file is one split.

    A gzip file is one split, so ``partitions`` spreads its rows before further work.
    """
    raw = (spark.read.schema(schema).option("sep", sep).option("nullValue", null).option("header", header)
           .option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").option("multiLine", quoted_breaks).csv(path))
    if partitions:
        raw = raw.repartition(partitions)
    return raw.select(*[na_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
                        for f in raw.schema])


def read_keys(spark: SparkSession, path: str) -> DataFrame:
    """A list of keys: a CSV with a header, all columns text."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)


def file_inventory(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``(path, name, length)`` of the files of a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return files.select("path", base_name("path").alias("name"), "length")


def of_type(inventory: DataFrame, extension: str) -> DataFrame:
    return inventory.filter(F.lower("name").endswith("." + extension.lower()))


def from_manifest(inventory: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files named in the second column of a manifest (its header row is not a name)."""
    names = manifest.select(F.col(manifest.columns[1]).alias("name"))
    return inventory.join(names, "name", "left_semi")


def read_csv_folder(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(rows of all CSV files by column name, files with something left out: ``path``, ``reason``, how often and its first line).

    Files may have different headers and are read in blocks, so a large file is read by many tasks (see ``csv_folder.read``).
    """
    rows, left_out = csv_folder.read(spark, folder)
    return rows, left_out.groupBy("path", "reason").agg(F.count("*").alias("n"), F.min("line").alias("first_line"))


def number_folder_rows(df: DataFrame, name: str, offset: int = 0) -> DataFrame:
    """Rows of ``read_csv_folder`` with contiguous numbers over files and lines, without its marks."""
    return number_blocks(df, ["__path", "__start"], "__m", name, offset).drop(*csv_folder.MARKS)


def read_log(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(message)`` of each log line, without what precedes the first ' - '."""
    return spark.read.text(path).select(log_message("value").alias("message"))


def doc_pages(df: DataFrame, doc: str, page: str, text: str) -> DataFrame:
    return df.select(F.col(doc).alias("doc"), F.col(page).cast("int").alias("page"), F.col(text).alias("text"))


def web_pages(df: DataFrame, status: str | None = None) -> DataFrame:
    """Pages whose request succeeded; without a status column all pages count as fetched."""
    return df.filter(F.col(status).between(200, 299)) if status else df
