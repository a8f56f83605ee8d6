"""Sinks. Writers never gather rows: one file per state means one partition column, not one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", by: Sequence[str] = ()) -> None:
    """CSV with a header, quotes only where needed."""
    writer = df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "")
    (writer.partitionBy(*by) if by else writer).csv(path)


def export_csv(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """CSV for people: missing text is written as an empty field, missing numbers as they are."""
    write_csv(df.fillna(""), path, by=by)


def append_table(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """A new version of a table beside the old ones: readers keep the version they opened."""
    path = f"{root}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_by_state(df: DataFrame, path: str, batch: str | None = None) -> None:
    """One folder per state. Rebalancing gathers a state into few files and splits one that holds most rows.

    Rows are appended; with a batch name, once however often the batch is written."""
    balanced = df.hint("rebalance", F.col("state"))
    if batch is None:
        write_csv(balanced, path, mode="append", by=["state"])
    else:
        write_batch(balanced, path, batch, ["state"], "csv")


def write_by_outcome(df: DataFrame, path: str) -> None:
    """Documents routed by outcome (done, N/A, error): a partition column instead of moved files. Lists (the pages of a document)
    are written with blanks between their items."""
    lists = [c for c, t in df.dtypes if t.startswith("array")]
    write_csv(df.withColumns({c: F.array_join(F.col(c).cast("array<string>"), " ") for c in lists}) if lists else df, path, by=["outcome"])


# --- batches that count once ---------------------------------------------------------------------

def committed_batches(spark: SparkSession, root: str) -> list[str]:
    """Names of the batches of a sink that were written in full: one row of its manifest each."""
    try:
        found = spark.read.parquet(f"{root}/manifest")
    except AnalysisException:  # nothing was committed yet
        return []
    return sorted(r["batch"] for r in found.select(F.col("batch").cast("string")).distinct().collect())


def write_batch(df: DataFrame, root: str, batch: str, by: Sequence[str] = (), kind: str = "parquet") -> bool:
    """Add a batch to a sink once, however often it is written; whether this call added it.

    The rows go to a folder of the batch, which a repeated write replaces, and then a row goes to the manifest. Readers take the
    batches of the manifest alone (``read_batches``), so what a killed write left is not seen and its repetition starts anew. A name
    holds letters, digits, ``-``, ``_`` and ``.``, so that it is the same in a path. One writer at a time.
    """
    if not batch or not all(c.isascii() and (c.isalnum() or c in "-_.") for c in batch) or batch[0] in "_.":
        raise ValueError(f"not a batch name: {batch!r}")
    spark = df.sparkSession
    if batch in committed_batches(spark, root):
        return False
    path = f"{root}/data/batch={batch}"
    if kind == "csv":
        write_csv(df, path, by=by)
    else:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*by) if by else writer).parquet(path)
    spark.createDataFrame([(batch, kind)], "name string, kind string").coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/batch={batch}")
    return True


def read_batches(spark: SparkSession, root: str, kind: str = "parquet") -> DataFrame | None:
    """All rows of the committed batches, with their ``batch`` name; None before the first."""
    names = committed_batches(spark, root)
    if not names:
        return None
    reader = spark.read.option("basePath", f"{root}/data")
    paths = [f"{root}/data/batch={n}" for n in names]
    return reader.option("header", True).option("escape", '"').csv(paths) if kind == "csv" else reader.option("mergeSchema", True).parquet(*paths)
