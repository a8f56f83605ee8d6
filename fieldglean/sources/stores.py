"""Stored tables that a run changes in part: a log of versions, and a table of which only the files with a hit are written anew.

Both are Parquet folders. What a killed run leaves is not seen by readers, and its repetition gives what one run gives. One writer at a
time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from fieldglean.operators.relational import upsert
from fieldglean.operators.snapshots import checksum
from fieldglean.sources.writers import committed_batches, read_batches, write_batch

# --- log of versions -----------------------------------------------------------------------------
# One row per change of a listing: a new version with its record, or another flag of its latest version (record NULL). What a run
# writes grows with what has changed, and what it reads is the narrow columns.

_RUN = "run-{:09d}"


def _log(spark: SparkSession, root: str) -> DataFrame | None:
    return read_batches(spark, root)


def log_run(root: str, batch: DataFrame, key: str, run_id: int, payload: Sequence[str], reset: bool = True) -> bool:
    """Log what a run changes; False if the run was logged before. ``batch`` has one row per listing and is read twice.

    The same versions and flags as ``snapshots.apply_run`` gives, but stored records are neither read nor written anew: digests are
    compared with the latest of each listing, and records are fetched for those that are new or differ. A NULL key is one listing. Run
    numbers rise.
    """
    spark = batch.sparkSession
    name = _RUN.format(run_id)
    done = committed_batches(spark, root)
    if name in done:
        return False
    if done and done[-1] > name:
        raise ValueError(f"run {run_id} comes after {done[-1]}")
    seen = batch.select(F.col(key).alias("k"), checksum(payload).alias("checksum"))
    log = _log(spark, root)
    if log is None:
        changes = seen.select("k", "checksum", F.lit(1).alias("version_no"), F.lit(True).alias("on_sale"), F.lit(True).alias("fresh"))
    else:
        state = log.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct("version_no", "checksum", "on_sale"), "run").alias("s"))
        both = seen.withColumn("__in", F.lit(True)).join(state, F.col("k").eqNullSafe(F.col("__k")), "full")
        came, known = F.col("__in").isNotNull(), F.col("s").isNotNull()
        same = known & (F.col("s.checksum") == F.col("checksum"))
        fresh = came & ~F.coalesce(same, F.lit(False))
        back = came & ~F.coalesce(F.col("s.on_sale"), F.lit(False))
        gone = ~came & F.col("s.on_sale") if reset else F.lit(False)
        changes = both.filter(fresh | back | gone).select(
            F.when(came, F.col("k")).otherwise(F.col("__k")).alias("k"), F.coalesce("checksum", "s.checksum").alias("checksum"),
            (F.coalesce("s.version_no", F.lit(0)) + F.when(fresh, 1).otherwise(0)).alias("version_no"), came.alias("on_sale"), fresh.alias("fresh"))
    records = batch.select(F.col(key).alias("__k"), F.struct(*payload).alias("record"))
    wanted = F.col("fresh") & F.col("k").eqNullSafe(F.col("__k"))
    rows = changes.join(records, wanted, "left").select(
        F.col("k").alias(key), F.lit(run_id).alias("run"), F.col("version_no").cast("int"), "checksum", "on_sale", "fresh", "record")
    return write_batch(rows, root, name)


def logged_versions(spark: SparkSession, root: str, key: str, reset: bool = True) -> DataFrame | None:
    """All versions of a log, ``(key, version_no, run, payload, checksum, on_sale)``; None before the first run.

    Of the versions of a listing the latest alone can be on sale, except where flags are never cleared.
    """
    log = _log(spark, root)
    if log is None:
        return None
    made = log.filter("fresh")
    fields = [f.name for f in log.schema["record"].dataType if f.name != key]
    versions = made.select(key, "version_no", "run", *[F.col(f"record.`{f}`") for f in fields], "checksum")
    if not reset:
        return versions.withColumn("on_sale", F.lit(True))
    state = log.groupBy(F.col(key).alias("__k")).agg(F.max_by(F.struct("version_no", "on_sale"), "run").alias("__s"))
    return versions.join(state, F.col(key).eqNullSafe(F.col("__k"))).withColumn(
        "on_sale", (F.col("version_no") == F.col("__s.version_no")) & F.col("__s.on_sale")).drop("__k", "__s")


# --- table of files ------------------------------------------------------------------------------

def _manifest(spark: SparkSession, root: str) -> tuple[int, list[str], set[str]]:
    """(latest version, its files, names of the batches it holds). A table's files are what any scan of it lists on the driver, too."""
    try:
        found = spark.read.parquet(f"{root}/manifest")
    except AnalysisException:  # no version yet
        return 0, [], set()
    last = found.agg(F.max("version")).first()[0]
    batches = {r["batch"] for r in found.select("batch").distinct().collect()}
    return last, [r["file"] for r in found.filter((F.col("version") == last) & F.col("file").isNotNull()).select("file").collect()], batches


def _name(column: Column) -> Column:
    return F.regexp_extract(column, "(gen=[^/]*/[^/]*)$", 1)


def read_table(spark: SparkSession, root: str) -> DataFrame | None:
    """The latest version of a table; None before the first, or while it has no rows."""
    _, files, _ = _manifest(spark, root)
    return spark.read.parquet(*[f"{root}/data/{f}" for f in files]) if files else None


def hit_files(stored: DataFrame, keys: DataFrame, key: Sequence[str], live: Column) -> DataFrame:
    """``(file)`` of a stored table that hold a row of one of the keys. Of the table only the key columns are read."""
    wanted = keys.filter(F.coalesce(live, F.lit(False))).select(*key).distinct()
    place = stored.filter(F.coalesce(live, F.lit(False))).select(*key, _name(F.col("_metadata.file_path")).alias("file"))
    return place.join(wanted, list(key), "left_semi").select("file").distinct()


def upsert_table(root: str, incoming: DataFrame, key: Sequence[str], order: str, live: Column, batch: str) -> bool:
    """``relational.upsert`` of a batch into a table of files; False if the batch is in it already.

    A file is written anew only if one of its rows has a live key of the batch: a scan of the key columns says which. The others stay as
    they are, and inserted rows go to new files. Readers see the files of the latest manifest, so a killed run changes nothing.
    ``incoming`` is read several times. Old files are left for readers of earlier versions.
    """
    spark = incoming.sparkSession
    version, files, batches = _manifest(spark, root)
    if batch in batches:
        return False
    stored = read_table(spark, root)
    if stored is None:
        hit, rows = set(), incoming.drop(order)
    else:
        hit = {r["file"] for r in hit_files(stored, incoming, key, live).collect()}
        old = spark.read.schema(stored.schema).parquet(*[f"{root}/data/{f}" for f in sorted(hit)]) if hit else stored.limit(0)
        rows = upsert(old, incoming.select(*stored.columns, order), key, order, live)
    gen = f"gen={version + 1}"
    rows.write.mode("overwrite").parquet(f"{root}/data/{gen}")
    made = [f"{gen}/{f.rsplit('/', 1)[-1]}" for f in spark.read.schema(rows.schema).parquet(f"{root}/data/{gen}").inputFiles()]
    left = [f for f in files if f not in hit] + made
    listing = spark.createDataFrame([(batch, f) for f in left] or [(batch, None)], "batch string, file string")
    listing.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version + 1}")
    return True
