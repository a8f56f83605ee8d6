"""Versioned snapshots: a listing gets a new version when its checksum changes from run to run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldglean.operators.relational import last_per_key


def checksum(cols: Sequence[str]) -> Column:
    """Digest of the record in sorted field order, missing fields included."""
    return F.md5(F.to_json(F.struct(*sorted(cols)), {"ignoreNullFields": "false"}))


def one_per_run(raw: DataFrame, key: str, run: str, order: str) -> DataFrame:
    """The last record of a listing in a run. Afterwards a listing has at most one row per run."""
    return last_per_key(raw, [key, run], order)


def versions(records: DataFrame, key: str, run: str, payload: Sequence[str]) -> DataFrame:
    """Replay of all runs: the rows at which a listing's checksum changes, numbered.

    Only adjacent versions are ever compared, so ``lag`` over the runs equals applying run after
    run; a value that comes back makes a third version. ``records`` has one row per (listing, run),
    which bounds a window group by the number of runs whatever the raw volume of a listing.
    """
    w = Window.partitionBy(key).orderBy(run)
    before = F.lag("checksum").over(w)
    changed = (records.withColumn("checksum", checksum(payload)).withColumn("__p", before)
               .filter(F.col("__p").isNull() | (F.col("__p") != F.col("checksum"))))
    return changed.select(key, run, *[c for c in payload if c not in (key, run)], "checksum",
                          F.row_number().over(w).alias("version_no"))


def current(records: DataFrame, key: str, run: str, payload: Sequence[str]) -> DataFrame:
    """Latest version per listing; on sale when the listing was seen in the last run of all."""
    found = versions(records, key, run, payload)
    last_run = records.agg(F.max(run)).scalar()
    seen = records.groupBy(key).agg(F.max(run).alias("__seen"))
    latest = last_per_key(found, [key], run)
    return latest.join(seen, key).withColumn("on_sale", F.col("__seen") == last_run).drop("__seen")


def apply_run(store: DataFrame, batch: DataFrame, key: str, run_id: int, payload: Sequence[str],
              reset: bool = True) -> DataFrame:
    """One run against the stored versions ``(key, version_no, run, payload, checksum, on_sale)``.

    All flags are cleared (unless the site never does), unseen or changed listings get a version
    that is on sale, unchanged ones have the flag of their latest version set.
    """
    cols = store.columns
    latest = store.groupBy(key).agg(F.max_by(F.struct("version_no", "checksum"), "version_no").alias("__l"))
    incoming = batch.withColumn("checksum", checksum(payload)).join(latest, key, "left")
    same = F.col("__l").isNotNull() & (F.col("__l.checksum") == F.col("checksum"))
    fresh = incoming.filter(~same).withColumns({
        "version_no": F.coalesce(F.col("__l.version_no"), F.lit(0)) + 1,
        "run": F.lit(run_id), "on_sale": F.lit(True)}).select(*cols)
    still = (incoming.filter(same).select(key, F.col("__l.version_no").alias("version_no"))
             .distinct().withColumn("__same", F.lit(True)))
    flag = F.coalesce(F.col("__same"), F.lit(False) if reset else F.col("on_sale"))
    kept = store.join(still, [key, "version_no"], "left").withColumn("on_sale", flag).select(*cols)
    return kept.unionByName(fresh)


def versions_from_store(store: DataFrame, key: str, created: str, tie: str) -> DataFrame:
    """Latest stored row per listing: greatest creation time, then greatest id."""
    return last_per_key(store.withColumn("__o", F.struct(created, tie)), [key], "__o").drop("__o")
