"""Session defaults. Every setting here is a default a cluster configuration may override."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Parsed web pages turn into many node rows: small Arrow batches bound the Python side's memory.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
}


def get_session(app: str = "fieldglean", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_shipped: set[str] = set()


def archive_package(folder: str) -> str:
    """This package as an archive in a folder, its tables of rules included."""
    root = Path(__file__).resolve().parent
    archive = Path(folder) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*")):
            if f.suffix in (".py", ".txt"):
                z.write(f, f.relative_to(root.parent))
    return str(archive)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so Python steps import it there from any folder."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    context.addPyFile(archive_package(tempfile.mkdtemp(prefix="fieldglean-ship-")))
    _shipped.add(context.applicationId)


def parallelism(spark: SparkSession) -> int:
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def spread(df: DataFrame) -> DataFrame:
    """A table scan over at least as many tasks as there are cores, for work that is heavy per row.

    Only a table of few files is reshuffled; a large one has its partitions already and is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _shared(spark: SparkSession) -> None:
    """See that there is a checkpoint folder: the one the cluster names, for a local session without one (tests, a laptop) a temporary one."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="fieldglean-"))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name on the storage all executors share."""
    _shared(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage, on the shared storage the cluster names.

    For small results that cost much and are read several times. The files survive a lost executor.
    """
    _shared(df.sparkSession)
    return df.checkpoint(eager=True)
