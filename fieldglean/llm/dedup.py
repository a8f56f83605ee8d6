"""Exact dedup as a stream: keyed state on disk holds each text's digest, stable identifier and content locator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldglean.llm.common import pick, shared_folder, written

#: Rows of a group that one task compares byte by byte, about: a large group is dealt out by this many salts.
SALTS = 64
_CARRIED = ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone", "spark.sql.adaptive.enabled")
_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Each partition's files leave the executor's disk when its task has committed them to the checkpoint folder.
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def state_session(spark: SparkSession) -> SparkSession:
    """A session of the same application whose streams keep their state in RocksDB, on the executors' disks, with a
    copy of every version in the checkpoint folder. The caller's settings stay as they are."""
    own = spark.newSession()
    for name in _CARRIED:
        own.conf.set(name, spark.conf.get(name))
    for name, value in _STATE.items():
        own.conf.set(name, value)
    return own


def track(fingerprints: str, schema: T.StructType, spark: SparkSession, state: str, files_per_batch: int | None = None) -> DataFrame:
    """Feed the files of a folder of (digest, id, locator) rows that the stream has not seen yet to the state.

    The state has a row per digest, without expiry: the largest id so far, its locator and the number of rows. Partial
    sums are made before rows go to the state, so a text with very many copies is no hot key. Called again with the same
    `state` folder, it takes only new files: the checkpoint holds what was read. Returns the state as it is now:
    (digest, keep_id, keep_locator, group_size).
    """
    own = state_session(spark)
    stream = own.readStream.schema(schema)
    if files_per_batch:
        stream = stream.option("maxFilesPerTrigger", files_per_batch)
    groups = stream.parquet(fingerprints).groupBy("digest").agg(
        F.max(F.struct("id", "locator")).alias("keep"), F.count("*").alias("group_size"))

    def put(batch: DataFrame, number: int) -> None:
        # A batch that is run again after a failure replaces what it wrote before.
        batch.select("digest", "keep", "group_size").write.mode("overwrite").parquet(f"{state}/changes/batch={number}")

    query = (groups.writeStream.outputMode("update").option("checkpointLocation", f"{state}/checkpoint")
             .trigger(availableNow=True).foreachBatch(put).start())
    query.awaitTermination()
    changes = T.StructType([T.StructField("digest", schema["digest"].dataType), T.StructField("keep", T.StructType([
        T.StructField("id", schema["id"].dataType), T.StructField("locator", schema["locator"].dataType)])),
        T.StructField("group_size", T.LongType())])
    # A key's last change has its largest count.
    last = spark.read.schema(changes).parquet(f"{state}/changes").groupBy("digest").agg(
        F.max(F.struct("group_size", "keep")).alias("s"))
    return last.select("digest", F.col("s.keep.id").alias("keep_id"), F.col("s.keep.locator").alias("keep_locator"), "s.group_size")


def exact_duplicates(docs: DataFrame, digest: Callable[[Column], Column] = sha256, key: str = "doc_id", text: str = "text",
                     files_per_batch: int | None = None) -> DataFrame:
    """Per row: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the row with the largest key stays. A null
    key is below all others; a group of null keys only has a null keep_id and is kept. Rows that repeat a key with the
    same text are counted each and share one result. An empty table gives an empty result; other columns are not looked at.

    The stream sees digests only; the locator says in which input file a text stands. The texts of each digest that was
    hit again are then compared in full: smallest and largest text must be the same bytes. Digests that fail (a
    collision) are grouped anew by the texts themselves.
    """
    spark = docs.sparkSession
    rows = pick(docs, key, text).select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"),
                                        F.input_file_name().alias("locator"))
    rows = rows.withColumn("digest", digest(F.col("t")))
    folder = shared_folder(spark, "dedup")
    prints = rows.select("digest", "id", "locator", F.sha2("t", 256).alias("text_sha256"))
    prints.write.parquet(f"{folder}/prints")
    prints = spark.read.schema(prints.schema).parquet(f"{folder}/prints")
    state = track(f"{folder}/prints", prints.schema, spark, folder, files_per_batch)

    hits = state.where("group_size > 1").select("digest")
    salted = hits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    compared = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int")).select("digest", "salt", "t").join(
        salted, ["digest", "salt"], "left_semi")
    extremes = compared.groupBy("digest", "salt").agg(F.min("t").alias("low"), F.max("t").alias("high"))
    # All texts of a digest are the same bytes if each salt holds one text, and all salts the same one.
    split = extremes.groupBy("digest").agg(F.max(F.col("low") != F.col("high")).alias("inside"), F.min("low").alias("low"),
                                           F.max("low").alias("high")).where("inside or low <> high").select("digest")
    collided = written(split, "dedup-collided")

    doubtful = rows.join(collided, "digest", "left_semi").withColumn("text_sha256", F.sha2("t", 256))
    regrouped = doubtful.groupBy("digest", "t").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
    plain = prints.join(collided, "digest", "left_anti").join(state, "digest").select("id", "keep_id", "group_size", "text_sha256")
    again = doubtful.join(regrouped, ["digest", "t"]).select("id", "keep_id", "group_size", "text_sha256")
    return plain.unionByName(again).select(
        F.col("id").alias(key), "keep_id", "group_size", F.coalesce(F.col("id") == F.col("keep_id"), F.col("keep_id").isNull()).alias("kept"),
        "text_sha256")
