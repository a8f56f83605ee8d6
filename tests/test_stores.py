"""Stores that a run changes in part, against the operators that make the whole table anew."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fieldglean.operators import relational, snapshots
from fieldglean.sources import stores

RUNS = [[("a", "1", 5), ("b", "1", 6), (None, "1", 1)], [("a", "2", 5), ("c", "1", 7), (None, "1", 1)], [("a", "1", 5), ("b", "1", 6)],
        [], [("b", None, 6), ("c", "1", 7), ("a", "1", 5)]]


def rows(df):
    return sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))


@pytest.mark.parametrize("reset", [True, False])
def test_log_equals_replayed_runs(spark, tmp_path, reset):
    root, store = str(tmp_path / "log"), None
    assert stores.logged_versions(spark, root, "k") is None
    for n, run in enumerate(RUNS, start=1):
        batch = spark.createDataFrame(run, "k string, v string, w int")
        assert stores.log_run(root, batch, "k", n, ["k", "v", "w"], reset) and not stores.log_run(root, batch, "k", n, ["k", "v", "w"], reset)
        named = batch.filter("k is not null")
        if store is None:
            store = named.withColumns({"checksum": snapshots.checksum(["k", "v", "w"]), "version_no": F.lit(1), "run": F.lit(n), "on_sale": F.lit(True)})
        else:
            store = snapshots.apply_run(store, named, "k", n, ["k", "v", "w"], reset)
        store = spark.createDataFrame(store.collect(), store.schema)
        got = stores.logged_versions(spark, root, "k", reset)
        assert rows(got.filter("k is not null")) == rows(store.select(*got.columns))
    # A NULL key is one listing: seen twice unchanged, then gone.
    assert [(r.version_no, r.on_sale) for r in got.filter("k is null").collect()] == [(1, not reset)]
    with pytest.raises(ValueError):
        stores.log_run(root, batch, "k", 0, ["k", "v", "w"], reset)


def test_a_run_logs_what_has_changed_only(spark, tmp_path):
    root = str(tmp_path / "log")
    first = spark.range(2000).select("id", F.md5(F.col("id").cast("string")).alias("text"))
    second = first.withColumn("text", F.when(F.col("id") % 100 == 0, "new").otherwise(F.col("text"))).filter("id <> 7")
    stores.log_run(root, first, "id", 1, ["text"])
    before = {p: p.stat().st_mtime_ns for p in Path(root).rglob("*.parquet")}
    stores.log_run(root, second, "id", 2, ["text"])
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert spark.read.parquet(f"{root}/data/batch=run-000000002").count() == 21
    got = stores.logged_versions(spark, root, "id")
    assert got.count() == 2020 and got.filter("on_sale").count() == 1999
    # An interrupted write of a run is not seen, and its repetition counts once.
    (Path(root) / "data" / "batch=run-000000003").mkdir()
    assert stores.logged_versions(spark, root, "id").count() == 2020


COLUMNS = "doc string, phone string, name string"


def test_upsert_writes_hit_files_only(spark, tmp_path):
    root, live = str(tmp_path / "t"), F.col("phone") != ""
    assert stores.read_table(spark, root) is None
    base = spark.range(1000).select(F.concat(F.lit("d"), F.col("id") % 10).alias("doc"), F.col("id").cast("string").alias("phone"),
                                    F.lit("old").alias("name"), F.lit(0).alias("n")).repartitionByRange(8, F.col("phone").cast("int"))
    assert stores.upsert_table(root, base, ["doc", "phone"], "n", live, "one")
    files = {p.name: p.stat().st_size for p in Path(root, "data").rglob("*.parquet")}
    assert len(files) >= 4
    new = [("d5", "5", "x", 1), ("d5", "5", "y", 2), ("d7", "7", "z", 3), ("d7", "", "blank", 4), ("d1", "5", "other", 5), ("d1", None, "none", 6),
           ("e", "1", "twice", 7), ("e", "1", "twice", 8)]
    incoming = spark.createDataFrame(new, COLUMNS + ", n int")
    want = rows(relational.upsert(base.drop("n"), incoming, ["doc", "phone"], "n", live))
    hit = stores.hit_files(stores.read_table(spark, root), incoming, ["doc", "phone"], live)
    assert hit.count() == 1 and "name" not in hit._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].splitlines()[0]
    assert stores.upsert_table(root, incoming, ["doc", "phone"], "n", live, "two") and not stores.upsert_table(root, incoming, ["doc", "phone"], "n", live, "two")
    assert rows(stores.read_table(spark, root)) == want
    # All files but one are still those of the first batch.
    now = {p.rsplit("/", 1)[-1] for p in stores.read_table(spark, root).inputFiles()}
    assert len(set(files) - now) == 1
    # A batch without hits rewrites nothing; an empty one neither.
    stores.upsert_table(root, spark.createDataFrame([("q", "", "a", 1)], COLUMNS + ", n int"), ["doc", "phone"], "n", live, "three")
    stores.upsert_table(root, incoming.limit(0), ["doc", "phone"], "n", live, "four")
    assert stores.read_table(spark, root).count() == len(want) + 1
    assert now <= {p.rsplit("/", 1)[-1] for p in stores.read_table(spark, root).inputFiles()}
