"""What the plans must and must not contain, and that a hot key is spread."""

import re

import pytest

from pyspark.sql import functions as F

from fieldglean import queries as registry
from fieldglean.operators import html, ordered, relational
from fieldglean.rules import sites as R
from fieldglean.sources.readers import table

registry.load_all()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if not n.startswith("contact_")))
def test_no_row_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(registry.QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text
    assert text.count("MapInArrow") + text.count("MapInPandas") <= 1


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(registry.QUERIES["join_filter_explode_top10"](spark, sf_dir))
    # The bare column is compared, so the range can be pushed into the parquet reader.
    assert re.search(r"DataFilters: \[isnotnull\(l_returnflag#\d+\), isnotnull\(l_shipdate#\d+\)", text)
    assert re.search(r"\(l_shipdate#\d+ >= 1996-01-01 00:00:00\)\) AND \(l_shipdate#\d+ < 2000-01-01 00:00:00\)", text)
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string,l_shipdate:timestamp" in text
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in text


def test_first_n_is_limited_before_the_shuffle(spark, sf_dir):
    text = plan(registry.QUERIES["first_n_active"](spark, sf_dir))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_rules_are_broadcast_and_page_fields_share_one_shuffle(spark):
    pages = spark.createDataFrame([(1, "<html></html>")], "page_id bigint, html string")
    from fieldglean.plans import listings
    text = plan(listings.raw_fields(pages, "bizquest"))
    assert "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") == 1
    nodes = html.matched_nodes(pages, R.detail_rules("bizmls"), site="bizmls")
    assert "BroadcastHashJoin" in plan(nodes) and "Exchange hashpartitioning" not in plan(nodes)


def test_checkpoint_folder_is_the_configured_one(spark, tmp_path):
    from fieldglean.session import cut
    assert cut(spark.range(3)).count() == 3
    assert spark.sparkContext.getCheckpointDir()


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    text = plan(registry.QUERIES["value_counts"](spark, sf_dir))
    assert text.count("HashAggregate") == 2


def test_hot_key_is_numbered_and_filled_in_pieces(spark):
    hot = spark.range(100_000).select(F.lit("hot").alias("g"), F.col("id").alias("k"))
    numbered = relational.number_rows(hot, ["g"], F.col("k"), 1000, "n")
    assert numbered.filter(F.col("n") != F.col("k")).count() == 0
    filled = ordered.fill_forward(hot, ["g"], "k", F.when(F.col("k") % 777 == 0, F.col("k")), "f", [F.floor(F.col("k") / 1000)])
    assert filled.filter(F.col("f") != F.col("k") - F.col("k") % 777).count() == 0
    assert re.search(r"hashpartitioning\(.*__b", plan(numbered))


def test_blank_keys_take_no_part_in_the_upsert_join(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("fdd_name"), F.lit("").alias("phone"), "c_name")
    out = relational.upsert(c, c.withColumn("row_no", F.lit(1)), ["fdd_name", "phone"], "row_no", F.col("phone") != "")
    assert out.count() == 2 * c.count()
