"""Mixing sources to target weights: Efraimidis-Spirakis keys, prefix sums to a word budget, whole epochs first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fieldglean.llm.common import WORD, pick, written

WEIGHTS = (3.0, 1.0, 2.0)
SHARE, MOST_EPOCHS = 1.5, 2.0
#: Quality weights lie in this range, which bounds how unevenly key blocks fill.
QUALITY = (0.5, 1.5)
#: Rows of a source that one task sorts, about.
BLOCK_ROWS = 50_000


def quality(text: Column) -> Column:
    """0.5 to 1.5: half, plus the share of letters A-Z, a-z among a text's characters; 1 for an empty text."""
    n = F.length(text)
    letters = n - F.length(F.regexp_replace(text, "[A-Za-z]+", ""))
    return F.when(n > 0, F.lit(QUALITY[0]) + letters / n).otherwise(1.0)


def uniform(key: Column) -> Column:
    """A number inside (0, 1) that depends on the key only: 52 bits of its MD5."""
    bits = F.conv(F.substring(F.md5(key.cast("string").cast("binary")), 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS) -> DataFrame:
    """`sources(source, source_size, n_rows)` with `weight` and `target`.

    Sources in code-point order, null last, take the weights in turn. Sharing by weight under a cap, with the excess
    shared anew until none is above, ends where min(cap, x * weight) sums to the whole; x follows from prefix sums over
    the sources in order of cap / weight. One row per source: the source list is a setting of the mix, not data.
    """
    place = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    options = F.array(*[F.lit(float(w)) for w in weights])
    table = sources.withColumn("weight", F.element_at(options, (place % len(weights) + 1).cast("int")))
    table = table.withColumn("cap", F.col("source_size") * F.lit(most)).withColumn("ratio", F.col("cap") / F.col("weight"))
    every = W.partitionBy().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    order = W.orderBy("ratio", F.col("source").asc_nulls_last())
    below = F.coalesce(F.sum("cap").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0))
    above = F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing))
    table = table.withColumn("level", (F.sum("source_size").over(every) * F.lit(share) - below) / above)
    table = table.withColumn("x", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(every)["level"])
    return table.select("source", "source_size", "n_rows", "weight", F.when(F.col("source_size") == 0, 0.0).otherwise(
        F.coalesce(F.least("cap", F.col("x") * F.col("weight")), F.col("cap"))).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, most: float = MOST_EPOCHS,
        key: str = "doc_id", source: str = "source", text: str = "text", block_rows: int = BLOCK_ROWS, tie: str | None = None) -> DataFrame:
    """Per row: key, source, size (words), source_size, target, times (how often the mix takes it), taken (words).

    Each source is taken whole floor(target / source_size) times; then its rows in order of -ln(u) / quality (ties by
    key) once more, as long as a row's middle word lies within what is left of the target. u comes from the key alone,
    so reruns agree. Null texts have size 0; null is a source of its own; rows of size 0 are taken with a complete epoch
    or at once when their turn comes. Rows that repeat a key share a place in the order: which goes first does not
    show, as both hold the same. A column `tie` that differs in every row settles ties of keys and is returned too. An empty
    table gives an empty result; other columns are not looked at.

    A source of any size is ordered in blocks of its keys: totals per block, a prefix over blocks, then a sort inside
    each block. The blocks are even up to the ratio of the largest to the smallest quality.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    ties = [F.col(tie).alias("tie")] if tie else []
    narrow = pick(docs, key, source, text, *([tie] if tie else [])).select(
        *ties, F.col(key).alias("k"), F.col(source).alias("source"), F.regexp_count(body, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(uniform(F.coalesce(F.col(key).cast("string"), F.lit("")))) / quality(body)).alias("e"))
    narrow = written(narrow, "mix")
    aims = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows")), weights, share, most)
    aims = aims.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)).withColumn(
        "left", F.col("target") - F.col("whole") * F.col("source_size"))
    aims = written(aims.withColumn("blocks", F.ceil(F.col("n_rows") / F.lit(block_rows))), "mix-targets")
    same = F.col("r.source").eqNullSafe(F.col("a.source"))
    rows = narrow.alias("r").join(aims.alias("a"), same).select(
        "r.*", "source_size", "target", "whole", "left",
        F.floor((1 - F.exp(-F.col("e") * QUALITY[0])) * F.col("blocks")).alias("block"))
    sums = rows.groupBy("source", "block").agg(F.sum("size").alias("words"))
    before = F.sum("words").over(W.partitionBy("source").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    sums = sums.select("source", "block", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("size").over(W.partitionBy("source", "block").orderBy("e", "k", *(["tie"] if tie else [])).rowsBetween(W.unboundedPreceding, 0))
    rows = rows.withColumn("inside", inside).alias("r").join(
        sums.alias("s"), F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.block") == F.col("s.block"))).select("r.*", "before")
    middle = F.col("before") + F.col("inside") - F.col("size") / 2
    times = F.col("whole") + F.when(middle <= F.col("left"), 1).otherwise(0)
    times = F.least(times, F.lit(int(most))).cast("long")
    return rows.select(*([F.col("tie").alias(tie)] if tie else []), F.col("k").alias(key), "source", "size", "source_size", "target",
                       times.alias("times"), (times * F.col("size")).alias("taken"))
