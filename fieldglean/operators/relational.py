"""Keyed updates, unions, row numbers and lookups.

Nothing here hints a broadcast of user data: Spark and AQE pick the join from measured sizes. Only
rule tables written in this package, whose size is known, are broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType


def reindex(df: DataFrame, cols: Sequence[str], dtype: str = "string") -> DataFrame:
    """Exactly the listed columns in that order; missing ones are NULL, others are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).cast(dtype).alias(c) for c in cols])


def union_by_name(*dfs: DataFrame) -> DataFrame:
    out = dfs[0]
    for df in dfs[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def merge_matching_columns(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """Columns whose name matches become one: several are joined with a blank, one is renamed."""
    hits = [c for c in df.columns if re.search(pattern, c, re.IGNORECASE)]
    if not hits:
        return df
    if len(hits) == 1:
        return df.withColumnRenamed(hits[0], name)
    merged = F.concat_ws(" ", *[F.col(c).cast("string") for c in hits])
    return df.select(*[c for c in df.columns if c not in hits], merged.alias(name))


def promote_header(cells: DataFrame, table: str, fields: Sequence[str]) -> DataFrame:
    """Cells ``(table, row_no, col_no, text)`` to rows: row 0 names the columns of its table.

    Cells meet their header in a join on (table, column), so no table is gathered anywhere; the
    fixed field list keeps the pivot a plain aggregate.
    """
    header = cells.filter("row_no = 0").select(table, "col_no", F.col("text").alias("field"))
    body = cells.filter("row_no > 0").join(header, [table, "col_no"])
    return body.groupBy(table, "row_no").agg(
        *[F.max(F.when(F.col("field") == f, F.col("text"))).alias(f) for f in fields])


def last_per_key(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the greatest order value; combines on the map side."""
    rest = [c for c in df.columns if c not in key]
    return (df.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("__r"))
            .select(*key, *[F.col("__r")[c].alias(c) for c in rest]))


def lookup(df: DataFrame, table: DataFrame, key: str, value: str, order: Column | str,
           default: str = "") -> DataFrame:
    """Left lookup of the first row per key; no row gives the default."""
    first = table.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min_by(value, order).alias(value))
    return df.join(first, key, "left").withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def upsert(existing: DataFrame, incoming: DataFrame, key: Sequence[str], order: str,
           live: Column) -> DataFrame:
    """New version of ``existing`` after ``incoming``.

    A live key that exists updates all its rows, the last incoming row winning; any other incoming
    row is inserted, duplicates included. ``incoming`` has the columns of ``existing`` and ``order``.
    """
    cols = existing.columns
    rest = [c for c in cols if c not in key]
    live = F.coalesce(live, F.lit(False))
    # Rows without a live key take no part in the joins, so a frequent blank key skews nothing.
    keys = existing.filter(live).select(*key).distinct().withColumn("__hit", F.lit(True))
    marked = incoming.filter(live).join(keys, list(key), "left")
    newest = last_per_key(marked.filter(F.col("__hit")).drop("__hit"), key, order)
    newest = newest.select(*key, F.struct(*rest).alias("__new"))
    kept = existing.filter(live).join(newest, list(key), "left").select(
        *[c if c in key else F.when(F.col("__new").isNotNull(), F.col("__new")[c]).otherwise(F.col(c)).alias(c)
          for c in cols])
    inserts = marked.filter(F.col("__hit").isNull()).select(*cols)
    return (kept.unionByName(existing.filter(~live)).unionByName(inserts)
            .unionByName(incoming.filter(~live).select(*cols)))


def update_columns(df: DataFrame, results: DataFrame, key: str, values: Mapping[str, str],
                   order: Column | str, default: str = "") -> DataFrame:
    """Add columns holding ``default`` and set them where a result has the key; the last one wins.

    ``values`` maps the new column to its source column in ``results``.
    """
    latest = results.groupBy(key).agg(
        F.max_by(F.struct(*[F.col(src).alias(c) for c, src in values.items()]), order).alias("__r"))
    return df.join(latest, key, "left").select(
        *df.columns, *[F.when(F.col("__r").isNotNull(), F.col("__r")[c]).otherwise(F.lit(default)).alias(c)
                       for c in values])


def set_flags(df: DataFrame, keys: DataFrame, key: str, flags: Mapping[str, str]) -> DataFrame:
    """Overwrite columns with constants on the rows whose key is listed."""
    hit = keys.select(key).distinct().withColumn("__hit", F.lit(True))
    return df.join(hit, key, "left").select(*[
        F.when(F.col("__hit"), F.lit(flags[c])).otherwise(F.col(c)).alias(c) if c in flags else F.col(c)
        for c in df.columns])


def latest_status(existing: DataFrame, updates: DataFrame, key: Sequence[str], ts: str) -> DataFrame:
    """Insert or update by key: the row with the greatest time wins."""
    return last_per_key(existing.unionByName(updates), key, ts)


def move_rows(source: DataFrame, target: DataFrame, moved: Column) -> tuple[DataFrame, DataFrame]:
    """(source without the moved rows, target with them). A NULL condition does not move a row."""
    hit = F.coalesce(moved, F.lit(False))
    return source.filter(~hit), target.unionByName(source.filter(hit))


def replace_children(children: DataFrame, parents: DataFrame, fresh: DataFrame, key: str) -> DataFrame:
    """Children of the listed parents are dropped, the fresh ones added."""
    return children.join(parents.select(key).distinct(), key, "left_anti").unionByName(fresh)


def skip_processed(df: DataFrame, flags: DataFrame, key: str, has: str = "has_contacts",
                   scrape: str = "scrape_contacts") -> DataFrame:
    """Rows not flagged Yes / Yes or No / No."""
    done = flags.filter((F.col(has) == F.col(scrape)) & F.col(has).isin("Yes", "No")).select(key)
    return df.join(done, key, "left_anti")


def _join_starts(rows: DataFrame, starts: DataFrame, on: Sequence[str], name: str, offset: int,
                 cols: Sequence[str]) -> DataFrame:
    right = starts.select(*[F.col(c).alias(f"__r_{c}") for c in on], "__s")
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    return rows.join(right, same).select((F.col("__s") + F.col("__i") - 1 + offset).alias(name), *cols)


def range_of(rows: Column, bounds: Column) -> Column:
    """How many of the sorted bounds are not above a value: a binary search, as many steps as the bounds' number has digits."""
    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(bounds) + 1)).cast("int"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        above = F.get(bounds, middle) <= rows
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & above, middle + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & ~above, middle).otherwise(acc["hi"]).alias("hi"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.size(bounds).alias("hi")), halve, lambda acc: acc["lo"])


def drawn_bounds(df: DataFrame, order: str, width: int, most: int = 4096) -> Column:
    """Sorted values of a struct column, about one in ``width`` of the rows and about ``most`` at most, as a constant.

    A row is drawn by a hash of the value, so a second run draws the same. The rows are counted, then the bounds come to the driver.
    """
    every = max(width, -(-df.count() // most))
    drawn = df.filter(F.pmod(F.xxhash64(F.lit("bound"), order), F.lit(every)) == 0)
    text = drawn.agg(F.to_json(F.sort_array(F.collect_list(order)))).first()[0]
    return F.from_json(F.lit(text), ArrayType(df.schema[order].dataType))


def number_rows(df: DataFrame, group: Sequence[str], key: Column, width: int, name: str,
                offset: int = 0, restart: bool = False) -> DataFrame:
    """Contiguous numbers over (group, key) order, nulls first, for a key unique in its group.

    Rows drawn by a hash of their place bound ranges, so ranges hold about ``width`` rows (seldom more than ten times that) whatever
    the values of the key and the sizes of the groups. Each range is sorted and numbered on its own from the sum of the counts
    before it; that sum sees one row per range. ``restart`` numbers every group from the offset anew.
    """
    tagged = df.withColumn("__o", F.struct(*group, key.alias("__k")))
    tagged = tagged.withColumn("__b", range_of(F.col("__o"), drawn_bounds(tagged, "__o", width)))
    piece = [*group, "__b"] if restart else ["__b"]
    counts = tagged.groupBy(*piece).agg(F.count("*").alias("__n"))
    before = (Window.partitionBy(*group) if restart else Window).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*piece, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    inside = F.row_number().over(Window.partitionBy(*piece).orderBy("__o"))
    return _join_starts(tagged.withColumn("__i", inside), starts, piece, name, offset, df.columns)


def number_blocks(df: DataFrame, block: Sequence[str], order: str, name: str, offset: int = 0) -> DataFrame:
    """Contiguous numbers over blocks of bounded size and the row order inside them.

    For file scans: the block is (file, block start), which the scan bounds at
    ``spark.sql.files.maxPartitionBytes``, and the scan's row ids order the rows inside it.
    """
    counts = df.groupBy(*block).agg(F.count("*").alias("__n"))
    before = Window.orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*block, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    inside = F.row_number().over(Window.partitionBy(*block).orderBy(order))
    return _join_starts(df.withColumn("__i", inside), starts, block, name, offset, df.columns)


def shuffled(df: DataFrame, key: str, seed: str) -> DataFrame:
    """Repeatable random order: by the digest of seed and key."""
    return df.orderBy(F.md5(F.concat(F.lit(seed), F.col(key).cast("string"))), key)


def pick_random(df: DataFrame, key: str, seed: str, n: int = 1) -> DataFrame:
    return shuffled(df, key, seed).limit(n)
