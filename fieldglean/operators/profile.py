"""Profiling aggregates: counts, quartiles, null reports, histograms.

All of them combine on the map side; what is shuffled is one small partial result per task, so a
value that holds a third of the rows costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rank error of the sketches that enclose a quantile (one in so many rows), margins tried around it, points of a later sketch.
_SKETCH_ACCURACY, _GRID = 10_000, 1_000
_MARGINS = (0.001, 0.003, 0.01, 0.03, 0.1, 0.3, 1.0)
# Rows between two values that are few enough to be sorted.
_MOST = 10_000


def value_counts(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    """Rows per value, NULL dropped, most frequent first; equal counts in value order."""
    return (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias(name))
            .orderBy(F.desc(name), c))


def counts_in_order(df: DataFrame, c: str, name: str = "count") -> DataFrame:
    return (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias(name)).orderBy(c))


def explode_counts(df: DataFrame, items: Column, item: str = "item", name: str = "count") -> DataFrame:
    """Rows per element of an array column."""
    return df.select(F.explode(items).alias(item)).groupBy(item).agg(F.count("*").alias(name))


def top_k(df: DataFrame, k: int, *order: Column | str) -> DataFrame:
    return df.orderBy(*order).limit(k)


def present(c: str) -> Column:
    """The column as a double, NaN counting as missing."""
    v = F.col(c).cast("double")
    return F.when(~F.isnan(v), v)


def _narrowed(df: DataFrame, cols: Sequence[str], probs: Sequence[float], most: int) -> tuple[dict[str, int], dict[tuple[str, float], tuple]]:
    """Rows per column, and for each (column, probability) two values that enclose its ranks with about ``most`` rows between them.

    Rank selection in rounds: sketches merged over all partitions tell where the ranks lie, what lies below is counted, and the
    rows between are sketched again. A round leaves a thousandth of the rows, so 10^12 take four. A few numbers a round come here.
    """
    num = {c: present(c) for c in cols}
    margin = lambda n: next(d for d in _MARGINS if d >= 3 / _SKETCH_ACCURACY + 2 / max(n, 1) or d == 1.0)
    points = sorted({min(max(p + s * d, 0.0), 1.0) for p in probs for d in _MARGINS for s in (-1, 1)})
    first = df.agg(*[F.struct(F.count(num[c]).alias("n"), F.percentile_approx(num[c], points, _SKETCH_ACCURACY).alias("q")).alias(c) for c in cols]).first()
    at = lambda c, p: first[c]["q"][points.index(min(max(p, 0.0), 1.0))]
    found, size = {}, {}
    for c in cols:
        n = first[c]["n"]
        for p in probs:
            d = margin(n)
            found[c, p] = (at(c, p - d), at(c, p + d)) if n else (None, None)
            size[c, p] = 2 * d * n
    grid = [i / _GRID for i in range(_GRID + 1)]
    while wide := [k for k, (lo, hi) in found.items() if size[k] > most and lo < hi]:
        told = df.agg(*[F.struct(
            F.count_if(num[c] < lo).alias("below"), F.count_if(num[c].between(lo, hi)).alias("n"),
            F.percentile_approx(F.when(num[c].between(lo, hi), num[c]), grid, _SKETCH_ACCURACY).alias("q")).alias(str(i))
            for i, ((c, p), (lo, hi)) in enumerate((k, found[k]) for k in wide)]).first()
        for i, k in enumerate(wide):
            below, n, q = told[str(i)]
            rank = (first[k[0]]["n"] - 1) * k[1] - below
            # Two steps beside the ranks: one for the grid, one for what the sketch may be off.
            lo, hi = (max(0, int(rank / n * _GRID) - 2), min(_GRID, int((rank + 1) / n * _GRID) + 3))
            # Many rows of one value cannot be parted; the same bounds again end the rounds.
            size[k] = 0 if (q[lo], q[hi]) == found[k] else n * (hi - lo) / _GRID
            found[k] = (q[lo], q[hi])
    return {c: first[c]["n"] for c in cols}, found


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], most: int = _MOST) -> DataFrame:
    """``(column_name, prob, quantile)`` with linear interpolation, exact at any size.

    Each quantile is first enclosed between two values with at most about ``most`` rows between them (``_narrowed``). One more pass
    counts what lies below and groups the values between, so only that sliver is shuffled and sorted, however many rows or values
    a column has. If the values should not enclose the rank the query fails instead of returning a wrong value.
    """
    num = {c: present(c) for c in cols}
    total, found_between = _narrowed(df, cols, probs, most)
    cases = [(c, p, *(F.lit(v).cast("double") for v in found_between[c, p])) for c in cols for p in probs]
    tag = lambda c, p: (F.lit(c).alias("column_name"), F.lit(float(p)).alias("prob"))

    # How many rows lie below each bracket: plain counters of one pass.
    counted = df.agg(*[F.count_if(num[c] < lo).alias(f"b{i}") for i, (c, _, lo, _) in enumerate(cases)])
    below = counted.select(F.inline(F.array(*[
        F.struct(*tag(c, p), F.lit(None).cast("double").alias("value"), F.col(f"b{i}").alias("rows"))
        for i, (c, p, _, _) in enumerate(cases)])))
    # The values inside any bracket of their column, grouped before they are shuffled, then given
    # to the brackets that hold them.
    near = {c: reduce(lambda a, b: a | b, [num[c].between(lo, hi) for k, _, lo, hi in cases if k == c]) for c in cols}
    values = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.when(near[c], num[c]).alias("value")) for c in cols])))
    values = values.filter("value is not null").groupBy("column_name", "value").agg(F.count("*").alias("rows"))
    holders = F.array_compact(F.array(*[
        F.when((F.col("column_name") == c) & F.col("value").between(lo, hi), F.lit(float(p))) for c, p, lo, hi in cases]))
    inside = values.select("column_name", F.explode(holders).alias("prob"), "value", "rows")

    # NULL sorts first: the count of everything below the bracket starts the running total.
    w = Window.partitionBy("column_name", "prob").orderBy(F.col("value").asc_nulls_first())
    last = reduce(lambda chain, c: chain.when(F.col("column_name") == c, total[c] - 1), cols, F)
    pos = last * F.col("prob")
    ranked = below.unionByName(inside).withColumn("upto", F.sum("rows").over(w)).select(
        "column_name", "prob", "value", "upto", (F.col("upto") - F.col("rows")).alias("from"), pos.alias("pos"))
    holds = lambda rank: F.max(F.when((rank >= F.col("from")) & (rank < F.col("upto")), F.col("value")))
    found = ranked.groupBy("column_name", "prob").agg(
        F.first("pos").alias("pos"), holds(F.floor("pos")).alias("a"), holds(F.ceil("pos")).alias("b"))
    frac = F.col("pos") - F.floor("pos")
    value = F.when(frac == 0, F.col("a")).otherwise(F.col("a") + (F.col("b") - F.col("a")) * frac)
    missed = (F.col("pos") >= 0) & (F.col("a").isNull() | F.col("b").isNull())
    checked = F.when(missed, F.raise_error(F.lit("quantile outside its bracket")).cast("double")).otherwise(value)
    return found.select("column_name", "prob", checked.alias("quantile"))


def describe(df: DataFrame, cols: Sequence[str], digits: int | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum, one row per numeric column."""
    stats = {"cnt": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    once = df.agg(*[F.struct(*[f(present(c)).alias(n) for n, f in stats.items()]).alias(c) for c in cols])
    rows = once.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), *[F.col(c)[n].alias(n) for n in stats]) for c in cols])))
    q = (exact_quantiles(df, cols, (0.25, 0.5, 0.75)).groupBy("column_name").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
          for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))]))
    out = rows.join(q, "column_name", "left").select(
        "column_name", "cnt", "mean", "std", "min", "q25", "q50", "q75", "max")
    if digits is not None:
        out = out.select("column_name", "cnt", *[F.round(c, digits).alias(c) for c in out.columns[2:]])
    return out


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, nulls)`` for all columns in one pass."""
    missing = {c: F.col(c).isNull() | F.isnan(c) if t in ("double", "float") else F.col(c).isNull() for c, t in df.dtypes}
    once = df.agg(*[F.count_if(F.coalesce(m, F.lit(True))).alias(c) for c, m in missing.items()])
    return once.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns])))


def table_info(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, non_null, total)`` for all columns in one pass."""
    once = df.agg(F.count("*").alias("__total"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    return once.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"),
                 F.col(c).alias("non_null"), F.col("__total").alias("total")) for c, t in df.dtypes])))


def histogram(df: DataFrame, c: str, bins: int = 50) -> DataFrame:
    """Equal-width bins from minimum to maximum, last bin closed, empty bins kept."""
    v = present(c)
    # Minimum and maximum come from a scalar subquery: one pass, one row, no join.
    edge = df.agg(F.struct(F.min(v).alias("lo"), F.max(v).alias("hi"))).scalar()
    lo, hi = edge["lo"], edge["hi"]
    at = F.when(hi == lo, 0).otherwise(F.least(F.floor((v - lo) / (hi - lo) * bins), F.lit(bins - 1)))
    counted = (df.filter(v.isNotNull()).select(at.cast("int").alias("bin"))
               .groupBy("bin").agg(F.count("*").alias("count")))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select("bin", F.coalesce("count", F.lit(0)).alias("count"))


def all_null_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: how many of the columns hold no value at all."""
    once = df.agg(*[F.count(F.col(c)).alias(c) for c in cols])
    empty = reduce(lambda a, b: a + b, [(F.col(c) == 0).cast("int") for c in cols])
    return once.select(empty.alias("all_null"))
