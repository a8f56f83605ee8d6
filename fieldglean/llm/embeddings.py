"""Near duplicates among embeddings: cross-polytope hashing after fast Hadamard rotations, multiprobe, verified pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import components, pick, prepare, written

LEAST_COSINE = 0.9
#: Probes beside a vector's own bucket; rows of a bucket that are compared at once; vectors that a bucket should hold, about.
PROBES, BLOCK, BUCKET = 2, 2048, 1000


def plan(n: int, dim: int) -> tuple[int, int]:
    """Hash functions per table, which make buckets small, and tables, which win back what smaller buckets lose."""
    functions = max(1, math.ceil(math.log(max(1, n / BUCKET)) / math.log(2 * max(2, dim))))
    return functions, 4 * 2 ** (functions - 1)


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        x = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2)
        step *= 2
    return x.reshape(n, d) / math.sqrt(d)


def codes(x: np.ndarray, functions: int, tables: int, probes: int = PROBES, seed: int = 11) -> np.ndarray:
    """(row, table, 1 + probes): a vector's own bucket and the next best, by the least loss in one function."""
    n, width = x.shape
    d = 1 << max(0, (width - 1).bit_length())
    padded = np.zeros((n, d))
    padded[:, :width] = x
    out = np.zeros((n, tables, 1 + probes), np.int64)
    places = 2 * d
    for t in range(tables):
        own, losses, changes = np.zeros(n, np.int64), [], []
        for k in range(functions):
            rng = np.random.default_rng([seed, t, k, d])
            y = padded
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], d))
            size = np.abs(y)
            top = np.argsort(-size, 1, kind="stable")[:, :1 + probes]
            best = np.take_along_axis(size, top, 1)
            place = 2 * top + (np.take_along_axis(y, top, 1) < 0)
            own = own * places + place[:, 0]
            scale = places ** (functions - 1 - k)
            for r in range(1, top.shape[1]):
                losses.append(best[:, 0] - best[:, r])
                changes.append((place[:, r] - place[:, 0]) * scale)
        out[:, t, :] = own[:, None]
        if losses:
            order = np.argsort(np.array(losses).T, 1, kind="stable")[:, :probes]
            picked = np.take_along_axis(np.array(changes).T, order, 1)
            out[:, t, 1:1 + picked.shape[1]] += picked
    return out


def _finite(batch: pa.RecordBatch, column: int) -> list[np.ndarray | None]:
    out = []
    for v in batch.column(column).to_pylist():
        x = None if not v or any(c is None for c in v) else np.array(v, float)
        # Scaled first, so that squares neither overflow nor vanish.
        top = np.abs(x).max() if x is not None else 0
        out.append(x / top / np.linalg.norm(x / top) if x is not None and np.isfinite(x).all() and top > 0 else None)
    return out


def _compare(key: tuple, group: pa.Table, least: float, shape: tuple[int, int]) -> pa.Table:
    """Links inside one bucket, or between two parts of a large one: (id, links, parent).

    A pair counts where it is first found: in no earlier table, and of two probes that find each other, in the smaller bucket.
    """
    table, part, other = (key[i].as_py() for i in (0, 2, 3))
    col = {c: group.column(c).to_numpy() for c in ("id", "copies", "own", "part")}
    code = np.frombuffer(b"".join(group.column("codes").to_pylist()), np.int64).reshape(-1, *shape)
    x = np.frombuffer(b"".join(group.column("vector").to_pylist()), np.float64).reshape(len(code), -1)
    links, parent = np.zeros(len(code), np.int64), np.arange(len(code))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def cross(a: np.ndarray, b: np.ndarray, same: bool, probing: bool) -> None:
        for at in range(0, len(a), 512):
            rows, cols = np.nonzero(x[a[at:at + 512]] @ x[b].T >= least)
            i, j = a[at:at + 512][rows], b[cols]
            keep = col["id"][i] < col["id"][j] if same else col["id"][i] != col["id"][j]
            i, j = i[keep], j[keep]
            early = code[:, :table]
            met = (early[i, :, 0] == early[j, :, 0]) | (early[i, :, :1] == early[j, :, 1:]).any(2) | (early[j, :, :1] == early[i, :, 1:]).any(2)
            keep = ~met.any(1)
            if probing:
                mutual = (code[j, table, :1] == code[i, table, 1:]).any(1)
                keep &= ~mutual | (code[i, table, 0] < code[j, table, 0])
            i, j = i[keep], j[keep]
            np.add.at(links, i, col["copies"][j])
            np.add.at(links, j, col["copies"][i])
            for u, v in zip(i.tolist(), j.tolist()):
                ru, rv = find(u), find(v)
                if ru != rv:
                    parent[rv] = ru

    left, right = np.flatnonzero(col["part"] == part), np.flatnonzero(col["part"] == other)
    own = col["own"]
    cross(left[own[left]], right[own[right]], part == other, False)
    cross(left[own[left]], right[~own[right]], False, True)
    if part != other:
        cross(right[own[right]], left[~own[left]], False, True)
    roots = np.array([find(i) for i in range(len(code))], np.int64)
    told = np.flatnonzero((links > 0) | (roots != np.arange(len(code))))
    return pa.table({"id": col["id"][told], "links": links[told], "parent": col["id"][roots[told]]})


def near_duplicates(vectors: DataFrame, least: float = LEAST_COSINE, key: str = "vec_id", column: str = "embedding", probes: int = PROBES) -> DataFrame:
    """Per row: key, n_links (other rows with a cosine of at least `least`, as found), component_id (smallest key that links reach,
    itself included), kept (whether that is the row itself).

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing. Vectors of different lengths do not
    link. Equal vectors are one class, compared once and counted as often as they occur, so copies make no large bucket; a
    bucket of many different vectors is compared in pairs of parts. A null key takes part in links but is never the id of a
    component with other keys. An empty table gives an empty result; other columns are not looked at.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = pick(vectors, key, column).select(F.col(key).alias("k"), F.col(column).alias("v"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit = _finite(batch, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if u is None else u.tobytes() for u in unit], pa.binary())], ["k", "u"])

    kind = rows.schema["k"].dataType.simpleString()
    rows = written(rows.mapInArrow(check, f"k {kind}, u binary").withColumn("id", F.when(F.col("u").isNotNull(), F.xxhash64("u"))), "vectors")
    groups = written(rows.where("u is not null").groupBy("id").agg(
        F.min("u").alias("u"), (F.min("u") != F.max("u")).alias("clash"), F.min("k").alias("first"), F.count("*").alias("copies")), "vector-classes")
    size = groups.agg(F.count("*").alias("n"), F.max(F.length("u")).alias("bytes"), F.max("clash").alias("clash")).first()
    if size["clash"]:
        raise RuntimeError("two different vectors have the same 64-bit hash")
    functions, tables = plan(size["n"], (size["bytes"] or 8) // 8)
    shape = (tables, 1 + probes)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column(1).to_pylist()
            for width in sorted({len(r) for r in raw}):
                take = [i for i, r in enumerate(raw) if len(r) == width]
                x = np.frombuffer(b"".join(raw[i] for i in take), np.float64).reshape(len(take), -1)
                code = codes(x, functions, tables, probes)
                part = batch.take(pa.array(take))
                # One row per vector and table; its own bucket and the probed ones follow as an array.
                n = len(take)
                for t in range(tables):
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0), part.column(2), part.column(1), pa.array([c.tobytes() for c in code]), pa.array(np.full(n, t, np.int32)),
                         pa.array(np.full(n, width, np.int32)), pa.array(list(code[:, t]), pa.list_(pa.int64()))],
                        ["id", "copies", "vector", "codes", "table", "width", "buckets"])

    entries = groups.select("id", "u", "copies").mapInArrow(
        spread, "id long, copies long, vector binary, codes binary, table int, width int, buckets array<long>")
    entries = entries.select("*", F.posexplode("buckets").alias("rank", "bucket")).drop("buckets")
    entries = entries.withColumn("own", F.col("rank") == 0)
    counts = entries.groupBy("table", "width", "bucket").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / BLOCK).cast("int")
    entries = entries.join(counts.where("n > 1"), ["table", "width", "bucket"]).withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    entries = entries.withColumn("with", F.explode(F.sequence(F.lit(0), parts - 1))).select(
        F.col("table"), F.concat_ws(":", "width", "bucket").alias("bucket"), F.least("part", "with").alias("one"), F.greatest("part", "with").alias("two"),
        "id", "copies", "vector", "codes", "own", "part")

    def compare(key: tuple, group: pa.Table) -> pa.Table:
        return _compare(key, group, least, shape)

    found = written(entries.groupBy("table", "bucket", "one", "two").applyInArrow(compare, "id long, links long, parent long"), "vector-links")
    total = found.groupBy("id").agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("id").alias("a"), F.col("parent").alias("b")))
    labels = groups.join(reached, groups["id"] == reached["node"], "left").select("id", "first", "copies", F.coalesce("component", "id").alias("component"))
    names = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    result = labels.join(names, "component").join(total, "id", "left").select(
        "id", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.join(result, "id", "left").select(F.col("k").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                                                 F.coalesce("component_id", "k").alias("component_id"))
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
