"""Helpers that the operators share: column picking, written tables, word hashes, components."""

from __future__ import annotations

import re
import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglean.session import ship_package

#: A word, in the syntax that Java, RE2 and Python share.
WORD = r"[^\x20\x09-\x0D]+"
#: Texts are handed to Python in batches of few rows and bytes, which bounds a worker's memory.
BATCH_ROWS, BATCH_BYTES = 64, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Ship the package to the executors and bound the Arrow batches of this session."""
    ship_package(spark)
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(re.sub(r"\D", "", spark.conf.get(key)) or 0)
        if not 0 < now <= most:
            spark.conf.set(key, str(most))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Exactly these columns. Others may differ from them in case only, or repeat a name (then the first counts)."""
    columns = df.columns
    renamed = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return renamed.select(*[F.col(f"c{columns.index(n)}").alias(n) for n in names])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under spark.checkpoint.dir; only a local session without that setting gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="fieldglean-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Compute once: write to the shared folder and read back, so a lost executor costs one task, not the lineage."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# --- word hashes ---------------------------------------------------------------------------------

_U = np.uint64
_P = _U(0x9E3779B97F4A7C15)
_P_INVERSE = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Bytes hashed at a time: the arrays of a piece fit a core's cache.
_PIECE = 1 << 15
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept for the longest piece seen."""
    if len(_powers.get("up", ())) < n:
        with np.errstate(over="ignore"):
            for key, base in (("up", _P), ("down", _P_INVERSE)):
                out = np.full(n, base, _U)
                out[0] = 1
                _powers[key] = np.multiply.accumulate(out)
    return _powers["up"], _powers["down"]


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word of a UTF-8 text, in order. Long texts are taken in pieces cut at white space."""
    parts, at = [], 0
    while at < len(text):
        end = len(text)
        if end - at > _PIECE:
            found = _SPACE.search(text, at + _PIECE)
            end = found.start() if found else end
        parts.append(_piece_hashes(np.frombuffer(text, np.uint8, end - at, at)))
        at = end
    return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.empty(0, _U)


def batch_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The word hashes of several texts after one another, and where each text's words begin (one more than texts)."""
    joined = b"\n".join(texts)
    bounds = np.zeros(len(texts) + 1, np.int64)
    if joined:
        raw = np.frombuffer(joined, np.uint8)
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        counts = np.add.reduceat(np.append(_word_starts(raw), 0), np.minimum(starts[:-1], len(raw)), dtype=np.int64)
        counts[np.diff(starts) == 1] = 0
        bounds[1:] = np.cumsum(counts)
    return word_hashes(joined), bounds


def _word_starts(raw: np.ndarray) -> np.ndarray:
    """1 where a word begins."""
    inside = ~_SPACES[raw]
    inside[1:] &= _SPACES[raw[:-1]]
    return inside.view(np.uint8)


def _piece_hashes(raw: np.ndarray) -> np.ndarray:
    inside = np.concatenate(([False], ~_SPACES[raw], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, _U)
    up, down = _power(len(raw) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, _U)
        np.multiply(raw, up[: len(raw)], out=sums[1:])
        np.cumsum(sums, out=sums)
        value = (sums[ends] - sums[starts]) * down[starts]
        return mix(value + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` consecutive words; empty when there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, _U)
    out = hashes[:n].copy()
    with np.errstate(over="ignore"):
        for i in range(1, width):
            out *= _U(0xC2B2AE3D27D4EB4F)
            out += hashes[i:i + n]
    return mix(out + _U(width))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


# --- components ----------------------------------------------------------------------------------

def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, component): the smallest node reachable, for every node of `edges(a, b)`.

    Alternates large-star and small-star steps over (node, parent) rows; each is one grouped minimum, which combines
    before the shuffle, so a node with very many neighbours is no hot key. Each round is written to the shared folder.
    """
    pairs = written(edges.select("a", "b").where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(rounds):
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.unionByName(least.where("m < a").select("a", F.col("m").alias("b"))).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        pairs = written(small.unionByName(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    nodes = pairs.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.groupBy("node").agg(F.min("component").alias("component")).unionByName(
        pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
