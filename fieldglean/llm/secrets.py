"""Secret scans: fixed patterns, and character Markov models of random strings against ordinary identifiers."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglean.llm.common import pick

#: (kind, pattern, group that is measured, least length of that group), in the order in which equal starts are listed.
#: Of a run of hex digits or capitals only the start can match, so the look-behind changes no result; it saves retries.
BASE = (
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    ("access", r"AKIA[A-Z0-9]{14,}", 0, 18),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{16,}", 0, 16),
)
#: What the models are asked about: runs of key characters of some length.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}"
#: A run counts as random from this log-likelihood ratio on, in total and per pair of characters.
LEAST_TOTAL, LEAST_MEAN = 12.0, 0.75
#: Documents whose words are taken as samples of ordinary identifiers, about; generated random strings.
SAMPLE_DOCS, SAMPLE_RANDOM = 20_000, 2_000
_CODES, _ALPHABET, _PRIOR = 128, 66, 0.5


#: Entries that a pass over an array gathers before it hands them on.
CHUNK = 256


def scanned(items: Column, step) -> Column:
    """The spans that `step(state, item) -> (state, keep, span)` keeps along an array, from state 0 on.

    An array that grows with each entry would be copied as often, so entries are gathered in arrays of bounded size and these are
    gathered; time stays near proportional to the entries. The array must not be empty.
    """
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    nones = F.expr("cast(array() as array<array<struct<start:int,rank:int,end:int,kind:string>>>)")

    def one(acc: Column, x: Column) -> Column:
        state, keep, span = step(acc["at"], x)
        return F.struct(state.alias("at"), F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    def many(acc: Column, part: Column) -> Column:
        told = F.aggregate(part, F.struct(acc["at"].alias("at"), none.alias("out")), one)
        # Through an array, so that what was told is not worked out twice.
        return F.transform(F.array(told), lambda t: F.struct(t["at"].alias("at"), F.concat(acc["out"], F.array(t["out"])).alias("out")))[0]

    parts = F.transform(F.sequence(F.lit(0), F.size(items) - 1, F.lit(CHUNK)), lambda i: F.slice(items, i + 1, F.lit(CHUNK)))
    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), nones.alias("out")), many, lambda a: F.flatten(a["out"]))


def found(text: Column, matches: Column, pattern: str, kind: str, rank: int, keep) -> Column:
    """array of (start, rank, end, kind) of the matches that `keep` accepts; code points, end exclusive.

    The pieces between the matches give their places: a running length over (piece, match) pairs.
    """
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), 1, F.size(matches)), matches, lambda p, m: F.struct(
        F.length(p).alias("gap"), F.length(m).alias("n"), m.alias("m")))
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")

    def step(at: Column, x: Column) -> tuple[Column, Column, Column]:
        start = at + x["gap"]
        end = start + x["n"]
        return end, keep(x["m"]), F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"))

    # As an array of one, so that the pairs are made once and not for each part.
    return F.when(F.size(matches) > 0, F.flatten(F.transform(F.array(pairs), lambda p: scanned(p, step)))).otherwise(none)


def free_spans(spans: Column, others: Column, rank: int) -> Column:
    """Those of `spans` (of this rank, disjoint, by start) that touch none of `others` (of lower ranks): one pass over both by start.
    What lies before reaches no further than the furthest end so far; of what follows only the next can touch."""
    none = F.expr("cast(array() as array<struct<start:int,rank:int,end:int,kind:string>>)")
    pairs = F.flatten(F.transform(F.array(F.array_sort(F.concat(others, spans))), lambda s: F.zip_with(
        s, F.slice(s, 2, F.size(s)), lambda x, after: F.struct(x.alias("x"), after["start"].alias("next"), after["rank"].alias("r")))))

    def step(reach: Column, p: Column) -> tuple[Column, Column, Column]:
        x, own = p["x"], p["x"]["rank"] == rank
        touched = (reach > x["start"]) | (F.coalesce(p["r"] != rank, F.lit(False)) & F.coalesce(p["next"] < x["end"], F.lit(False)))
        return F.when(own, reach).otherwise(F.greatest(reach, x["end"])), own & ~touched, x

    return F.when(F.size(spans) == 0, none).when(F.size(others) == 0, spans).otherwise(
        F.flatten(F.transform(F.array(pairs), lambda p: scanned(p, step))))


def random_strings(spark: SparkSession, n: int = SAMPLE_RANDOM) -> DataFrame:
    """(sample, random=true): strings of evenly drawn characters, in base 64 and in hex digits."""
    ids = spark.range(n)
    digest = F.sha2(F.concat(F.lit("random"), F.col("id").cast("string")), 256)
    text = F.when(F.col("id") % 4 == 0, F.substring(digest, 1, 40)).otherwise(F.substring(F.base64(F.unhex(digest)), 1, 40))
    return ids.select(text.alias("sample"), F.lit(True).alias("random"))


def labelled_samples(docs: DataFrame, text: str = "text", key: str = "doc_id", most: int = SAMPLE_DOCS) -> DataFrame:
    """(sample, random): generated random strings, and words of about `most` documents that no base pattern takes."""
    rows = pick(docs, key, text)
    rate = min(1.0, most / max(1, rows.count()))
    rows = rows.where(F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 20)) < int(rate * (1 << 20)) + 1)
    plain = F.col(text)
    for _, pattern, _, _ in BASE:
        plain = F.regexp_replace(plain, pattern, " ")
    words = rows.select(F.explode(F.regexp_extract_all(plain, F.lit(r"(?<![A-Za-z0-9+/_=-])[A-Za-z][A-Za-z0-9_-]{5,}"), F.lit(0))).alias("sample"))
    return words.withColumn("random", F.lit(False)).unionByName(random_strings(docs.sparkSession))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratios, random over ordinary, of each pair of ASCII characters, at 128 * first + second.

    First-order models with additive smoothing; a null, empty or one-character sample adds nothing. Only pair counts
    (at most 2 * 128 * 128) come to the driver.
    """
    pairs = samples.where(F.length("sample") > 1).select("random", F.explode(F.transform(
        F.sequence(F.lit(1), F.length("sample") - 1), lambda i: F.substring(F.col("sample"), i, F.lit(2)))).alias("p"))
    pairs = pairs.select("random", F.ascii("p").alias("a"), F.ascii(F.substring("p", 2, 1)).alias("b")).where(
        (F.col("a") < _CODES) & (F.col("b") < _CODES)).groupBy("random", "a", "b").count()
    counts: dict[bool, dict[tuple[int, int], int]] = {True: {}, False: {}}
    firsts: dict[bool, dict[int, int]] = {True: {}, False: {}}
    for r in pairs.collect():
        counts[r["random"]][r["a"], r["b"]] = r["count"]
        firsts[r["random"]][r["a"]] = firsts[r["random"]].get(r["a"], 0) + r["count"]

    def log_p(random: bool, a: int, b: int) -> float:
        return math.log((counts[random].get((a, b), 0) + _PRIOR) / (firsts[random].get(a, 0) + _PRIOR * _ALPHABET))

    return [log_p(True, a, b) - log_p(False, a, b) for a in range(_CODES) for b in range(_CODES)]


def ratio(token: Column, model: list[float]) -> Column:
    """The sum of the model over a token's pairs of characters. The model is one array literal (a cast folds, a lambda would not)."""
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in model)), ",").cast("array<double>")
    characters = F.split(token, "")
    pairs = F.zip_with(characters, F.slice(characters, 2, F.length(token)), lambda a, b: F.when(
        b.isNull() | (b == ""), 0.0).otherwise(F.element_at(table, F.ascii(a) * _CODES + F.ascii(b) + 1)))
    return F.aggregate(pairs, F.lit(0.0), lambda acc, x: acc + x)


def scan(docs: DataFrame, model: list[float], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_assign, n_access, n_hex, base_spans, random_spans (arrays of start, rank, end, kind).

    Patterns of BASE, leftmost without overlap per kind; a match that is too short is dropped and not tried again. A run of
    key characters that touches no base span is added as `random` where the models say so. Null texts count as empty.
    Rows are judged one by one: repeated rows and null keys stay; an empty table gives an empty result; other columns are
    not looked at.
    """
    t = F.col("t")
    rows = pick(docs, key, text).select(key, F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("*", *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p, _, _ in BASE],
                       F.regexp_extract_all("t", F.lit(CANDIDATE), F.lit(0)).alias("m_random"))
    spans = []
    for rank, (kind, pattern, group, least) in enumerate(BASE):
        measured = (lambda m, p=pattern, g=group: F.regexp_extract(m, p, g)) if group else (lambda m: m)
        spans.append(found(t, F.col(f"m_{kind}"), pattern, kind, rank, lambda m, f=measured, n=least: F.length(f(m)) >= n).alias(f"s_{kind}"))

    def likely(m: Column) -> Column:
        r = ratio(m, model)
        return (r >= LEAST_TOTAL) & (r >= LEAST_MEAN * (F.length(m) - 1))

    spans.append(found(t, F.col("m_random"), CANDIDATE, "random", len(BASE), likely).alias("s_random"))
    rows = rows.select(key, *spans)
    base = F.array_sort(F.concat(*[F.col(f"s_{k}") for k, _, _, _ in BASE]))
    rows = rows.select(key, *[F.size(f"s_{k}").cast("long").alias(f"n_{k}") for k, _, _, _ in BASE], base.alias("base_spans"), "s_random")
    apart = free_spans(F.col("s_random"), F.col("base_spans"), len(BASE))
    return rows.select(key, *[f"n_{k}" for k, _, _, _ in BASE], "base_spans", apart.alias("random_spans"))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
