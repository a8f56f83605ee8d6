"""Language ID: a bit-sliced Bloom filter returns, for an n-gram, all languages that contain it."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import mix, pick, prepare

#: Lengths of the n-grams in bytes; slots of the filter and hashes of an n-gram.
LENGTHS, SLOTS, HASHES = (3, 4, 5), 1 << 19, 3
#: Labelled documents of each language to learn from, about. An n-gram belongs to a language if this share of its documents has it.
TRAIN_DOCS, LEAST_SHARE, LEAST_DOCS = 5_000, 0.005, 2
UNKNOWN = "und"
_U = np.uint64
_PIECE = 1 << 20
_FLUSH = 1 << 20
#: Letters stay, and so do the bytes of other letters than ASCII's; all else is a gap between words.
_CLASSES = np.full(256, 32, np.uint8)
_CLASSES[97:123] = np.arange(97, 123)
_CLASSES[128:] = np.arange(128, 256)
_MAYBE_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    return any(m.group().isalpha() for m in _MAYBE_LETTER.finditer(text))


def grams(text: str, lengths: Sequence[int] = LENGTHS) -> Iterator[np.ndarray]:
    """Hashes of the n-grams inside words, word ends included, in pieces of bounded size cut between words."""
    raw = _CLASSES[np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)].tobytes()
    at = 0
    while at < len(raw):
        end = len(raw)
        if end - at > _PIECE:
            found = raw.find(b" ", at + _PIECE)
            end = found if found >= 0 else end
        piece = np.frombuffer(b" " + raw[at:end] + b" ", np.uint8)
        wide, gap = piece.astype(_U), piece == 32
        for n in lengths:
            k = len(piece) - n + 1
            if k <= 0:
                continue
            value, broken = np.full(k, n, _U), np.zeros(k, bool)
            for i in range(n):
                value = (value << _U(8)) | wide[i:i + k]
                if 0 < i < n - 1:
                    broken |= gap[i:i + k]
            yield mix(value[~broken])
        at = end


def slots(hashes: np.ndarray, i: int, size: int) -> np.ndarray:
    """The slot of the i-th hash function: double hashing with the two halves."""
    with np.errstate(over="ignore"):
        return ((hashes >> _U(32)) + _U(i) * ((hashes & _U(0xFFFFFFFF)) | _U(1))) % _U(size)


@dataclass(frozen=True)
class Model:
    """`table[w, slot]`: bit b is set if a n-gram of language 64 * w + b has that slot."""

    languages: tuple[str, ...]
    table: np.ndarray
    false_rate: np.ndarray
    lengths: tuple[int, ...] = LENGTHS
    hashes: int = HASHES

    def counts(self, text: str) -> tuple[int, np.ndarray]:
        """The number of n-grams, and for each language how many of them its filter contains."""
        total, hits = 0, np.zeros(len(self.languages))
        for g in grams(text, self.lengths):
            total += len(g)
            at = [slots(g, i, self.table.shape[1]) for i in range(self.hashes)]
            for w, words in enumerate(self.table):
                mask = words[at[0]]
                for a in at[1:]:
                    mask = mask & words[a]
                for b in range(min(64, len(self.languages) - 64 * w)):
                    hits[64 * w + b] += np.count_nonzero(mask & _U(1 << b))
        return total, hits

    def judge(self, text: str) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        total, hits = self.counts(text)
        if not total:
            return self.languages[0], 0.0
        # Of the n-grams a language does not have, its filter still returns the share `false_rate`.
        real = np.clip((hits - self.false_rate * total) / (1 - self.false_rate), 0, total) / total
        best = int(np.argmax(real))
        return self.languages[best], float(real[best])


def train(docs: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", per_language: int = TRAIN_DOCS,
          lengths: Sequence[int] = LENGTHS, size: int = SLOTS, hashes: int = HASHES) -> Model:
    """Learn from about `per_language` documents of each language, drawn by a hash of the key.

    Rows without text, language or key teach nothing. The filter has a fixed size; its slots (at most `size` rows per
    64 languages) are what comes to the driver.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text, lang).toDF("k", "t", "l").where("k is not null and t is not null and l is not null")
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    wide = -(-len(names) // 64)
    table = np.zeros((wide, size), _U)
    lengths = tuple(lengths)
    if names:
        number = F.create_map(*[F.lit(x) for i, n in enumerate(names) for x in (n, i)])[F.col("l")]
        rate = F.create_map(*[F.lit(x) for n in names for x in (n, int(min(1.0, per_language / sizes[n]) * (1 << 20)) + 1)])[F.col("l")]
        drawn = rows.where(F.pmod(F.xxhash64(F.lit("train"), "k"), F.lit(1 << 20)) < rate).select(number.alias("n"), "t")

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, waiting = {}, 0

            def flush():
                for n, parts in held.items():
                    g, c = np.unique(np.concatenate(parts), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(g), n, np.int32)), pa.array(g.view(np.int64)), pa.array(c)], ["n", "g", "c"])

            for batch in batches:
                for n, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                    parts = list(grams(t.as_py(), lengths))
                    if parts:
                        held.setdefault(n, []).append(np.unique(np.concatenate(parts)))
                        waiting += len(held[n][-1])
                    if waiting > _FLUSH:
                        yield from flush()
                        held, waiting = {}, 0
            yield from flush()

        seen = drawn.mapInArrow(count, "n int, g long, c long").groupBy("n", "g").agg(F.sum("c").alias("c"))
        taken = drawn.groupBy("n").agg(F.count("*").alias("docs"))
        kept = seen.join(F.broadcast(taken), "n").where((F.col("c") >= LEAST_DOCS) & (F.col("c") >= LEAST_SHARE * F.col("docs")))

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                n, g = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(_U)
                at = np.concatenate([slots(g, i, size) for i in range(hashes)]).astype(np.int32)
                bit = np.left_shift(_U(1), (n % 64).astype(_U)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.tile((n // 64).astype(np.int32), hashes)), pa.array(at), pa.array(np.tile(bit, hashes))], ["w", "s", "m"])

        filled = kept.select("n", "g").mapInArrow(place, "w int, s int, m long").groupBy("w", "s").agg(F.bit_or("m").alias("m")).toArrow()
        table[filled["w"].to_numpy(), filled["s"].to_numpy()] = filled["m"].to_numpy().view(_U)
    fill = np.array([np.count_nonzero(table[i // 64] & _U(1 << (i % 64))) / size for i in range(len(names))])
    return Model(tuple(names), table, fill ** hashes, lengths, hashes)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, lang_pred, score (the share of the text's n-grams that the language contains, corrected).

    Null texts and texts without a letter are `und` with score 0, as is every text if nothing was learned. Of languages
    with equal counts, the first in code-point order is taken. Rows are judged one by one from the text alone: repeated rows
    and null keys stay; an empty table gives an empty result; other columns are not looked at.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            out = [known.judge((t.as_py() or b"").decode("utf-8", "replace")) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([o[0] for o in out], pa.string()),
                                              pa.array([o[1] for o in out], pa.float64())], [key, "lang_pred", "score"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, F.col(text).cast("binary")).mapInArrow(run, f"`{key}` {kind}, lang_pred string, score double")


def held_out(key):
    """Whether a document is kept from learning: crc32 of its id as text leaves 0 when divided by 5; not for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
