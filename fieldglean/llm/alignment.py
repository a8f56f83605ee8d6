"""Alignment of two tokenizers over the same texts by interval coalescing.

Tokens of both are intervals of bytes. Sorted by start, with the running maximum of their ends, they fall into groups wherever a
start reaches that maximum; overlaps are expanded within. How many documents link an id pair is counted over the whole corpus.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import pick, prepare, written

#: Texts are handed to the tokenizers in pieces of about so many characters, pieces together until there are so many.
PIECE_CHARS, TOGETHER_CHARS = 100_000, 400_000
#: Distinct id pairs of documents that are looked up together, about (a document's pairs are never parted).
CHUNK_PAIRS = 1 << 20
#: Both tokenizers begin a token at a single space between two other characters. A piece ends before it; piece tokenizers put
#: the space back.
_SAFE = re.compile(r"\S(?= \S)")
_ROWS = 1 << 16
_models: dict[str, tuple] = {}
TYPES = {"groups": "string", "groups_sha256": "string"}


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: printable ones themselves, the rest from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def piece_bytes(piece: str) -> bytes:
    """The bytes of a piece: U+2581 is a space, <0xHH> a byte."""
    if re.fullmatch(r"<0x[0-9A-Fa-f]{2}>", piece):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Pair:
    """Both tokenizers, made once per worker process from the contents of their files, and the bytes of their entries."""

    def __init__(self, a: bytes, b: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(a.decode())
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        own = byte_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.a_bytes[i] = bytes(own[c] for c in entry) if all(c in own for c in entry) else entry.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [piece_bytes(p) for p in pieces]
        #: No piece crosses the place before a space, so texts may be cut there.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # The decimal ids with each of the separators that may follow: none , | ;
        ids = [*range(len(self.a_bytes)), *range(len(self.b_bytes))]
        self.printed = np.array([f"{i}{s}".encode() for s in ("", ",", "|", ";") for i in ids])

    def pieces(self, text: str, limit: int) -> list[str]:
        out, at = [], 0
        while self.cuts and len(text) - at > limit:
            found = _SAFE.search(text, at + limit - 1)
            if not found:
                break
            out.append(text[at:found.end()])
            at = found.end() + 1
        return [*out, text[at:]]


def pair_of(a: bytes, b: bytes) -> Pair:
    key = hashlib.sha256(a).hexdigest() + hashlib.sha256(b).hexdigest()
    if key not in _models:
        _models.clear()
        _models[key] = Pair(a, b)
    return _models[key]


def coalesce(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and overlaps of two rows of adjoining intervals over the same bytes, given by their sizes.

    (group of each a and then each b interval, order of all intervals by group with a before b, links as a and b numbers)
    """
    n = len(a_sizes)
    a_ends, b_ends = np.cumsum(a_sizes), np.cumsum(b_sizes)
    starts, ends = np.concatenate([a_ends - a_sizes, b_ends - b_sizes]), np.concatenate([a_ends, b_ends])
    side = np.repeat(np.array([0, 1], np.int8), [n, len(b_sizes)])
    order = np.lexsort((side, starts))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    # Within a group an a interval overlaps the run of b intervals that end after its start and start before its end.
    first = np.searchsorted(b_ends, starts[:n], "right")
    count = np.searchsorted(starts[n:], a_ends, "left") - first
    a_of = np.repeat(np.arange(n), count)
    b_of = np.arange(len(a_of)) + np.repeat(first - (np.cumsum(count) - count), count)
    return group, np.lexsort((side, group)), a_of, b_of


class _Document:
    """What is known of a document while its pieces are read."""

    def __init__(self, listing: bool):
        self.a = self.b = self.groups = self.links = 0
        self.broken, self.sha, self.listed = False, hashlib.sha256(), [] if listing else None
        self.pairs: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def merged(self, kind: str) -> tuple[bytes, bytes, int]:
        if self.broken or not self.pairs:
            return b"", b"", 0
        pairs, times = self.pairs[0], self.times[0]
        if len(self.pairs) > 1:
            pairs, at = np.unique(np.concatenate(self.pairs), return_inverse=True)
            times = np.bincount(at, np.concatenate(self.times)).astype(np.int64)
        return pairs.astype(kind).tobytes(), times.astype("<u4").tobytes(), len(pairs)


def read_texts(models: Pair, texts: list[str], listing: bool = False, piece_chars: int = PIECE_CHARS) -> list[_Document]:
    """Tokens, groups and links of each text; a text whose joined tokens are not its bytes is broken."""
    docs = [_Document(listing) for _ in texts]
    waiting, chars = [], 0
    for i, text in enumerate(texts):
        parts = models.pieces(text, piece_chars) if text else []
        for j, part in enumerate(parts):
            waiting.append((i, part, j == len(parts) - 1))
            chars += len(part)
            if chars >= TOGETHER_CHARS:
                _read_pieces(models, docs, waiting)
                waiting, chars = [], 0
    if waiting:
        _read_pieces(models, docs, waiting)
    return docs


def _read_pieces(models: Pair, docs: list[_Document], pieces: list[tuple[int, str, bool]]) -> None:
    spaced = [f" {p}" for _, p, _ in pieces]
    a_ids = [e.ids for e in models.a.encode_batch_fast(spaced, add_special_tokens=False)]
    b_ids = models.b.encode([p for _, p, _ in pieces], num_threads=1)
    for (i, _, _), text, a, b in zip(pieces, spaced, a_ids, b_ids):
        whole = text.encode()
        if b"".join(map(models.a_bytes.__getitem__, a)) != whole or b"".join(map(models.b_bytes.__getitem__, b)) != whole:
            docs[i].broken = True
    kept = [k for k, (i, _, _) in enumerate(pieces) if not docs[i].broken]
    if not kept:
        return
    owner, last = [pieces[k][0] for k in kept], [pieces[k][2] for k in kept]
    a_counts, b_counts = (np.array([len(v[k]) for k in kept]) for v in (a_ids, b_ids))
    a, b = (np.fromiter((t for k in kept for t in v[k]), np.int64) for v in (a_ids, b_ids))
    group, order, a_of, b_of = coalesce(models.a_sizes[a], models.b_sizes[b])
    # Pieces begin at a boundary of both, so each is a run of groups, of that order and of links.
    a_cuts, b_cuts = np.append(0, np.cumsum(a_counts)), np.append(0, np.cumsum(b_counts))
    codes = np.concatenate([a, b + len(models.a_bytes)])[order]
    grouped, sides = group[order], order >= len(a)
    follows = np.full(len(order), 3, np.int64)  # ;
    same = grouped[1:] == grouped[:-1]
    follows[:-1][same] = np.where(sides[1:] == sides[:-1], 1, 2)[same]  # , |
    ends = a_cuts[1:] + b_cuts[1:]
    follows[(ends - 1)[np.array(last)]] = 0
    printed = models.printed[codes + follows * (len(models.a_bytes) + len(models.b_bytes))]
    firsts = group[a_cuts[:-1]]
    counts = np.diff(np.append(firsts, group[-1] + 1))
    link_cuts = np.searchsorted(a_of, a_cuts)
    position = np.repeat(np.arange(len(kept)), np.diff(link_cuts))
    space = len(models.a_bytes) * len(models.b_bytes)
    keys, times = np.unique(position * space + a[a_of] * len(models.b_bytes) + b[b_of], return_counts=True)
    key_cuts = np.searchsorted(keys, np.arange(len(kept) + 1) * space)
    for k, i in enumerate(owner):
        doc = docs[i]
        doc.a += int(a_counts[k])
        doc.b += int(b_counts[k])
        doc.groups += int(counts[k])
        doc.links += int(link_cuts[k + 1] - link_cuts[k])
        text = printed[ends[k] - a_counts[k] - b_counts[k]:ends[k]].tobytes().translate(None, b"\0")
        doc.sha.update(text)
        if doc.listed is not None:
            doc.listed.append(text.decode())
        own = slice(key_cuts[k], key_cuts[k + 1])
        doc.pairs.append(keys[own] - k * space)
        doc.times.append(times[own])


def _kind(space: int) -> str:
    return "<u4" if space <= 1 << 32 else "<u8"


def token_groups(docs: DataFrame, a: bytes, b: bytes, outputs: Sequence[str] = ("groups",), key: str = "doc_id", text: str = "text",
                 piece_chars: int = PIECE_CHARS, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, the asked outputs (groups: `a1,a2|b1;a3|b2,b3`; groups_sha256 of that), and
    chunk, pairs, times: the distinct linked id pairs (a id * size of B + b id, little-endian) with their numbers of links.

    `a` is the content of a byte-level tokenizer's file, given a space before the text, `b` that of a piece model, which adds it.
    A chunk is a run of rows of a task that hold about `chunk_pairs` pairs.
    """
    rows = pick(docs, key, text)
    shared, outputs = rows.sparkSession.sparkContext.broadcast((a, b)), tuple(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = pair_of(*shared.value)
        kind = _kind(len(models.a_bytes) * len(models.b_bytes))
        chunk, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts = [(v.as_py() or b"").decode("utf-8", "replace") for v in batch.column(1)]
            made = {c: [] for c in ("n_a", "n_b", "n_groups", "n_links", *outputs, "chunk", "pairs", "times")}
            for doc in read_texts(models, texts, "groups" in outputs, piece_chars):
                none = doc.broken or not doc.a
                for c, n in (("n_a", doc.a), ("n_b", doc.b), ("n_groups", doc.groups), ("n_links", doc.links)):
                    made[c].append(0 if none else n)
                if "groups" in made:
                    made["groups"].append("" if none else "".join(doc.listed))
                if "groups_sha256" in made:
                    made["groups_sha256"].append("" if none else doc.sha.hexdigest())
                pairs, times, n = doc.merged(kind)
                if held >= chunk_pairs:
                    chunk, held = chunk + 1, 0
                held += n + 16
                made["chunk"].append(chunk)
                made["pairs"].append(pairs)
                made["times"].append(times)
            kinds = {**dict.fromkeys(outputs, pa.string()), "pairs": pa.binary(), "times": pa.binary()}
            yield pa.RecordBatch.from_arrays([batch.column(0)] + [pa.array(v, kinds.get(c, pa.int64())) for c, v in made.items()],
                                             [key, *made])

    schema = ", ".join([f"`{key}` {rows.schema[key].dataType.simpleString()}", *(f"{c} long" for c in ("n_a", "n_b", "n_groups", "n_links")),
                        *(f"{c} {TYPES[c]}" for c in outputs), "chunk long, pairs binary, times binary"])
    return rows.select(key, F.col(text).cast("binary")).mapInArrow(run, schema)


def chunk_pairs_of(groups: DataFrame, kind: str) -> DataFrame:
    """(chunk, pair, n): the distinct pairs of the rows of a chunk that a task reads, with the number of rows that hold each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            pairs, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(pairs), _ROWS):
                part = slice(at, at + _ROWS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pairs[part]), now)), pa.array(pairs[part].astype(np.int64)), pa.array(
                    n[part].astype(np.int64))], ["chunk", "pair", "n"])

        now, held = None, []
        for batch in batches:
            for chunk, pairs in zip(batch.column(0).to_pylist(), batch.column(1)):
                if chunk != now:
                    if held:
                        yield from flush()
                    now, held = chunk, []
                held.append(np.frombuffer(pairs.as_py(), kind))
        if held:
            yield from flush()

    return groups.select("chunk", "pairs").mapInArrow(run, "chunk long, pair long, n long")


def pair_counts(pairs: DataFrame, b_size: int) -> DataFrame:
    """(pair, count, best): in how many documents a pair is linked; whether no pair of its a id is in more."""
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    a_id = F.expr(f"pair div {b_size}").alias("a")
    # One row per entry of A's vocabulary at most.
    tops = F.broadcast(counts.groupBy(a_id).agg(F.max("count").alias("top")))
    return counts.select(a_id, "pair", "count").join(tops, "a").select("pair", "count", (F.col("count") == F.col("top")).alias("best"))


def align(docs: DataFrame, a: bytes, b: bytes, outputs: Sequence[str] = ("groups_sha256",), key: str = "doc_id", text: str = "text",
          piece_chars: int = PIECE_CHARS, chunk_pairs: int = CHUNK_PAIRS) -> DataFrame:
    """Per row: key, n_a, n_b, n_groups, n_links, n_best (links whose pair is in as many documents as any of its a id), count_sum
    (that number, over all links) and the asked outputs of `token_groups`.

    A text that is null or empty, or whose tokens joined are not the bytes of a space and the text, has no tokens: zeros and
    empty strings. Rows are documents: repeated rows and null keys count each. An empty table gives an empty result; other columns
    are not looked at. Long texts are cut where no token can cross, so memory is bounded by a text's tokens, not by its encodings.

    Documents are tokenized once and written. Their pairs go to the counting as distinct ones per chunk, the counts come back to
    the chunk, so what is shuffled is a chunk's vocabulary and not its links, and the work of a hot pair is one row per chunk.
    """
    spark = docs.sparkSession
    prepare(spark)
    models = pair_of(a, b)
    b_size, kind = len(models.b_bytes), _kind(len(models.a_bytes) * len(models.b_bytes))
    groups = written(token_groups(docs, a, b, outputs, key, text, piece_chars, chunk_pairs), "align-groups")
    pairs = written(chunk_pairs_of(groups, kind), "align-pairs")
    answers = pairs.select("chunk", "pair").join(pair_counts(pairs, b_size), "pair")
    names = [key, "n_a", "n_b", "n_groups", "n_links", *outputs]

    def look_up(held: pa.Table, known: pa.Table) -> pa.Table:
        pair, count, best = (known.column(c).to_numpy() for c in ("pair", "count", "best"))
        order = np.argsort(pair)
        pair, count, best = pair[order], count[order], best[order].astype(np.int64)
        lists = held.column("pairs").to_pylist()
        asked = np.searchsorted(pair, np.frombuffer(b"".join(lists), kind).astype(np.int64))
        times = np.frombuffer(b"".join(held.column("times").to_pylist()), "<u4").astype(np.int64)
        cuts = np.append(0, np.cumsum([len(x) // np.dtype(kind).itemsize for x in lists])).astype(np.int64)
        sums = [np.append(0, np.cumsum(times * v[asked]))[cuts] if len(asked) else cuts for v in (best, count)]
        return pa.table({c: held.column(c) for c in names} | {"n_best": np.diff(sums[0]), "count_sum": np.diff(sums[1])})

    schema = ", ".join(f"`{c}` {groups.schema[c].dataType.simpleString()}" for c in names)
    return groups.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(look_up, f"{schema}, n_best long, count_sum long")
