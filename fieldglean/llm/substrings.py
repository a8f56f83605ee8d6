"""Substring dedup: suffix automata of reference shards, through which segments stream for their matching statistics."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglean.llm.common import batch_words, mix, pick, prepare, rolling, word_hashes, written
from fieldglean.session import parallelism

#: Words of a window, and of the anchors in it: every window has the same anchor wherever it occurs, its run of this many words
#: with the least hash. Words that one automaton holds, about.
WINDOW, ANCHOR = 50, 16
SHARD_WORDS = 150_000
_U = np.uint64
_WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` neighbours, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    return np.minimum(out[:len(out) - (width - have)], out[width - have:]) if have < width else out


def _runs(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of `width` words, put together from runs of half the length."""
    with np.errstate(over="ignore"):
        have, out, done = 1, words, None
        # Bits of the width from the least: the parts they stand for follow one another.
        covered = 0
        while True:
            if width & have:
                done = out if done is None else mix(done[:len(out) - covered] * _U(0xC2B2AE3D27D4EB4F) + out[covered:])
                covered += have
            if covered == width:
                return mix(done + _U(width))
            out = mix(out[:-have] * _U(0x9E3779B97F4A7C15) + out[have:])
            have *= 2


def segments(words: np.ndarray, bounds: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor, of several texts whose words follow one another (`bounds`: where each begins, and the end):
    the text, the anchor, a hash of all words of the run, the first window, the number of windows."""
    n = len(words) - window + 1
    if n <= 0:
        none = np.empty(0, np.int32)
        return none, words[:0], words[:0], none, none
    least = _least(_runs(words, anchor), window - anchor + 1)
    # Windows that lie in one text, and those of them that begin a run.
    steps = np.zeros(n + 1, np.int32)
    whole = np.diff(bounds) >= window
    np.add.at(steps, bounds[:-1][whole], 1)
    np.add.at(steps, bounds[1:][whole] - window + 1, -1)
    valid = np.cumsum(steps[:-1]) > 0
    begins = np.append(True, least[1:] != least[:-1])
    begins[bounds[:-1][whole]] = True
    edges = np.flatnonzero(begins | np.append(True, valid[1:] != valid[:-1]))
    counts = np.diff(np.append(edges, n))
    starts, counts = edges[valid[edges]], counts[valid[edges]]
    with np.errstate(over="ignore"):
        pairs = mix(rolling(words, 2) if len(words) > 1 else words)
        sums = np.append(_U(0), np.cumsum(pairs))
        ends = starts + counts + window - 2
        # Neighbouring pairs in a run, with their place relative to its first word.
        place = np.append(_U(0), np.cumsum(pairs * np.arange(1, len(pairs) + 1, dtype=_U)))
        content = mix((place[ends] - place[starts]) - (sums[ends] - sums[starts]) * starts.astype(_U)) + mix(words[starts]) + mix(counts.astype(_U))
    text = np.searchsorted(bounds, starts, "right") - 1
    return text.astype(np.int32), least[starts], content, (starts - bounds[text]).astype(np.int32), counts.astype(np.int32)


class Automaton:
    """The suffix automaton of several sequences. `earliest` of a state: the smallest document that holds its sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.size, self.earliest = [-1], [0], [None]

    def _add(self, size: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.size.append(size)
        self.link.append(link)
        self.earliest.append(None)
        return len(self.size) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """The part of `target` that is reached by one more word than `state` holds, as a state of its own."""
        part = self._add(self.size[state] + 1, dict(self.next[target]), self.link[target])
        self.link[target] = part
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = part
            state = self.link[state]
        return part

    def add(self, words: list[int], document: int) -> None:
        moves, link, size, earliest = self.next, self.link, self.size, self.earliest
        last = 0
        for word in words:
            target = moves[last].get(word)
            if target is not None:
                last = target if size[target] == size[last] + 1 else self._split(last, word, target)
            else:
                new, state = self._add(size[last] + 1, {}, 0), last
                while state >= 0 and word not in moves[state]:
                    moves[state][word] = new
                    state = link[state]
                if state >= 0:
                    target = moves[state][word]
                    link[new] = target if size[target] == size[state] + 1 else self._split(state, word, target)
                last = new
            before = earliest[last]
            if before is None or document < before:
                earliest[last] = document

    def settle(self) -> None:
        """Hand each state's earliest document to the states of its suffixes."""
        for state in sorted(range(1, len(self.size)), key=self.size.__getitem__, reverse=True):
            up, own = self.link[state], self.earliest[state]
            if up > 0 and own is not None and (self.earliest[up] is None or own < self.earliest[up]):
                self.earliest[up] = own

    def first_documents(self, words: list[int], window: int) -> list[int | None]:
        """Stream a sequence through: for each window, the smallest document that holds it, or None. The state always stands for the
        longest suffix read that the references hold, cut to the window."""
        moves, link, size, earliest = self.next, self.link, self.size, self.earliest
        out, state, matched = [], 0, 0
        for i, word in enumerate(words, 1 - window):
            target = moves[state].get(word)
            while target is None and state:
                state = link[state]
                matched = size[state]
                target = moves[state].get(word)
            if target is not None:
                state = target
                if matched < window:
                    matched += 1
                # A state stands for lengths above its link's size: step up once the cut length falls to it.
                up = link[state]
                while up > 0 and size[up] >= matched:
                    state, up = up, link[up]
            if i >= 0:
                out.append(earliest[state] if matched == window else None)
        return out


def _fetch(rows: DataFrame, wanted: DataFrame, window: int, split: bool) -> DataFrame:
    """The words of wanted segments: `wanted(doc, rid, want array<struct<anchor, content, start, n>>)` joined to the texts. With `split`,
    a row per document and distinct window, whose anchor and content are the window's own hash; `more` lists its further places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, rid, text, want in zip(*[c.to_pylist() for c in batch.columns]):
                words = word_hashes(text)
                if split:
                    whole = rolling(words, window).view(np.int64)
                    places: dict[int, list[int]] = {}
                    for w in want:
                        for a in range(w["start"], w["start"] + w["n"]):
                            places.setdefault(int(whole[a]), []).append(a)
                    made = [(h, h, at[0], 1, at[1:]) for h, at in places.items()]
                else:
                    made = [(w["anchor"], w["content"], w["start"], w["n"], words[w["start"]:w["start"] + w["n"] + window - 1].tobytes()) for w in want]
                anchors, contents, starts, counts, last = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchors, pa.int64()), pa.array(contents, pa.int64()), pa.array([doc] * len(made), pa.int64()), pa.array([rid] * len(made), pa.int32()),
                     pa.array(starts, pa.int32()), pa.array(counts, pa.int32()), pa.array(last, pa.list_(pa.int32()) if split else pa.binary())],
                    ["anchor", "content", "doc", "rid", "start", "n", "more" if split else "words"])

    joined = rows.join(wanted, ["doc", "rid"]).select("doc", "rid", "t", "want")
    return joined.mapInArrow(run, "anchor long, content long, doc long, rid int, start int, n int, " + ("more array<int>" if split else "words binary"))


def _by_document(found: DataFrame) -> DataFrame:
    return found.groupBy("doc", "rid").agg(F.collect_list(F.struct("anchor", "content", "start", "n")).alias("want"))


def _shared(found: DataFrame) -> DataFrame:
    """Segments whose anchor at least two documents hold."""
    plural = found.groupBy("anchor").agg(F.min("doc").alias("a"), F.max("doc").alias("b")).where("a < b").select("anchor")
    return found.join(plural, "anchor", "left_semi")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR, key: str = "doc_id", text: str = "text",
                   shard_words: int = SHARD_WORDS, outputs: tuple[str, ...] = ("n_words", "n_removed", "kept_sha256")) -> DataFrame:
    """Per row: key and the asked outputs (n_words, n_removed, kept_sha256, kept_text).

    Words are runs of anything but ASCII white space. A word goes if a run of `window` words that covers it also starts in a document
    with a smaller key; runs are judged on the input. Null texts have no words. A row with a null key loses nothing and takes
    nothing; rows that repeat a key are judged each on its own text and take nothing from one another. An empty table gives
    an empty result; other columns are not looked at.

    Only segments whose anchor occurs in two documents take part, each distinct one once, with its smallest document. They are dealt to
    shards by anchor, so all occurrences of a window meet in one shard. A shard's automaton is made in the task that streams
    the shard's segments through it: references grow with the corpus, so sending each automaton to all tasks would be
    quadratic. The windows of an anchor whose segments alone would overfill a shard are dealt by their own hash instead.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = pick(docs, key, text).select(F.col(key).cast("long").alias("doc"), F.hash(text).alias("rid"),
                                        F.coalesce(F.col(text), F.lit("")).cast("binary").alias("t"))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, bounds = batch_words(batch.column(2).to_pylist())
            at, a, c, starts, n = segments(words, bounds, window, anchor)
            at = pa.array(at)
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(c.view(np.int64)), batch.column(0).take(at), batch.column(1).take(at),
                                              pa.array(starts), pa.array(n)], ["anchor", "content", "doc", "rid", "start", "n"])

    fields = "anchor long, content long, doc long, rid int, start int, n int"
    found = rows.where("doc is not null").mapInArrow(scan, fields)
    found = written(_shared(found).withColumn("more", F.array().cast("array<int>")), "substring-segments")
    contents = found.groupBy("anchor", "content").agg(F.max("n").alias("n")).groupBy("anchor").agg(F.sum(F.col("n") + window - 1).alias("size"))
    many = written(contents.where(F.col("size") > shard_words).select("anchor"), "substring-wide")
    if not many.isEmpty():
        apart = written(_fetch(rows, _by_document(found.join(many, "anchor", "left_semi")), window, True), "substring-windows")
        found = written(found.join(many, "anchor", "left_anti").unionByName(_shared(apart)), "substring-segments")
    distinct = written(found.groupBy("anchor", "content").agg(F.min(F.struct("doc", "rid", "start", "n")).alias("s")).select(
        "anchor", "content", "s.*"), "substring-distinct")
    total = distinct.agg(F.sum(F.col("n") + window - 1)).first()[0] or 0
    shards = max(parallelism(spark), -(-total // shard_words))

    def match(group: pa.Table) -> pa.Table:
        cut = np.frombuffer(b"".join(group.column("words").to_pylist()), np.int64)
        ids = np.unique(cut, return_inverse=True)[1].tolist()
        sizes = [n + window - 1 for n in group.column("n").to_pylist()]
        ends = np.cumsum([0, *sizes]).tolist()
        references = Automaton()
        for a, b, doc in zip(ends, ends[1:], group.column("doc").to_pylist()):
            references.add(ids[a:b], doc)
        references.settle()
        first = [references.first_documents(ids[a:b], window) for a, b in zip(ends, ends[1:])]
        return pa.table({"anchor": group.column("anchor"), "content": group.column("content"), "first": pa.array(first, pa.list_(pa.int64()))})

    words = _fetch(rows, _by_document(distinct), window, False).withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    told = words.groupBy("shard").applyInArrow(match, "anchor long, content long, first array<long>")
    # Windows of a segment that start in a smaller document, as places in the text.
    starts = F.concat(F.array("start"), "more")
    gone = found.join(told, ["anchor", "content"]).select("doc", "rid", F.flatten(F.transform(starts, lambda s: F.filter(F.transform(
        "first", lambda x, i: F.when(x < F.col("doc"), s + i)), lambda x: x.isNotNull()))).alias("gone")).where(F.size("gone") > 0)
    gone = gone.groupBy("doc", "rid").agg(F.flatten(F.collect_list("gone")).alias("gone"))
    kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {c: [] for c in outputs}
            for value, places in zip(batch.column(1), batch.column(2)):
                words = _WORDS.findall(value.as_py())
                kept = words
                if places.is_valid:
                    steps = np.zeros(len(words) + 1, np.int32)
                    at = np.unique(places.values.to_numpy())
                    np.add.at(steps, at, 1)
                    np.add.at(steps, at + window, -1)
                    kept = [words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)]
                joined = b" ".join(kept)
                made = {"n_words": len(words), "n_removed": len(words) - len(kept), "kept_sha256": hashlib.sha256(joined).hexdigest(),
                        "kept_text": joined.decode("utf-8", "replace")}
                for c in outputs:
                    out[c].append(made[c])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(out[c], kinds[c]) for c in outputs]], ["doc", *outputs])

    types = {"n_words": "long", "n_removed": "long", "kept_sha256": "string", "kept_text": "string"}
    both = rows.join(gone, ["doc", "rid"], "left").select("doc", "t", "gone")
    out = both.mapInArrow(cut, "doc long, " + ", ".join(f"{c} {types[c]}" for c in outputs))
    return out.select(F.col("doc").alias(key), *outputs)
