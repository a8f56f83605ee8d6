"""The stages of the pipeline against plain Python, row by row with multiplicity."""

import hashlib
import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from test_text_operators import WORD, shingles

import corpus_pipeline
from fieldglean.llm import language

#: Ids that repeat with the same and with other texts, null ids, texts without words, components of null ids only.
LONG = [" ".join(f"{w}{i}" for i in range(30)) for w in ("alpha", "beta", "gamma")]
ODD_ROWS = [(1, None, None, None), (2, "", "en", "a"), (None, "", "en", "a"), (3, "one two three", "en", "a"), (3, "one two three", "en", "a"),
            (3, "one two three", "en", "b"), (3, "four five six", "en", "a"), (None, "one two", "en", "b"), (None, "one two", "en", "b"),
            (None, LONG[0], "en", "a"), (None, LONG[0] + " end", "en", "a"), (7, LONG[1], "en", "a"), (None, LONG[1] + " end", "en", "b"),
            (9, LONG[1] + " last", "en", None), (9, LONG[2], "en", None), (9, LONG[2] + " end", "en", None), (None, None, "en", "c"),
            (None, " \n ", "en", "c"), (2, " \n ", "en", "c"), (2, " \n ", "en", "c"), (None, LONG[2] + " end", "en", "c")]


def language_by_force(rows, model):
    told = [model.judge(r[1] or "") for r in rows]
    return [r for r, (lang, score) in zip(rows, told) if lang != language.UNKNOWN and score >= corpus_pipeline.LEAST_SCORE]


def copies_by_force(rows):
    best = {}
    for r in rows:
        old = best.get(r[1] or "")
        if old is None or (r[0] is not None, r[0] or 0) >= (old[0] is not None, old[0] or 0):
            best[r[1] or ""] = r
    return list(best.values())


def near_by_force(rows):
    sets, group = [shingles(r[1]) for r in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= 75 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    return [min((rows[i] for i in range(len(rows)) if group[i] == g), key=lambda r: (r[0] is None, r[0] or 0)) for g in sorted(set(group))]


def mix_by_force(rows, weights=(3, 1, 2)):
    size = [len(WORD.findall(r[1] or "")) for r in rows]
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for n, r in zip(size, rows) if r[3] == s) for s in sources}
    open_, left, target = {s: weights[i % 3] for i, s in enumerate(sources)}, 1.5 * sum(total.values()), {}
    while open_:
        share = left / sum(open_.values())
        full = [s for s in open_ if 2 * total[s] < share * open_[s]]
        for s in full or list(open_):
            target[s] = 2 * total[s] if full else share * open_[s]
        left -= sum(target[s] for s in full)
        open_ = {s: w for s, w in open_.items() if s not in target}
    out = []
    for s in sources:
        def turn(i):
            key, text = "" if rows[i][0] is None else str(rows[i][0]), rows[i][1] or ""
            u = (int(hashlib.md5(key.encode()).hexdigest()[:13], 16) + 0.5) / 2**52
            quality = 0.5 + len(re.findall("[A-Za-z]", text)) / len(text) if text else 1.0
            return -math.log(u) / quality, rows[i][0] is not None, rows[i][0] or 0, i
        whole = math.floor(target[s] / total[s]) if total[s] else 0
        before = 0
        for i in sorted((i for i in range(len(rows)) if rows[i][3] == s), key=turn):
            before += size[i]
            out += [rows[i]] * min(2, whole + (before - size[i] / 2 <= target[s] - whole * total[s]))
    return out


def counted(df):
    return Counter(tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect())


@pytest.fixture(scope="module", params=["file", "table"])
def odd_rows(request, make_docs, tmp_path_factory):
    """The odd rows as a Parquet file and as a table that is none, with columns that clash in name."""
    docs = make_docs(ODD_ROWS).coalesce(1)
    if request.param == "table":
        return docs
    path = str(tmp_path_factory.mktemp("odd") / "documents.parquet")
    corpus_pipeline.pick(docs, *corpus_pipeline.COLUMNS).write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def test_copies_and_near_copies_of_odd_rows(spark, odd_rows):
    assert counted(corpus_pipeline.drop_copies(spark, odd_rows, "")) == Counter(copies_by_force(ODD_ROWS))
    assert counted(corpus_pipeline.drop_near_copies(spark, odd_rows, "")) == Counter(near_by_force(ODD_ROWS))


def test_mix_of_odd_rows(spark, odd_rows):
    assert counted(corpus_pipeline.mix_sources(spark, odd_rows, "")) == Counter(mix_by_force(ODD_ROWS))


def test_language_judges_each_row_of_an_id(spark, make_docs):
    learned = [(i, "the cat and the dog went out to the house", "en", "a") for i in range(40)]
    rows = learned + [(50, "the cat and the dog", "en", "a"), (50, "12 34", "en", "a"), (None, "the dog went out", "en", "a"), (None, "", "en", "a")]
    docs = make_docs(rows)
    model = language.train(corpus_pipeline.numbered(docs).where(~language.held_out("doc_id")))
    got = counted(corpus_pipeline.identify_language(spark, docs, ""))
    assert got == Counter(language_by_force(rows, model)) == Counter([*learned, rows[-4], rows[-2]])


def test_rows_of_a_path_given_twice_are_told_apart(spark, make_docs, tmp_path):
    path = str(tmp_path / "documents.parquet")
    corpus_pipeline.pick(make_docs(ODD_ROWS), *corpus_pipeline.COLUMNS).write.parquet(path)
    for docs in (spark.read.parquet(path), spark.read.parquet(path, path), spark.read.parquet(path).union(spark.read.parquet(path))):
        rows = corpus_pipeline.numbered(docs)
        assert rows.count() == docs.count() == rows.select("row").distinct().count()


@pytest.mark.parametrize("unlearned", ["fr", "en"])
def test_an_unlearned_language_is_rejected(spark, sf_dir, unlearned):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shown = docs.withColumn("lang", F.when(F.col("lang") != unlearned, F.col("lang")))
    got = corpus_pipeline.identify_language(spark, shown, sf_dir)
    assert counted(got) == counted(shown.where("lang is not null")) and got.count() < docs.count()


def test_stages_on_the_small_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text", "lang", "source").collect()]
    model = language.train(docs.where(~language.held_out("doc_id")))
    forced = {"language_id": lambda r: language_by_force(r, model), "exact_dedup": copies_by_force, "near_dedup": near_by_force, "mixing": mix_by_force}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.written(stage(spark, docs, sf_dir), f"small-{name}")
        want = Counter(forced[name](rows))
        assert counted(docs) == want, name
        rows = list(want.elements())
    # Bytes of all languages must come back: the digests of the tokens' bytes are those of the texts.
    ids = Counter((r["doc_id"], r["decoded_sha256"]) for r in corpus_pipeline.encode(spark, docs, sf_dir).select("doc_id", "decoded_sha256").collect())
    assert ids == Counter((r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows)
