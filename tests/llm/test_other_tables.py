"""URL filter, embeddings, SQL texts of the queries, and the pipeline."""

import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldglean.llm import embeddings, queries, urls
from test_oracle import rows_of


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, duck, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, result.fetchall())


def test_urls_of_all_kinds(spark):
    rows = [(1, "http://A.Example.NET/en/x?casino"), (2, "https://b.net"), (3, "https://b.net/x"), (4, "x.org/fr/"), (5, None), (6, ""), (7, "ftp://Org/fr/a#spam"),
            (8, "http://free-deal.example/"), (9, "http://freedeal.example/"), (10, "http://free-free.example/"), (11, "http://mycasino.example/"), (12, "http://a.example.com/de/?q"),
            (13, "http://a://b/c"), (14, "http://notexample.com/de/"), (None, "http://pills.example/"), (15, "http://h?x=/de/"), (16, "http://CASINO.example")]
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "url as URL", "1 as host")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urls.filter_urls(pages).collect()}
    assert got == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"), 2: ("b.net", "", None, "allow"), 3: ("b.net", "/x", "net/", "block"), 4: ("", "", None, "allow"),
        5: ("", "", None, "allow"), 6: ("", "", None, "allow"), 7: ("org", "/fr/a", "org/fr/", "allow"), 8: ("free-deal.example", "/", None, "block"),
        9: ("freedeal.example", "/", None, "allow"), 10: ("free-free.example", "/", None, "allow"), 11: ("mycasino.example", "/", None, "allow"),
        12: ("a.example.com", "/de/", "example.com/de/", "block"), 13: ("a:", "//b/c", None, "allow"), 14: ("notexample.com", "/de/", None, "allow"),
        None: ("pills.example", "/", None, "block"), 15: ("h", "", None, "allow"), 16: ("casino.example", "", None, "block")}
    assert urls.filter_urls(pages.limit(0)).count() == 0
    assert urls.matcher({})("http://casino") == 0


def links_by_force(rows):
    unit = []
    for _, v in rows:
        good = v and all(x is not None and np.isfinite(x) for x in v) and any(v)
        unit.append(np.array(v, float) / np.linalg.norm(np.array(v, float)) if good else None)
    n, link = len(rows), {i: set() for i in range(len(rows))}
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.9:
                link[i].add(j)
                link[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for k in link[todo.pop()] - seen:
                seen.add(k)
                todo.append(k)
        least = min((rows[k][0] for k in seen if rows[k][0] is not None), default=None)
        out.append((rows[i][0], len(link[i]), least, rows[i][0] == least))
    return out


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)  # buckets in parts
    rng = np.random.default_rng(0)
    rows, centers = [], rng.normal(size=(12, 24))
    for i in range(400):
        rows.append((i, [float(x) for x in centers[i % 12] * rng.uniform(0.5, 2) + rng.normal(size=24) * rng.choice([0.02, 0.2, 0.3])]))
    rows += [(500 + i, rows[7][1]) for i in range(40)] + [(7, rows[7][1]), (None, rows[7][1]), (None, rows[8][1])]
    rows += [(600, None), (601, []), (602, [0.0] * 24), (603, [1.0, None]), (604, [float("nan")] * 24), (605, [float("inf")] * 24), (606, [1.0, 0.0]), (607, [2.0, 0.1]), (608, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as id", "2 as EMBEDDING", "3 as kept")
    got, want = sorted(map(tuple, embeddings.near_duplicates(vectors).collect()), key=str), sorted(links_by_force(rows), key=str)
    assert [r[0] for r in got] == [r[0] for r in want] and all(g[1] <= w[1] for g, w in zip(got, want))
    assert sum(g[1] for g in got) >= 0.98 * sum(w[1] for w in want)
    assert sum(g == w for g, w in zip(got, want)) >= 0.9 * len(want)
    assert embeddings.near_duplicates(vectors.limit(0)).count() == 0


@pytest.mark.parametrize("dim,n", [(64, 10_000), (64, 10 ** 8), (300, 10 ** 6)])
def test_recall_near_the_limit(dim, n):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, dim))
    x /= np.linalg.norm(x, axis=1)[:, None]
    r = rng.normal(size=x.shape)
    r -= (r * x).sum(1)[:, None] * x
    c = rng.uniform(0.9, 0.92, 400)[:, None]
    y = c * x + np.sqrt(1 - c * c) * r / np.linalg.norm(r, axis=1)[:, None]
    a, b = (embeddings.codes(v, *embeddings.plan(n, dim)) for v in (x, y))
    met = (a[:, :, 0] == b[:, :, 0]) | (a[:, :, :1] == b[:, :, 1:]).any(2) | (b[:, :, :1] == a[:, :, 1:]).any(2)
    assert met.any(1).mean() >= 0.95


def test_pipeline_stages(spark, sf_dir):
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.written(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "bpe":
            assert docs.columns == list(corpus_pipeline.COLUMNS)
            assert docs.exceptAll(before).count() == 0 or name == "mixing"
        if name == "exact_dedup":
            assert docs.count() == before.select("text").distinct().count()
            assert docs.join(before.groupBy("text").agg(F.max("doc_id").alias("m")), "text").where("doc_id <> m").count() == 0
        if name == "near_dedup":
            from fieldglean.llm import ngram_join
            assert docs.count() == ngram_join.jaccard_components(before).select("component_id").distinct().count()
        if name == "mixing":
            assert docs.groupBy("doc_id").count().where("count > 2").count() == 0
    assert docs.count() == before.count() and {"doc_id", "n_tokens", "ids"} <= set(docs.columns)


def test_pipeline_on_odd_and_empty_tables(spark, make_docs, tmp_path):
    rows = [(1, None, None, None), (2, "", "en", "a"), (3, "one two three", "en", "a"), (3, "one two three", "en", "a"), (4, "one two three", "en", None), (None, "one two", "en", "b")]
    for i, table in enumerate((rows, [])):
        columns = ["doc_id", "text", "lang", "source", "n_chars"]
        make_docs(table).select(*[F.col(f"`{c}`") for c in columns[2:]]).count()
        folder = str(tmp_path / str(i))
        spark.createDataFrame([(*r, 0) for r in table], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
        assert corpus_pipeline.run(spark, folder).columns[0] == "doc_id"


def test_no_local_checkpoints():
    root = os.path.dirname(os.path.abspath(queries.__file__))
    for path in glob.glob(f"{root}/*.py"):
        assert "localCheckpoint" not in open(path).read()
