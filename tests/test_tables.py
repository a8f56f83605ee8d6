"""Sources, sinks, keyed updates, row numbers, snapshots, profiling: fixtures and properties."""

import gzip
import random
import statistics

import numpy as np
import pytest

from pyspark.sql import functions as F

from fieldglean.operators import ordered, profile, relational, snapshots
from fieldglean.plans import listings, surface_area, titles
from fieldglean.rules.contacts import CONTACT_COLUMNS, MERGED_COLUMNS
from fieldglean.sources import readers, writers


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


# --- sources and sinks --------------------------------------------------------------------------

def test_titles_from_gzip(spark, tmp_path):
    body = "tconst\ttitleType\tprimaryTitle\toriginalTitle\tisAdult\tstartYear\tendYear\truntimeMinutes\tgenres\n"
    data = [("t1", "tvMiniSeries", '"Quoted"', "x", "0", "2000", "\\N", "45", "Drama,Comedy"), ("t2", "tvMiniSeries", "NA", "x", "\\N", "2022", "\\N", "abc", "Drama"),
            ("t3", "tvMiniSeries", "x", "x", "1", "1999", "\\N", "\\N", "Drama"), ("t4", "tvMiniSeries", "x", "x", "0", "2023", "\\N", "1", "Drama"),
            ("t5", "movie", "x", "x", "0", "2010", "\\N", "1", "Drama"), ("t6", "tvMiniSeries", "x", "x", "0", "2022", "\\N", "1", "\\N")]
    with gzip.open(tmp_path / "titles.tsv.gz", "wt") as f:
        f.write(body + "\n".join("\t".join(r) for r in data) + "\n")
    (tmp_path / "ratings.tsv").write_text("tconst\taverageRating\tnumVotes\nt1\t7.5\t10\nzz\t1\t1\n")
    t = titles.clean_titles(readers.read_delimited(spark, str(tmp_path / "titles.tsv.gz"), readers.TITLES_SCHEMA, partitions=2))
    df = titles.with_ratings(t, readers.read_delimited(spark, str(tmp_path / "ratings.tsv"), readers.RATINGS_SCHEMA))
    got = {r.tconst: r for r in df.collect()}
    assert len(got) == 6 and got["t1"].averageRating == 7.5 and got["t2"].averageRating is None
    assert got["t1"].primaryTitle == "Quoted" and got["t2"].primaryTitle is None
    assert (got["t1"].isAdult, got["t2"].isAdult, got["t3"].isAdult) == (False, True, True)
    assert got["t2"].runtimeMinutes is None and got["t1"].runtimeMinutes == 45.0
    assert rows(titles.per_year(df)) == [(2000, 1), (2022, 2)]
    assert rows(titles.top_genres(df)) == [("Drama", 2), ("Comedy", 1)]


def test_csv_folder_by_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text('fdd_name,phone,email\nd1,"5,55",a@example.com\nd1,,\n')
    (tmp_path / "b.csv").write_text("email,fdd_name,title\nb@example.com,d2,Boss\n")
    (tmp_path / "c.csv").write_text("fdd_name,phone,email\nd3,7,c@example.com\n")
    (tmp_path / "bad.csv").write_text("\n\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "note.txt").write_text("x")
    df, rejected = readers.read_csv_folder(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[-1] for r in rejected.collect()] == ["bad.csv"]
    assert {(r.fdd_name, r.phone, r.email, r.title) for r in df.collect()} == {
        ("d1", "5,55", "a@example.com", None), ("d1", None, None, None), ("d2", None, "b@example.com", "Boss"), ("d3", "7", "c@example.com", None)}
    numbered = readers.number_folder_rows(df, "id", offset=10)
    assert sorted(r.id for r in numbered.collect()) == [10, 11, 12, 13]
    by_file = {}
    for r in numbered.collect():
        by_file.setdefault(r.fdd_name, []).append(r.id)
    assert sorted(by_file["d1"]) == [10, 11] and by_file["d2"] == [12] and by_file["d3"] == [13]
    out = relational.reindex(numbered.fillna(""), ["id", *CONTACT_COLUMNS])
    assert out.columns == ["id", *CONTACT_COLUMNS]
    first = out.filter("id = 11").first()
    assert first.phone == "" and first.title == "" and first.city is None


def test_inventory_manifest_log_keys(spark, tmp_path):
    for n in ("a.pdf", "b.PDF", "c.txt"):
        (tmp_path / n).write_bytes(b"12345")
    inv = readers.file_inventory(spark, str(tmp_path))
    assert sorted(r.name for r in readers.of_type(inv, "pdf").collect()) == ["a.pdf", "b.PDF"]
    assert [r.length for r in readers.file_inventory(spark, str(tmp_path), "*.txt").collect()] == [5]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "manifest.csv").write_text("id,name\n1,a.pdf\n2,zz.pdf\n")
    man = readers.read_keys(spark, str(tmp_path / "m" / "manifest.csv"))
    assert [r.name for r in readers.from_manifest(inv, man).collect()] == ["a.pdf"]
    (tmp_path / "m" / "x.log").write_text("t - hello\nbare line\n")
    assert sorted(r.message for r in readers.read_log(spark, str(tmp_path / "m" / "x.log")).collect()) == ["hello", "re line"]
    p = spark.createDataFrame([(1, 200), (2, 299), (3, 404), (4, None)], "page_id int, status int")
    assert sorted(r.page_id for r in readers.web_pages(p, "status").collect()) == [1, 2]
    assert readers.web_pages(p).count() == 4
    d = readers.doc_pages(spark.createDataFrame([("d", 3, "x")], "f string, n bigint, t string"), "f", "n", "t")
    assert d.columns == ["doc", "page", "text"]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("Texas", "A, Inc", "x"), ("Texas", 'B "q"', "y"), ("New York", "C", "")], "state string, franchise string, result string")
    writers.write_csv(df, str(tmp_path / "c"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("*.csv")))
    assert '"A, Inc"' in text and '"B ""q"""' in text and "state,franchise,result" in text
    writers.write_by_state(df, str(tmp_path / "s"))
    writers.write_by_state(df.filter("state = 'Texas'"), str(tmp_path / "s"))
    back = spark.read.option("header", True).csv(str(tmp_path / "s"))
    assert {r.state: r["count"] for r in back.groupBy("state").count().collect()} == {"Texas": 4, "New York": 1}
    writers.write_by_outcome(df.withColumn("outcome", F.lit("done")), str(tmp_path / "o"))
    assert (tmp_path / "o" / "outcome=done").exists()
    writers.append_table(df, str(tmp_path / "t"))
    writers.append_table(df, str(tmp_path / "t"))
    assert readers.stored_table(spark, str(tmp_path / "t")).count() == 6
    path = writers.write_version(df, str(tmp_path / "v"), 1)
    assert spark.read.parquet(path).count() == 3
    with pytest.raises(Exception):
        writers.write_version(df, str(tmp_path / "v"), 1)


# --- relational ---------------------------------------------------------------------------------

def test_merge_columns_and_merged_file(spark):
    df = spark.createDataFrame([("a", None, "c", 1), (None, None, None, 2)], "Owner string, first_name string, Contact string, n int")
    got = relational.merge_matching_columns(df, "owner|first|contact", "owner_name")
    assert rows(got, "n") == [(1, "a c"), (2, "")]
    assert relational.merge_matching_columns(df, "owner", "o").columns == ["o", "first_name", "Contact", "n"]
    assert relational.merge_matching_columns(df, "zzz", "o").columns == df.columns
    assert len(MERGED_COLUMNS) == 16 and relational.reindex(df, MERGED_COLUMNS).columns == MERGED_COLUMNS


def test_number_rows_is_contiguous_with_nulls_and_hot_group(spark):
    data = [("hot", k * 3) for k in range(500)] + [(None, 5), (None, 9), ("z", 1)]
    random.shuffle(data)
    df = spark.createDataFrame(data, "g string, k bigint")
    got = relational.number_rows(df, ["g"], F.col("k"), 50, "id", offset=7)
    want = {(g, k): i + 7 for i, (g, k) in enumerate(sorted(data, key=lambda t: (t[0] is not None, t[0] or "", t[1])))}
    assert {(r.g, r.k): r.id for r in got.collect()} == want
    again = relational.number_rows(df, ["g"], F.col("k"), 50, "n", offset=1, restart=True)
    assert max(r.n for r in again.collect() if r.g == "hot") == 500 and {r.n for r in again.collect() if r.g is None} == {1, 2}


def test_batches_count_once(spark, tmp_path):
    """A repeated batch adds nothing, a killed one is not read, its repetition equals one write."""
    root = str(tmp_path / "sink")
    df = spark.createDataFrame([("Texas", "A, Inc", 1), ("Ohio", 'B "q"', 2)], "state string, franchise string, n int")
    assert writers.read_batches(spark, root) is None and writers.committed_batches(spark, root) == []
    assert writers.write_batch(df, root, "b1", ["state"]) and not writers.write_batch(df, root, "b1", ["state"])
    # A write that died after its rows and before its commit, with other rows than the repetition.
    df.limit(1).write.parquet(f"{root}/data/batch=b2/state=Utah")
    assert writers.read_batches(spark, root).count() == 2
    assert writers.write_batch(df.withColumn("n", F.col("n") + 10), root, "b2", ["state"])
    got = writers.read_batches(spark, root).select("batch", "state", "franchise", "n").collect()
    assert sorted(map(tuple, got)) == [("b1", "Ohio", 'B "q"', 2), ("b1", "Texas", "A, Inc", 1), ("b2", "Ohio", 'B "q"', 12), ("b2", "Texas", "A, Inc", 11)]
    for name in ("", "a/b", "a=b", "_x", "..", "é"):
        with pytest.raises(ValueError):
            writers.write_batch(df, root, name)
    for _ in range(2):
        writers.write_by_state(df, str(tmp_path / "states"), "run-1")
    back = writers.read_batches(spark, str(tmp_path / "states"), "csv")
    assert sorted((r.state, r.franchise) for r in back.collect()) == [("Ohio", 'B "q"'), ("Texas", "A, Inc")]
    pages = spark.createDataFrame([("a", 0, "900 sq. ft."), ("a", 1, None), ("b", 0, "100 sq. ft."), ("b", 1, "200 sq. ft."), ("b", 2, "x")], "doc string, page int, text string")
    writers.write_by_outcome(surface_area.surface_areas(pages, detail=True), str(tmp_path / "areas"))
    kept = {r.doc: r for r in spark.read.option("header", True).csv(str(tmp_path / "areas")).collect()}
    assert (kept["a"].outcome, kept["a"].pages, kept["a"].error) == ("error", "0 1", "no readable text on page 1")
    assert (kept["b"].outcome, kept["b"].pages, kept["b"].error) == ("done", "0 1", None)


def test_header_lookup_takes_all_titles(spark):
    cells = spark.createDataFrame([("t", 0, 0, "1987"), ("t", 0, 1, " 2031 "), ("t", 0, 2, " "), ("t", 1, 0, "5"), ("t", 1, 1, "6"), ("t", 1, 2, "7")],
                                  "t string, row_no int, col_no int, text string")
    assert sorted((r.title, r.text) for r in ordered.header_lookup(cells, ["t"]).collect()) == [("1987", "5"), ("2031", "6")]


def test_number_rows_of_sparse_keys(spark):
    """Keys all over 64 bits, of text and of both signs: as many rows in a range as with dense ones."""
    rng = random.Random(8)
    data = [(rng.choice(["a", "b", None]), rng.choice([-1, 1]) * 2 ** rng.uniform(0, 62.9)) for _ in range(4000)]
    data = list({(g, int(k)) for g, k in data})
    df = spark.createDataFrame(data, "g string, k bigint")
    order = lambda t: (t[0] is not None, t[0] or "", t[1])
    want = {t: i for i, t in enumerate(sorted(data, key=order))}
    assert {(r.g, r.k): r.n for r in relational.number_rows(df, ["g"], F.col("k"), 100, "n").collect()} == want
    assert {(r.g, r.k): r.n for r in relational.number_rows(df, ["g"], F.col("k"), 10 ** 9, "n").collect()} == want
    words = relational.number_rows(df, [], F.concat(F.coalesce("g", F.lit("")), F.lit("/"), F.col("k").cast("string")), 100, "n").collect()
    assert {(r.g, r.k): r.n for r in words} == {t: i for i, t in enumerate(sorted(data, key=lambda t: f"{t[0] or ''}/{t[1]}"))}
    tagged = df.select(F.struct("g", "k").alias("o"))
    bounds = relational.drawn_bounds(tagged, "o", 100)
    sizes = [r["count"] for r in tagged.groupBy(relational.range_of(F.col("o"), bounds)).count().collect()]
    assert 20 < len(sizes) < 80 and max(sizes) < 1000
    assert relational.number_rows(df.limit(0), ["g"], F.col("k"), 100, "n").count() == 0


def test_promote_header(spark):
    cells = [("t", 0, 0, "name"), ("t", 0, 1, "city"), ("t", 1, 0, "Ann"), ("t", 1, 1, "X"), ("t", 2, 1, "Y"), ("u", 0, 0, "city"), ("u", 1, 0, "Z")]
    df = spark.createDataFrame(cells, "t string, row_no int, col_no int, text string")
    assert rows(relational.promote_header(df, "t", ["name", "city"]), "t", "row_no") == [("t", 1, "Ann", "X"), ("t", 2, None, "Y"), ("u", 1, None, "Z")]


def test_update_and_flags(spark):
    base = spark.createDataFrame([("a",), ("b",), ("c",)], "franchise string")
    res = spark.createDataFrame([("a", "x", 1), ("a", None, 2), ("b", "y", 1)], "franchise string, email string, n int")
    got = relational.update_columns(base, res, "franchise", {"Contact Email": "email"}, "n", "")
    assert rows(got, "franchise") == [("a", None), ("b", "y"), ("c", "")]
    flags = spark.createDataFrame([("a", "No", "Yes"), ("b", "No", "Yes")], "filename string, has_contacts string, scrape_contacts string")
    out = relational.set_flags(flags, spark.createDataFrame([("a",), ("a",)], "filename string"), "filename", {"has_contacts": "Yes", "scrape_contacts": "No"})
    assert rows(out, "filename") == [("a", "Yes", "No"), ("b", "No", "Yes")]
    todo = relational.skip_processed(spark.createDataFrame([(x,) for x in "abcd"], "f string"), spark.createDataFrame(
        [("a", "Yes", "Yes"), ("b", "No", "No"), ("c", "Yes", "No")], "f string, has_contacts string, scrape_contacts string"), "f")
    assert rows(todo, "f") == [("c",), ("d",)]
    active, gone = relational.move_rows(spark.createDataFrame([(1, True), (2, False), (3, None)], "id int, bad boolean"),
                                        spark.createDataFrame([(9, True)], "id int, bad boolean"), F.col("bad"))
    assert sorted(r.id for r in active.collect()) == [2, 3] and sorted(r.id for r in gone.collect()) == [1, 9]
    assert rows(relational.shuffled(base, "franchise", "s")) == rows(relational.shuffled(base, "franchise", "s"))


# --- ordered ------------------------------------------------------------------------------------

def test_runs_have_no_gap_and_stop_at_first_miss(spark):
    rng = random.Random(3)
    data, want = [], {}
    for d in range(40):
        flags = [rng.random() < 0.7 for _ in range(rng.randint(1, 9))]
        data += [(d, i, f) for i, f in enumerate(flags)]
        if any(flags):
            start = flags.index(True)
            stop = next((i for i in range(start, len(flags)) if not flags[i]), len(flags))
            want[d] = (start, stop - 1)
    got = ordered.first_run(spark.createDataFrame(data, "doc int, page int, ok boolean"), "doc", "page", F.col("ok"))
    assert {r.doc: (r.from_page, r.to_page) for r in got.collect()} == want


def test_fill_forward_across_pieces(spark):
    rng = random.Random(4)
    data = [(k, i, rng.choice([None, None, rng.randint(1, 99)])) for k in "ab" for i in range(200)]
    df = spark.createDataFrame(data, "k string, i int, v int")
    got = {(r.k, r.i): r.f for r in ordered.fill_forward(df, ["k"], "i", F.col("v"), "f", [F.floor(F.col("i") / 7)]).collect()}
    last, want = {}, {}
    for k, i, v in data:
        last[k] = v if v is not None else last.get(k)
        want[k, i] = last[k]
    assert got == want


def test_method_rank_and_lookahead(spark):
    c = spark.createDataFrame([("d", 2, "regex"), ("d", 1, "table"), ("e", 2, "regex")], "doc string, rank int, m string")
    assert rows(ordered.first_method(c, ["doc"], "rank").select("doc", "m"), "doc") == [("d", "table"), ("e", "regex")]
    starts = spark.createDataFrame([("d", 3), ("d", 8), ("e", 1)], "doc string, page int")
    valid = spark.createDataFrame([("d", 9, "x"), ("d", 10, "y"), ("d", 6, "no"), ("e", 4, "no")], "doc string, page int, m string")
    assert rows(ordered.first_in_lookahead(starts, valid, "doc", "page").select("doc", "page", "start_page", "m")) == [("d", 9, 8, "x")]


# --- snapshots ----------------------------------------------------------------------------------

PAYLOAD = ["title", "price"]


def replay(runs):
    """Run after run by hand: list of versions per key and the on-sale flag of each."""
    store = []
    for run, batch in runs:
        for v in store:
            v["on_sale"] = False
        for key, payload in batch.items():
            mine = [v for v in store if v["key"] == key]
            if not mine or mine[-1]["payload"] != payload:
                store.append({"key": key, "run": run, "payload": payload, "on_sale": True, "no": len(mine) + 1})
            else:
                mine[-1]["on_sale"] = True
    return store


def make_runs(seed):
    rng = random.Random(seed)
    runs = []
    for run in range(1, 7):
        runs.append((run, {f"L{k}": (rng.choice("AB"), rng.choice([None, 1.5, 2.0])) for k in range(12) if rng.random() < 0.7}))
    return runs


def test_versions_replay_equals_runs_one_by_one(spark):
    runs = make_runs(1)
    want = replay(runs)
    flat = [(k, run, *p) for run, batch in runs for k, p in batch.items()]
    df = spark.createDataFrame(flat, "listing_number string, run int, title string, price double")
    got = snapshots.versions(df, "listing_number", "run", PAYLOAD)
    assert {(r.listing_number, r.run, r.version_no) for r in got.collect()} == {(v["key"], v["run"], v["no"]) for v in want}
    cur = {r.listing_number: (r.version_no, r.on_sale) for r in snapshots.current(df, "listing_number", "run", PAYLOAD).collect()}
    last = {v["key"]: (v["no"], v["on_sale"]) for v in want}
    assert cur == last
    store = None
    for run, batch in runs:
        rec = spark.createDataFrame([(k, *p, 0) for k, p in batch.items()], "listing_number string, title string, price double, page_id int")
        store = listings.load_run(store, rec, "bizquest", run, PAYLOAD)
        store = spark.createDataFrame(store.collect(), store.schema)
    assert {(r.listing_number, r.run, r.version_no, r.on_sale) for r in store.collect()} == {(v["key"], v["run"], v["no"], v["on_sale"]) for v in want}


def test_returning_value_makes_three_versions_and_no_reset_site(spark):
    df = spark.createDataFrame([("x", 1, "A"), ("x", 2, "B"), ("x", 3, "A"), ("x", 5, "A")], "k string, run int, title string")
    assert rows(snapshots.versions(df, "k", "run", ["title"]).select("run", "version_no"), "run") == [(1, 1), (2, 2), (3, 3)]
    one = spark.createDataFrame([("x", "A", 0)], "listing_number string, title string, page_id int")
    other = spark.createDataFrame([("y", "A", 0)], "listing_number string, title string, page_id int")
    for site, want in (("bizben", {"x": True, "y": True}), ("bizquest", {"x": False, "y": True})):
        store = listings.load_run(listings.load_run(None, one, site, 1, ["title"]), other, site, 2, ["title"])
        assert {r.listing_number: r.on_sale for r in store.collect()} == want


def test_checksum_tells_null_from_text(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "x")], "i int, t string").select(snapshots.checksum(["t"]).alias("c"))
    assert len({r.c for r in df.collect()}) == 3


def test_children_and_parent(spark):
    kids = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "parent_id int, title string")
    out = relational.replace_children(kids, spark.createDataFrame([(1,), (3,)], "parent_id int"), spark.createDataFrame([(3, "n")], "parent_id int, title string"), "parent_id")
    assert rows(out, "parent_id") == [(2, "c"), (3, "n")]
    got = listings.with_listing(spark.createDataFrame([("u", "Food")], "url string, category string"), spark.createDataFrame([("u", 5), ("v", 6)], "url string, price int"), "url")
    assert rows(got) == [("u", "Food", 5)]


# --- profiling ----------------------------------------------------------------------------------

@pytest.mark.parametrize("kind", ["ties", "skewed", "one", "few", "wide"])
def test_exact_quantiles(spark, kind):
    rng = random.Random(5)
    data = {"ties": [1.0] * 700 + [2.0] * 300, "skewed": [rng.paretovariate(0.3) for _ in range(3000)], "one": [4.0], "few": [3.0, 1.0],
            "wide": [rng.uniform(-1e9, 1e9) for _ in range(20000)]}[kind]
    df = spark.createDataFrame([(x,) for x in data] + [(None,)], "v double").repartition(5)
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    got = {r.prob: r.quantile for r in profile.exact_quantiles(df, ["v"], probs).collect()}
    for p in probs:
        assert got[p] == pytest.approx(float(np.quantile(data, p)), rel=1e-12), p
    # Few rows left to sort: many rounds, the same values.
    again = {r.prob: r.quantile for r in profile.exact_quantiles(df, ["v"], probs, most=5).collect()}
    assert again == got


def test_exact_quantiles_sort_few_rows(spark):
    """Of a million different values no more than a hundredth stands between the bounds of a quantile."""
    df = spark.range(1_000_000).select(F.exp(F.pmod(F.col("id") * 7919, F.lit(1_000_003)) / 50_000).alias("v"))
    total, found = profile._narrowed(df, ["v"], (0.25, 0.5, 0.999), profile._MOST)
    counts = df.agg(*[F.count_if(F.col("v").between(lo, hi)).alias(str(p)) for (_, p), (lo, hi) in found.items()]).first()
    assert total == {"v": 1_000_000} and max(counts) <= 10_000


def test_describe_empty_and_single(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    r = profile.describe(df, ["v"]).first()
    assert (r.cnt, r["mean"], r.q50) == (0, None, None)
    d = [1.0, 2.0, 4.0]
    r = profile.describe(spark.createDataFrame([(x,) for x in d], "v double"), ["v"]).first()
    assert r["std"] == pytest.approx(statistics.stdev(d)) and (r.q25, r.q50, r.q75) == (1.5, 2.0, 3.0)


def test_histogram(spark):
    data = [0.0, 0.1, 9.99, 10.0, 10.0, None]
    h = profile.histogram(spark.createDataFrame([(x,) for x in data], "v double"), "v", 50)
    got = {r.bin: r["count"] for r in h.collect()}
    assert len(got) == 50 and sum(got.values()) == 5 and got[49] == 3 and got[0] == 2
    flat = profile.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 5)
    assert {r.bin: r["count"] for r in flat.collect()} == {0: 2, 1: 0, 2: 0, 3: 0, 4: 0}


def test_null_reports(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(profile.null_counts(df), "column_name") == [("a", 1), ("b", 2)]
    assert rows(profile.table_info(df), "column_name") == [("a", "int", 1, 2), ("b", "string", 0, 2)]
    assert profile.all_null_columns(df, ["a", "b"]).first().all_null == 1


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,), (None,)], "x double")
    r = profile.describe(df, ["x"]).first()
    assert (r["cnt"], r["min"], r["max"], r["q50"]) == (3, 1.0, 4.0, 2.0) and abs(r["mean"] - 7 / 3) < 1e-12
    assert {b["bin"]: b["count"] for b in profile.histogram(df, "x", 3).collect()} == {0: 1, 1: 1, 2: 1}
    assert profile.null_counts(df).first()["nulls"] == 2


def test_broken_rows_are_listed_and_quoted_breaks_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,"two\nlines"\n5,6,7\n8\n')
    (tmp_path / "b.csv").write_text("x,y\n9,10\n")
    rows, rejected = readers.read_csv_folder(spark, str(tmp_path))
    assert sorted((r.x, r.y) for r in rows.collect()) == [("1", "two\nlines"), ("9", "10")]
    assert [r.path.rsplit("/", 1)[-1] for r in rejected.collect()] == ["a.csv"]
