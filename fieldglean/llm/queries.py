"""The registered queries of the operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglean.llm import alignment, bpe, conversations, dedup, embeddings, language, main_text, mixing, ngram_join, pii, secrets, substrings, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"


@query("op1_ngram_join")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op2_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.tokenize(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN,
                        ("n_tokens", "ids_sha256", "decoded_sha256"))


@query("op3_exact_dedup", """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, coalesce(doc_id = keep_id, keep_id IS NULL) AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
""")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op4_mix", rf"""
WITH d AS (
  SELECT doc_id, source, {_WORDS}::BIGINT AS size, length(coalesce(text, '')) AS n,
    length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[A-Za-z]+', '', 'g')) AS letters,
    (('0x' || substr(md5(doc_id::VARCHAR), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u FROM documents),
k AS (SELECT *, -ln(u) / CASE WHEN n > 0 THEN 0.5 + letters::DOUBLE / n ELSE 1.0 END AS e FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
        [3.0::DOUBLE, 1.0, 2.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source),
r AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / w AS ratio FROM s),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY ratio, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
x AS (SELECT (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, level LIMIT 1) AS x),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0.0 ELSE coalesce(least(cap, x * w), cap) END::DOUBLE AS target FROM l, x),
f AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
o AS (SELECT k.doc_id, k.size, f.source_size, f.target, f.whole, f.target - f.whole * f.source_size AS rest,
        sum(k.size) OVER (PARTITION BY k.source ORDER BY k.e, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size / 2 AS middle
      FROM k JOIN f ON k.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, size, source_size, target, (size * least(2, whole + CASE WHEN middle <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM o
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def _urls_sql() -> str:
    low = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    hit = " + ".join(f"{weight} * regexp_matches(u, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')::INT"
                     for terms, weight in ((urls.STRICT, urls.STRICT_WEIGHT), (urls.SOFT, urls.SOFT_WEIGHT)) for term in terms)
    rules = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    fit = [(f"(host = '{h}' OR host LIKE '%.{h}') AND path LIKE '{p}%'", h + p, v) for v, h, p in rules]
    return f"""
WITH r AS (SELECT page_id, {low} AS u, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT *, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM r),
p AS (SELECT *, regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path, {hit} AS weight FROM h)
SELECT page_id, host, path, CASE {" ".join(f"WHEN {c} THEN '{n}'" for c, n, _ in fit)} END AS rule, weight,
  CASE {" ".join(f"WHEN {c} THEN '{v}'" for c, _, v in fit)} WHEN weight >= {urls.REJECT} THEN 'block' ELSE 'allow' END AS verdict FROM p
"""


@query("op9_url_filter", _urls_sql())
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages"))


@query("op6_secrets")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    spans = secrets.scan(docs, secrets.train(secrets.labelled_samples(docs)))
    return spans.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.listed(F.array_sort(F.concat("base_spans", "random_spans"))).alias("spans"))


@query("op10_language")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(~language.held_out("doc_id")))
    told = language.predict(docs, model)
    return told.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query("op5_embedding_dedup")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.scan(docs, pii.train(*pii.training_windows(docs)))
    model = F.transform("model_spans", lambda s: F.struct(F.concat(F.lit("model_"), s["kind"]).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", *[f"n_{k}" for k in pii.KINDS], F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.listed(F.concat("base_spans", model)).alias("spans"))


@query("op7_substring_dedup", r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(words) - 48)) AS i, words FROM w WHERE len(words) >= 50),
h AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS win FROM p),
f AS (SELECT win, min(doc_id) AS least FROM h GROUP BY win HAVING min(doc_id) < max(doc_id)),
g AS (SELECT h.doc_id, unnest(range(h.i, h.i + 50)) AS i FROM h JOIN f ON h.win = f.win AND f.least < h.doc_id),
r AS (SELECT doc_id, list(DISTINCT i) AS gone FROM g GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN words ELSE [words[k] FOR k IN range(1, len(words) + 1) IF NOT list_contains(gone, k)] END, ' '))
  AS kept_sha256 FROM w LEFT JOIN r USING (doc_id)
""")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


@query("op11_conversation_repair")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


@query("op12_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    a, b = (bpe.read_ranks(public_tokenizers.path(f)) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), a, b)


@query("op13_main_text")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))
