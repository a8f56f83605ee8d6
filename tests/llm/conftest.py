import pytest

from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text, lang, source) with columns beside them that clash in case and in name."""
    def make(rows):
        df = spark.createDataFrame([(i, t, lang, s, None if t is None else len(t)) for i, t, lang, s in rows], DOCS)
        names = [*df.columns, "TEXT", "Doc_Id", "kept", "n_words", "size", "t", "ids"]
        return df.selectExpr(*df.columns, *["cast(null as string)"] * 7).toDF(*names)
    return make


@pytest.fixture(scope="session")
def texts(spark, sf_dir):
    """The documents of the small tables as (doc_id, text)."""
    return [(r[0], r[1]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
