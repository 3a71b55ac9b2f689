import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session", autouse=True)
def shared(spark, tmp_path_factory):
    """The workers find the package; scratch tables go to a folder of the test run."""
    from tidemark.llm.common import importable
    importable(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that the operators use themselves.
    *[T.StructField(c, T.StringType()) for c in ("id", "key", "n", "label", "score", "kept", "length", "path", "rank", "t", "_key")],
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang]) tuples, with extra columns of clashing names."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", None, *["x"] * 11) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows and ids."""
    return make_docs([
        (1, None, None), (2, ""), (3, " \t\n"), (4, "!!! ... ###"), (5, "a"), (6, LONG), (7, LONG), (None, "no id here at all"),
        (None, None, None), (8, "same row twice, word for word"), (8, "same row twice, word for word"), (9, "one id two texts"),
        (9, "one id, another text"), (10, "Same  row twice,\tword for word"), (11, "no id here at all"), (12, "\U0001F600 \U0001F600́ 日本語 テスト")])
