import pytest
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"

TEXTS = [
    None, "", " ", "\n\n", "a", "One two", "one TWO", "x  y", " lead", "trail ", "tab\tand \n mix", "a b  c",
    "mail me@example.com, or me@@a.b@c.d.e then x@y z@w.v.", "1.2.3.4.5 256.1.1.1 001.02.3.255 9.9.9", "+1 (555) 010-2233 +12 +1234567890123456 ++49 30 1234567",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 3782 822463 10005", "École 10@é.com café@a-b.co \U0001F600 1.1.1.1", "<|endoftext|> is text",
    "the same line here\nthe same line here\nanother line\n", "repeat " * 3000, "a b c d e f g h " * 9, "Wort " * 40 + "äöü",
    "### $$$ %% & | <b> *x*", "it's we'll I'd 3rd 2nd x1y2 ½ ²",
]


@pytest.fixture(scope="session")
def edge(spark):
    """Null, empty and odd texts, repeated rows, a repeated id, one very long
    text, a null id, and extra columns whose names clash with results."""
    rows = [(k, t, "en", "s", None, "kept", 7) for k, t in enumerate(TEXTS)]
    rows += [(900, "same text twice over", "en", "s", 3, None, 1)] * 2
    rows += [(901, "first text of a repeated id", None, None, None, None, None), (901, "second text of a repeated id", None, None, None, None, None)]
    rows += [(902, "long tail of words " * 30_000, "en", "s", 1, "x", 2), (None, "no id here", "en", "s", 1, "x", 2)]
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                           T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("kept", T.StringType()),
                           T.StructField("shard", T.IntegerType())])
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty(edge):
    return edge.where("1 = 0")


@pytest.fixture(scope="session")
def both(documents, edge):
    """The test table and the odd rows together."""
    return documents.unionByName(edge.selectExpr("doc_id + 1000000 doc_id", "text", "lang", "source", "n_chars"))
