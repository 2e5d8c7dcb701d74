import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """documents from (doc_id, text) pairs, with extra columns whose names
    clash with what the operators return."""
    def make(pairs):
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in pairs]
        extra = {c: "lit" for c in ("n_tokens", "score", "spans", "component_id", "start", "kept", "tie", "shard")}
        from pyspark.sql import functions as F
        return spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(v) for c, v in extra.items()})
    return make


@pytest.fixture(scope="session")
def odd_texts():
    return [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (4, "one"), (None, "null id"), (5, "a" * 70000),
            (6, "word 12 " * 30000), (7, "naïve  café x y 日本語 👩‍👩‍👧 it's we'll"), (8, "x\n\n\ny   z\r\n"),
            (9, "<|endoftext|> <|startoftext|>"), (10, "one")]
