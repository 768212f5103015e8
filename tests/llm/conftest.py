import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

TEXT_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def frame(spark):
    """documents-like rows from (doc_id, text), with columns that operators use inside."""

    def make(rows, **more):
        base = [(i, t, more.get("lang"), more.get("source", "s"), None if t is None else len(t)) for i, t in rows]
        docs = spark.createDataFrame(base, TEXT_SCHEMA)
        return docs.withColumns({c: F.lit("clash") for c in ("fp", "node", "n_words", "key", "copy", "host", "words", "at")})

    return make


@pytest.fixture
def documents(spark, tiny):
    return spark.read.parquet(f"{tiny}/documents.parquet")


@pytest.fixture
def odd_rows():
    """Null and empty texts, null and repeated ids, repeated rows, one very long text."""
    long = " ".join(f"word{i % 977} and" for i in range(60_000))
    return [(1, None), (2, ""), (None, "some text here"), (None, None), (3, "twice"), (3, "twice"), (4, " \n\t "), (5, long), (5, long)]
