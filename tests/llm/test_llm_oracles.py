import pytest
from compare import compare

from tokenmill.llm.oracles import ORACLES
from tokenmill.llm.queries import QUERIES


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, tiny, name):
    assert compare(spark, tiny, name, QUERIES[name], ORACLES[name]) == ""


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_other_queries_give_every_document(spark, tiny, name):
    rows = QUERIES[name](spark, tiny).select("doc_id").collect()
    want = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id").collect()
    assert sorted(rows) == sorted(want)
