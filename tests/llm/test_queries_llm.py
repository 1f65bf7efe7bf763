import pytest
from tests.conftest import DATA, assert_same

from orrery.llm.oracle import ORACLE_SQL
from orrery.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, duck, name):
    assert_same(QUERIES[name](spark, DATA), ORACLE_SQL[name], duck)


def test_every_operator_has_a_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op2_language_id", "op7_sentencepiece", "op8_quality", "op9_toxicity", "op10_pii", "op12_periodic_runs", "op13_token_counts"])
def test_one_row_a_document(spark, name):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = QUERIES[name](spark, DATA)
    assert sorted(r["doc_id"] for r in out.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_leaked_passages_are_found(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    items = {r["item_id"]: r["text"] for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()}
    planted = {(i, k) for i, t in docs.items() for k, x in items.items() if t and x in t}
    found = {(r["doc_id"], r["item_id"]) for r in QUERIES["op6_decontaminate"](spark, DATA).collect()}
    assert planted <= found
