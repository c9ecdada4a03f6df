import pytest

import corpus_pipeline
from check import difference
from ferry.llm.oracles import llm_oracles
from ferry.llm.queries import llm_queries

NUMBERS = range(1, 14)


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in llm_queries()] == [f"op{n}" for n in NUMBERS]
    assert set(llm_oracles()) <= set(llm_queries())


@pytest.mark.parametrize("name", sorted(llm_oracles()))
def test_query_equals_its_sql(spark, sf, duck, name):
    assert difference(llm_queries()[name](spark, sf), duck, llm_oracles()[name]) is None


def test_pipeline_stages_keep_the_columns(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = [docs.count()]
    start = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == start
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and kept[-1] > 0.8 * kept[0]
    last = corpus_pipeline.run(spark, sf)
    assert last.count() == kept[-1]
    assert last.where("round_trip").count() == kept[-1]
