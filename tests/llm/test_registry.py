import pytest

import __spark_entry__ as contract
import corpus_pipeline

from tests.oracle_check import compare, duck

SMALL = "/root/testdata/sf0.001"
WITH_SQL = [
    "op1_exact_dedup",
    "op2_exact_top_k",
    "op4_substring_dedup",
    "op5_minhash_near_dedup",
    "op6_license_scan",
    "op10_mixing",
    "op11_ranked_search",
    "op12_collocations",
    "op13_decontaminate",
]


@pytest.mark.parametrize("key", WITH_SQL)
def test_query_equals_sql(spark, key):
    assert compare(spark, duck(SMALL), key, contract.queries()[key], contract.oracle_sql()[key], SMALL).startswith("ok")


def test_one_query_for_each_operator():
    keys = contract.queries()
    assert all(sum(k.startswith(f"op{n}_") for k in keys) == 1 for n in range(1, 14))
    assert "pipeline" in keys


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= 3 * docs.count()
    final = corpus_pipeline.run(spark, SMALL)
    assert final.columns == ["doc_id", "lang", "source", "ids"]
    assert final.filter("ids is null").count() == 0
