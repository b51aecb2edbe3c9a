"""The pipeline against the plain sequence of its decisions, and the registered queries."""

import __spark_entry__ as registered
import corpus_pipeline
import pytest
from compare import connect, oracle_result, spark_result, type_differences
from odd_rows import ODD
from tidemark.llm import decontam, jaccard, quality
from tidemark.llm.queries import ORACLES, QUERIES


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(registered.queries())
    assert set(ORACLES) <= set(registered.oracle_sql())
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    duck, df = connect(sf_dir), QUERIES[name](spark, sf_dir)
    assert spark_result(df) == oracle_result(duck, ORACLES[name])
    assert type_differences(df, duck, ORACLES[name]) == []


def test_native_sharding_runs_no_python(spark, sf_dir):
    from helpers import plan

    text = plan(QUERIES["op5_sharding"](spark, sf_dir))
    assert "Python" not in text and "Arrow" not in text and "Pandas" not in text


def test_stages_take_effect_in_order(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r["doc_id"] for r in quality.quality_rules(docs).filter("kept").collect()}
    first = {r["doc_id"] for r in jaccard.jaccard_components(docs.filter(docs.doc_id.isin(list(kept)))).filter("component_id = doc_id").collect()}
    left = docs.filter(docs.doc_id.isin(list(first)))
    leaks = {r["doc_id"] for r in decontam.contaminated(left, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == first - leaks and len(rows) == len(first - leaks)
    assert 0 < len(rows) < docs.count()


def test_every_stage_returns_the_columns_of_documents(spark, sf_dir, odd, nothing):
    for docs in (odd, nothing):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, sf_dir)
            assert out.columns == docs.columns and out.count() <= len(ODD), name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() == docs.count()
