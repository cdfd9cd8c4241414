"""Numbered queries that have a DuckDB statement, and the pipeline."""

import pytest
from compare import connect, differences

import corpus_pipeline
from tidemark.llm import decontamination, order_minhash, queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_statement(spark, sf_dir, name):
    assert differences(queries.QUERIES[name](spark, sf_dir), connect(sf_dir), queries.ORACLES[name]) == []


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = {r.doc_id: r.text for r in docs.collect()}
    out = corpus_pipeline.run(spark, sf_dir)
    assert set(docs.columns) <= set(out.columns) and {"ids", "begins", "ends", "decoded"} <= set(out.columns)
    rows = out.collect()
    kept = {r.doc_id for r in rows}
    # one document of each class, unless another stage took it; no document of another's class
    classes = {r.doc_id: r.class_id for r in order_minhash.classes(docs).collect()}
    assert all(classes[d] == d for d in kept)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontamination.decontaminate(out.select("doc_id", "text"), benchmark).filter("n_hit > 0").count() == 0
    hit = {r.doc_id for r in decontamination.decontaminate(docs.select("doc_id", "text"), benchmark).filter("n_hit > 0").collect()}
    lost = {d for d, c in classes.items() if c == d} - kept - hit
    assert len(lost) <= 0.01 * len(want)
    assert all(r.n_chars == len(r.text) and r.decoded == r.text for r in rows)
    unchanged = sum(r.text == want[r.doc_id] for r in rows)
    assert unchanged >= 0.8 * len(rows)


def test_pipeline_is_registered(spark):
    import __spark_entry__ as e

    assert [n for n, _ in corpus_pipeline.STAGES] and "pipeline" in e.queries() and "pipeline" not in e.oracle_sql()
    assert {f"op{n}_" for n in range(1, 14)} == {f"{q.split('_')[0]}_" for q in queries.QUERIES}
