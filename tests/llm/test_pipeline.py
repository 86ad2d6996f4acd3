import os

import pytest

import check
import corpus_pipeline
from meterflow.llm.queries import ORACLE, QUERIES

from .conftest import SCHEMA

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables here")


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    same, ours, theirs, note = check.compare(spark, check.tables(SMALL), name, SMALL)
    assert same, (ours, theirs, note)


@needs_tables
def test_one_query_per_operator(spark):
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES)
    assert numbers == list(range(1, 14))


@needs_tables
def test_stages_against_plain_python(spark):
    """Each stage's rows follow from its own input by the rule of its operator."""
    from .test_simhash import brute_print, brute_roots

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    inputs, columns = {}, docs.columns
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs.collect()
        docs = stage(spark, docs, SMALL)
        if name != "bpe":
            assert docs.columns == columns
    result = docs.collect()
    assert set(inputs["exact_dedup"]) <= set(inputs["toxicity"])
    best = {}
    for row in inputs["exact_dedup"]:
        key = row.text.encode().lower()
        best[key] = max(best.get(key, row), row, key=lambda r: r.doc_id)
    assert set(inputs["near_dedup"]) == set(best.values())
    rows = sorted(inputs["near_dedup"], key=lambda r: r.doc_id)
    roots = brute_roots([brute_print(r.text) for r in rows])
    assert set(inputs["mixing"]) == {rows[r] for r in set(roots)}
    mixed = inputs["bpe"]
    assert set(mixed) <= set(inputs["mixing"])
    assert sorted(r.doc_id for r in result) == sorted(r.doc_id for r in mixed)


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
