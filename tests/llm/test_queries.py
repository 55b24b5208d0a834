"""The registered queries against SQL on the shared tables, and on tables without rows."""

import os

import compare
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from sparktally.llm import queries

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    assert compare.differences(queries.QUERIES[name](spark, FOLDER), compare.connect(FOLDER), queries.ORACLE[name]) == []


def test_registered():
    names = entry.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(names) and set(queries.ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_tables_without_rows(spark, tmp_path, name):
    for table in ("documents", "labels", "embeddings", "pages", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


def test_pipeline_stages_keep_columns(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "mixing", "sentencepiece"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).schema.names == docs.schema.names
