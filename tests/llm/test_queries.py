"""Registered queries of the subpackage: against their SQL, and the pipeline by its stages."""

import os

import pytest

import corpus_pipeline
from tests.compare import connect, differences
from tradewind.llm.queries import LLM_EXPECTED, LLM_QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(LLM_EXPECTED))
def test_query_gives_what_its_sql_gives(spark, name):
    assert differences(LLM_QUERIES[name](spark, SF_DIR), connect(SF_DIR), LLM_EXPECTED[name]) == []


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, rows = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(place)
        docs = spark.read.parquet(place)
        rows.append(docs.count())
        if name != "packing":
            assert docs.columns == columns
    read, known, single, clean, mixed, _ = rows
    assert 0.95 * read <= known <= read and 0 < single <= known and clean == single
    # each piece stands in one sequence, and all mixed documents are there
    assert docs.filter("piece = 0").count() == mixed
    assert docs.groupBy("sequence_id").sum("length").filter("`sum(length)` > 4096").isEmpty()


def test_pipeline_on_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        place = str(tmp_path / name)
        stage(spark, docs, SF_DIR).write.parquet(place)
        docs = spark.read.parquet(place)
        assert docs.count() == 0
