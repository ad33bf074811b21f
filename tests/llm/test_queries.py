"""Registered training-data queries on the benchmark tables."""

import os

import pytest

import corpus_pipeline
from stallbook.llm import mixing, simhash
from stallbook.llm.queries import QUERIES
from stallbook.llm.statements import STATEMENTS
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_matches_statement(spark, name):
    assert differences(QUERIES[name](spark, SF_DIR), duck(SF_DIR), STATEMENTS[name]) == []


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, sizes = docs.columns, [docs.count()]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.materialize(stage(spark, docs, SF_DIR), "stage")
        sizes.append(docs.count())
        if i < 4:
            assert docs.columns == columns
        if i == 1:  # nothing left to drop
            assert docs.selectExpr("count(distinct doc_id) = count(1)").first()[0]
            assert simhash.one_of_each(docs).count() == sizes[-1]
            assert {r[0] for r in docs.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
        if i == 2:
            assert docs.where("text rlike 'AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}'").count() == 0
        if i == 3:
            drawn = mixing.mixture(before).selectExpr("sum(taken)").first()[0]
            assert docs.select(mixing.word_count("text").alias("n")).selectExpr("sum(n)").first()[0] == drawn
    assert sizes[1] <= sizes[0] and sizes[2] <= sizes[1] and sizes[3] == sizes[2] and sizes[5] == sizes[4] > 0
    assert docs.columns == [c for c in columns if c != "text"] + ["ids"]
    assert docs.where("ids IS NULL OR length(ids) % 4 <> 0").count() == 0
