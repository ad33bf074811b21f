"""Every registered query with a check statement, against DuckDB."""

import os

import pytest

import __spark_entry__ as contract
from tests.compare import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")
from stallbook.registry import QUERIES  # noqa: E402

STATEMENTS = {name: text for name, text in contract.oracle_sql().items() if name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_statement_has_a_query():
    assert set(STATEMENTS) <= set(QUERIES)
    assert set(QUERIES) - set(STATEMENTS) == {"m2_seller_clusters", "m3_category_clusters", "m4_review_drivers"}


@pytest.mark.parametrize("name", list(STATEMENTS))
def test_query_matches_statement(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, STATEMENTS[name]) == []


def test_cluster_names(spark):
    sellers = QUERIES["m2_seller_clusters"](spark, SF_DIR).collect()
    by_name = {n: [r["avg_review_score"] for r in sellers if r["cluster_name"] == n] for n in ("Elite", "Non-Elite")}
    assert all(by_name.values())
    assert sum(by_name["Elite"]) / len(by_name["Elite"]) >= sum(by_name["Non-Elite"]) / len(by_name["Non-Elite"])
    categories = QUERIES["m3_category_clusters"](spark, SF_DIR).collect()
    assert {r["cluster_name"] for r in categories} == {"Revenue Core", "Trouble Spot", "Small & Sticky", "Small & Well-Reviewed"}


def test_driver_importances_sum_to_one(spark):
    rows = QUERIES["m4_review_drivers"](spark, SF_DIR).collect()
    assert abs(sum(r["importance"] for r in rows) - 1) < 1e-9
    assert [r["importance_rank"] for r in rows] == [1, 2, 3, 4, 5]
