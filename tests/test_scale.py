"""What the plans must not do on big tables, and results that must hold on any data."""

import os
import re

import pytest
from pyspark.sql import functions as F

from stallbook.operators import key_presence
from stallbook.params import BENCH_PARAMS as P
from stallbook.plans import warehouse
from stallbook.plans.reports import REPORTS
from stallbook.plans.views import customers, sellers
from stallbook.quality import checks, profile
from stallbook.sources.bench_tables import source_frames

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def frames(spark):
    return warehouse.report_frames(source_frames(spark, SF_DIR, number_items=False), P)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("job", [customers.rfm, customers.clv, sellers.seller_performance])
def test_tiles_are_assigned_without_a_shuffle(frames, job):
    text = plan(job(frames, P, rows_per_range=40))
    assert "Exchange" not in text and "Window" not in text


def test_pareto_ranks_in_many_tasks(frames):
    text = plan(sellers.pareto(frames, P, rows_per_range=40))
    big = [line for line in text.splitlines() if "SinglePartition" in line]
    # One small table of range totals per ranked table is the only thing gathered.
    assert len(big) <= 2
    assert re.search(r"Window .*windowspecdefinition\(_range", text)


@pytest.mark.parametrize("name", ["rfm", "clv", "seller_performance", "pareto_analysis"])
def test_ranges_do_not_change_results(frames, name):
    whole = sorted(map(str, REPORTS[name](frames, P).collect()))
    split = sorted(map(str, REPORTS[name](frames, P, rows_per_range=37).collect()))
    assert whole == split


def test_numbering_does_not_depend_on_ranges(spark):
    cleaned = warehouse.clean(source_frames(spark, SF_DIR), P)
    for table in ("fact_order_items", "dim_order"):
        a = warehouse.with_surrogate_keys(cleaned, P)[table].collect()
        b = warehouse.with_surrogate_keys(cleaned, P, rows_per_range=211)[table].collect()
        assert sorted(map(str, a)) == sorted(map(str, b))


def test_filters_and_columns_reach_the_scan(frames):
    text = plan(REPORTS["customer_health"](frames, P))
    assert "lineitem" not in text and "o_totalprice" not in text


def test_first_per_group_limits_before_the_shuffle(frames):
    text = plan(REPORTS["payment_behaviour"](frames, P))
    assert "WindowGroupLimit" in text and "Partial" in text


SMALL_PARTITIONS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}

HOT = {
    "seller": ("fact_order_items", "seller_id", "CASE WHEN order_id % 10 < 8 THEN 1L ELSE seller_id END", "seller_health"),
    "product": ("fact_order_items", "product_id", "CASE WHEN order_id % 10 < 8 THEN 1L ELSE product_id END", "product_customer_affinity"),
    "reviewed order": ("fact_reviews", "order_id", "CASE WHEN review_id % 10 < 8 THEN 1L ELSE order_id END", "review_response_intelligence"),
    "review": ("fact_reviews", "review_id", "CASE WHEN order_id % 10 < 8 THEN 1L ELSE review_id END", None),
}


@pytest.mark.parametrize("case", list(HOT))
def test_hot_key_is_split(spark, frames, case):
    """A key with most of the rows must not leave all of them to one join task."""
    table, key, expr, name = HOT[case]
    hot = dict(frames)
    hot[table] = frames[table].repartition(8).withColumn(key, F.expr(expr))

    def run():
        return REPORTS[name](hot, P) if name else checks.duplicated_rows(hot[table], key)

    plain = sorted(map(str, run().collect()))
    before = {k: spark.conf.get(k, None) for k in SMALL_PARTITIONS}
    try:
        for k, v in SMALL_PARTITIONS.items():
            spark.conf.set(k, v)
        result = run()
        rows, text = sorted(map(str, result.collect())), plan(result)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text
    assert rows == plain


def test_totals_agree_across_reports(frames):
    def total(name: str, col: str, where=lambda r: True):
        return sum(r[col] for r in REPORTS[name](frames, P).collect() if where(r))

    revenue = total("rfm", "total_spend")
    assert revenue == total("regional_analysis", "total_revenue")
    assert revenue == total("product_customer_affinity", "total_revenue")
    assert revenue == total("new_vs_returning_revenue", "total_revenue")
    assert revenue == total("pareto_analysis", "total_revenue", lambda r: r["entity_type"] == "Customer")
    delivered = REPORTS["delivery_experience"](frames, P).collect()
    by = {d: sum(r["total_orders"] for r in delivered if r["dimension"] == d) for d in {r["dimension"] for r in delivered}}
    assert len(by) == 3 and len(set(by.values())) == 1
    for name in ("regional_analysis", "product_customer_affinity"):
        assert max(r["cumulative_revenue_pct"] for r in REPORTS[name](frames, P).collect()) == 100
    assert all(
        r["retention_rate_pct"] == 100 for r in REPORTS["retention"](frames, P).collect() if r["period_number"] == 0
    )


def test_range_size_is_bounded_for_any_row_count(spark, monkeypatch):
    from stallbook.operators import ranking

    seen = []
    keep = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, label: seen.append(keep(df, label)) or seen[-1])
    for rows in (500, 5_000, 20_000):
        df = spark.range(rows).selectExpr("id % 7 AS v", "id AS k")
        assert ranking.with_global_order(df, ["v", "k"], "rn", rows_per_range=50).count() == rows
        sizes = [r.n for r in seen[-1].groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()]
        assert max(sizes) <= 5 * 50 and len(sizes) >= rows / 250


def test_selection_narrows_in_rounds(spark, monkeypatch):
    from stallbook.operators import order_stats, splits
    from stallbook.operators.materialize import materialize

    monkeypatch.setattr(splits, "FAN_OUT", 4)
    rounds = []
    keep = order_stats.find_splits
    monkeypatch.setattr(order_stats, "find_splits", lambda *a: rounds.append(a[2]) or keep(*a))
    df = materialize(spark.range(6_000).selectExpr("'g' AS g", "(id * 7919) % 6000 AS v"), "narrow")
    found = order_stats.select_at_ranks(df, "g", ["v"], lambda name, n: [1, 3_000, n], rows_per_range=100)
    assert {k: v[0] for k, v in found["g"].items()} == {1: 0, 3_000: 2_999, 6_000: 5_999}
    assert len(rounds) > 2 and rounds == sorted(rounds, reverse=True)


def test_items_take_keys_from_numbered_natural_keys(spark):
    cleaned = warehouse.clean(source_frames(spark, SF_DIR), P)
    keyed = warehouse.with_surrogate_keys(cleaned, P)
    text = plan(keyed["fact_order_items"])
    assert text.count("Join") <= 7 and "customer_unique_id" not in text and "zip_code_prefix" not in text and "full_date" not in text


def test_regional_analysis_does_not_expand(frames):
    assert "Expand" not in plan(REPORTS["regional_analysis"](frames, P))


def test_models_read_their_report_once(spark, frames, monkeypatch):
    from stallbook.models import features

    stored = []
    keep = features.materialize
    monkeypatch.setattr(features, "materialize", lambda df, label: stored.append(label) or keep(df, label))
    out = features.category_clusters(REPORTS["product_customer_affinity"](frames, P))
    assert stored == ["features"] and "lineitem" not in plan(out)


def test_references_share_one_pass_over_their_keys(spark):
    """A hot key is combined before the shuffle; each table is read once and every key domain is shuffled once."""
    frames = {
        "parents": spark.createDataFrame([(1,), (2,), (2,), (None,)], "id int"),
        "hot": spark.range(0, 30_000, numPartitions=8).selectExpr("CASE WHEN id % 3 = 0 THEN 7 WHEN id % 3 = 1 THEN 1 END AS parent", "CAST(id % 5 AS STRING) AS other"),
        "others": spark.createDataFrame([("0",), ("1",)], "id string"),
    }
    references = [("hot", "parent", "parents", "id"), ("hot", "other", "others", "id"), ("parents", "id", "others", "id")]
    counted = key_presence.reference_counts(frames, references)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    # One exchange of keys, one of the sums.
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Exchange SinglePartition") == 1
    assert [tuple(r) for r in counted.orderBy("at").collect()] == [(0, 2, 1, 10_000, 10_000), (1, 5, 3, 0, 18_000), (2, 2, 1, 1, 2)]
    keys = {(r.domain, r.k): r.c0 for r in key_presence.key_counts(frames, references).collect()}
    assert keys[0, "2"] == 2 and keys[0, "7"] == 0


def shuffled_bytes(spark, df):
    """Bytes that all stages write to shuffles while ``df`` is collected."""
    store = spark.sparkContext._jsc.sc().statusStore()

    def so_far():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    before, rows = so_far(), df.collect()
    return so_far() - before, rows


def test_repeated_rows_are_found_without_shuffling_texts(spark):
    def table(letters):
        text = f"CASE WHEN id % 5 > 0 THEN repeat(md5(CAST(id % 4000 AS STRING)), {letters}) END"
        return {"t": spark.range(0, 6_000, numPartitions=4).selectExpr("id % 3000 AS k", f"{text} AS a", f"CASE WHEN id % 2 = 0 THEN {text} END AS b")}

    (short, few), (long, many) = (shuffled_bytes(spark, profile.dataset_shapes(table(n))) for n in (1, 200))
    assert few == many and long < 1.2 * short
    swapped = spark.createDataFrame([("x", None), (None, "x"), ("x", None), ("", None), (None, None), (None, None)], "a string, b string")
    assert profile.dataset_shapes({"t": swapped}).first().duplicate_rows == 2
