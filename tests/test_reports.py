"""Hand-made cases for the reports' edge rules."""

import datetime as dt
from decimal import Decimal as D

import pytest

from stallbook.params import Params
from stallbook.plans.reports import DISPLAY, REPORTS, present, run_report
from stallbook.plans.warehouse import clean
from tests.fixtures import shop, staging

P = Params()


def report(spark, name, *sales, **more):
    frames = clean(staging(spark, **shop(*sales, **more)), P)
    return [r.asDict() for r in present(name, run_report(name, frames, P)).collect()]


def test_empty_month_is_filled_and_breaks_growth(spark):
    rows = report(
        spark, "new_vs_returning_revenue",
        ("o1", "a", "2018-01-05 10:00:00", "s", 100), ("o2", "b", "2018-03-05 10:00:00", "s", 50),
        ("o3", "a", "2018-03-06 10:00:00", "s", 25),
    )
    assert [r["order_month"] for r in rows] == [dt.date(2018, m, 1) for m in (1, 2, 3)]
    feb, mar = rows[1], rows[2]
    assert (feb["total_customers"], feb["total_revenue"], feb["new_revenue_pct"]) == (0, D("0.00"), None)
    assert mar["prev_month_total_revenue"] == 0 and mar["total_revenue_mom_growth_pct"] is None
    assert mar["returning_revenue_pct"] == D("33.33")
    assert mar["returning_pct_3m_rolling_avg"] == D("16.67")


def test_second_order_in_first_month_is_still_new(spark):
    sales = [("o1", "a", "2018-01-05 10:00:00", "s", 10), ("o2", "a", "2018-01-25 10:00:00", "s", 20)]
    (jan,) = report(spark, "new_vs_returning_revenue", *sales)
    assert (jan["new_customers"], jan["new_orders"], jan["returning_orders"]) == (1, 2, 0)
    (cohort,) = report(spark, "retention", *sales)
    assert (cohort["cohort_size"], cohort["period_number"], cohort["retained_customers"]) == (1, 0, 1)


def test_retention_grid_reaches_the_last_month(spark):
    rows = report(
        spark, "retention",
        ("o1", "a", "2017-11-05 10:00:00", "s", 10), ("o2", "b", "2017-11-06 10:00:00", "s", None),
        ("o3", "a", "2018-02-01 00:00:00", "s", 10),
    )
    assert [(r["period_number"], r["retained_customers"], r["churned_from_prev_period"]) for r in rows] == [
        (0, 2, None), (1, 0, 2), (2, 0, 0), (3, 1, -1),
    ]
    assert rows[3]["retention_rate_pct"] == D("50.00")


def test_mean_score_between_stars_counts_as_neither(spark):
    more = {"reviews": [("r1", "o1", 4), ("r2", "o1", 5)]}
    sales = [("o1", "a", "2018-01-05 10:00:00", "s", 10)]
    (seller,) = report(spark, "seller_performance", *sales, **more)
    assert (seller["total_reviews"], seller["avg_review_score"], seller["pct_5_star"], seller["pct_1_star"]) == (1, D("4.50"), 0, 0)
    assert seller["performance_tier"] == "Insufficient Data" and seller["performance_score"] is None
    (category,) = report(spark, "product_customer_affinity", *sales, **more)
    assert (category["category"], category["pct_5_star"], category["total_reviews"]) == ("category", 0, 1)


def test_seller_with_only_canceled_orders(spark):
    sales = [(f"o{i}", "a", "2018-01-05 10:00:00", "s", 10, "canceled") for i in range(5)]
    (seller,) = report(spark, "seller_performance", *sales)
    assert (seller["delivered_orders"], seller["cancellation_rate"], seller["total_orders"]) == (0, D("100.00"), 5)
    assert seller["total_items_sold"] == 5 and seller["total_revenue"] == 0
    # Only the revenue percentile (tile 1 of one seller) adds to the score.
    assert seller["performance_score"] == D("0.20") and seller["performance_tier"] == "Needs Work"


def test_three_sellers_in_a_hundred_tiles(spark):
    rows = report(
        spark, "seller_performance",
        ("o1", "a", "2018-01-05 10:00:00", "s1", 30), ("o2", "a", "2018-01-05 10:00:00", "s2", 10),
        ("o3", "a", "2018-01-05 10:00:00", "s3", 20),
    )
    assert {r["seller_id"]: r["revenue_percentile"] for r in rows} == {"s2": 1, "s3": 2, "s1": 3}


def test_part_days_truncate_toward_zero(spark):
    rows = report(
        spark, "delivery_experience",
        ("o1", "a", "2018-01-01 00:00:00", "s", 10, "delivered", "2018-01-08 12:00:00", "2018-01-10 00:00:00"),
    )
    overall = next(r for r in rows if r["dimension"] == "Overall")
    assert overall["avg_days_vs_estimate"] == D("-1.0") and overall["avg_delivery_days"] == D("7.0")
    assert overall["early_delivery_rate"] == 0 and overall["on_time_rate"] == 100
    assert {(r["dimension"], r["dimension_value"]) for r in rows} == {
        ("Overall", "National"), ("By State", "Sa"), ("On-time vs Late", "On-Time"),
    }


def test_delivery_needs_both_dates(spark):
    rows = report(spark, "delivery_experience", ("o1", "a", "2018-01-01 00:00:00", "s", 10))
    assert [(r["dimension"], r["total_orders"]) for r in rows if r["total_orders"]] == []


def test_entity_that_crosses_80_percent_is_outside(spark):
    rows = report(
        spark, "pareto_analysis",
        ("o1", "a", "2018-01-05 10:00:00", "s1", 60), ("o2", "b", "2018-01-05 10:00:00", "s2", 30),
        ("o3", "c", "2018-01-05 10:00:00", "s3", 10),
    )
    for kind in ("Customer", "Seller"):
        mine = [r for r in rows if r["entity_type"] == kind]
        assert [r["is_within_80_pct_revenue"] for r in mine] == [True, False, False]
        assert [r["revenue_rank"] for r in mine] == [1, 2, 3]
        assert mine[-1]["cumulative_revenue_pct"] == 100 and mine[0]["total_entities"] == 3


def test_pareto_ties_share_a_rank(spark):
    rows = report(
        spark, "pareto_analysis",
        *[(f"o{i}", p, "2018-01-05 10:00:00", "s1", v) for i, (p, v) in enumerate([("a", 5), ("b", 5), ("c", 1)])],
    )
    mine = [r for r in rows if r["entity_type"] == "Customer"]
    assert sorted(r["revenue_rank"] for r in mine) == [1, 1, 3]
    assert sorted(r["cumulative_pct_of_entities"] for r in mine) == [D("33.33"), D("66.67"), D("100.00")]


def test_projection_for_one_and_two_orders(spark):
    rows = {
        r["customer_unique_id"]: r
        for r in report(
            spark, "clv",
            ("o1", "a", "2018-01-05 10:00:00", "s", 10),
            ("o2", "b", "2018-01-05 10:00:00", "s", 10), ("o3", "b", "2018-01-05 18:00:00", "s", 20),
            ("o4", "d", "2017-01-05 10:00:00", "s", 10), ("o5", "d", "2018-01-05 10:00:00", "s", 10),
        )
    }
    assert (rows["a"]["annualised_purchase_rate"], rows["a"]["projected_clv_12m"]) == (1, D("10.00"))
    assert rows["a"]["avg_days_between_orders"] is None
    assert (rows["b"]["annualised_purchase_rate"], rows["b"]["projected_clv_12m"]) == (12, D("180.00"))
    assert rows["b"]["lifespan_days"] == 0
    assert (rows["d"]["annualised_purchase_rate"], rows["d"]["avg_days_between_orders"]) == (2, D("365.0"))
    assert rows["a"]["days_since_last_order"] == 238
    assert {r["clv_tier"] for r in rows.values()} == {"Low", "Mid", "High"}


def test_customer_and_seller_status(spark):
    sales = [
        ("o1", "a", "2018-03-01 00:00:00", "s1", 1), ("o2", "b", "2018-02-28 23:00:00", "s2", 1),
        ("o3", "c", "2017-08-31 23:00:00", "s3", 1), ("o4", "d", "2018-03-05 00:00:00", "s4", 1, "shipped"),
    ]
    assert {r["customer_unique_id"]: r["customer_status"] for r in report(spark, "customer_health", *sales)} == {
        "a": "Active", "b": "Dormant", "c": "Lost",
    }
    rows = report(spark, "seller_health", *sales)
    status = {r["seller_id"]: r["seller_status"] for r in rows if r["metric_type"] == "Status Snapshot"}
    assert status == {"s1": "Active", "s2": "Dormant", "s3": "Inactive", "s4": "Never Active"}


def test_order_shared_by_new_and_returning_seller_counts_for_both(spark):
    rows = report(
        spark, "seller_health",
        ("o1", "a", "2018-01-05 10:00:00", "s1", 10), ("o2", "a", "2018-03-05 10:00:00", "s1", 10),
        ("o2", "a", "2018-03-05 10:00:00", "s2", 30),
    )
    trend = {(r["order_month"].month, r["seller_type"]): r for r in rows if r["metric_type"] == "Monthly Trend"}
    assert len(trend) == 6
    march = trend[(3, "New")]
    assert (march["total_monthly_orders"], march["total_active_sellers"], march["revenue_share_pct"]) == (2, 2, D("75.00"))
    assert trend[(2, "New")]["seller_count"] == 0 and trend[(2, "New")]["avg_order_value"] is None
    assert trend[(2, "New")]["mom_seller_growth_pct"] == D("-100.00") and march["mom_seller_growth_pct"] is None


def test_payment_uses_the_first_one_and_keeps_unpaid_orders_out(spark):
    rows = report(
        spark, "payment_behaviour",
        ("o1", "a", "2018-01-05 10:00:00", "s", 100), ("o2", "a", "2018-01-05 10:00:00", "s", 60, "canceled"),
        payments=[("o1", 2, "voucher", 1, 50), ("o1", 3, "card", 9, 50), ("o2", 1, "card", 0, 60), ("lost", 1, "card", 13, 5)],
    )
    types = {r["dimension_value"]: r for r in rows if r["dimension"] == "By Payment Type"}
    assert (types["voucher"]["order_count"], types["voucher"]["total_payment_value"], types["voucher"]["pct_of_revenue"]) == (1, 100, 100)
    # The zero instalments of o2 became one; the canceled order brings no money.
    assert (types["card"]["single_instalment_orders"], types["card"]["total_payment_value"]) == (1, None)
    bands = {r["dimension_value"]: r["order_count"] for r in rows if r["dimension"] == "By Instalment Band"}
    assert bands == {"1 (Single)": 2, "12+": 1}
    assert sum(r["order_count"] for r in rows if r["dimension"] == "Cross") == 3


def test_review_takes_the_dearest_item_and_counts_once(spark):
    rows = report(
        spark, "review_response_intelligence",
        ("o1", "a", "2018-01-05 10:00:00", "s1", 10), ("o1", "a", "2018-01-05 10:00:00", "s2", 90),
        ("o2", "a", "2018-01-05 10:00:00", "s1", 50),
        reviews=[("r1", "o1", 5), ("r1", "o2", 5), ("r2", "gone", 1)],
        products=[{"product_id": "p-s1", "product_category_name": "cheap"}, {"product_id": "p-s2", "product_category_name": "cat"}],
    )
    by_category = {r["dimension_value"]: r["review_count"] for r in rows if r["dimension"] == "By Category"}
    assert by_category == {"category": 1, "uncategorised": 1}
    scores = {r["dimension_value"]: r for r in rows if r["dimension"] == "Score Distribution"}
    assert (scores["5"]["cumulative_pct"], scores["1"]["cumulative_pct"]) == (50, 100)
    assert scores["5"]["avg_response_hours"] == D("1.5")
    assert {r["dimension"] for r in rows} == {"Score Distribution", "Response Time", "By Score Band", "By Category"}


def test_region_without_sellers(spark):
    rows = report(
        spark, "regional_analysis",
        ("o1", "p1", "2018-01-05 10:00:00", "s", 75), ("o2", "p2", "2018-01-05 10:00:00", "s", 25),
    )
    one, two = rows
    assert (one["state"], one["total_sellers"], one["orders_per_seller"], one["seller_total_orders"]) == ("S1", 1, D("1.0"), 2)
    assert (two["total_sellers"], two["orders_per_seller"], two["cumulative_revenue_pct"]) == (0, None, 100)


def test_segments_cover_every_score(spark):
    from stallbook.plans.views.customers import segment_of

    grid = spark.range(25).selectExpr("CAST(id div 5 + 1 AS INT) AS r", "CAST(id % 5 + 1 AS INT) AS f")
    got = {(x.r, x.f): x.s for x in grid.selectExpr("r", "f", f"{segment_of('r', 'f')} AS s").collect()}
    assert "Uncategorised" not in got.values() and len(set(got.values())) == 9
    assert (got[(5, 5)], got[(1, 4)], got[(2, 5)], got[(5, 1)], got[(5, 2)]) == (
        "Champions", "Cannot Lose Them", "Loyal", "Recent", "Potential Loyal",
    )


@pytest.mark.parametrize("name", list(REPORTS))
def test_every_report_accepts_an_empty_marketplace(spark, name):
    frames = clean(staging(spark), P)
    rows = run_report(name, frames, P).collect()
    assert all(r["dimension"] == "Overall" for r in rows) if name == "delivery_experience" else rows == []
    assert set(DISPLAY) == set(REPORTS)
