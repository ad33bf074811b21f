"""Customer reports: segments, lifetime value, retention, health, revenue mix."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stallbook.functions.scalars import (
    add, agg, mean_money, money, month_of, months_between, percent, ratio, whole_days,
)
from stallbook.operators.calendar import fill_months
from stallbook.operators.materialize import materialize
from stallbook.operators.order_stats import with_ntiles
from stallbook.params import Params
from stallbook.plans.bases import VALUE, Frames, delivered, person_months, person_orders

# Segment names with their recency and frequency bands, first match wins.
SEGMENTS: list[tuple[str, tuple[int, int], tuple[int, int]]] = [
    ("Champions", (5, 5), (5, 5)),
    ("Cannot Lose Them", (1, 1), (4, 5)),
    ("Loyal", (1, 5), (4, 5)),
    ("Recent", (5, 5), (1, 1)),
    ("Potential Loyal", (4, 5), (1, 2)),
    ("Need Attention", (3, 5), (3, 5)),
    ("Promising", (3, 5), (1, 2)),
    ("At Risk", (1, 2), (3, 5)),
    ("About to Sleep", (1, 2), (1, 2)),
]


def segment_of(r: str, f: str) -> str:
    bands = " ".join(
        f"WHEN {r} BETWEEN {r_lo} AND {r_hi} AND {f} BETWEEN {f_lo} AND {f_hi} THEN '{name}'"
        for name, (r_lo, r_hi), (f_lo, f_hi) in SEGMENTS
    )
    return f"CASE {bands} ELSE 'Uncategorised' END"


def person_metrics(w: Frames, params: Params) -> DataFrame:
    """One stored row per person: what both segment and lifetime-value reports start from."""
    totals = agg(
        person_orders(w),
        ["customer_unique_id"],
        order_count="count(1)",
        spend_cents=f"sum({VALUE})",
        first_ts="min(order_purchase_timestamp)",
        last_ts="max(order_purchase_timestamp)",
    )
    facts = totals.selectExpr(
        "customer_unique_id",
        "order_count",
        "spend_cents",
        f"{mean_money('spend_cents', 'order_count')} AS avg_order_value",
        "CAST(first_ts AS DATE) AS first_order_date",
        "CAST(last_ts AS DATE) AS last_order_date",
        f"{whole_days('last_ts', 'first_ts')} AS lifespan_days",
        f"{whole_days(f'''TIMESTAMP_NTZ '{params.reference_date}' ''', 'last_ts')} AS days_since_last_order",
    )
    yearly, life = "CAST(order_count AS DECIMAL(20,0)) * 365", "greatest(lifespan_days, 1)"
    capped_rate = f"least({ratio(yearly, life, 2)}, 12)"
    capped_value = f"least({ratio(f'avg_order_value * {yearly}', life, 2)}, avg_order_value * 12)"
    # With one order the projection is one more order of the same size.
    projected = add(
        facts,
        projected_clv_12m=f"CAST(CASE WHEN order_count = 1 THEN avg_order_value ELSE {capped_value} END AS DECIMAL(20,2))",
        annualised_purchase_rate=f"CAST(CASE WHEN order_count = 1 THEN 1 ELSE {capped_rate} END AS DECIMAL(20,2))",
        avg_days_between_orders=ratio("lifespan_days", "order_count - 1", 1),
    )
    return materialize(add(projected, projected_cents="CAST(projected_clv_12m * 100 AS BIGINT)"), "persons")


def _scored(persons: DataFrame, rows_per_range: int | None, **extra: tuple[str, int]) -> DataFrame:
    tiles = {
        "recency_tile": ("days_since_last_order", 5),
        "f_score": ("order_count", 5),
        "m_score": ("spend_cents", 5),
        **extra,
    }
    tiled = add(with_ntiles(persons, "customer_unique_id", tiles, rows_per_range), r_score="6 - recency_tile")
    return add(tiled, segment=segment_of("r_score", "f_score"))


def rfm(w: Frames, params: Params, rows_per_range: int | None = None) -> DataFrame:
    return _scored(person_metrics(w, params), rows_per_range).selectExpr(
        "customer_unique_id", "r_score", "f_score", "m_score",
        "concat_ws('-', r_score, f_score, m_score) AS rfm_score",
        f"{ratio('r_score + f_score + m_score', '3', 2)} AS rfm_composite",
        "segment", "days_since_last_order", "order_count",
        f"{money('spend_cents')} AS total_spend",
        "avg_order_value", "first_order_date", "last_order_date",
    )


def clv(w: Frames, params: Params, rows_per_range: int | None = None) -> DataFrame:
    """Same persons as ``rfm``, so its columns are computed in the same pass instead of joined."""
    scored = _scored(person_metrics(w, params), rows_per_range, clv_tile=("projected_cents", 3))
    return scored.selectExpr(
        "customer_unique_id", "order_count",
        f"{money('spend_cents')} AS historical_clv",
        "avg_order_value", "projected_clv_12m", "annualised_purchase_rate",
        "elt(clv_tile, 'Low', 'Mid', 'High') AS clv_tier",
        "segment AS rfm_segment",
        "r_score", "f_score", "m_score", "first_order_date", "last_order_date", "lifespan_days",
        "days_since_last_order", "avg_days_between_orders",
    )


def retention(w: Frames, params: Params) -> DataFrame:
    """Cohort x months since the first order, complete up to the last month with orders.

    The big table is read once: everything after the (cohort, month) count works on one row
    per cohort that holds its counts by period, bounded by the calendar.
    """
    active = add(person_months(w), cohort_month="min(order_month) OVER (PARTITION BY customer_unique_id)")
    counts = agg(active, ["cohort_month", "order_month"], people="count(1)")
    period = months_between("order_month", "cohort_month")
    cohorts = agg(
        counts,
        ["cohort_month"],
        by_period=f"map_from_entries(collect_list(struct({period}, people)))",
        last="max(order_month)",
    )
    ended = add(cohorts, last="max(last) OVER ()")
    grid = ended.selectExpr(
        "cohort_month", "element_at(by_period, 0) AS cohort_size", "by_period",
        f"explode(sequence(0, {months_between('last', 'cohort_month')})) AS period_number",
    )
    kept = add(grid, retained_customers="coalesce(try_element_at(by_period, period_number), 0)")
    earlier = "lag(retained_customers) OVER (PARTITION BY cohort_month ORDER BY period_number)"
    return kept.selectExpr(
        "cohort_month", "cohort_size", "CAST(period_number AS BIGINT) AS period_number", "retained_customers",
        f"{percent('retained_customers', 'cohort_size')} AS retention_rate_pct",
        f"{earlier} - retained_customers AS churned_from_prev_period",
    )


def activity_status(last_month: str, params: Params, stale: str) -> str:
    return (
        f"CASE WHEN {last_month} >= DATE '{params.active_from}' THEN 'Active' "
        f"WHEN {last_month} >= DATE '{params.dormant_from}' THEN 'Dormant' ELSE '{stale}' END"
    )


def customer_health(w: Frames, params: Params) -> DataFrame:
    people = w["dim_customer"].select("customer_id", "customer_unique_id")
    orders = delivered(w["dim_order"]).select("customer_id", "order_purchase_timestamp")
    last = agg(
        orders.join(people, "customer_id"),
        ["customer_unique_id"],
        last_order_month=month_of("max(order_purchase_timestamp)"),
    )
    return add(last, customer_status=activity_status("last_order_month", params, "Lost"))


def new_vs_returning_revenue(w: Frames, params: Params) -> DataFrame:
    """Monthly revenue mix. At person x month grain every distinct count is a plain count."""
    monthly = agg(
        person_orders(w),
        ["customer_unique_id", f"{month_of('order_purchase_timestamp')} AS order_month"],
        orders="count(1)",
        revenue=f"sum({VALUE})",
    )
    tagged = add(monthly, is_new="order_month = min(order_month) OVER (PARTITION BY customer_unique_id)")

    def split(prefix: str, chosen: str) -> dict[str, str]:
        return {
            f"{prefix}_customers": f"count_if({chosen})",
            f"{prefix}_orders": f"coalesce(sum(orders) FILTER (WHERE {chosen}), 0)",
            f"{prefix}_cents": f"coalesce(sum(revenue) FILTER (WHERE {chosen}), 0)",
        }

    sums = {**split("new", "is_new"), **split("returning", "NOT is_new"), **split("total", "true")}
    full = fill_months(agg(tagged, ["order_month"], **sums), "order_month", list(sums))

    # The rolling mean takes unrounded shares; a month without revenue has none.
    share = "CAST(CAST(returning_cents AS DECIMAL(20,0)) * 100 / nullif(CAST(total_cents AS DECIMAL(17,0)), 0BD) AS DECIMAL(24,16))"
    recent = "OVER (ORDER BY order_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"
    rolled = add(
        add(full, share=share),
        prev_returning="lag(returning_cents) OVER (ORDER BY order_month)",
        prev_total="lag(total_cents) OVER (ORDER BY order_month)",
        recent_sum=f"sum(share) {recent}",
        recent_count=f"count(share) {recent}",
    )
    new, back, total = "new_cents", "returning_cents", "total_cents"
    return rolled.selectExpr(
        "order_month", "new_customers", "returning_customers", "total_customers",
        "new_orders", "returning_orders", "total_orders",
        f"{money(new)} AS new_revenue", f"{money(back)} AS returning_revenue", f"{money(total)} AS total_revenue",
        f"{percent(new, total)} AS new_revenue_pct",
        f"{percent(back, total)} AS returning_revenue_pct",
        f"{mean_money(new, 'new_orders')} AS new_avg_order_value",
        f"{mean_money(back, 'returning_orders')} AS returning_avg_order_value",
        f"{mean_money(new, 'new_customers')} AS revenue_per_new_customer",
        f"{money('prev_returning')} AS prev_month_returning_revenue",
        f"{percent(f'({back} - prev_returning)', 'prev_returning')} AS returning_revenue_mom_growth_pct",
        f"{money('prev_total')} AS prev_month_total_revenue",
        f"{percent(f'({total} - prev_total)', 'prev_total')} AS total_revenue_mom_growth_pct",
        f"{ratio('recent_sum', 'recent_count', 2, 'DECIMAL(24,16)')} AS returning_pct_3m_rolling_avg",
    )
