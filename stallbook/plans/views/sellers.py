"""Seller reports: scorecard, health, and revenue concentration."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame

from stallbook.functions.scalars import add, agg, mean, mean_money, money, month_of, percent, whole_days
from stallbook.operators.calendar import fill_months
from stallbook.operators.materialize import materialize
from stallbook.operators.order_stats import with_ntiles
from stallbook.operators.ranking import with_global_order
from stallbook.params import Params
from stallbook.plans.bases import VALUE, Frames, person_orders, review_scores, seller_orders
from stallbook.plans.views.customers import activity_status

# Weights of the composite score and lower bounds of its tiers.
WEIGHTS = {"review": "0.40", "on_time": "0.30", "revenue": "0.20", "kept": "0.10"}
TIERS = [("Elite", 80), ("Strong", 60), ("Average", 40)]


def seller_metrics(w: Frames) -> DataFrame:
    """All seller measures from one pass over seller x order rows."""
    lines = seller_orders(w, only_delivered=False).join(review_scores(w["fact_reviews"]), "order_id", "left")
    arrived, due = "order_delivered_customer_date", "order_estimated_delivery_date"
    done = "order_status = 'delivered'"
    timed = f"{done} AND {arrived} IS NOT NULL AND {due} IS NOT NULL"
    trip = whole_days(arrived, "order_purchase_timestamp")
    sums = agg(
        lines,
        ["seller_id"],
        total_orders="count(1)",
        total_items_sold="sum(items)",
        canceled="count_if(order_status = 'canceled')",
        delivered_orders=f"count_if({done})",
        price_cents=f"sum(price_cents) FILTER (WHERE {done})",
        freight_cents=f"sum(freight_cents) FILTER (WHERE {done})",
        days=f"sum({trip}) FILTER (WHERE {timed})",
        day_rows=f"count({trip}) FILTER (WHERE {timed})",
        timed=f"count_if({timed})",
        on_time=f"count_if({timed} AND {arrived} <= {due})",
        score="sum(order_score)",
        scored="count(order_score)",
        fives="count_if(order_score = 5)",
        ones="count_if(order_score = 1)",
    )
    return sums.selectExpr(
        "seller_id", "total_orders", "total_items_sold", "delivered_orders",
        f"{percent('canceled', 'total_orders')} AS cancellation_rate",
        f"{VALUE} AS revenue_cents",
        f"{mean_money(VALUE, 'delivered_orders')} AS avg_order_value",
        "price_cents", "freight_cents",
        f"{mean('days', 'day_rows', 1)} AS avg_delivery_days",
        f"{percent('on_time', 'timed')} AS on_time_rate",
        "scored AS total_reviews",
        f"{mean('score', 'scored', 2)} AS avg_review_score",
        f"{percent('fives', 'scored')} AS pct_5_star",
        f"{percent('ones', 'scored')} AS pct_1_star",
    )


def seller_performance(w: Frames, params: Params, rows_per_range: int | None = None) -> DataFrame:
    sellers = w["dim_seller"].select("seller_id", "seller_city", "seller_state")
    metrics = seller_metrics(w)
    zeros = [f"coalesce({c}, CAST(0 AS {t})) AS {c}" for c, t in metrics.dtypes if c != "seller_id"]
    stored = materialize(sellers.join(metrics, "seller_id", "left").selectExpr(*sellers.columns, *zeros), "sellers")
    tiled = with_ntiles(stored, "seller_id", {"revenue_percentile": ("revenue_cents", 100)}, rows_per_range)

    parts = {
        "review": "avg_review_score * 20",
        "on_time": "on_time_rate",
        "revenue": "CAST(revenue_percentile AS DECIMAL(5,2))",
        "kept": "(CAST(100 AS DECIMAL(5,2)) - cancellation_rate)",
    }
    total = " + ".join(f"{parts[name]} * {weight}BD" for name, weight in WEIGHTS.items())
    enough = f"total_orders >= {params.min_orders_for_score}"
    scored = add(tiled, performance_score=f"CASE WHEN {enough} THEN CAST(round({total}, 2) AS DECIMAL(20,2)) END")
    tiers = " ".join(f"WHEN performance_score >= {floor} THEN '{name}'" for name, floor in TIERS)
    return scored.selectExpr(
        "seller_id", "seller_city", "seller_state", "total_orders", "total_items_sold", "delivered_orders",
        f"{money('revenue_cents')} AS total_revenue", "avg_order_value",
        f"{money('price_cents')} AS total_product_revenue",
        f"{money('freight_cents')} AS total_freight_revenue",
        "avg_delivery_days", "on_time_rate", "cancellation_rate", "total_reviews", "avg_review_score",
        "pct_5_star", "pct_1_star",
        "CAST(revenue_percentile AS DECIMAL(20,2)) AS revenue_percentile",
        "performance_score",
        f"CASE WHEN NOT ({enough}) THEN 'Insufficient Data' {tiers} ELSE 'Needs Work' END AS performance_tier",
    )


def seller_health(w: Frames, params: Params) -> DataFrame:
    """Monthly trend rows and one status row per seller.

    The seller x month table is stored: it is small next to the sales, and the trend, the
    status and each seller's first month all come from it.
    """
    lines = seller_orders(w).selectExpr(
        "seller_id", "order_id", f"{month_of('order_purchase_timestamp')} AS order_month", f"{VALUE} AS value"
    )
    months = agg(lines, ["seller_id", "order_month"], lines="count(1)", value="sum(value)").join(_known(w), "seller_id")
    by_seller = materialize(add(months, first_month="min(order_month) OVER (PARTITION BY seller_id)"), "seller-months")
    trend = _seller_trend(w, lines, by_seller)
    return trend.unionByName(_seller_status(w, by_seller, params), allowMissingColumns=True)


def _known(w: Frames) -> DataFrame:
    return w["dim_seller"].select("seller_id")


def _seller_trend(w: Frames, lines: DataFrame, by_seller: DataFrame) -> DataFrame:
    """Month x New/Returning, complete over the calendar.

    Counts and sums of sellers come from seller x month rows. Only the distinct orders need
    the seller's type on each seller x order row, because sellers can share an order. Both
    sides of that join are shuffled just for it, so a hot seller's rows can be split.
    """
    kind = "CASE WHEN order_month = first_month THEN 'New' ELSE 'Returning' END AS seller_type"
    starts = by_seller.filter("order_month = first_month").select("seller_id", "first_month")
    tagged = lines.select("seller_id", "order_id", "order_month").join(starts, "seller_id")
    orders = agg(
        tagged.selectExpr("order_month", kind, "order_id").distinct(), ["order_month", "seller_type"], orders="count(1)"
    )

    sellers = agg(by_seller, ["order_month", kind], sellers="count(1)", lines="sum(lines)", value="sum(value)")

    kinds, measures = ("New", "Returning"), ("sellers", "orders", "lines", "value")
    wide = agg(
        sellers.join(orders, ["order_month", "seller_type"]),
        ["order_month"],
        **{f"{k}_{m}": f"sum({m}) FILTER (WHERE seller_type = '{k}')" for k in kinds for m in measures},
    )
    sides = ", ".join(
        f"named_struct('seller_type', '{k}', " + ", ".join(f"'{m}', coalesce({k}_{m}, 0)" for m in measures) + ")"
        for k in kinds
    )
    rows = fill_months(wide, "order_month", []).selectExpr("order_month", f"inline(array({sides}))")
    month = "OVER (PARTITION BY order_month)"
    seen = add(
        rows,
        month_sellers=f"sum(sellers) {month}",
        month_orders=f"sum(orders) {month}",
        month_value=f"sum(value) {month}",
        before="lag(sellers) OVER (PARTITION BY seller_type ORDER BY order_month)",
    )
    return seen.selectExpr(
        "'Monthly Trend' AS metric_type", "order_month", "seller_type",
        f"CAST(NULL AS {dict(w['dim_seller'].dtypes)['seller_id']}) AS seller_id",
        "CAST(NULL AS STRING) AS seller_status",
        "CAST(NULL AS DATE) AS last_sale_month",
        "sellers AS seller_count",
        "orders AS order_count",
        f"{money('value')} AS total_revenue",
        f"{mean_money('value', 'lines')} AS avg_order_value",
        f"{percent('value', 'month_value')} AS revenue_share_pct",
        "month_sellers AS total_active_sellers",
        "month_orders AS total_monthly_orders",
        f"{money('month_value')} AS total_monthly_revenue",
        "before AS prev_month_sellers",
        f"{percent('(sellers - before)', 'before')} AS mom_seller_growth_pct",
    )


def _seller_status(w: Frames, by_seller: DataFrame, params: Params) -> DataFrame:
    sold = agg(by_seller, ["seller_id"], last_sale_month="max(order_month)")
    return _known(w).join(sold, "seller_id", "left").selectExpr(
        "'Status Snapshot' AS metric_type",
        "seller_id",
        f"CASE WHEN last_sale_month IS NULL THEN 'Never Active' "
        f"ELSE {activity_status('last_sale_month', params, 'Inactive')} END AS seller_status",
        "last_sale_month",
    )


def pareto(w: Frames, params: Params, rows_per_range: int | None = None) -> DataFrame:
    """Revenue concentration of persons and of sellers, each ranked across many tasks."""

    def totals(lines: DataFrame, entity: str, kind: str) -> DataFrame:
        sums = agg(lines, [f"{entity} AS entity_id"], value=f"sum({VALUE})", total_orders="count(1)")
        return sums.selectExpr(f"'{kind}' AS entity_type", "entity_id", "value", "-value AS descending", "total_orders")

    sellers = totals(seller_orders(w), "seller_id", "Seller")
    known = w["dim_seller"].selectExpr("seller_id AS entity_id")
    both = totals(person_orders(w), "customer_unique_id", "Customer").unionByName(sellers.join(known, "entity_id"))
    stored = materialize(both, "pareto", "entity_type")
    sizes = agg(stored, ["entity_type"], n="count(1)", v="sum(CAST(value AS DECIMAL(38,0)))").collect()
    parts = [_ranked(stored, r["entity_type"], r["n"], r["v"], rows_per_range) for r in sizes]
    return reduce(DataFrame.unionByName, parts) if parts else _ranked(stored, "", 0, Decimal(0), rows_per_range)


def _ranked(stored: DataFrame, kind: str, n: int, v: Decimal, rows_per_range: int | None) -> DataFrame:
    mine = add(stored.filter(f"entity_type = '{kind}'"), wide="CAST(value AS DECIMAL(28,0))")
    placed = with_global_order(
        mine, ["descending", "entity_id"], row_number="position", rank="revenue_rank",
        running={"so_far": "wide"}, rows=n, rows_per_range=rows_per_range,
    )
    shared = add(placed, so_far=percent("so_far", f"{v}BD"), position=percent("position", f"{n}L"))
    return shared.selectExpr(
        "entity_type", "entity_id",
        f"{money('value')} AS total_revenue", "total_orders", "revenue_rank",
        f"{percent('value', f'{v}BD', 4)} AS revenue_pct_of_total",
        "so_far AS cumulative_revenue_pct",
        "position AS cumulative_pct_of_entities",
        f"{money(f'{v}BD')} AS grand_total_revenue",
        f"{n}L AS total_entities",
        "coalesce(position <= 20, false) AS is_top_20_pct",
        "coalesce(so_far <= 80, false) AS is_within_80_pct_revenue",
    )
