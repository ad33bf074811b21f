"""Grains shared by the reports.

Items, payments and reviews are all many-per-order, so each is collapsed to the order before
it meets another. Collapsing first also keeps joins on unique keys and lets a hot order,
seller or product shrink on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from stallbook.functions.scalars import agg, cents, mean, month_of

Frames = Mapping[str, DataFrame]

VALUE = "price_cents + freight_cents"


def delivered(orders: DataFrame) -> DataFrame:
    return orders.filter("order_status = 'delivered'")


def order_values(items: DataFrame, *more_keys: str) -> DataFrame:
    """Cents and item count per order (or per order and ``more_keys``)."""
    return agg(
        items,
        ["order_id", *more_keys],
        price_cents=f"sum({cents('price')})",
        freight_cents=f"sum({cents('freight_value')})",
        items="count(1)",
    )


def review_scores(reviews: DataFrame) -> DataFrame:
    """Mean score per order."""
    totals = agg(reviews, ["order_id"], _sum="sum(CAST(review_score AS BIGINT))", _n="count(review_score)")
    return totals.selectExpr("order_id", f"CAST({mean('_sum', '_n', 10)} AS DECIMAL(12,10)) AS order_score")


def person_orders(w: Frames) -> DataFrame:
    """Delivered orders that have items, with their person: one row per order."""
    people = w["dim_customer"].select("customer_id", "customer_unique_id", "customer_state")
    return delivered(w["dim_order"]).join(people, "customer_id").join(order_values(w["fact_order_items"]), "order_id")


def person_months(w: Frames) -> DataFrame:
    """Person x month of delivered orders, with or without items."""
    people = w["dim_customer"].select("customer_id", "customer_unique_id")
    months = delivered(w["dim_order"]).selectExpr(
        "customer_id", f"{month_of('order_purchase_timestamp')} AS order_month"
    )
    return months.join(people, "customer_id").select("customer_unique_id", "order_month").distinct()


def seller_orders(w: Frames, only_delivered: bool = True) -> DataFrame:
    """Seller x order: the seller's own share of each order, with the order's dates."""
    orders = delivered(w["dim_order"]) if only_delivered else w["dim_order"]
    dated = orders.select(
        "order_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    return order_values(w["fact_order_items"], "seller_id").join(dated, "order_id")
