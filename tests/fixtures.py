"""A tiny hand-made marketplace: staging frames from a few literal rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stallbook.schemas import STAGING


def staging(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    """All nine frames; columns not given are NULL. Values are text, cast to the staging types."""
    frames = {}
    for table, ddl in STAGING.items():
        fields = [part.strip().split(" ", 1) for part in _split(ddl)]
        text_ddl = ", ".join(f"{name} string" for name, _ in fields)
        data = [tuple(None if r.get(n) is None else str(r[n]) for n, _ in fields) for r in rows.get(table, [])]
        raw = spark.createDataFrame(data, text_ddl)
        frames[table] = raw.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in fields])
    return frames


def _split(ddl: str) -> list[str]:
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(ddl):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(ddl[start:i])
            start = i + 1
    return [*parts, ddl[start:]]


def shop(*sales: tuple, reviews: list[tuple] = (), payments: list[tuple] = (), products: list[dict] | None = None) -> dict:
    """Rows from ``(order, person, bought, seller, price[, status[, arrived, due]])`` tuples."""
    orders, customers, items, sellers = {}, {}, [], set()
    for sale in sales:
        order, person, bought, seller, price = sale[:5]
        status = sale[5] if len(sale) > 5 else "delivered"
        arrived, due = sale[6:8] if len(sale) > 7 else (None, None)
        orders[order] = {
            "order_id": order, "customer_id": f"c-{order}", "order_status": status, "order_purchase_timestamp": bought,
            "order_delivered_customer_date": arrived, "order_estimated_delivery_date": due,
        }
        customers[order] = {"customer_id": f"c-{order}", "customer_unique_id": person, "customer_state": f"S{person[-1]}"}
        if price is not None:
            items.append(
                {"order_id": order, "order_item_id": len(items) + 1, "product_id": f"p-{seller}", "seller_id": seller,
                 "price": price, "freight_value": 0}
            )
        sellers.add(seller)
    products = products or [{"product_id": f"p-{s}", "product_category_name": "cat"} for s in sellers]
    return {
        "orders": list(orders.values()),
        "customers": list(customers.values()),
        "order_items": items,
        "sellers": [{"seller_id": s, "seller_state": "S1"} for s in sorted(sellers)],
        "products": products,
        "category_translation": [{"product_category_name": "cat", "product_category_name_english": "category"}],
        "reviews": [
            {"review_id": r, "order_id": o, "review_score": s, "review_creation_date": "2018-01-01 00:00:00",
             "review_answer_timestamp": "2018-01-01 01:30:00"}
            for r, o, s in reviews
        ],
        "payments": [
            {"order_id": o, "payment_sequential": q, "payment_type": t, "payment_installments": n, "payment_value": v}
            for o, q, t, n, v in payments
        ],
    }
