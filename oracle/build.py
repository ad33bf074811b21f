"""Pieces the check statements are put together from."""

from __future__ import annotations

import re

from stallbook.params import BENCH_PARAMS as P
from stallbook.sources.bench_tables import SOURCE_SQL


def rnd(expr: str, digits: int) -> str:
    """Round half away from zero: snap the double to ten decimals first."""
    return f"CAST(ROUND(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def div(a: str, b: str, digits: int) -> str:
    return rnd(f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))", digits)


def pct(a: str, b: str, digits: int = 2) -> str:
    return rnd(f"(CAST({a} AS DOUBLE) * 100 / NULLIF(CAST({b} AS DOUBLE), 0))", digits)


def days(a: str, b: str) -> str:
    return f"CAST(trunc((epoch_us({a}) - epoch_us({b})) / 86400000000.0) AS BIGINT)"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


_MANUAL = ", ".join(f"('{k}', '{v}')" for k, v in P.manual_categories)

CTES: dict[str, str] = {f"src_{name}": text.strip() for name, text in SOURCE_SQL.items()}
CTES |= {
    "manual_map": f"SELECT * FROM (VALUES {_MANUAL}) m(product_category_name, english)",
    "products_en": """
SELECT p.*, COALESCE(m.english, t.product_category_name_english) AS english
FROM src_products p LEFT JOIN manual_map m USING (product_category_name)
LEFT JOIN src_category_translation t USING (product_category_name)""",
    "payments_fixed": """
SELECT order_id, payment_sequential, payment_type, payment_value,
 CASE payment_installments WHEN 0 THEN 1 ELSE payment_installments END AS payment_installments FROM src_payments""",
    "score_of": "SELECT order_id, CAST(AVG(review_score) AS DECIMAL(12,10)) AS sc FROM src_reviews GROUP BY order_id",
    "worth": "SELECT order_id, SUM(price) AS p, SUM(freight_value) AS f, SUM(price + freight_value) AS v FROM src_order_items GROUP BY order_id",
    "sales": f"""
SELECT customer_unique_id AS who, customer_state AS st, order_id, order_purchase_timestamp AS ts, p, f, v,
 order_delivered_customer_date AS arr, order_estimated_delivery_date AS due,
 CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS mon
FROM src_orders JOIN src_customers USING (customer_id) JOIN worth USING (order_id) WHERE order_status = 'delivered'""",
    "seller_lines": """
SELECT i.seller_id, i.order_id, o.order_status AS status, o.order_purchase_timestamp AS ts, o.order_delivered_customer_date AS arr,
 o.order_estimated_delivery_date AS due, CAST(date_trunc('month', o.order_purchase_timestamp) AS DATE) AS mon,
 COUNT(*) AS k, SUM(i.price) AS p, SUM(i.freight_value) AS f, SUM(i.price + i.freight_value) AS v
FROM src_order_items i JOIN src_orders o ON o.order_id = i.order_id JOIN src_sellers s ON s.seller_id = i.seller_id
GROUP BY ALL""",
    "persons": f"""
SELECT who, COUNT(*) AS n, SUM(v) AS spend, CAST(MIN(ts) AS DATE) AS first_day, CAST(MAX(ts) AS DATE) AS last_day,
 {days('MAX(ts)', 'MIN(ts)')} AS life, {days(f"TIMESTAMP '{P.reference_date}'", 'MAX(ts)')} AS idle,
 {div('SUM(v)', 'COUNT(*)', 2)} AS aov
FROM sales GROUP BY who""",
    "scores": """
SELECT who, 6 - NTILE(5) OVER (ORDER BY idle, who) AS r, NTILE(5) OVER (ORDER BY n, who) AS f,
 NTILE(5) OVER (ORDER BY spend, who) AS m FROM persons""",
    "segments": """
SELECT *, CASE WHEN r = 5 AND f = 5 THEN 'Champions' WHEN r = 1 AND f >= 4 THEN 'Cannot Lose Them' WHEN f >= 4 THEN 'Loyal'
 WHEN r = 5 AND f = 1 THEN 'Recent' WHEN r >= 4 AND f <= 2 THEN 'Potential Loyal' WHEN r >= 3 AND f >= 3 THEN 'Need Attention'
 WHEN r >= 3 AND f <= 2 THEN 'Promising' WHEN r <= 2 AND f >= 3 THEN 'At Risk' WHEN r <= 2 AND f <= 2 THEN 'About to Sleep' END AS segment
FROM scores""",
}


def _needs(text: str) -> list[str]:
    return [n for n in CTES if re.search(rf"\b{n}\b", text)]


def statement(body: str, extra: dict[str, str] | None = None) -> str:
    """Put only the needed common tables, in dependency order, in front of ``body``."""
    extra = extra or {}
    wanted: list[str] = []

    def visit(name: str) -> None:
        for other in _needs(CTES[name]):
            if other != name and other not in wanted:
                visit(other)
        if name not in wanted:
            wanted.append(name)

    for text in [*extra.values(), body]:
        for name in _needs(text):
            visit(name)
    parts = [f"{n} AS ({CTES[n]})" for n in wanted] + [f"{n} AS ({t})" for n, t in extra.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
