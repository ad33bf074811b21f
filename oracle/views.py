"""Check statements of the reports."""

from __future__ import annotations

from oracle.build import P, big, days, dbl, div, pct, rnd, statement


def _status(col: str, stale: str) -> str:
    return (
        f"CASE WHEN {col} >= DATE '{P.active_from}' THEN 'Active' WHEN {col} >= DATE '{P.dormant_from}' THEN 'Dormant' "
        f"ELSE '{stale}' END"
    )


def rfm() -> str:
    return statement(f"""
SELECT who AS customer_unique_id, {big('r')} AS r_score, {big('f')} AS f_score, {big('m')} AS m_score,
 CONCAT(r, '-', f, '-', m) AS rfm_score, {div('r + f + m', '3', 2)} AS rfm_composite, segment,
 idle AS days_since_last_order, n AS order_count, {dbl('spend')} AS total_spend, aov AS avg_order_value,
 first_day AS first_order_date, last_day AS last_order_date
FROM persons JOIN segments USING (who)""")


def clv() -> str:
    rate = "CAST(n AS DOUBLE) * 365 / GREATEST(life, 1)"
    return statement(
        f"""
SELECT who AS customer_unique_id, n AS order_count, {dbl('spend')} AS historical_clv, aov AS avg_order_value,
 proj AS projected_clv_12m, CASE n WHEN 1 THEN 1.0::DOUBLE ELSE LEAST({rnd(rate, 2)}, 12.0::DOUBLE) END AS annualised_purchase_rate,
 CASE NTILE(3) OVER (ORDER BY proj, who) WHEN 1 THEN 'Low' WHEN 2 THEN 'Mid' ELSE 'High' END AS clv_tier,
 segment AS rfm_segment, {big('r')} AS r_score, {big('f')} AS f_score, {big('m')} AS m_score,
 first_day AS first_order_date, last_day AS last_order_date, life AS lifespan_days, idle AS days_since_last_order,
 {div('life', 'n - 1', 1)} AS avg_days_between_orders
FROM projected JOIN segments USING (who)""",
        {"projected": f"SELECT *, CASE n WHEN 1 THEN aov ELSE {rnd(f'LEAST(aov * {rate}, aov * 12)', 2)} END AS proj FROM persons"},
    )


def retention() -> str:
    return statement(
        f"""
SELECT c AS cohort_month, size AS cohort_size, per AS period_number, kept AS retained_customers,
 {pct('kept', 'size')} AS retention_rate_pct, LAG(kept) OVER (PARTITION BY c ORDER BY per) - kept AS churned_from_prev_period
FROM (SELECT c, size, per, COALESCE(n, 0) AS kept FROM grid LEFT JOIN seen USING (c, per))""",
        {
            "act": """SELECT customer_unique_id AS who, CAST(date_trunc('month', order_purchase_timestamp) AS DATE) AS mon
 FROM src_orders JOIN src_customers USING (customer_id) WHERE order_status = 'delivered'""",
            "born": "SELECT who, MIN(mon) AS c FROM act GROUP BY who",
            "seen": "SELECT c, datediff('month', c, mon) AS per, COUNT(DISTINCT who) AS n FROM act JOIN born USING (who) GROUP BY ALL",
            "grid": """SELECT c, size, UNNEST(range(0, 1 + datediff('month', c, (SELECT MAX(mon) FROM act)))) AS per
 FROM (SELECT c, COUNT(*) AS size FROM born GROUP BY c)""",
        },
    )


def seller_performance() -> str:
    z = lambda e: f"COALESCE({e}, 0)"
    done = "status = 'delivered'"
    timed = f"{done} AND arr IS NOT NULL AND due IS NOT NULL"
    return statement(
        f"""
SELECT seller_id, seller_city, seller_state, total_orders, total_items_sold, delivered_orders, total_revenue, avg_order_value,
 total_product_revenue, total_freight_revenue, avg_delivery_days, on_time_rate, cancellation_rate, total_reviews,
 avg_review_score, pct_5_star, pct_1_star, {dbl('q')} AS revenue_percentile, sc AS performance_score,
 CASE WHEN total_orders < 5 THEN 'Insufficient Data' WHEN sc >= 80 THEN 'Elite' WHEN sc >= 60 THEN 'Strong'
  WHEN sc >= 40 THEN 'Average' ELSE 'Needs Work' END AS performance_tier
FROM (SELECT *, CASE WHEN total_orders >= 5 THEN
 {rnd('avg_review_score * 8 + on_time_rate * 0.3 + q * 0.2 + (100 - cancellation_rate) * 0.1', 2)} END AS sc FROM tiled)""",
        {
            "per_seller": f"""
SELECT seller_id, COUNT(*) AS total_orders, {big('SUM(k)')} AS total_items_sold, COUNT(*) FILTER ({done}) AS delivered_orders,
 {dbl(f'SUM(v) FILTER ({done})')} AS rev, {div(f'SUM(v) FILTER ({done})', f'COUNT(*) FILTER ({done})', 2)} AS aov,
 {dbl(f'SUM(p) FILTER ({done})')} AS prod, {dbl(f'SUM(f) FILTER ({done})')} AS fre,
 {rnd(f"AVG({days('arr', 'ts')}) FILTER ({timed})", 1)} AS dd,
 {pct(f'COUNT(*) FILTER ({timed} AND arr <= due)', f'COUNT(*) FILTER ({timed})')} AS otr,
 {pct("COUNT(*) FILTER (status = 'canceled')", 'COUNT(*)')} AS can, COUNT(sc) AS nr, {div('SUM(sc)', 'COUNT(sc)', 2)} AS ar,
 {pct('COUNT(*) FILTER (sc = 5)', 'COUNT(sc)')} AS s5, {pct('COUNT(*) FILTER (sc = 1)', 'COUNT(sc)')} AS s1
FROM seller_lines LEFT JOIN score_of USING (order_id) GROUP BY seller_id""",
            "tiled": f"""
SELECT s.seller_id, seller_city, seller_state, {z('total_orders')} AS total_orders, {z('total_items_sold')} AS total_items_sold,
 {z('delivered_orders')} AS delivered_orders, {z('rev')} AS total_revenue, {z('aov')} AS avg_order_value,
 {z('prod')} AS total_product_revenue, {z('fre')} AS total_freight_revenue, {z('dd')} AS avg_delivery_days,
 {z('otr')} AS on_time_rate, {z('can')} AS cancellation_rate, {z('nr')} AS total_reviews, {z('ar')} AS avg_review_score,
 {z('s5')} AS pct_5_star, {z('s1')} AS pct_1_star, NTILE(100) OVER (ORDER BY {z('rev')}, s.seller_id) AS q
FROM src_sellers s LEFT JOIN per_seller x ON x.seller_id = s.seller_id""",
        },
    )


def regional_analysis() -> str:
    return statement(
        f"""
SELECT st AS state, u AS unique_customers, n AS total_orders, {dbl('v')} AS total_revenue, {div('v', 'n', 2)} AS avg_order_value,
 {dbl('p')} AS total_product_revenue, {dbl('f')} AS total_freight_revenue, {pct('v', 'SUM(v) OVER ()')} AS revenue_share_pct,
 {pct('SUM(v) OVER (ORDER BY v DESC, st NULLS LAST ROWS UNBOUNDED PRECEDING)', 'SUM(v) OVER ()')} AS cumulative_revenue_pct,
 dd AS avg_delivery_days, otr AS on_time_rate, ar AS avg_review_score, COALESCE(sellers, 0) AS total_sellers,
 {dbl('COALESCE(srev, 0)')} AS seller_total_revenue, COALESCE(sord, 0) AS seller_total_orders,
 {div('n', 'sellers', 1)} AS orders_per_seller
FROM demand LEFT JOIN supply ON st = sst""",
        {
            "demand": f"""
SELECT st, COUNT(DISTINCT who) AS u, COUNT(*) AS n, SUM(v) AS v, SUM(p) AS p, SUM(f) AS f, {rnd(f"AVG({days('arr', 'ts')})", 1)} AS dd,
 {pct('COUNT(*) FILTER (arr <= due)', 'COUNT(*) FILTER (arr IS NOT NULL AND due IS NOT NULL)')} AS otr,
 {div('SUM(sc)', 'COUNT(sc)', 2)} AS ar FROM sales LEFT JOIN score_of USING (order_id) GROUP BY st""",
            "supply": """
SELECT seller_state AS sst, COUNT(DISTINCT seller_id) AS sellers, SUM(v) AS srev, COUNT(DISTINCT order_id) AS sord
FROM seller_lines JOIN src_sellers USING (seller_id) WHERE status = 'delivered' GROUP BY 1""",
        },
    )


def customer_health() -> str:
    return statement(f"""
SELECT who AS customer_unique_id, mon AS last_order_month, {_status('mon', 'Lost')} AS customer_status FROM (
 SELECT customer_unique_id AS who, CAST(date_trunc('month', MAX(order_purchase_timestamp)) AS DATE) AS mon
 FROM src_orders JOIN src_customers USING (customer_id) WHERE order_status = 'delivered' GROUP BY 1)""")


def seller_health() -> str:
    return statement(
        f"""
SELECT 'Monthly Trend' AS metric_type, mon AS order_month, kind AS seller_type, CAST(NULL AS BIGINT) AS seller_id,
 CAST(NULL AS VARCHAR) AS seller_status, CAST(NULL AS DATE) AS last_sale_month, s AS seller_count, o AS order_count,
 {dbl('v')} AS total_revenue, {div('v', 'lines', 2)} AS avg_order_value, {pct('v', 'SUM(v) OVER mm')} AS revenue_share_pct,
 {big('SUM(s) OVER mm')} AS total_active_sellers, {big('SUM(o) OVER mm')} AS total_monthly_orders,
 {dbl('SUM(v) OVER mm')} AS total_monthly_revenue, LAG(s) OVER kk AS prev_month_sellers,
 {pct('s - LAG(s) OVER kk', 'LAG(s) OVER kk')} AS mom_seller_growth_pct
FROM filled WINDOW mm AS (PARTITION BY mon), kk AS (PARTITION BY kind ORDER BY mon)
UNION ALL
SELECT 'Status Snapshot', NULL, NULL, seller_id, CASE WHEN last IS NULL THEN 'Never Active' ELSE {_status('last', 'Inactive')} END, last,
 NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
FROM src_sellers LEFT JOIN (SELECT seller_id, MAX(mon) AS last FROM sold GROUP BY 1) USING (seller_id)""",
        {
            "sold": "SELECT *, MIN(mon) OVER (PARTITION BY seller_id) AS born FROM seller_lines WHERE status = 'delivered'",
            "cells": """SELECT mon, CASE WHEN mon = born THEN 'New' ELSE 'Returning' END AS kind, COUNT(DISTINCT seller_id) AS s,
 COUNT(DISTINCT order_id) AS o, COUNT(*) AS lines, SUM(v) AS v FROM sold GROUP BY ALL""",
            "months": """SELECT CAST(UNNEST(generate_series(CAST(MIN(mon) AS TIMESTAMP), CAST(MAX(mon) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS mon
 FROM sold""",
            "filled": """SELECT mon, kind, COALESCE(s, 0) AS s, COALESCE(o, 0) AS o, lines, COALESCE(v, 0) AS v
 FROM (SELECT * FROM months, (VALUES ('New'), ('Returning')) k(kind)) LEFT JOIN cells USING (mon, kind)""",
        },
    )


def new_vs_returning_revenue() -> str:
    nn, rr = "FILTER (mon = born)", "FILTER (mon <> born)"
    return statement(
        f"""
SELECT mon AS order_month, nc AS new_customers, rc AS returning_customers, tc AS total_customers, n_o AS new_orders,
 r_o AS returning_orders, t_o AS total_orders, {dbl('nv')} AS new_revenue, {dbl('rv')} AS returning_revenue, {dbl('tv')} AS total_revenue,
 {pct('nv', 'tv')} AS new_revenue_pct, {pct('rv', 'tv')} AS returning_revenue_pct, {div('nv', 'n_o', 2)} AS new_avg_order_value,
 {div('rv', 'r_o', 2)} AS returning_avg_order_value, {div('nv', 'nc', 2)} AS revenue_per_new_customer,
 {dbl('LAG(rv) OVER w')} AS prev_month_returning_revenue, {pct('rv - LAG(rv) OVER w', 'LAG(rv) OVER w')} AS returning_revenue_mom_growth_pct,
 {dbl('LAG(tv) OVER w')} AS prev_month_total_revenue, {pct('tv - LAG(tv) OVER w', 'LAG(tv) OVER w')} AS total_revenue_mom_growth_pct,
 {rnd('AVG(CAST(rv AS DOUBLE) * 100 / NULLIF(CAST(tv AS DOUBLE), 0)) OVER (ORDER BY mon ROWS 2 PRECEDING)', 2)} AS returning_pct_3m_rolling_avg
FROM filled WINDOW w AS (ORDER BY mon)""",
        {
            "tagged": "SELECT *, MIN(mon) OVER (PARTITION BY who) AS born FROM sales",
            "agg": f"""SELECT mon, COUNT(DISTINCT who) {nn} AS nc, COUNT(DISTINCT who) {rr} AS rc, COUNT(DISTINCT who) AS tc,
 COUNT(*) {nn} AS n_o, COUNT(*) {rr} AS r_o, COUNT(*) AS t_o, SUM(v) {nn} AS nv, SUM(v) {rr} AS rv, SUM(v) AS tv FROM tagged GROUP BY mon""",
            "filled": """SELECT mon, COALESCE(nc, 0) AS nc, COALESCE(rc, 0) AS rc, COALESCE(tc, 0) AS tc, COALESCE(n_o, 0) AS n_o,
 COALESCE(r_o, 0) AS r_o, COALESCE(t_o, 0) AS t_o, COALESCE(nv, 0) AS nv, COALESCE(rv, 0) AS rv, COALESCE(tv, 0) AS tv
FROM (SELECT CAST(UNNEST(generate_series(CAST(MIN(mon) AS TIMESTAMP), CAST(MAX(mon) AS TIMESTAMP), INTERVAL 1 MONTH)) AS DATE) AS mon FROM agg)
LEFT JOIN agg USING (mon)""",
        },
    )


def pareto_analysis() -> str:
    return statement(
        f"""
SELECT kind AS entity_type, id AS entity_id, {dbl('v')} AS total_revenue, n AS total_orders,
 RANK() OVER (PARTITION BY kind ORDER BY v DESC) AS revenue_rank, {pct('v', 'tot', 4)} AS revenue_pct_of_total,
 run AS cumulative_revenue_pct, pos AS cumulative_pct_of_entities, {dbl('tot')} AS grand_total_revenue, cnt AS total_entities,
 COALESCE(pos <= 20, FALSE) AS is_top_20_pct, COALESCE(run <= 80, FALSE) AS is_within_80_pct_revenue
FROM (SELECT *, {pct('SUM(v) OVER w', 'tot')} AS run, {pct('ROW_NUMBER() OVER w', 'cnt')} AS pos
 FROM (SELECT *, SUM(v) OVER (PARTITION BY kind) AS tot, COUNT(*) OVER (PARTITION BY kind) AS cnt FROM entities)
 WINDOW w AS (PARTITION BY kind ORDER BY v DESC, id ROWS UNBOUNDED PRECEDING))""",
        {
            "entities": """SELECT 'Customer' AS kind, who AS id, SUM(v) AS v, COUNT(*) AS n FROM sales GROUP BY who
 UNION ALL SELECT 'Seller', seller_id, SUM(v), COUNT(*) FROM seller_lines WHERE status = 'delivered' GROUP BY seller_id"""
        },
    )


def delivery_experience() -> str:
    ok = "arr <= due"
    return statement(
        f"""
SELECT CASE g WHEN 3 THEN 'Overall' WHEN 1 THEN 'By State' ELSE 'On-time vs Late' END AS dimension,
 CASE g WHEN 3 THEN 'National' WHEN 1 THEN st ELSE status END AS dimension_value, * EXCLUDE (g, st, status) FROM (
SELECT GROUPING(st, status) AS g, st, status, COUNT(*) AS total_orders, {rnd('AVG(d)', 1)} AS avg_delivery_days,
 {dbl('MIN(d)')} AS min_delivery_days, {dbl('MAX(d)')} AS max_delivery_days, {rnd('quantile_cont(d, 0.5)', 1)} AS median_delivery_days,
 {pct("COUNT(*) FILTER (status = 'On-Time')", 'COUNT(*)')} AS on_time_rate, {pct('COUNT(*) FILTER (early)', 'COUNT(*)')} AS early_delivery_rate,
 {pct("COUNT(*) FILTER (status = 'Late')", 'COUNT(*)')} AS late_delivery_rate, {rnd('AVG(e)', 1)} AS avg_days_vs_estimate,
 {div('SUM(sc)', 'COUNT(sc)', 2)} AS avg_review_score,
 {div("SUM(sc) FILTER (ok)", "COUNT(sc) FILTER (ok)", 2)} AS avg_review_on_time,
 {div("SUM(sc) FILTER (NOT ok)", "COUNT(sc) FILTER (NOT ok)", 2)} AS avg_review_late
FROM trips GROUP BY GROUPING SETS ((), (st), (status)))""",
        {
            "trips": f"""SELECT customer_state AS st, {ok} AS ok, CASE WHEN {ok} THEN 'On-Time' ELSE 'Late' END AS status,
 arr <= due - INTERVAL {P.early_days} DAY AS early, {days('arr', 'ts')} AS d, {days('arr', 'due')} AS e, sc
FROM (SELECT order_id, customer_id, order_purchase_timestamp AS ts, order_delivered_customer_date AS arr, order_estimated_delivery_date AS due
 FROM src_orders WHERE order_status = 'delivered') JOIN src_customers USING (customer_id) LEFT JOIN score_of USING (order_id)
WHERE arr IS NOT NULL AND due IS NOT NULL"""
        },
    )


def product_customer_affinity() -> str:
    return statement(
        f"""
SELECT cat AS category, n AS total_orders, items AS total_items, prods AS unique_products, ppl AS unique_customers,
 {dbl('v')} AS total_revenue, {div('v', 'items', 2)} AS avg_item_value, {dbl('p')} AS total_product_revenue, {dbl('f')} AS total_freight_revenue,
 {pct('f', 'v')} AS freight_pct_of_revenue, dd AS avg_delivery_days, {pct('v', 'SUM(v) OVER ()')} AS revenue_share_pct,
 {pct('SUM(v) OVER (ORDER BY v DESC, cat ROWS UNBOUNDED PRECEDING)', 'SUM(v) OVER ()')} AS cumulative_revenue_pct,
 ar AS avg_review_score, nr AS total_reviews, s5 AS pct_5_star, s1 AS pct_1_star, ppl AS total_category_customers,
 rep AS repeat_customers, {pct('rep', 'ppl')} AS category_repeat_rate_pct, top_st AS top_customer_state, top_n AS top_state_orders,
 CASE WHEN {pct('v', 'SUM(v) OVER ()')} >= 5 THEN 'High Revenue' WHEN {pct('v', 'SUM(v) OVER ()')} >= 1 THEN 'Mid Revenue' ELSE 'Long Tail' END AS revenue_tier
FROM money JOIN orders_in USING (cat) JOIN fans USING (cat) JOIN tops USING (cat)""",
        {
            "lines": """SELECT COALESCE(english, 'uncategorised') AS cat, product_id, i.order_id, customer_unique_id AS who, customer_state AS st,
 order_delivered_customer_date AS arr, order_purchase_timestamp AS ts, price AS p, freight_value AS f
FROM src_order_items i JOIN products_en USING (product_id) JOIN src_orders o ON o.order_id = i.order_id
JOIN src_customers USING (customer_id) WHERE order_status = 'delivered'""",
            "money": "SELECT cat, COUNT(*) AS items, COUNT(DISTINCT product_id) AS prods, SUM(p + f) AS v, SUM(p) AS p, SUM(f) AS f FROM lines GROUP BY cat",
            "orders_in": f"""SELECT cat, COUNT(*) AS n, {rnd('AVG(d)', 1)} AS dd, {div('SUM(sc)', 'COUNT(sc)', 2)} AS ar, COUNT(sc) AS nr,
 {pct('COUNT(*) FILTER (sc = 5)', 'COUNT(sc)')} AS s5, {pct('COUNT(*) FILTER (sc = 1)', 'COUNT(sc)')} AS s1
FROM (SELECT DISTINCT cat, order_id, {days('arr', 'ts')} AS d FROM lines) LEFT JOIN score_of USING (order_id) GROUP BY cat""",
            "fans": """SELECT cat, COUNT(*) AS ppl, COUNT(*) FILTER (k > 1) AS rep
FROM (SELECT cat, who, COUNT(DISTINCT order_id) AS k FROM lines GROUP BY cat, who) GROUP BY cat""",
            "tops": """SELECT cat, st AS top_st, COUNT(DISTINCT order_id) AS top_n FROM lines GROUP BY cat, st
QUALIFY ROW_NUMBER() OVER (PARTITION BY cat ORDER BY COUNT(DISTINCT order_id) DESC, st NULLS LAST) = 1""",
        },
    )


def payment_behaviour() -> str:
    return statement(
        f"""
SELECT CASE g WHEN 1 THEN 'By Payment Type' WHEN 2 THEN 'By Instalment Band' ELSE 'Cross' END AS dimension,
 CASE g WHEN 2 THEN band ELSE typ END AS dimension_value, CASE g WHEN 0 THEN band END AS sub_dimension, n AS order_count,
 {dbl('v')} AS total_payment_value, {div('v', 'k', 2)} AS avg_payment_value, {div('v', 'k', 2)} AS avg_order_item_total, ai AS avg_instalments,
 one AS single_instalment_orders, many AS multi_instalment_orders, {pct('one', 'n')} AS pct_single_instalment, {pct('high', 'n')} AS pct_high_instalment,
 {pct('n', 'SUM(n) OVER (PARTITION BY g)')} AS pct_of_orders, {pct('v', 'SUM(v) OVER (PARTITION BY g)')} AS pct_of_revenue
FROM (SELECT GROUPING(typ, band) AS g, typ, band, COUNT(*) AS n, SUM(v) AS v, COUNT(v) AS k, {rnd('AVG(c)', 2)} AS ai,
 COUNT(*) FILTER (c = 1) AS one, COUNT(*) FILTER (c > 1) AS many, COUNT(*) FILTER (c > 6) AS high
 FROM paid GROUP BY GROUPING SETS ((typ), (band), (typ, band)))""",
        {
            "paid": """SELECT payment_type AS typ, payment_installments AS c, CASE order_status WHEN 'delivered' THEN worth.v END AS v,
 CASE WHEN c = 1 THEN '1 (Single)' WHEN c <= 3 THEN '2-3' WHEN c <= 6 THEN '4-6' WHEN c <= 12 THEN '7-12' ELSE '12+' END AS band
FROM payments_fixed LEFT JOIN src_orders USING (order_id) LEFT JOIN worth USING (order_id)
QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY payment_sequential, payment_type, c, payment_value) = 1"""
        },
    )


def review_response_intelligence() -> str:
    cols = "avg_response_hours, reviews_with_comment, pct_with_comment, reviews_with_response, pct_with_response"
    block = f"""COUNT(*) AS review_count, {div('SUM(h)', 'COUNT(h)', 1)} AS avg_response_hours, COUNT(*) FILTER (com) AS reviews_with_comment,
 {pct('COUNT(*) FILTER (com)', 'COUNT(*)')} AS pct_with_comment, COUNT(h) AS reviews_with_response, {pct('COUNT(h)', 'COUNT(*)')} AS pct_with_response"""
    null = "CAST(NULL AS DOUBLE)"
    sub = "CAST(NULL AS VARCHAR) AS sub_dimension"
    return statement(
        f"""
SELECT 'Score Distribution' AS dimension, CAST(s AS VARCHAR) AS dimension_value, {sub}, review_count,
 {pct('review_count', 'SUM(review_count) OVER ()')} AS pct_of_total,
 {pct('SUM(review_count) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING)', 'SUM(review_count) OVER ()')} AS cumulative_pct,
 {cols}, {null} AS avg_review_score, {null} AS pct_5_star, {null} AS pct_1_star FROM by_score
UNION ALL SELECT 'Response Time', CAST(s AS VARCHAR), NULL, review_count, NULL, NULL, {cols}, NULL, NULL, NULL FROM by_score
UNION ALL SELECT 'By Score Band', band, NULL, review_count, {pct('review_count', 'SUM(review_count) OVER ()')}, NULL, {cols}, ar, NULL, NULL
 FROM (SELECT CASE WHEN s >= 4 THEN 'Positive (4-5)' WHEN s = 3 THEN 'Neutral (3)' ELSE 'Negative (1-2)' END AS band, {block}, {rnd('AVG(s)', 2)} AS ar
 FROM one GROUP BY band)
UNION ALL SELECT 'By Category', cat, NULL, review_count, NULL, NULL, {cols}, ar, s5, s1 FROM (SELECT cat, {block},
 {rnd('AVG(s)', 2)} AS ar, {pct('COUNT(*) FILTER (s = 5)', 'COUNT(*)')} AS s5, {pct('COUNT(*) FILTER (s = 1)', 'COUNT(*)')} AS s1
 FROM one GROUP BY cat)""",
        {
            "one": f"""SELECT review_id, review_score AS s, review_comment_message IS NOT NULL AS com, COALESCE(english, 'uncategorised') AS cat,
 CAST(ROUND(CAST((epoch_us(review_answer_timestamp) - epoch_us(review_creation_date)) / 3600000000.0 AS DECIMAL(38,10)), 1) AS DECIMAL(18,1)) AS h
FROM src_reviews LEFT JOIN src_order_items USING (order_id) LEFT JOIN products_en USING (product_id)
QUALIFY ROW_NUMBER() OVER (PARTITION BY review_id ORDER BY price + freight_value DESC NULLS LAST, order_id, cat, review_creation_date,
 review_answer_timestamp - review_creation_date NULLS LAST, s, com) = 1""",
            "by_score": f"SELECT s, {block} FROM one GROUP BY s",
        },
    )


VIEWS = {
    "v1_rfm": rfm,
    "v2_clv": clv,
    "v3_retention": retention,
    "v4_seller_performance": seller_performance,
    "v5_regional_analysis": regional_analysis,
    "v6_customer_health": customer_health,
    "v7_seller_health": seller_health,
    "v8_new_vs_returning_revenue": new_vs_returning_revenue,
    "v9_pareto_analysis": pareto_analysis,
    "v10_delivery_experience": delivery_experience,
    "v11_product_customer_affinity": product_customer_affinity,
    "v12_payment_behaviour": payment_behaviour,
    "v13_review_response_intelligence": review_response_intelligence,
}
