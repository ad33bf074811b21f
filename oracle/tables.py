"""Check statements of the loads, the warehouse tables, the quality jobs and the outlier list."""

from __future__ import annotations

from oracle.build import P, big, dbl, div, pct, rnd, statement
from oracle.views import VIEWS, seller_performance

COLUMNS: dict[str, list[tuple[str, str]]] = {
    "orders": [
        ("order_id", "bigint"), ("customer_id", "bigint"), ("order_status", "string"), ("order_purchase_timestamp", "timestamp_ntz"),
        ("order_approved_at", "timestamp_ntz"), ("order_delivered_carrier_date", "timestamp_ntz"),
        ("order_delivered_customer_date", "timestamp_ntz"), ("order_estimated_delivery_date", "timestamp_ntz"),
    ],
    "customers": [
        ("customer_id", "bigint"), ("customer_unique_id", "bigint"), ("customer_zip_code_prefix", "string"),
        ("customer_city", "string"), ("customer_state", "string"),
    ],
    "order_items": [
        ("order_id", "bigint"), ("order_item_id", "int"), ("product_id", "bigint"), ("seller_id", "bigint"),
        ("shipping_limit_date", "timestamp_ntz"), ("price", "decimal(10,2)"), ("freight_value", "decimal(10,2)"),
    ],
    "payments": [
        ("order_id", "bigint"), ("payment_sequential", "int"), ("payment_type", "string"), ("payment_installments", "int"),
        ("payment_value", "decimal(10,2)"),
    ],
    "reviews": [
        ("review_id", "bigint"), ("order_id", "bigint"), ("review_score", "int"), ("review_comment_title", "string"),
        ("review_comment_message", "string"), ("review_creation_date", "timestamp_ntz"), ("review_answer_timestamp", "timestamp_ntz"),
    ],
    "products": [
        ("product_id", "bigint"), ("product_category_name", "string"), ("product_name_length", "int"),
        ("product_description_length", "int"), ("product_photos_qty", "int"), ("product_weight_g", "decimal(10,2)"),
        ("product_length_cm", "decimal(10,2)"), ("product_height_cm", "decimal(10,2)"), ("product_width_cm", "decimal(10,2)"),
    ],
    "sellers": [
        ("seller_id", "bigint"), ("seller_zip_code_prefix", "string"), ("seller_city", "string"), ("seller_state", "string"),
    ],
    "geolocation": [
        ("zip_code_prefix", "string"), ("lat", "decimal(9,6)"), ("lng", "decimal(9,6)"), ("city", "string"), ("state", "string"),
    ],
    "category_translation": [("product_category_name", "string"), ("product_category_name_english", "string")],
}
DATES = {
    t: [c for c, k in cols if k == "timestamp_ntz"] for t, cols in COLUMNS.items() if any(k == "timestamp_ntz" for _, k in cols)
}
NUMBERS = {
    t: [c for c, k in cols if k.startswith(("int", "decimal")) and not c.endswith(("_id", "_sequential"))] for t, cols in COLUMNS.items()
}
TEXTS = {
    "orders": ["order_status"], "customers": ["customer_city", "customer_state"], "payments": ["payment_type"],
    "products": ["product_category_name"], "sellers": ["seller_city", "seller_state"], "geolocation": ["city", "state"],
}
BOX = f"lat BETWEEN {P.lat_min} AND {P.lat_max} AND lng BETWEEN {P.lng_min} AND {P.lng_max}"
GRACE = f"INTERVAL {P.shipping_grace_days} DAY"


def union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def csv_round_trip() -> str:
    def one(t: str, c: str) -> str:
        number = f"CAST('0x' || substr(md5(CAST({c} AS VARCHAR)), 1, 8) AS BIGINT)"
        return (
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, '{c}' AS column_name, COUNT({c}) AS filled, "
            f"COALESCE({big(f'SUM({number})')}, 0) AS checksum FROM src_{t}"
        )

    return statement(union([one(t, c) for t, cols in COLUMNS.items() for c, _ in cols]))


def planted_defects() -> str:
    rows = [
        ("sellers", "rows", "SELECT 2 * COUNT(*) FROM src_sellers"),
        ("products", "rows", "SELECT COUNT(*) FROM src_products"),
        ("products", "blank category", "SELECT COUNT(*) FROM src_products WHERE product_category_name IS NULL"),
        ("sellers", "failed", "SELECT 0"), ("payments", "failed", "SELECT 1"), ("products", "failed", "SELECT 0"), ("orders", "failed", "SELECT 1"),
        ("payments", "lost payment_value", "SELECT COUNT(*) FROM src_payments WHERE payment_installments = 0"),
        ("payments", "lost payment_installments", "SELECT COUNT(*) FROM src_payments WHERE payment_installments = 7"),
        ("products", "lost product_photos_qty", "SELECT COUNT(*) FROM src_products WHERE product_photos_qty = 1"),
    ]
    return statement(union([f"SELECT '{t}' AS table_name, '{w}' AS what, {big(f'({q})')} AS n" for t, w, q in rows]))


def stored_loads() -> str:
    steps = "(VALUES ('loaded', 1), ('loaded again', 1), ('cleared', 0)) s(step, k)"
    return f"SELECT table_name, step, {big('row_count * k')} AS row_count FROM ({row_counts()}), {steps}"


def failed_loads() -> str:
    steps = "(VALUES ('loaded'), ('reported'), ('after failure'), ('seen by an early reader')) s(step)"
    return f"SELECT table_name, step, {big("CASE step WHEN 'reported' THEN 1 ELSE row_count END")} AS row_count FROM ({row_counts()}), {steps}"


def display_order() -> str:
    order = "row_number() OVER (ORDER BY cohort_month, period_number)"
    return f"SELECT {order} AS place, cohort_month, period_number, retained_customers FROM ({VIEWS['v3_retention']()})"


def sql_over_views() -> str:
    return statement(
        f"""
SELECT customer_status, order_status, COUNT(*) AS orders FROM src_orders JOIN src_customers USING (customer_id)
LEFT JOIN health USING (customer_unique_id) GROUP BY ALL""",
        {
            "health": f"""SELECT customer_unique_id, CASE WHEN MAX(order_purchase_timestamp) >= DATE '{P.active_from}' THEN 'Active'
 WHEN MAX(order_purchase_timestamp) >= DATE '{P.dormant_from}' THEN 'Dormant' ELSE 'Lost' END AS customer_status
FROM src_orders JOIN src_customers USING (customer_id) WHERE order_status = 'delivered' GROUP BY 1"""
        },
    )


CALENDAR = f"""
 CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, day(d) AS day, month(d) AS month, monthname(d) AS month_name,
 quarter(d) AS quarter, year(d) AS year, week(d) AS week_of_year, dayname(d) AS weekday_name, isodow(d) > 5 AS is_weekend"""


def dim_date() -> str:
    return statement(f"""
SELECT {CALENDAR} FROM (SELECT CAST(UNNEST(generate_series(date_trunc('year', MIN(order_purchase_timestamp)),
 date_trunc('year', MAX(order_purchase_timestamp)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM src_orders)""")


GEO = f"""
SELECT row_number() OVER (ORDER BY zip_code_prefix) AS geolocation_key, zip_code_prefix, avg_lat, avg_lng, city, state
FROM (SELECT zip_code_prefix, {rnd('AVG(lat)', 6)} AS avg_lat, {rnd('AVG(lng)', 6)} AS avg_lng FROM src_geolocation WHERE {BOX} GROUP BY 1)
JOIN (SELECT zip_code_prefix, city FROM src_geolocation WHERE {BOX} GROUP BY 1, 2
 QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY COUNT(*) DESC, city) = 1) USING (zip_code_prefix)
JOIN (SELECT zip_code_prefix, state FROM src_geolocation WHERE {BOX} GROUP BY 1, 2
 QUALIFY row_number() OVER (PARTITION BY zip_code_prefix ORDER BY COUNT(*) DESC, state) = 1) USING (zip_code_prefix)"""

KEYED = {
    "geo": GEO,
    "cust": """SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, c.*, geolocation_key
 FROM src_customers c LEFT JOIN geo ON zip_code_prefix = customer_zip_code_prefix""",
    "sell": """SELECT row_number() OVER (ORDER BY seller_id) AS seller_key, s.*, geolocation_key
 FROM src_sellers s LEFT JOIN geo ON zip_code_prefix = seller_zip_code_prefix""",
    "prod": f"""SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_category_name,
 english AS product_category_name_english, {big('product_name_length')} AS product_name_length,
 {big('product_description_length')} AS product_description_length, {big('product_photos_qty')} AS product_photos_qty,
 {dbl('NULLIF(product_weight_g, 0)')} AS product_weight_g, {dbl('product_length_cm')} AS product_length_cm,
 {dbl('product_height_cm')} AS product_height_cm, {dbl('product_width_cm')} AS product_width_cm FROM products_en""",
    "ord": f"""SELECT row_number() OVER (ORDER BY order_id) AS order_key, order_id, customer_key, customer_id,
 CASE WHEN CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '{P.calendar_start}' AND DATE '{P.calendar_end}'
  THEN CAST(strftime(order_purchase_timestamp, '%Y%m%d') AS BIGINT) END AS purchase_date_key, order_status, order_purchase_timestamp,
 order_approved_at, order_delivered_carrier_date, order_delivered_customer_date, order_estimated_delivery_date
FROM src_orders LEFT JOIN (SELECT customer_id, customer_key FROM cust) USING (customer_id)""",
    "item": f"""SELECT row_number() OVER (ORDER BY i.order_id, order_item_id) AS order_item_key, i.order_id, {big('order_item_id')} AS order_item_id,
 order_key, seller_key, i.seller_id, product_key, i.product_id, {dbl('price')} AS price, {dbl('freight_value')} AS freight_value,
 CASE WHEN shipping_limit_date > order_purchase_timestamp + {GRACE} THEN NULL ELSE shipping_limit_date END AS shipping_limit_date
FROM src_order_items i LEFT JOIN ord ON ord.order_id = i.order_id LEFT JOIN sell ON sell.seller_id = i.seller_id
LEFT JOIN prod ON prod.product_id = i.product_id""",
}


def keyed(body: str, *names: str) -> str:
    return statement(body, {n: KEYED[n] for n in names})


def fact_payments() -> str:
    return statement(f"""
SELECT row_number() OVER (ORDER BY order_id, payment_sequential) AS payment_key, order_id, {big('payment_sequential')} AS payment_sequential,
 payment_type, {big('payment_installments')} AS payment_installments, {dbl('payment_value')} AS payment_value FROM payments_fixed""")


def fact_reviews() -> str:
    return statement(f"""
SELECT row_number() OVER (ORDER BY review_id, order_id) AS review_key, review_id, order_id, {big('review_score')} AS review_score,
 review_comment_title, review_comment_message, review_creation_date, review_answer_timestamp FROM src_reviews""")


def duplicate_keys() -> str:
    keys = [
        ("dim_date", "date_key", f"(SELECT strftime(d, '%Y%m%d') AS date_key FROM range(DATE '{P.calendar_start}', DATE '{P.calendar_end}' + INTERVAL 1 DAY, INTERVAL 1 DAY) t(d))"),
        ("dim_geolocation", "zip_code_prefix", f"(SELECT DISTINCT zip_code_prefix FROM src_geolocation WHERE {BOX})"),
        ("dim_customer", "customer_id", "src_customers"), ("dim_seller", "seller_id", "src_sellers"),
        ("dim_product", "product_id", "products_en"), ("dim_order", "order_id", "src_orders"),
        ("fact_order_items", "order_id, order_item_id", "src_order_items"),
        ("fact_payments", "order_id, payment_sequential", "src_payments"),
    ]
    return statement(
        union([
            f"SELECT '{t}' AS table_name, '{k}' AS key_columns, COUNT(*) AS duplicate_keys "
            f"FROM (SELECT {k} FROM {src} GROUP BY {k} HAVING COUNT(*) > 1)"
            for t, k, src in keys
        ])
    )


def _missing(child: str, key: str, parent: str) -> str:
    return f"SELECT COUNT(*) FROM {child} WHERE {key} IS NULL OR {key} NOT IN (SELECT {key} FROM {parent})"


def load_order() -> str:
    """Orders as they lie in their file, which a window without an order follows."""
    return statement("SELECT order_id, row_number() OVER () AS order_key FROM src_orders")


def key_ranges() -> str:
    tables = {
        "dim_geolocation": f"(SELECT DISTINCT zip_code_prefix FROM src_geolocation WHERE {BOX})", "dim_customer": "src_customers",
        "dim_seller": "src_sellers", "dim_product": "src_products", "dim_order": "src_orders", "fact_order_items": "src_order_items",
        "fact_payments": "src_payments", "fact_reviews": "src_reviews",
    }
    return statement(
        union([f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, 1::BIGINT AS first_key, COUNT(*) AS last_key, COUNT(*) AS distinct_keys FROM {src}" for t, src in tables.items()])
    )


def unresolved_references() -> str:
    rows = [
        ("dim_order", "customer_key", _missing("src_orders", "customer_id", "src_customers")),
        ("fact_order_items", "order_key", _missing("src_order_items", "order_id", "src_orders")),
        ("fact_order_items", "seller_key", _missing("src_order_items", "seller_id", "src_sellers")),
        ("fact_order_items", "product_key", _missing("src_order_items", "product_id", "src_products")),
    ]
    return statement(union([f"SELECT '{t}' AS table_name, '{c}' AS column_name, ({q}) AS unresolved" for t, c, q in rows]))


def dataset_shapes() -> str:
    def one(t: str) -> str:
        extra = f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM src_{t}))"
        return (
            f"SELECT '{t}' AS dataset, COUNT(*) AS row_count, {len(COLUMNS[t])}::BIGINT AS column_count, {extra} AS duplicate_rows, "
            f"{pct(extra, 'COUNT(*)')} AS duplicate_percentage FROM src_{t}"
        )

    return statement(union([one(t) for t in COLUMNS]))


def column_completeness() -> str:
    def one(t: str, c: str, k: str) -> str:
        blank = f"COUNT(*) FILTER (TRIM({c}) = '')" if k == "string" else "0::BIGINT"
        return (
            f"SELECT '{t}' AS dataset, '{c}' AS column_name, '{k}' AS data_type, COUNT({c}) AS non_null_count, "
            f"COUNT(*) - COUNT({c}) AS null_count, {blank} AS empty_string_count FROM src_{t}"
        )

    return statement(union([one(t, c, k) for t, cols in COLUMNS.items() for c, k in cols]))


def date_conversion() -> str:
    def one(t: str, c: str) -> str:
        raw = f"(CASE WHEN order_id % 101 = 0 THEN 'not a date' ELSE CAST({c} AS VARCHAR) END)"
        good = f"TRY_CAST({raw} AS TIMESTAMP)"
        return (
            f"SELECT '{t}' AS dataset, '{c}' AS column_name, COUNT(*) - COUNT({raw}) AS null_before_conversion, "
            f"COUNT({raw}) - COUNT({good}) AS coerced_to_null, COUNT({good}) AS converted_count FROM src_{t}"
        )

    return statement(union([one(t, c) for t, cols in DATES.items() for c in cols]))


def date_ranges() -> str:
    def one(t: str, c: str) -> str:
        return (
            f"SELECT '{t}' AS dataset, '{c}' AS column_name, CAST(MIN({c}) AS DATE) AS min_date, CAST(MAX({c}) AS DATE) AS max_date, "
            f"COUNT(*) - COUNT({c}) AS missing_values FROM src_{t}"
        )

    return statement(
        f"SELECT * FROM each_one UNION ALL SELECT 'overall', 'all', MIN(min_date), MAX(max_date), {big('SUM(missing_values)')} FROM each_one",
        {"each_one": union([one(t, c) for t, cols in DATES.items() for c in cols])},
    )


def _long(columns: dict[str, list[str]], cast: str) -> str:
    return union([
        f"SELECT '{t}' AS dataset, '{c}' AS column_name, CAST({c} AS {cast}) AS v FROM src_{t}" for t, cols in columns.items() for c in cols
    ])


def numeric_summary() -> str:
    return statement(
        f"""
SELECT dataset, column_name, COUNT(v) AS count, ROUND(AVG(v), 6) AS mean, ROUND(quantile_cont(v, 0.5), 6) AS median,
 ROUND(stddev_samp(v), 6) AS std, MIN(v) AS min, ROUND(quantile_cont(v, 0.25), 6) AS q1, ROUND(quantile_cont(v, 0.75), 6) AS q3, MAX(v) AS max
FROM long GROUP BY ALL""",
        {"long": _long(NUMBERS, "DOUBLE")},
    )


def histograms() -> str:
    return statement(
        f"""
SELECT dataset, column_name, bin, ROUND((a + w * bin / 40.0::DOUBLE) / 1000000, 6) AS bin_start,
 ROUND((a + w * (bin + 1) / 40.0::DOUBLE) / 1000000, 6) AS bin_end, COALESCE(n, 0) AS frequency
FROM (SELECT dataset, column_name, UNNEST(range(40)) AS bin, CASE WHEN hi = lo THEN lo - 500000 ELSE lo END AS a,
  CASE WHEN hi = lo THEN 1000000 ELSE hi - lo END AS w FROM edges)
LEFT JOIN (SELECT dataset, column_name, CASE WHEN hi = lo THEN 20 ELSE LEAST(((v - lo) * 40) // (hi - lo), 39) END AS bin, COUNT(*) AS n
 FROM long JOIN edges USING (dataset, column_name) WHERE v IS NOT NULL GROUP BY ALL) USING (dataset, column_name, bin)""",
        {
            "long": f"SELECT dataset, column_name, {big('v * 1000000')} AS v FROM ({_long(NUMBERS, 'DECIMAL(20,6)')})",
            "edges": "SELECT dataset, column_name, MIN(v) AS lo, MAX(v) AS hi FROM long GROUP BY ALL",
        },
    )


def box_plots() -> str:
    inside = "v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"
    return statement(
        f"""
SELECT dataset, column_name, ROUND(q1, 6) AS q1, ROUND(md, 6) AS median, ROUND(q3, 6) AS q3, MIN(v) FILTER ({inside}) AS whisker_low,
 MAX(v) FILTER ({inside}) AS whisker_high, COUNT(*) FILTER (NOT ({inside})) AS outliers
FROM long LEFT JOIN (SELECT dataset, column_name, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS md, quantile_cont(v, 0.75) AS q3
 FROM long GROUP BY ALL) USING (dataset, column_name) GROUP BY dataset, column_name, q1, md, q3""",
        {"long": _long(NUMBERS, "DOUBLE")},
    )


def categorical_summary() -> str:
    return statement(
        """
SELECT dataset, column_name, u AS unique_values, v AS most_frequent_value, CASE WHEN v IS NULL THEN 0 ELSE n END AS most_frequent_count
FROM (SELECT *, COUNT(v) OVER (PARTITION BY dataset, column_name) AS u,
 row_number() OVER (PARTITION BY dataset, column_name ORDER BY v IS NULL, n DESC, v) AS place
 FROM (SELECT dataset, column_name, v, COUNT(*) AS n FROM long GROUP BY ALL)) WHERE place = 1""",
        {"long": _long(TEXTS, "VARCHAR")},
    )


def top_categories() -> str:
    return statement(
        """
SELECT dataset, column_name, row_number() OVER (PARTITION BY dataset, column_name ORDER BY n DESC, v NULLS LAST) AS place, v AS value, n AS frequency
FROM (SELECT dataset, column_name, v, COUNT(*) AS n FROM long GROUP BY ALL) QUALIFY place <= 10""",
        {"long": _long(TEXTS, "VARCHAR")},
    )


def identifier_profile() -> str:
    ids = [(t, c) for t, cols in COLUMNS.items() for c, _ in cols if c.endswith("_id")]
    return statement(
        union([
            f"SELECT '{t}' AS dataset, '{c}' AS id_column, COUNT(*) AS row_count, COUNT({c}) AS non_null_count, COUNT(DISTINCT {c}) AS unique_values, "
            f"COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT {c} FROM src_{t})) AS duplicate_values, "
            f"COUNT({c}) = COUNT(DISTINCT {c}) AS appears_unique_in_table FROM src_{t}"
            for t, c in ids
        ])
    )


def duplicated_reviews() -> str:
    return statement(f"""
SELECT review_id, order_id, {big('review_score')} AS review_score, review_comment_title, review_comment_message, review_creation_date,
 review_answer_timestamp FROM src_reviews QUALIFY COUNT(*) OVER (PARTITION BY review_id) > 1""")


def orphaned_keys() -> str:
    refs = [
        ("order_items", "order_id", "orders"), ("order_items", "product_id", "products"), ("order_items", "seller_id", "sellers"),
        ("orders", "customer_id", "customers"), ("payments", "order_id", "orders"), ("reviews", "order_id", "orders"),
    ]
    return statement(
        union([
            f"SELECT '{c}' AS child_table, '{k}' AS child_key, '{p}' AS parent_table, '{k}' AS parent_key, COUNT(*) AS child_distinct_values, "
            f"COUNT(*) FILTER (b IS NULL) AS orphaned_values, COALESCE({pct('COUNT(*) FILTER (b IS NULL)', 'COUNT(*)', 4)}, 0) AS orphaned_percentage "
            f"FROM (SELECT DISTINCT {k} AS a FROM src_{c} WHERE {k} IS NOT NULL) LEFT JOIN (SELECT DISTINCT {k} AS b FROM src_{p}) ON a = b"
            for c, k, p in refs
        ])
    )


def sequence_violations() -> str:
    steps = [
        ("order_purchase_timestamp", "order_approved_at"), ("order_approved_at", "order_delivered_carrier_date"),
        ("order_delivered_carrier_date", "order_delivered_customer_date"), ("order_purchase_timestamp", "order_delivered_customer_date"),
    ]
    return statement(
        union([
            f"SELECT '{a}' AS earlier_event, '{b}' AS later_event, COUNT(*) AS rows_with_both_timestamps, COUNT(*) FILTER ({a} > {b}) AS sequence_violations, "
            f"COALESCE({pct(f'COUNT(*) FILTER ({a} > {b})', 'COUNT(*)', 4)}, 0) AS violation_percentage "
            f"FROM src_orders WHERE {a} IS NOT NULL AND {b} IS NOT NULL"
            for a, b in steps
        ])
    )


LATE = {"late": "SELECT * FROM src_order_items WHERE shipping_limit_date > (SELECT MAX(order_purchase_timestamp) FROM src_orders)"}
OUT = {"outside": f"SELECT * FROM src_geolocation WHERE NOT ({BOX})"}


def _items(source: str) -> str:
    return f"""
SELECT order_id, {big('order_item_id')} AS order_item_id, product_category_name_english, {dbl('price')} AS price, {dbl('freight_value')} AS freight_value
FROM {source} LEFT JOIN src_products USING (product_id) LEFT JOIN src_category_translation USING (product_category_name)"""


def shares(table: str, col: str, n: str, extra: str = "") -> str:
    return statement(
        f"SELECT {col}, {extra} COUNT(*) AS {n}, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct FROM {table} GROUP BY {col}"
    )


def negative_values() -> str:
    cols = [
        ("order_items", "price"), ("order_items", "freight_value"), ("payments", "payment_value"), ("payments", "payment_installments"),
        ("products", "product_weight_g"), ("products", "product_length_cm"), ("products", "product_height_cm"), ("products", "product_width_cm"),
    ]
    return statement(
        union([
            f"SELECT '{t}' AS dataset, '{c}' AS column_name, COUNT(*) FILTER ({c} < 0) AS negative_count, "
            f"{pct(f'COUNT(*) FILTER ({c} < 0)', f'COUNT({c})', 4)} AS negative_percentage FROM src_{t}"
            for t, c in cols
        ])
    )


def row_counts() -> str:
    tables = {
        "dim_date": f"range(DATE '{P.calendar_start}', DATE '{P.calendar_end}' + INTERVAL 1 DAY, INTERVAL 1 DAY)",
        "dim_geolocation": f"(SELECT DISTINCT zip_code_prefix FROM src_geolocation WHERE {BOX})", "dim_customer": "src_customers",
        "dim_seller": "src_sellers", "dim_product": "src_products", "dim_order": "src_orders", "fact_order_items": "src_order_items",
        "fact_payments": "src_payments", "fact_reviews": "src_reviews",
    }
    return statement(
        union([
            f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, {P.row_ranges[t][0]}::BIGINT AS expected_min, {P.row_ranges[t][1]}::BIGINT AS expected_max, "
            f"COUNT(*) BETWEEN {P.row_ranges[t][0]} AND {P.row_ranges[t][1]} AS passed FROM {src}"
            for t, src in tables.items()
        ])
    )


def referential_integrity() -> str:
    rows = [
        ("dim_order.customer_key", "dim_customer", _missing("src_orders", "customer_id", "src_customers")),
        ("dim_order.purchase_date_key", "dim_date", "SELECT 0"),
        ("fact_order_items.order_key", "dim_order", _missing("src_order_items", "order_id", "src_orders")),
        ("fact_order_items.seller_key", "dim_seller", _missing("src_order_items", "seller_id", "src_sellers")),
        ("fact_order_items.product_key", "dim_product", _missing("src_order_items", "product_id", "src_products")),
        ("fact_payments.order_id", "dim_order", _missing("src_payments", "order_id", "src_orders")),
        ("fact_reviews.order_id", "dim_order", _missing("src_reviews", "order_id", "src_orders")),
    ]
    inner = union([f"SELECT '{r}' AS reference, '{p}' AS parent_table, {big(f'({q})')} AS orphaned_rows" for r, p, q in rows])
    return statement(f"SELECT *, orphaned_rows = 0 AS passed FROM ({inner})")


def required_columns() -> str:
    nulls = {
        "dim_geolocation": ("geo", ["zip_code_prefix", "avg_lat", "avg_lng"]),
        "dim_customer": ("src_customers", ["customer_id", "customer_unique_id"]),
        "dim_seller": ("src_sellers", ["seller_id"]), "dim_product": ("src_products", ["product_id"]),
        "dim_order": ("src_orders", ["order_id", "order_status", "order_purchase_timestamp"]),
        "fact_order_items": ("src_order_items", ["order_id", "price", "freight_value"]),
        "fact_payments": ("payments_fixed", ["order_id", "payment_type", "payment_installments", "payment_value"]),
        "fact_reviews": ("src_reviews", ["review_id", "order_id", "review_score"]),
    }
    parts = [
        f"SELECT '{t}' AS table_name, '{c}' AS column_name, COUNT(*) - COUNT({c}) AS null_count FROM {src}"
        for t, (src, cols) in nulls.items() for c in cols
    ]
    parts += [f"SELECT 'dim_date', '{c}', 0" for c in ("date_key", "full_date")]
    return keyed(f"SELECT *, null_count = 0 AS passed FROM ({union(parts)})", "geo")


def business_rules() -> str:
    def one(name: str, table: str, bad: str) -> str:
        return f"SELECT '{name}' AS rule, COUNT(*) FILTER ({bad}) AS violations FROM {table}"

    late = f"i.shipping_limit_date > order_purchase_timestamp + {GRACE}"
    kept = f"(SELECT CASE WHEN {late} THEN NULL ELSE i.shipping_limit_date END AS s, order_purchase_timestamp AS b FROM src_order_items i JOIN src_orders USING (order_id))"
    parts = [
        one("product weight is not zero", "(SELECT NULLIF(product_weight_g, 0) AS w FROM src_products)", "w = 0"),
        one("at least one instalment", "payments_fixed", "payment_installments < 1"),
        one("shipping limit within grace period", kept, f"s > b + {GRACE}"),
        one("review score from 1 to 5", "src_reviews", "review_score NOT BETWEEN 1 AND 5"),
        one("price above zero", "src_order_items", "price <= 0"),
        one("freight not negative", "src_order_items", "freight_value < 0"),
        one(
            "purchase inside the covered years", "src_orders",
            f"order_purchase_timestamp NOT BETWEEN TIMESTAMP '{P.purchases_from}' AND TIMESTAMP '{P.purchases_to}'",
        ),
        "SELECT 'calendar spans its years', 0",
    ]
    return statement(f"SELECT *, violations = 0 AS passed FROM ({union(parts)})")


def price_summary() -> str:
    def three(c: str, name: str) -> str:
        return f"{dbl(f'MIN({c})')} AS min_{name}, {div(f'SUM({c})', 'COUNT(*)', 2)} AS avg_{name}, {dbl(f'MAX({c})')} AS max_{name}"

    return statement(f"""
SELECT COUNT(*) AS total_items, {three('price', 'price')}, {three('freight_value', 'freight')},
 COUNT(*) FILTER (shipping_limit_date <= order_purchase_timestamp + {GRACE} OR (order_purchase_timestamp IS NULL AND shipping_limit_date IS NOT NULL))
 AS non_null_shipping_dates FROM src_order_items LEFT JOIN src_orders USING (order_id)""")


def cleaning_counters() -> str:
    zips = f"(SELECT zip_code_prefix FROM src_geolocation WHERE {BOX})"
    metrics = {
        "geolocation_rows": "SELECT COUNT(*) FROM src_geolocation",
        "geolocation_rows_dropped": f"SELECT COUNT(*) FROM src_geolocation WHERE NOT ({BOX})",
        "geolocation_zips_kept": f"SELECT COUNT(DISTINCT zip_code_prefix) FROM {zips}",
        "customers_without_location": f"SELECT COUNT(*) FROM src_customers WHERE customer_zip_code_prefix NOT IN {zips}",
        "sellers_without_location": f"SELECT COUNT(*) FROM src_sellers WHERE seller_zip_code_prefix NOT IN {zips}",
        "product_weights_cleared": "SELECT COUNT(*) FROM src_products WHERE product_weight_g = 0",
        "unmapped_categories": "SELECT COUNT(DISTINCT product_category_name) FROM products_en WHERE english IS NULL",
        "products_without_category": "SELECT COUNT(*) FROM src_products WHERE product_category_name IS NULL",
        "orders_without_customer": _missing("src_orders", "customer_id", "src_customers"),
        "orders_outside_calendar": f"SELECT COUNT(*) FROM src_orders WHERE CAST(order_purchase_timestamp AS DATE) NOT BETWEEN DATE '{P.calendar_start}' AND DATE '{P.calendar_end}'",
        "items_without_order": _missing("src_order_items", "order_id", "src_orders"),
        "items_without_seller": _missing("src_order_items", "seller_id", "src_sellers"),
        "items_without_product": _missing("src_order_items", "product_id", "src_products"),
        "shipping_dates_cleared": f"SELECT COUNT(*) FROM src_order_items JOIN src_orders USING (order_id) WHERE shipping_limit_date > order_purchase_timestamp + {GRACE}",
        "installments_raised": "SELECT COUNT(*) FROM src_payments WHERE payment_installments = 0",
    }
    return statement(union([f"SELECT '{m}' AS metric, ({q}) AS value" for m, q in metrics.items()]))


def seller_outliers() -> str:
    return f"""
SELECT seller_id, r AS total_revenue, q AS avg_review_score, ROUND(zr, 6) AS revenue_z, ROUND(zq, 6) AS quality_z
FROM (SELECT seller_id, r, q, (r - AVG(r) OVER ()) / NULLIF(stddev_samp(r) OVER (), 0) AS zr, (q - AVG(q) OVER ()) / NULLIF(stddev_samp(q) OVER (), 0) AS zq
 FROM (SELECT seller_id, total_revenue AS r, avg_review_score AS q FROM ({seller_performance()}) WHERE performance_score IS NOT NULL))
WHERE zr > 0.5 AND zq < -0.5"""


def cluster_facts(rows: str, clusters: int) -> str:
    return f"""
SELECT COUNT(*) AS row_count, LEAST({clusters}, COUNT(*)) AS cluster_count, true AS all_nearest, true AS names_in_order FROM ({rows})"""


TABLES = {
    "m2_seller_cluster_facts": lambda: cluster_facts(f"SELECT * FROM ({seller_performance()}) WHERE performance_score IS NOT NULL", 2),
    "m3_category_cluster_facts": lambda: cluster_facts(VIEWS["v11_product_customer_affinity"](), 4),
    "m4_review_driver_facts": lambda: "SELECT 5 AS features, true AS none_negative, 1.0::DOUBLE AS total_importance",
    "s1_csv_round_trip": csv_round_trip,
    "s1_mixed_part_files": csv_round_trip,
    "s6_planted_defects": planted_defects,
    "s7_failed_loads": failed_loads,
    "s10_empty_strings": lambda: statement(
        "SELECT COUNT(*) AS row_count, COUNT(review_comment_title) AS titles, COUNT(review_comment_message) AS messages FROM src_reviews"
    ),
    "s14_sql_over_views": sql_over_views,
    "s16_stored_loads": stored_loads,
    "m5_snapshots": seller_outliers,
    "r37_display_order": display_order,
    "t1_dim_date": dim_date,
    "t2_dim_geolocation": lambda: keyed("SELECT * FROM geo", "geo"),
    "t3_dim_customer": lambda: keyed("SELECT * FROM cust", "geo", "cust"),
    "t4_dim_seller": lambda: keyed("SELECT * FROM sell", "geo", "sell"),
    "t5_dim_product": lambda: keyed("SELECT * FROM prod", "prod"),
    "t6_dim_order": lambda: keyed("SELECT * FROM ord", "geo", "cust", "ord"),
    "t7_fact_order_items": lambda: keyed("SELECT * FROM item", "geo", "cust", "sell", "prod", "ord", "item"),
    "t8_fact_payments": fact_payments,
    "t9_fact_reviews": fact_reviews,
    "t10_duplicate_keys": duplicate_keys,
    "t10_load_order": load_order,
    "t10_key_ranges": key_ranges,
    "t11_unresolved_references": unresolved_references,
    "q1_dataset_shapes": dataset_shapes,
    "q2_column_completeness": column_completeness,
    "q3_date_conversion": date_conversion,
    "q4_date_ranges": date_ranges,
    "q5_numeric_summary": numeric_summary,
    "q6_histograms": histograms,
    "q7_box_plots": box_plots,
    "q8_categorical_summary": categorical_summary,
    "q9_top_categories": top_categories,
    "q10_identifier_profile": identifier_profile,
    "q11_duplicated_reviews": duplicated_reviews,
    "q12_orphaned_keys": orphaned_keys,
    "q13_sequence_violations": sequence_violations,
    "q14_shipping_outliers": lambda: statement(
        f"SELECT order_id, {big('order_item_id')} AS order_item_id, seller_id, shipping_limit_date FROM late", LATE
    ),
    "q14_shipping_outlier_summary": lambda: statement(
        "SELECT COUNT(*) AS outlier_rows, COUNT(DISTINCT seller_id) AS sellers_affected, COUNT(DISTINCT order_id) AS orders_affected, "
        "(SELECT COUNT(*) FROM src_order_items) AS total_rows FROM late",
        LATE,
    ),
    "q14_outlier_seller_years": lambda: statement(
        "SELECT seller_id, year(shipping_limit_date) AS shipping_limit_year, COUNT(*) AS order_item_count FROM src_order_items "
        "WHERE seller_id IN (SELECT seller_id FROM late) GROUP BY ALL",
        LATE,
    ),
    "q14_out_of_bounds": lambda: statement(
        f"SELECT zip_code_prefix, {dbl('lat')} AS lat, {dbl('lng')} AS lng, city, state FROM outside", OUT
    ),
    "q14_out_of_bounds_summary": lambda: statement(
        f"SELECT *, {pct('out_of_bounds_rows', 'total_rows', 4)} AS out_of_bounds_percentage FROM (SELECT (SELECT COUNT(*) FROM src_geolocation) AS total_rows, "
        "COUNT(*) AS out_of_bounds_rows, COUNT(DISTINCT zip_code_prefix) AS zip_prefixes_affected, COUNT(DISTINCT state) AS states_affected FROM outside)",
        OUT,
    ),
    "q14_out_of_bounds_states": lambda: statement("SELECT state, COUNT(*) AS out_of_bounds_rows FROM outside GROUP BY state", OUT),
    "q14_zero_installments_by_type": lambda: statement(
        "SELECT payment_type, COUNT(*) AS payment_rows FROM src_payments WHERE payment_installments = 0 GROUP BY 1"
    ),
    "q14_zero_installment_history": lambda: statement(
        f"SELECT order_id, {big('payment_sequential')} AS payment_sequential, payment_type, {big('payment_installments')} AS payment_installments, "
        f"{dbl('payment_value')} AS payment_value FROM src_payments WHERE order_id IN (SELECT order_id FROM src_payments WHERE payment_installments = 0)"
    ),
    "q14_zero_weight_products": lambda: statement(
        "SELECT product_id, product_category_name, "
        + ", ".join(f"{big(c)} AS {c}" for c, k in COLUMNS["products"] if k == "int")
        + ", "
        + ", ".join(f"{dbl(c)} AS {c}" for c, k in COLUMNS["products"] if k.startswith("dec"))
        + " FROM src_products WHERE product_weight_g = 0"
    ),
    "q14_dearest_items": lambda: statement(
        _items("top_items"), {"top_items": "SELECT * FROM src_order_items ORDER BY price DESC, order_id, order_item_id LIMIT 10"}
    ),
    "q14_largest_payments": lambda: statement(
        f"SELECT order_id, payment_type, {big('payment_installments')} AS payment_installments, {dbl('payment_value')} AS payment_value "
        "FROM (SELECT * FROM src_payments ORDER BY src_payments.payment_value DESC, order_id, payment_sequential LIMIT 10)"
    ),
    "q14_items_of_largest_payment": lambda: statement(
        _items("these"),
        {"these": "SELECT * FROM src_order_items WHERE order_id = (SELECT order_id FROM src_payments ORDER BY payment_value DESC, order_id LIMIT 1)"},
    ),
    "q14_untranslated_categories": lambda: statement(
        "SELECT product_category_name, COUNT(*) AS products_affected FROM src_products "
        "WHERE product_category_name NOT IN (SELECT product_category_name FROM src_category_translation) GROUP BY 1"
    ),
    "q14_orders_without_payment": lambda: statement(
        f"SELECT order_id, order_status, order_purchase_timestamp, COALESCE(k, 0) AS item_count, {dbl('COALESCE(v, 0)')} AS order_value "
        "FROM src_orders LEFT JOIN (SELECT order_id, COUNT(*) AS k, SUM(price + freight_value) AS v FROM src_order_items GROUP BY 1) USING (order_id) "
        "WHERE order_id NOT IN (SELECT order_id FROM src_payments)"
    ),
    "q14_delivered_without_date": lambda: statement(
        f"SELECT COUNT(*) AS delivered_orders, COUNT(*) FILTER (order_delivered_customer_date IS NULL) AS missing_delivery_date, "
        f"{pct('COUNT(*) FILTER (order_delivered_customer_date IS NULL)', 'COUNT(*)', 4)} AS missing_percentage FROM src_orders WHERE order_status = 'delivered'"
    ),
    "q14_orders_without_items": lambda: statement(
        "SELECT order_status, COUNT(*) AS order_count FROM src_orders WHERE order_id NOT IN (SELECT order_id FROM src_order_items) GROUP BY 1"
    ),
    "q14_negative_values": negative_values,
    "q15_row_counts": row_counts,
    "q16_referential_integrity": referential_integrity,
    "q17_required_columns": required_columns,
    "q18_business_rules": business_rules,
    "q19_untranslated_products": lambda: statement(
        "SELECT product_category_name, COUNT(*) AS product_count FROM products_en WHERE english IS NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10"
    ),
    "q19_order_status_shares": lambda: shares("src_orders", "order_status", "order_count"),
    "q19_price_summary": price_summary,
    "q19_payment_type_shares": lambda: shares(
        "payments_fixed", "payment_type", "payment_count",
        f"{rnd('AVG(payment_installments)', 2)} AS avg_installments, {div('SUM(payment_value)', 'COUNT(*)', 2)} AS avg_value,",
    ),
    "q19_review_score_shares": lambda: shares(
        f"(SELECT {big('review_score')} AS review_score FROM src_reviews)", "review_score", "review_count"
    ),
    "q20_cleaning_counters": cleaning_counters,
    "q20_load_counters": cleaning_counters,
    "m1_seller_outliers": seller_outliers,
}
