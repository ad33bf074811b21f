"""Validation of the loaded warehouse, and the counters of its cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.functions.scalars import agg, cents, percent, ratio
from stallbook.operators.joins import count_without_key_in
from stallbook.operators.key_presence import reference_counts
from stallbook.params import Params
from stallbook.plans.warehouse import inside_box
from stallbook.quality.profile import Frames, small_table, union_all
from stallbook.schemas import REQUIRED

# References inside the warehouse; the date may be missing on purpose.
WAREHOUSE_REFERENCES = [
    ("dim_order", "customer_key", "dim_customer", "customer_key", False),
    ("dim_order", "purchase_date_key", "dim_date", "date_key", True),
    ("fact_order_items", "order_key", "dim_order", "order_key", False),
    ("fact_order_items", "seller_key", "dim_seller", "seller_key", False),
    ("fact_order_items", "product_key", "dim_product", "product_key", False),
    ("fact_payments", "order_id", "dim_order", "order_id", False),
    ("fact_reviews", "order_id", "dim_order", "order_id", False),
]


def row_counts(warehouse: Frames, ranges: dict[str, tuple[int, int]]) -> DataFrame:
    """Rows per table against the accepted range."""

    def of(table: str, low: int, high: int) -> DataFrame:
        return warehouse[table].selectExpr("count(1) AS row_count").selectExpr(
            f"'{table}' AS table_name", "row_count", f"{low}L AS expected_min", f"{high}L AS expected_max",
            f"row_count BETWEEN {low} AND {high} AS passed",
        )

    return union_all([of(table, *ranges[table]) for table in warehouse if table in ranges])


def referential_integrity(warehouse: Frames) -> DataFrame:
    """Rows whose reference does not resolve; all references from one pass over their keys. A missing key counts where it is mandatory."""
    spark = next(iter(warehouse.values())).sparkSession
    names = [{"at": i, "reference": f"{child}.{key}", "parent_table": parent, "optional": optional} for i, (child, key, parent, _, optional) in enumerate(WAREHOUSE_REFERENCES)]
    told = small_table(spark, names, "at:int,reference:string,parent_table:string,optional:boolean")
    lost = reference_counts(warehouse, [r[:4] for r in WAREHOUSE_REFERENCES]).join(F.broadcast(told), "at")
    lost = lost.selectExpr("reference", "parent_table", "lost_rows + CASE WHEN optional THEN 0 ELSE null_rows END AS orphaned_rows")
    return lost.selectExpr("*", "orphaned_rows = 0 AS passed")


def required_columns(warehouse: Frames) -> DataFrame:
    """Missing values in the mandatory columns; one pass per table."""

    def of(table: str, columns: list[str]) -> DataFrame:
        counts = warehouse[table].selectExpr(*[f"count_if({c} IS NULL) AS {c}" for c in columns])
        long = counts.unpivot([], columns, "column_name", "null_count")
        return long.selectExpr(f"'{table}' AS table_name", "column_name", "null_count", "null_count = 0 AS passed")

    return union_all([of(table, cols) for table, cols in REQUIRED.items() if table in warehouse])


def business_rules(warehouse: Frames, params: Params) -> DataFrame:
    """Violations of the eight cleaning rules."""

    def rule(name: str, counted: DataFrame) -> DataFrame:
        return counted.selectExpr(f"'{name}' AS rule", "violations", "violations = 0 AS passed")

    def simple(name: str, table: str, bad: str) -> DataFrame:
        return rule(name, warehouse[table].selectExpr(f"count_if({bad}) AS violations"))

    items = warehouse["fact_order_items"].select("order_id", "shipping_limit_date").filter("shipping_limit_date IS NOT NULL")
    orders = warehouse["dim_order"].select("order_id", "order_purchase_timestamp")
    late = f"shipping_limit_date > order_purchase_timestamp + interval {params.shipping_grace_days} days"
    span = (
        f"CASE WHEN min(full_date) = DATE '{params.calendar_start}' AND max(full_date) = DATE '{params.calendar_end}' "
        "THEN 0L ELSE 1L END AS violations"
    )
    early_or_late = (
        f"order_purchase_timestamp < TIMESTAMP_NTZ '{params.purchases_from}' "
        f"OR order_purchase_timestamp > TIMESTAMP_NTZ '{params.purchases_to}'"
    )
    return union_all(
        [
            simple("product weight is not zero", "dim_product", "product_weight_g = 0"),
            simple("at least one instalment", "fact_payments", "payment_installments < 1"),
            rule(
                "shipping limit within grace period",
                items.join(orders, "order_id").selectExpr(f"count_if({late}) AS violations"),
            ),
            simple("review score from 1 to 5", "fact_reviews", "review_score NOT BETWEEN 1 AND 5"),
            simple("price above zero", "fact_order_items", "price <= 0"),
            simple("freight not negative", "fact_order_items", "freight_value < 0"),
            simple("purchase inside the covered years", "dim_order", early_or_late),
            rule("calendar spans its years", warehouse["dim_date"].selectExpr(span)),
        ]
    )


def _with_share(counts: DataFrame, n: str) -> DataFrame:
    """Add each row's share of all; the input is one row per category."""
    return counts.selectExpr("*", f"{percent(n, f'sum({n}) OVER ()')} AS pct")


def untranslated_products(warehouse: Frames, k: int = 10) -> DataFrame:
    rows = warehouse["dim_product"].filter("product_category_name_english IS NULL")
    counts = agg(rows, ["product_category_name"], product_count="count(1)")
    return counts.orderBy("product_count", "product_category_name", ascending=[False, True]).limit(k)


def order_status_shares(warehouse: Frames) -> DataFrame:
    return _with_share(agg(warehouse["dim_order"], ["order_status"], order_count="count(1)"), "order_count")


def price_summary(warehouse: Frames) -> DataFrame:
    def mean_of(column: str) -> str:
        return f"{ratio(f'sum({cents(column)})', 'count(1) * 100', 2)}"

    return warehouse["fact_order_items"].selectExpr(
        "count(1) AS total_items",
        "min(price) AS min_price", f"{mean_of('price')} AS avg_price", "max(price) AS max_price",
        "min(freight_value) AS min_freight", f"{mean_of('freight_value')} AS avg_freight", "max(freight_value) AS max_freight",
        "count(shipping_limit_date) AS non_null_shipping_dates",
    )


def payment_type_shares(warehouse: Frames) -> DataFrame:
    counts = agg(
        warehouse["fact_payments"],
        ["payment_type"],
        payment_count="count(1)",
        avg_installments=ratio("sum(CAST(payment_installments AS BIGINT))", "count(payment_installments)", 2),
        avg_value=ratio(f"sum({cents('payment_value')})", "count(payment_value) * 100", 2),
    )
    return _with_share(counts, "payment_count")


def review_score_shares(warehouse: Frames) -> DataFrame:
    return _with_share(agg(warehouse["fact_reviews"], ["review_score"], review_count="count(1)"), "review_count")


def outside_calendar(params: Params) -> str:
    return (
        f"CAST(order_purchase_timestamp AS DATE) NOT BETWEEN DATE '{params.calendar_start}' AND DATE '{params.calendar_end}' "
        "OR order_purchase_timestamp IS NULL"
    )


def staging_rules(params: Params) -> dict[str, dict[str, str]]:
    """Counters that a staging table's rows decide alone, as aggregates."""
    return {
        "geolocation": {"geolocation_rows": "count(1)", "geolocation_rows_dropped": f"count_if(NOT coalesce({inside_box(params)}, false))"},
        "products": {"product_weights_cleared": "count_if(product_weight_g = 0)"},
        "orders": {"orders_outside_calendar": f"count_if({outside_calendar(params)})"},
        "payments": {"installments_raised": "count_if(payment_installments = 0)"},
    }


# Counters of lookups, as aggregates over a finished warehouse table with its keys.
LOOKUP_RULES: dict[str, dict[str, str]] = {
    "dim_geolocation": {"geolocation_zips_kept": "count(1)"},
    "dim_customer": {"customers_without_location": "count_if(geolocation_key IS NULL)"},
    "dim_seller": {"sellers_without_location": "count_if(geolocation_key IS NULL)"},
    "dim_product": {"products_without_category": "count_if(product_category_name IS NULL)"},
    "dim_order": {"orders_without_customer": "count_if(customer_key IS NULL)"},
    "fact_order_items": {
        "items_without_seller": "count_if(seller_key IS NULL)",
        "items_without_product": "count_if(product_key IS NULL)",
        "items_without_order": "count_if(order_key IS NULL)",
        "shipping_dates_cleared": "count_if(_date_cleared)",
    },
}


def unmapped_categories(products: DataFrame) -> DataFrame:
    """One row: distinct categories without an English name."""
    return products.selectExpr("count(DISTINCT CASE WHEN product_category_name_english IS NULL THEN product_category_name END) AS unmapped_categories")


def cleaning_counters(staging: Frames, cleaned: Frames, params: Params) -> DataFrame:
    """What the cleaning rules changed, and which lookups found nothing, by passes of its own; ``plans.loading`` counts as it loads."""

    def lines(df: DataFrame, **metrics: str) -> DataFrame:
        counts = df.selectExpr(*[f"{text} AS {name}" for name, text in metrics.items()])
        return counts.unpivot([], list(metrics), "metric", "value")

    def unmatched(name: str, child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
        return lines(count_without_key_in(child, parent, key, "missing"), **{name: "missing"})

    zips = cleaned["dim_geolocation"].select("zip_code_prefix")
    orders, items = staging["orders"], staging["order_items"]
    products = cleaned["dim_product"]
    no_name = "product_category_name_english IS NULL AND product_category_name IS NOT NULL"
    rules = staging_rules(params)
    late = f"shipping_limit_date > order_purchase_timestamp + interval {params.shipping_grace_days} days"

    def by_zip(table: str, column: str) -> DataFrame:
        return cleaned[table].selectExpr(f"{column} AS zip_code_prefix")

    return union_all(
        [
            lines(staging["geolocation"], **rules["geolocation"]),
            lines(zips, geolocation_zips_kept="count(1)"),
            unmatched("customers_without_location", by_zip("dim_customer", "customer_zip_code_prefix"), zips, "zip_code_prefix"),
            unmatched("sellers_without_location", by_zip("dim_seller", "seller_zip_code_prefix"), zips, "zip_code_prefix"),
            lines(staging["products"], **rules["products"]),
            lines(
                products,
                unmapped_categories=f"count(DISTINCT CASE WHEN {no_name} THEN product_category_name END)",
                products_without_category="count_if(product_category_name IS NULL)",
            ),
            unmatched("orders_without_customer", orders, staging["customers"], "customer_id"),
            lines(orders, **rules["orders"]),
            unmatched("items_without_seller", items, staging["sellers"], "seller_id"),
            unmatched("items_without_product", items, staging["products"], "product_id"),
            lines(
                items.join(orders.selectExpr("order_id", "order_purchase_timestamp", "true AS _found"), "order_id", "left"),
                items_without_order="count_if(_found IS NULL)",
                shipping_dates_cleared=f"count_if({late})",
            ),
            lines(staging["payments"], **rules["payments"]),
        ]
    )
