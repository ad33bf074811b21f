"""Investigations of the source tables: keys, sequences and rule violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.functions.scalars import add, agg, money, cents, percent
from stallbook.operators.joins import rows_with_key_in, rows_without_key_in
from stallbook.operators.key_presence import reference_counts
from stallbook.params import Params
from stallbook.plans.warehouse import inside_box
from stallbook.quality.profile import Frames, small_table, union_all

# Foreign keys between the source tables.
REFERENCES = [
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("order_items", "seller_id", "sellers", "seller_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("reviews", "order_id", "orders", "order_id"),
]

# Order events that should not happen in reverse.
SEQUENCES = [
    ("order_purchase_timestamp", "order_approved_at"),
    ("order_approved_at", "order_delivered_carrier_date"),
    ("order_delivered_carrier_date", "order_delivered_customer_date"),
    ("order_purchase_timestamp", "order_delivered_customer_date"),
]

# Quantities that must not be negative.
QUANTITIES = {
    "order_items": ["price", "freight_value"],
    "payments": ["payment_value", "payment_installments"],
    "products": ["product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
}


def duplicated_rows(df: DataFrame, key: str) -> DataFrame:
    """All rows whose key occurs more than once.

    Keys are counted apart and joined back, so the rows of a frequent key are never
    gathered in one place.
    """
    return rows_with_key_in(df, df.groupBy(key).count().filter("count > 1"), key)


def orphaned_keys(staging: Frames) -> DataFrame:
    """Distinct child keys and how many of them have no parent; all references from one pass over their keys."""
    spark = next(iter(staging.values())).sparkSession
    names = [dict(zip(("child_table", "child_key", "parent_table", "parent_key"), r), at=i) for i, r in enumerate(REFERENCES)]
    told = small_table(spark, names, "at:int,child_table:string,child_key:string,parent_table:string,parent_key:string")
    return reference_counts(staging, REFERENCES).join(F.broadcast(told), "at").selectExpr(
        "child_table", "child_key", "parent_table", "parent_key", "keys AS child_distinct_values", "lost_keys AS orphaned_values",
        f"coalesce({percent('lost_keys', 'keys', 4)}, 0) AS orphaned_percentage",
    )


def sequence_violations(staging: Frames) -> DataFrame:
    """Orders whose later event is recorded before the earlier one; one pass for all pairs."""
    counts = []
    for i, (a, b) in enumerate(SEQUENCES):
        counts += [f"count_if({a} IS NOT NULL AND {b} IS NOT NULL) AS both_{i}", f"count_if({a} > {b}) AS bad_{i}"]
    lines = ", ".join(
        f"named_struct('earlier_event', '{a}', 'later_event', '{b}', 'rows_with_both_timestamps', both_{i}, "
        f"'sequence_violations', bad_{i}, 'violation_percentage', coalesce({percent(f'bad_{i}', f'both_{i}', 4)}, 0))"
        for i, (a, b) in enumerate(SEQUENCES)
    )
    return staging["orders"].selectExpr(*counts).selectExpr(f"inline(array({lines}))")


def _late_items(staging: Frames) -> DataFrame:
    return staging["orders"].sparkSession.sql(
        "SELECT * FROM {items} WHERE shipping_limit_date > (SELECT max(order_purchase_timestamp) FROM {orders})",
        items=staging["order_items"],
        orders=staging["orders"],
    )


def shipping_outliers(staging: Frames) -> DataFrame:
    """Items whose shipping limit lies after the last purchase of all."""
    return _late_items(staging).select("order_id", "order_item_id", "seller_id", "shipping_limit_date")


def shipping_outlier_summary(staging: Frames) -> DataFrame:
    return staging["orders"].sparkSession.sql(
        "SELECT count(1) AS outlier_rows, count(DISTINCT seller_id) AS sellers_affected, "
        "count(DISTINCT order_id) AS orders_affected, (SELECT count(1) FROM {items}) AS total_rows FROM {late}",
        items=staging["order_items"],
        late=_late_items(staging),
    )


def outlier_seller_years(staging: Frames) -> DataFrame:
    """Items per shipping year of every seller that has an outlier."""
    sellers = _late_items(staging).select("seller_id").distinct()
    items = staging["order_items"].selectExpr("seller_id", "year(shipping_limit_date) AS shipping_limit_year")
    by_year = agg(items, ["seller_id", "shipping_limit_year"], order_item_count="count(1)")
    return by_year.join(sellers, "seller_id", "left_semi")


def _outside(params: Params) -> str:
    return f"NOT ({inside_box(params)})"


def out_of_bounds(staging: Frames, params: Params) -> DataFrame:
    return staging["geolocation"].filter(_outside(params))


def out_of_bounds_summary(staging: Frames, params: Params) -> DataFrame:
    seen = add(staging["geolocation"], outside=f"coalesce({_outside(params)}, false)")
    sums = seen.selectExpr(
        "count(1) AS total_rows",
        "count_if(outside) AS out_of_bounds_rows",
        "count(DISTINCT CASE WHEN outside THEN zip_code_prefix END) AS zip_prefixes_affected",
        "count(DISTINCT CASE WHEN outside THEN state END) AS states_affected",
    )
    return add(sums, out_of_bounds_percentage=percent("out_of_bounds_rows", "total_rows", 4))


def out_of_bounds_states(staging: Frames, params: Params) -> DataFrame:
    return agg(out_of_bounds(staging, params), ["state"], out_of_bounds_rows="count(1)")


def zero_installments_by_type(staging: Frames) -> DataFrame:
    return agg(staging["payments"].filter("payment_installments = 0"), ["payment_type"], payment_rows="count(1)")


def zero_installment_history(staging: Frames) -> DataFrame:
    """All payments of the orders that have a payment with zero instalments."""
    return rows_with_key_in(staging["payments"], staging["payments"].filter("payment_installments = 0"), "order_id")


def zero_weight_products(staging: Frames) -> DataFrame:
    return staging["products"].filter("product_weight_g = 0")


def items_with_category(staging: Frames) -> DataFrame:
    products = staging["products"].select("product_id", "product_category_name")
    return staging["order_items"].join(products, "product_id", "left").join(
        staging["category_translation"], "product_category_name", "left"
    )


def dearest_items(staging: Frames, k: int = 10) -> DataFrame:
    """The ``k`` items with the highest price. Only they are looked up in the other tables."""
    top = staging["order_items"].orderBy("price", "order_id", "order_item_id", ascending=[False, True, True]).limit(k)
    return items_with_category({**staging, "order_items": top}).select(
        "order_id", "order_item_id", "product_category_name_english", "price", "freight_value"
    )


def largest_payments(staging: Frames, k: int = 10) -> DataFrame:
    top = staging["payments"].orderBy(
        "payment_value", "order_id", "payment_sequential", ascending=[False, True, True]
    )
    return top.limit(k).select("order_id", "payment_type", "payment_installments", "payment_value")


def items_of_largest_payment(staging: Frames) -> DataFrame:
    order = largest_payments(staging, 1).select("order_id")
    items = staging["order_items"].join(order.hint("broadcast"), "order_id", "left_semi")
    return items_with_category({**staging, "order_items": items}).select(
        "order_id", "order_item_id", "product_category_name_english", "price", "freight_value"
    )


def untranslated_categories(staging: Frames) -> DataFrame:
    counts = agg(
        staging["products"].filter("product_category_name IS NOT NULL"), ["product_category_name"], products_affected="count(1)"
    )
    return counts.join(staging["category_translation"], "product_category_name", "left_anti")


def orders_without_payment(staging: Frames) -> DataFrame:
    """Orders no payment refers to, with what their items are worth."""
    missing = rows_without_key_in(staging["orders"], staging["payments"], "order_id")
    worth = agg(
        staging["order_items"], ["order_id"], items="count(1)", value=f"sum({cents('price')} + {cents('freight_value')})"
    )
    return missing.join(worth, "order_id", "left").selectExpr(
        "order_id", "order_status", "order_purchase_timestamp", "coalesce(items, 0) AS item_count",
        f"{money('coalesce(value, 0)')} AS order_value",
    )


def delivered_without_date(staging: Frames) -> DataFrame:
    sums = staging["orders"].filter("order_status = 'delivered'").selectExpr(
        "count(1) AS delivered_orders", "count_if(order_delivered_customer_date IS NULL) AS missing_delivery_date"
    )
    return add(sums, missing_percentage=percent("missing_delivery_date", "delivered_orders", 4))


def orders_without_items(staging: Frames) -> DataFrame:
    missing = rows_without_key_in(staging["orders"], staging["order_items"], "order_id")
    return agg(missing, ["order_status"], order_count="count(1)")


def negative_values(staging: Frames) -> DataFrame:
    def of(name: str, columns: list[str]) -> DataFrame:
        counts = [t for i, c in enumerate(columns) for t in (f"count_if({c} < 0) AS bad_{i}", f"count({c}) AS n_{i}")]
        lines = ", ".join(
            f"named_struct('column_name', '{c}', 'negative_count', bad_{i}, "
            f"'negative_percentage', {percent(f'bad_{i}', f'n_{i}', 4)})"
            for i, c in enumerate(columns)
        )
        return staging[name].selectExpr(*counts).selectExpr(f"'{name}' AS dataset", f"inline(array({lines}))")

    return union_all([of(name, cols) for name, cols in QUANTITIES.items()])
