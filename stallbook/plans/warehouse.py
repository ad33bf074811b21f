"""Staging frames -> cleaned star schema.

Two layers. ``clean`` applies every rule and keeps natural keys; reports read that layer, so
they never pay for numbering. ``with_surrogate_keys`` adds dense 1..n keys for the stored
warehouse: those that ``in_load_order`` gave the staging rows, or else keys in natural-key order.
Both are lazy apart from the small counts and samples that numbering needs.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from stallbook.functions.scalars import add, agg, pad_zip, ratio, text_literal
from stallbook.operators.load_order import with_load_order
from stallbook.operators.materialize import materialize
from stallbook.operators.ranking import with_global_order
from stallbook.operators.top import first_per_group
from stallbook.params import Params
from stallbook.schemas import UNIQUE, WAREHOUSE
from stallbook.sources.frames import LazyFrames

Frames = Mapping[str, DataFrame]


class IntegrityError(RuntimeError):
    """A natural key repeats or a mandatory reference does not resolve."""


CALENDAR = [
    "CAST(date_format(full_date, 'yyyyMMdd') AS INT) AS date_key",
    "full_date",
    "CAST(day(full_date) AS SMALLINT) AS day",
    "CAST(month(full_date) AS SMALLINT) AS month",
    "date_format(full_date, 'MMMM') AS month_name",
    "CAST(quarter(full_date) AS SMALLINT) AS quarter",
    "CAST(year(full_date) AS SMALLINT) AS year",
    "CAST(weekofyear(full_date) AS SMALLINT) AS week_of_year",
    "date_format(full_date, 'EEEE') AS weekday_name",
    "weekday(full_date) >= 5 AS is_weekend",
]


def dim_date(spark: SparkSession, start: str, end: str) -> DataFrame:
    days = spark.range(1).selectExpr(f"explode(sequence(DATE '{start}', DATE '{end}')) AS full_date")
    return days.selectExpr(*CALENDAR)


def dim_date_covering(orders: DataFrame) -> DataFrame:
    """The calendar of all years in which orders were placed."""
    seen = orders.selectExpr(
        "trunc(min(order_purchase_timestamp), 'YEAR') AS first",
        "add_months(trunc(max(order_purchase_timestamp), 'YEAR'), 12) - 1 AS last",
    )
    days = seen.filter("first IS NOT NULL").selectExpr("explode(sequence(first, last)) AS full_date")
    return days.selectExpr(*CALENDAR)


def inside_box(params: Params) -> str:
    return (
        f"lat BETWEEN CAST({params.lat_min} AS DECIMAL(9,6)) AND CAST({params.lat_max} AS DECIMAL(9,6)) "
        f"AND lng BETWEEN CAST({params.lng_min} AS DECIMAL(9,6)) AND CAST({params.lng_max} AS DECIMAL(9,6))"
    )


def clean_geolocation(raw: DataFrame, params: Params) -> DataFrame:
    """One row per zip: mean position, and the most frequent city and state, each on its own.

    Rows are first counted per (zip, city, state), so what is grouped by zip afterwards is a
    list of distinct names rather than every sighting. Equal counts go to the smaller name.
    """
    padded = add(raw, zip_code_prefix=pad_zip("zip_code_prefix"))
    counted = agg(
        padded.filter(f"zip_code_prefix IS NOT NULL AND {inside_box(params)}"),
        ["zip_code_prefix", "city", "state"],
        n="count(1)",
        lat="sum(lat)",
        lng="sum(lng)",
    )
    seen = materialize(counted, "locations")  # read three times below

    def most_frequent(name: str) -> DataFrame:
        counts = agg(seen.filter(f"{name} IS NOT NULL"), ["zip_code_prefix", name], n="sum(n)")
        return first_per_group(counts, ["zip_code_prefix"], ["n DESC", name]).select("zip_code_prefix", name)

    def centre(axis: str) -> str:
        return f"CAST({ratio(f'sum({axis})', 'sum(n)', 6, 'DECIMAL(28,6)')} AS DECIMAL(9,6))"

    middle = agg(seen, ["zip_code_prefix"], avg_lat=centre("lat"), avg_lng=centre("lng"))
    named = middle.join(most_frequent("city"), "zip_code_prefix", "left")
    return named.join(most_frequent("state"), "zip_code_prefix", "left")


def category_lookup(translation: DataFrame, params: Params) -> DataFrame:
    """Category -> English name; hand-made entries win over the file's."""
    rows = translation.selectExpr("product_category_name", "product_category_name_english", "1 AS priority")
    if params.manual_categories:
        entries = ", ".join(
            f"named_struct('k', {text_literal(k)}, 'v', {text_literal(v)})" for k, v in params.manual_categories
        )
        manual = translation.sparkSession.range(1).selectExpr(f"inline(array({entries}))")
        rows = rows.unionAll(manual.selectExpr("k", "v", "0"))
    best = first_per_group(
        rows.filter("product_category_name IS NOT NULL"),
        ["product_category_name"],
        ["priority", "product_category_name_english ASC NULLS LAST"],
    )
    return best.drop("priority")


def clean_products(raw: DataFrame, translation: DataFrame, params: Params) -> DataFrame:
    ints = ("product_name_length", "product_description_length", "product_photos_qty")
    fixed = add(
        raw,
        product_weight_g="CASE WHEN product_weight_g <> 0 THEN product_weight_g END",
        **{c: f"CAST({c} AS INT)" for c in ints},
    )
    # Dealt out again, so that the products of a hot category can be split in the join.
    lookup = add(category_lookup(translation, params), _deal="hash(product_category_name_english)")
    lookup = lookup.repartition("_deal", "product_category_name").drop("_deal")
    named = fixed.join(lookup, "product_category_name", "left")
    return named.select(*[c for c in WAREHOUSE["dim_product"] if c in named.columns])


def clean_order_items(items: DataFrame, orders: DataFrame, params: Params, mark: bool = False) -> DataFrame:
    """A shipping limit later than the grace period after the purchase is a data error: drop the date.

    With ``mark``, the column ``_date_cleared`` tells where that happened.
    """
    bought = orders.selectExpr("order_id", "order_purchase_timestamp AS _bought")
    too_late = f"shipping_limit_date > _bought + interval {params.shipping_grace_days} days"
    limit = f"CASE WHEN {too_late} THEN NULL ELSE shipping_limit_date END"
    marked = {"_date_cleared": f"coalesce({too_late}, false)"} if mark else {}
    return add(items.join(bought, "order_id", "left"), shipping_limit_date=limit, **marked).drop("_bought")


def clean_payments(payments: DataFrame) -> DataFrame:
    count = "CASE payment_installments WHEN 0 THEN 1 ELSE payment_installments END"
    return add(payments, payment_installments=f"CAST({count} AS INT)")


def clean(staging: Frames, params: Params, mark: bool = False) -> Frames:
    """Natural-key layer of the warehouse, each table made when first used; ``mark`` as in ``clean_order_items``."""

    def padded(table: str, column: str) -> DataFrame:
        return add(staging[table], **{column: pad_zip(column)})

    return LazyFrames(
        {
            "dim_date": lambda: dim_date(staging["orders"].sparkSession, params.calendar_start, params.calendar_end),
            "dim_geolocation": lambda: clean_geolocation(staging["geolocation"], params),
            "dim_customer": lambda: padded("customers", "customer_zip_code_prefix"),
            "dim_seller": lambda: padded("sellers", "seller_zip_code_prefix"),
            "dim_product": lambda: clean_products(staging["products"], staging["category_translation"], params),
            "dim_order": lambda: staging["orders"],
            "fact_order_items": lambda: clean_order_items(staging["order_items"], staging["orders"], params, mark),
            "fact_payments": lambda: clean_payments(staging["payments"]),
            "fact_reviews": lambda: staging["reviews"],
        }
    )


def report_frames(staging: Frames, params: Params) -> Frames:
    """Like ``clean``, with the items' shipping date left out, which no report looks at.

    The check of that date costs a join of items with orders that reports can do without.
    """
    cleaned = clean(staging, params)
    makers = {name: (lambda name=name: cleaned[name]) for name in cleaned}
    makers["fact_order_items"] = lambda: staging["order_items"].drop("shipping_limit_date")
    return LazyFrames(makers)


# Staging tables whose rows become rows of a warehouse table, and the key they get there. Locations are grouped by zip first.
LOADED_KEYS = {
    "customers": "customer_key",
    "sellers": "seller_key",
    "products": "product_key",
    "orders": "order_key",
    "order_items": "order_item_key",
    "payments": "payment_key",
    "reviews": "review_key",
}


def in_load_order(staging: Frames, stored: bool = False) -> Frames:
    """Staging frames whose rows carry their surrogate keys, numbered 1..n as they were loaded.

    The frames are stored first, as their numbers are places in files; with ``stored`` they are files already.
    """

    def loaded(table: str) -> DataFrame:
        if table not in LOADED_KEYS:
            return staging[table]
        files = staging[table] if stored else materialize(staging[table], f"staging-{table}")
        return with_load_order(files, LOADED_KEYS[table])

    return LazyFrames({table: (lambda table=table: loaded(table)) for table in staging})


def number_rows(df: DataFrame, key: str, order: list[str], rows_per_range: int | None = None) -> DataFrame:
    """Dense 1..n surrogate key in natural-key order."""
    return with_global_order(df, order, row_number=key, rows_per_range=rows_per_range)


def with_surrogate_keys(cleaned: Frames, params: Params, rows_per_range: int | None = None, watch: Callable[[str, DataFrame], DataFrame] = lambda table, df: df) -> Frames:
    """The nine warehouse tables with surrogate keys resolved through natural keys.

    Rows that have their key from loading keep it; others are numbered along their natural key. Tables are made when first used;
    a dimension is numbered once and shared by its facts. ``watch`` gets every finished table before its columns are picked.
    """

    def numbered(table: str, key: str, order: list[str]) -> DataFrame:
        if key in cleaned[table].columns:
            return cleaned[table]
        return number_rows(cleaned[table], key, order, rows_per_range)

    def located(table: str, zip_col: str) -> DataFrame:
        keys = bases["dim_geolocation"].selectExpr(f"zip_code_prefix AS {zip_col}", "geolocation_key")
        return bases[table].join(keys, zip_col, "left")

    def products() -> DataFrame:
        rows = numbered("dim_product", "product_key", ["product_id"])
        # Numbering by natural key has stored them; otherwise the join that names categories would run for the items again.
        return materialize(rows, "products") if "product_key" in cleaned["dim_product"].columns else rows

    # Numbered natural keys, each made and stored once; facts look their keys up here, not in finished tables.
    bases = LazyFrames(
        {
            "dim_geolocation": lambda: numbered("dim_geolocation", "geolocation_key", ["zip_code_prefix"]),
            "dim_customer": lambda: numbered("dim_customer", "customer_key", ["customer_id"]),
            "dim_seller": lambda: numbered("dim_seller", "seller_key", ["seller_id"]),
            "dim_product": products,
            "dim_order": lambda: numbered("dim_order", "order_key", ["order_id"]),
        }
    )

    def orders() -> DataFrame:
        customers = bases["dim_customer"].select("customer_id", "customer_key")
        rows = bases["dim_order"].join(customers, "customer_id", "left")
        rows = add(rows, _day="CAST(date_format(order_purchase_timestamp, 'yyyyMMdd') AS INT)")
        days = tables["dim_date"].selectExpr("date_key AS _day", "date_key AS purchase_date_key")
        return rows.join(days, "_day", "left")

    def items() -> DataFrame:
        rows = numbered("fact_order_items", "order_item_key", ["order_id", "order_item_id"])
        for table, natural, key in (
            ("dim_order", "order_id", "order_key"),
            ("dim_seller", "seller_id", "seller_key"),
            ("dim_product", "product_id", "product_key"),
        ):
            rows = rows.join(bases[table].select(natural, key), natural, "left")
        return rows

    makers = {
        "dim_date": lambda: cleaned["dim_date"],
        "dim_geolocation": lambda: bases["dim_geolocation"],
        "dim_customer": lambda: located("dim_customer", "customer_zip_code_prefix"),
        "dim_seller": lambda: located("dim_seller", "seller_zip_code_prefix"),
        "dim_product": lambda: bases["dim_product"],
        "dim_order": orders,
        "fact_order_items": items,
        "fact_payments": lambda: numbered("fact_payments", "payment_key", ["order_id", "payment_sequential"]),
        # Reviews have no declared key; identical (review, order) pairs may swap numbers freely.
        "fact_reviews": lambda: numbered("fact_reviews", "review_key", ["review_id", "order_id"]),
    }
    tables = LazyFrames({name: (lambda name=name: watch(name, makers[name]()).select(*WAREHOUSE[name])) for name in WAREHOUSE})
    return tables


def duplicate_keys(frames: Frames) -> DataFrame:
    """How many natural keys occur more than once, per table."""

    def of(table: str) -> DataFrame:
        repeated = frames[table].groupBy(*UNIQUE[table]).count().filter("count > 1")
        return repeated.selectExpr("count(1) AS duplicate_keys").selectExpr(
            f"'{table}' AS table_name", f"'{', '.join(UNIQUE[table])}' AS key_columns", "duplicate_keys"
        )

    return reduce(DataFrame.unionByName, [of(t) for t in UNIQUE if t in frames])


def key_ranges(warehouse: Frames) -> DataFrame:
    """Rows, smallest, largest and number of distinct surrogate keys per table: dense keys run from 1 to the number of rows."""

    def of(table: str) -> DataFrame:
        key = WAREHOUSE[table][0]
        # Distinct keys are as many as rows exactly when no key repeats, so rows are counted per key.
        counted = warehouse[table].groupBy(key).count()
        return counted.selectExpr("coalesce(sum(count), 0) AS row_count", f"min({key}) AS first_key", f"max({key}) AS last_key", "count(1) AS distinct_keys").selectExpr(f"'{table}' AS table_name", "*")

    return reduce(DataFrame.unionByName, [of(t) for t in WAREHOUSE if t != "dim_date"])


def unresolved_references(warehouse: Frames) -> DataFrame:
    """Mandatory surrogate references left empty, per table and column."""
    mandatory = {"dim_order": ["customer_key"], "fact_order_items": ["order_key", "seller_key", "product_key"]}

    def of(table: str, cols: list[str]) -> DataFrame:
        counts = warehouse[table].selectExpr(*[f"count_if({c} IS NULL) AS {c}" for c in cols])
        long = counts.unpivot([], cols, "column_name", "unresolved")
        return long.selectExpr(f"'{table}' AS table_name", "column_name", "unresolved")

    return reduce(DataFrame.unionByName, [of(t, cols) for t, cols in mandatory.items()])


def check_integrity(cleaned: Frames, warehouse: Frames) -> None:
    """Raise with all counts if a unique key repeats or a mandatory reference is missing."""
    bad = [
        f"{r.table_name}({r.key_columns}): {r.duplicate_keys} repeated keys"
        for r in duplicate_keys(cleaned).filter("duplicate_keys > 0").collect()
    ]
    bad += [
        f"{r.table_name}.{r.column_name}: {r.unresolved} rows without a match"
        for r in unresolved_references(warehouse).filter("unresolved > 0").collect()
    ]
    if bad:
        raise IntegrityError("; ".join(bad))


def stored_warehouse(cleaned: Frames, params: Params) -> Frames:
    """The nine tables written once, dimensions before facts; checks and loads read what was written."""
    keyed = with_surrogate_keys(cleaned, params)
    return {name: materialize(keyed[name], name) for name in WAREHOUSE}


def build_warehouse(staging: Frames, params: Params, check: bool = True) -> Frames:
    """The stored warehouse of staging frames, with keys in load order."""
    cleaned = clean(in_load_order(staging), params)
    warehouse = stored_warehouse(cleaned, params)
    if check:
        check_integrity(cleaned, warehouse)
    return warehouse
