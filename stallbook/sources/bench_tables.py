"""Shape the benchmark tables like the nine source tables.

The statements are plain SQL that Spark and DuckDB both run, so a check in another engine
starts from the very same rows. Ids stay integers here.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from stallbook.functions.scalars import add, agg
from stallbook.operators.ranking import ROWS_PER_RANGE, with_global_order
from stallbook.schemas import DATE_COLUMNS
from stallbook.sources.frames import LazyFrames

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

SOURCE_SQL: dict[str, str] = {
    "orders": """
SELECT o_orderkey AS order_id, o_orderkey AS customer_id,
 CASE WHEN o_orderstatus IN ('F','O') THEN 'delivered' WHEN o_orderpriority='1-URGENT' THEN 'canceled' ELSE 'shipped' END AS order_status,
 o_orderdate + (o_orderkey*7919 % 86400) * INTERVAL '1' SECOND AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 61 <> 0 THEN o_orderdate + (o_orderkey*7919 % 86400 + 3600) * INTERVAL '1' SECOND END AS order_approved_at,
 CASE WHEN o_orderkey % 53 <> 0 THEN o_orderdate + (o_orderkey*104729 % 432000) * INTERVAL '1' SECOND END AS order_delivered_carrier_date,
 CASE WHEN o_orderstatus IN ('F','O') AND o_orderkey % 97 <> 0 THEN o_orderdate + (259200 + o_orderkey*15485863 % 2160000) * INTERVAL '1' SECOND END AS order_delivered_customer_date,
 o_orderdate + (10 + o_custkey % 15) * INTERVAL '1' DAY AS order_estimated_delivery_date
FROM orders""",
    "customers": """
SELECT o_orderkey AS customer_id,
 CASE WHEN o_orderkey % 10 < 8 THEN 1000000 + o_orderkey ELSE o_custkey END AS customer_unique_id,
 lpad(cast(o_custkey % 250 AS string),5,'0') AS customer_zip_code_prefix, cast(NULL AS string) AS customer_city,
 CASE WHEN o_custkey % 200 = 7 THEN NULL ELSE n_name END AS customer_state
FROM orders JOIN customer ON o_custkey=c_custkey JOIN nation ON c_nationkey=n_nationkey""",
    "order_items": """
SELECT l_orderkey AS order_id,
 cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber,l_partkey,l_suppkey,l_extendedprice,l_shipdate,l_quantity) AS int) AS order_item_id,
 l_partkey AS product_id, CASE WHEN l_orderkey % 5000 = 1 THEN cast(100000 AS bigint) ELSE l_suppkey END AS seller_id, l_shipdate AS shipping_limit_date,
 cast(l_extendedprice AS decimal(10,2)) AS price, cast(l_quantity AS decimal(10,2)) AS freight_value
FROM lineitem""",
    "payments": """
SELECT CASE WHEN o_orderkey % 499 = 0 THEN -o_orderkey ELSE o_orderkey END AS order_id, CASE WHEN o_orderkey % 53 = 0 THEN 2 ELSE 1 END AS payment_sequential,
 CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'credit_card' WHEN '3-MEDIUM' THEN 'boleto' WHEN '4-NOT SPECIFIED' THEN 'not_defined' ELSE 'debit_card' END AS payment_type,
 cast(o_orderkey % 14 AS int) AS payment_installments, cast(o_totalprice AS decimal(10,2)) AS payment_value FROM orders
UNION ALL SELECT CASE WHEN o_orderkey % 499 = 0 THEN -o_orderkey ELSE o_orderkey END, 3, 'voucher', 1, cast(10 AS decimal(10,2)) FROM orders WHERE o_orderkey % 20 = 0""",
    "reviews": """
SELECT CASE WHEN event_id % 50 = 1 THEN event_id - 1 ELSE event_id END AS review_id, event_id AS order_id,
 1 + cast(floor(value) AS int) % 5 AS review_score, CASE WHEN event_type = 'error' THEN props END AS review_comment_title,
 CASE WHEN event_type IN ('error','click') THEN props END AS review_comment_message, ts AS review_creation_date,
 CASE WHEN event_type <> 'view' THEN ts + cast(floor(value*3600) AS bigint) * INTERVAL '1' SECOND END AS review_answer_timestamp
FROM events""",
    "products": """
SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS product_category_name,
 cast(length(p_name) AS int) AS product_name_length, cast(NULL AS int) AS product_description_length, p_size % 6 AS product_photos_qty,
 cast(p_size - 1 AS decimal(10,2)) AS product_weight_g, cast(p_size AS decimal(10,2)) AS product_length_cm,
 cast(p_size AS decimal(10,2)) AS product_height_cm, cast(p_size AS decimal(10,2)) AS product_width_cm FROM part""",
    "sellers": """
SELECT s_suppkey AS seller_id, lpad(cast(s_suppkey AS string),5,'0') AS seller_zip_code_prefix, s_name AS seller_city, n_name AS seller_state
FROM supplier JOIN nation ON s_nationkey=n_nationkey
UNION ALL SELECT s_suppkey + 100000, lpad(cast(s_suppkey AS string),5,'0'), s_name, 'NATION_X' FROM supplier WHERE s_suppkey % 10 = 0""",
    "geolocation": """
SELECT lpad(cast(c_custkey % 200 AS string),5,'0') AS zip_code_prefix, cast(cast(c_custkey % 48 AS int) - 36 AS decimal(9,6)) AS lat,
 cast(c_nationkey * 2 - 78 AS decimal(9,6)) AS lng, c_mktsegment AS city, n_name AS state FROM customer JOIN nation ON c_nationkey=n_nationkey""",
    "category_translation": """
SELECT CASE WHEN p_type = 'PROMO' THEN 'PROMO (old)' ELSE p_type END AS product_category_name, lower(p_type) AS product_category_name_english
FROM part GROUP BY p_type""",
}


_SCHEMAS: dict[str, StructType] = {}


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table; its schema is looked up once per process."""
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def base_frames(spark: SparkSession, sf_dir: str) -> LazyFrames:
    def reader(table: str) -> Callable[[], DataFrame]:
        return lambda: read_table(spark, f"{sf_dir.rstrip('/')}/{table}.parquet")

    return LazyFrames({t: reader(t) for t in BASE_TABLES})


# Items as Spark makes them: the statement above without its window, each column once.
ITEM_ROWS = """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS product_id, l_suppkey AS supplier_id,
 cast(l_extendedprice AS decimal(10,2)) AS price, l_shipdate AS shipping_limit_date, cast(l_quantity AS decimal(10,2)) AS freight_value
FROM lineitem"""
ITEM_ORDER = ["line", "product_id", "supplier_id", "price", "shipping_limit_date", "freight_value"]
ITEM_SELLER = "CASE WHEN order_id % 5000 = 1 THEN cast(100000 AS bigint) ELSE supplier_id END AS seller_id"


def numbered_items(rows: DataFrame, hot_rows: int = ROWS_PER_RANGE) -> DataFrame:
    """Number the items of each order.

    A window per order would sort a hot order in one task, so orders of more than ``hot_rows`` items, of which there are at most
    as many as that goes into the rows, take another way: the position in all their rows, less the position where the order starts,
    needs no such group. The other rows are shuffled once and not stored.
    """
    hot = [r[0] for r in agg(rows, ["order_id"], _n="count(1)").filter(f"_n > {hot_rows}").select("order_id").collect()]
    found = rows
    if hot:
        is_hot = " OR ".join("order_id IS NULL" if key is None else f"order_id <=> {key}L" for key in hot)
        found = rows.filter(f"NOT ({is_hot})")
    found = add(found, order_item_id=f"row_number() OVER (PARTITION BY order_id ORDER BY {', '.join(ITEM_ORDER)})")
    if hot:
        placed = with_global_order(rows.filter(is_hot), ["order_id", *ITEM_ORDER], "position", "start", rows_per_range=hot_rows)
        found = found.unionByName(add(placed, order_item_id="position - start + 1").drop("position", "start"))
    return found.selectExpr("order_id", "CAST(order_item_id AS INT) AS order_item_id", "product_id", ITEM_SELLER, "shipping_limit_date", "price", "freight_value")


def source_frames(spark: SparkSession, sf_dir: str, number_items: bool = True) -> LazyFrames:
    """The nine staging-shaped frames, lazily derived from the Parquet tables in ``sf_dir``.

    Without ``number_items`` the items have no ``order_item_id``, which reports do not use.
    """
    base = base_frames(spark, sf_dir)

    def select(text: str) -> DataFrame:
        bound, used = bind_tables(text)
        return spark.sql(bound, **{t: base[t] for t in used})

    def items() -> DataFrame:
        rows = select(ITEM_ROWS)
        return numbered_items(rows) if number_items else rows.selectExpr("order_id", "product_id", ITEM_SELLER, "shipping_limit_date", "price", "freight_value")

    makers = {name: (lambda text=text: select(text)) for name, text in SOURCE_SQL.items()}
    return LazyFrames({**makers, "order_items": items})


def bind_tables(text: str) -> tuple[str, list[str]]:
    """Point table names at frames passed as arguments, so no view is left in the session."""
    used: list[str] = []

    def swap(m: re.Match) -> str:
        used.append(m.group(2))
        return f"{m.group(1)} {{{m.group(2)}}}"

    bound = re.sub(r"\b(FROM|JOIN) (" + "|".join(BASE_TABLES) + r")\b", swap, text)
    return bound, sorted(set(used))


def raw_date_frames(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The tables with dates as text, some of it unreadable."""
    sources = source_frames(spark, sf_dir, number_items=False)

    def maker(table: str) -> Callable[[], DataFrame]:
        texts = [f"CASE WHEN order_id % 101 = 0 THEN 'not a date' ELSE CAST({c} AS STRING) END AS {c}" for c in DATE_COLUMNS[table]]
        return lambda: sources[table].selectExpr(*texts)

    return LazyFrames({table: maker(table) for table in DATE_COLUMNS})
