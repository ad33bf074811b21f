"""Catalog side: databases, table loads, views and exports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stallbook.functions.scalars import add
from stallbook.schemas import LOAD_ORDER
from stallbook.sources.csv_files import LoadError, export_csv
from stallbook.sources.versions import replace_table

# Facts and orders meet on order_id: bucketed on it, their joins need no shuffle.
BUCKET_KEYS = {
    "dim_order": "order_id",
    "fact_order_items": "order_id",
    "fact_payments": "order_id",
    "fact_reviews": "order_id",
}


def reset_databases(spark: SparkSession, names: tuple[str, ...] = ("staging", "warehouse")) -> None:
    for name in names:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        spark.sql(f"CREATE DATABASE {name}")


def empty_strings_to_null(df: DataFrame) -> DataFrame:
    text = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return add(df, **{c: f"nullif({c}, '')" for c in text}) if text else df


def load_table(df: DataFrame, table: str, buckets: int | None = None) -> None:
    """Replace a table's content at once; a second run leaves the same result, a failed one the former rows."""
    key = BUCKET_KEYS.get(table.rsplit(".", 1)[-1])
    replace_table(empty_strings_to_null(df), table, buckets if key else None, key)


def load_all(frames: Mapping[str, DataFrame], database: str, buckets: int | None = None) -> None:
    """Load every table in dependency order; failures are collected and raised once."""
    order = [t for t in LOAD_ORDER if t in frames] + [t for t in frames if t not in LOAD_ORDER]
    problems = []
    for table in order:
        try:
            load_table(frames[table], f"{database}.{table}", buckets)
        except Exception as problem:  # noqa: BLE001 - reported below, with the other tables
            problems.append(f"{table}: {problem}")
    if problems:
        raise LoadError("; ".join(problems))


def bucketing(spark: SparkSession, table: str) -> tuple[int | None, str | None]:
    """Number of buckets and bucket column of a stored table."""
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    return (int(told["Num Buckets"]), told["Bucket Columns"].strip("[]`")) if "Num Buckets" in told else (None, None)


def clear_all(spark: SparkSession, database: str) -> None:
    """Empty the tables, dependants first, and keep their definitions; their last rows stay as an old version."""
    present = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}  # the session's views are listed with any database
    for table in reversed(LOAD_ORDER):
        if table in present:
            stored = spark.table(f"{database}.{table}")
            spec = bucketing(spark, f"{database}.{table}")
            replace_table(spark.createDataFrame([], stored.schema), f"{database}.{table}", *spec)


def read_tables(spark: SparkSession, database: str, names: list[str] | None = None) -> dict[str, DataFrame]:
    return {name: spark.table(f"{database}.{name}") for name in names or LOAD_ORDER}


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Make frames queryable from SQL under their names, replacing earlier definitions."""
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)


def export_all(frames: Mapping[str, DataFrame], folder: str) -> None:
    for name, frame in frames.items():
        export_csv(frame, f"{folder.rstrip('/')}/{name}")


