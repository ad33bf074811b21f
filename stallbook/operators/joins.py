"""Membership joins that a hot key cannot overload."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stallbook.functions.scalars import agg


def rows_with_key_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``keys``.

    The keys are made distinct and dealt out again, which leaves both sides of the join with
    a shuffle of their own: the form in which Spark splits an oversized partition of ``df``.
    """
    wanted = agg(keys, [key], _n="count(1)").repartition("_n", key).select(key)
    return df.join(wanted, key, "left_semi")


def rows_without_key_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``keys``; a NULL key never occurs."""
    known = agg(keys, [key], _n="count(1)").repartition("_n", key).select(key)
    return df.join(known, key, "left_anti")


def count_without_key_in(df: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """One row: how many rows of ``df`` have a key that does not occur in ``keys``.

    Rows are counted per key before the join, so equal keys never meet in one task as rows.
    """
    per_key = agg(df, [key], _n="count(1)")
    missing = per_key.join(keys.select(key).distinct(), key, "left_anti")
    return missing.selectExpr(f"coalesce(sum(_n), 0) AS {name}")
