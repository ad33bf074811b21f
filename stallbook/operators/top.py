"""First row of each group."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stallbook.functions.scalars import add


def first_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per group, the first by ``order`` (e.g. ``"price DESC NULLS LAST"``).

    Spark turns the filter into a group limit that every map task applies before the
    shuffle, so a hot group sends one row per task rather than all of its rows.
    """
    spot = f"row_number() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return add(df, _spot=spot).filter("_spot = 1").drop("_spot")


def leaders_per_group(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """All rows tied for first place in their group."""
    spot = f"rank() OVER (PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)})"
    return add(df, _spot=spot).filter("_spot = 1").drop("_spot")
