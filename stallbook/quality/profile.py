"""Profiles of the source tables: shapes, completeness, dates, numbers, categories, ids.

Columns are turned into (metric, value) rows and counted per value first. Everything else
works on those counts, so repeated values never travel and no column ends up in one task.
"""

from __future__ import annotations

import json
import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stallbook.functions.scalars import add, agg, text_literal, to_ts
from stallbook.operators.materialize import materialize
from stallbook.operators.order_stats import quantile_ranks, select_at_ranks
from stallbook.schemas import DATE_COLUMNS

Frames = Mapping[str, DataFrame]

# What counts as an identifier, and text that is never profiled.
ID_SUFFIXES = ("_id", "_zip_code_prefix", "_sequential", "_item_id")
FREE_TEXT = ("review_comment_title", "review_comment_message")
NOT_CATEGORICAL_TABLES = ("category_translation",)
BINS = 40
SCALE = 1_000_000


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def small_table(spark: SparkSession, rows: list[dict], ddl: str) -> DataFrame:
    """A handful of rows known on the driver, as a literal inside the plan."""
    text = text_literal(json.dumps(rows))
    return spark.range(1).selectExpr(f"inline(from_json({text}, {text_literal(f'array<struct<{ddl}>>')}))")


def dataset_shapes(staging: Frames) -> DataFrame:
    """Rows, columns and rows that repeat an earlier one, per table."""

    def of(name: str) -> DataFrame:
        df = staging[name]
        # Rows are counted by 128 bits that stand for all their values, so that no text is shuffled. Hashes skip
        # NULLs, hence the mask of them.
        values = ", ".join([*(f"`{c}`" for c in df.columns), *(f"`{c}` IS NULL" for c in df.columns)])
        counts = agg(df.selectExpr(f"xxhash64({values}) AS _h", f"xxhash64(7, {values}) AS _g"), ["_h", "_g"], n="count(1)")
        both = counts.selectExpr("coalesce(sum(n), 0) AS n", "coalesce(sum(n - 1), 0) AS repeated")
        return both.selectExpr(
            f"'{name}' AS dataset",
            "n AS row_count",
            f"{len(df.columns)} AS column_count",
            "repeated AS duplicate_rows",
            "coalesce(CAST(round(CAST(repeated AS DECIMAL(20,0)) * 100 / nullif(CAST(n AS DECIMAL(20,0)), 0), 2) "
            "AS DECIMAL(10,2)), 0) AS duplicate_percentage",
        )

    return union_all([of(name) for name in staging])


def column_completeness(staging: Frames) -> DataFrame:
    """Type, filled, missing and blank values of every column; one pass per table."""

    def of(name: str) -> DataFrame:
        fields = staging[name].schema.fields
        counts = ["count(1) AS n"]
        for i, f in enumerate(fields):
            counts.append(f"count(`{f.name}`) AS filled_{i}")
            blank = f"count_if(trim(`{f.name}`) = '')" if isinstance(f.dataType, T.StringType) else "0L"
            counts.append(f"{blank} AS blank_{i}")
        lines = ", ".join(
            f"named_struct('column_name', '{f.name}', 'data_type', '{f.dataType.simpleString()}', "
            f"'non_null_count', filled_{i}, 'null_count', n - filled_{i}, 'empty_string_count', blank_{i})"
            for i, f in enumerate(fields)
        )
        return staging[name].selectExpr(*counts).selectExpr(f"'{name}' AS dataset", f"inline(array({lines}))")

    return union_all([of(name) for name in staging])


def date_conversion(raw: Frames, date_columns: Mapping[str, list[str]] = DATE_COLUMNS) -> DataFrame:
    """For text date columns: missing before, lost to bad values, and converted."""

    def of(name: str, columns: list[str]) -> DataFrame:
        counts = []
        for i, c in enumerate(columns):
            counts += [
                f"count_if({c} IS NULL) AS missing_{i}",
                f"count_if({c} IS NOT NULL AND {to_ts(c)} IS NULL) AS lost_{i}",
                f"count({to_ts(c)}) AS kept_{i}",
            ]
        lines = ", ".join(
            f"named_struct('column_name', '{c}', 'null_before_conversion', missing_{i}, 'coerced_to_null', lost_{i}, "
            f"'converted_count', kept_{i})"
            for i, c in enumerate(columns)
        )
        return raw[name].selectExpr(*counts).selectExpr(f"'{name}' AS dataset", f"inline(array({lines}))")

    return union_all([of(name, cols) for name, cols in date_columns.items() if name in raw])


def date_ranges(staging: Frames, date_columns: Mapping[str, list[str]] = DATE_COLUMNS) -> DataFrame:
    """First and last day and missing values per date column, and over all of them."""

    def of(name: str, columns: list[str]) -> DataFrame:
        bounds = []
        for i, c in enumerate(columns):
            bounds += [f"CAST(min({c}) AS DATE) AS lo_{i}", f"CAST(max({c}) AS DATE) AS hi_{i}", f"count_if({c} IS NULL) AS no_{i}"]
        lines = ", ".join(
            f"named_struct('column_name', '{c}', 'min_date', lo_{i}, 'max_date', hi_{i}, 'missing_values', no_{i})"
            for i, c in enumerate(columns)
        )
        return staging[name].selectExpr(*bounds).selectExpr(f"'{name}' AS dataset", f"inline(array({lines}))")

    each = union_all([of(name, cols) for name, cols in date_columns.items()])
    # The grand total row comes from the same handful of rows.
    return (
        each.rollup("dataset", "column_name")
        .agg({"min_date": "min", "max_date": "max", "missing_values": "sum"})
        .filter("column_name IS NOT NULL OR dataset IS NULL")
        .selectExpr(
            "coalesce(dataset, 'overall') AS dataset", "coalesce(column_name, 'all') AS column_name",
            "`min(min_date)` AS min_date", "`max(max_date)` AS max_date", "`sum(missing_values)` AS missing_values",
        )
    )


def numeric_columns(staging: Frames) -> dict[str, list[str]]:
    found = {}
    for name in staging:
        numeric = [f.name for f in staging[name].schema if isinstance(f.dataType, T.NumericType)]
        found[name] = [c for c in numeric if not c.lower().endswith(ID_SUFFIXES)]
    return {name: cols for name, cols in found.items() if cols}


def _value_counts(staging: Frames, columns: Mapping[str, list[str]], value: str) -> DataFrame:
    """(metric, value, n) for all given columns, NULL counted as a value; ``value`` is a template over ``{c}``."""

    def of(name: str, cols: list[str]) -> DataFrame:
        lines = ", ".join(f"named_struct('metric', '{name}.{c}', 'v', {value.format(c=c)})" for c in cols)
        return staging[name].selectExpr(f"inline(array({lines}))")

    long = union_all([of(name, cols) for name, cols in columns.items()])
    return agg(long, ["metric", "v"], n="count(1)")


def numeric_counts(staging: Frames) -> DataFrame:
    """Stored (metric, value in millionths, n) of the numeric columns that are not ids.

    Rows are counted by the value as it is, and decimals worked out once per distinct value, not once per row.
    """
    apart, together = [], []
    for name, columns in numeric_columns(staging).items():
        for c in columns:
            counted = agg(staging[name], [c], _n="count(1)")
            micro = f"CAST(CAST({c} AS DECIMAL(20,6)) * {SCALE} AS BIGINT)"
            # Values of these types stay apart in millionths; others may meet there.
            kind = staging[name].schema[c].dataType
            exact = kind.scale <= 6 if isinstance(kind, T.DecimalType) else isinstance(kind, T.IntegralType)
            (apart if exact else together).append(counted.selectExpr(f"'{name}.{c}' AS metric", f"{micro} AS v", "_n AS n"))
    if together:
        apart.append(agg(union_all(together), ["metric", "v"], n="sum(n)"))
    return materialize(union_all(apart), "numbers")


def _quantiles(counts: DataFrame, probs: list[float], rows_per_range: int | None) -> dict[str, list[float]]:
    totals: dict[str, int] = {}

    def ranks(metric: str, n: int) -> list[int]:
        totals[metric] = n
        return quantile_ranks(n, probs)

    found = select_at_ranks(counts.filter("v IS NOT NULL"), "metric", ["v"], ranks, "n", rows_per_range=rows_per_range)
    out = {}
    for metric, n in totals.items():
        at = found[metric]
        values = []
        for p in probs:
            position = (n - 1) * p
            low = math.floor(position)
            a, b = at[low + 1][0], at[min(low + 2, n)][0]
            values.append((a + (b - a) * (position - low)) / SCALE)
        out[metric] = values
    return out


def _named_metric() -> list[str]:
    return ["split_part(metric, '.', 1) AS dataset", "split_part(metric, '.', 2) AS column_name"]


def numeric_summary(staging: Frames, rows_per_range: int | None = None) -> DataFrame:
    """Count, mean, median, deviation, extremes and quartiles; exact, without a global sort."""
    counts = numeric_counts(staging)
    cuts = _quantiles(counts, [0.25, 0.5, 0.75], rows_per_range)
    quartiles = small_table(
        counts.sparkSession,
        [{"metric": m, "q1": q[0], "median": q[1], "q3": q[2]} for m, q in cuts.items()],
        "metric:string,q1:double,median:double,q3:double",
    )
    sums = agg(
        counts,
        ["metric"],
        rows="coalesce(sum(n) FILTER (WHERE v IS NOT NULL), 0)",
        mean=f"CAST(sum(CAST(v AS DECIMAL(28,0)) * n) AS DOUBLE) / nullif(sum(n) FILTER (WHERE v IS NOT NULL), 0) / {SCALE}",
        low="min(v)",
        high="max(v)",
    )
    # Second pass around the mean: squares of large values would cancel badly.
    around = counts.join(sums.hint("broadcast"), "metric")
    spread = agg(around, ["metric"], squares=f"sum(n * pow(v / {SCALE}D - mean, 2))")
    return (
        sums.join(spread.hint("broadcast"), "metric")
        .join(quartiles.hint("broadcast"), "metric", "left")
        .selectExpr(
            *_named_metric(), "rows AS count", "round(mean, 6) AS mean", "round(median, 6) AS median",
            "round(sqrt(squares / nullif(rows - 1, 0)), 6) AS std", f"low / {SCALE}D AS min",
            "round(q1, 6) AS q1", "round(q3, 6) AS q3", f"high / {SCALE}D AS max",
        )
    )


def histograms(staging: Frames, bins: int = BINS) -> DataFrame:
    """Equal-width bins per numeric column; the last bin includes the maximum."""
    counts = numeric_counts(staging)
    edges = agg(counts, ["metric"], low="min(v)", high="max(v)")
    placed = counts.filter("v IS NOT NULL").join(edges.hint("broadcast"), "metric").selectExpr(
        "metric", "n",
        f"CASE WHEN high = low THEN {bins // 2} ELSE least(((v - low) * {bins}) div (high - low), {bins - 1}) END AS bin",
    )
    filled = agg(placed, ["metric", "bin"], n="sum(n)")
    every = add(edges, bin=f"explode(sequence(0L, {bins - 1}L))")
    joined = every.join(filled, ["metric", "bin"], "left")
    # A constant column gets one unit of width around its value.
    start = f"CASE WHEN high = low THEN low - {SCALE // 2} ELSE low END"
    width = f"CASE WHEN high = low THEN {SCALE} ELSE high - low END"
    return joined.selectExpr(
        *_named_metric(), "bin",
        f"round(({start} + ({width}) * bin / {bins}D) / {SCALE}, 6) AS bin_start",
        f"round(({start} + ({width}) * (bin + 1) / {bins}D) / {SCALE}, 6) AS bin_end",
        "coalesce(n, 0) AS frequency",
    )


def box_plots(staging: Frames, rows_per_range: int | None = None) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 interquartile ranges, and outliers."""
    counts = numeric_counts(staging)
    cuts = _quantiles(counts, [0.25, 0.5, 0.75], rows_per_range)
    fences = small_table(
        counts.sparkSession,
        [
            {"metric": m, "q1": a, "median": b, "q3": c, "low": a - 1.5 * (c - a), "high": c + 1.5 * (c - a)}
            for m, (a, b, c) in cuts.items()
        ],
        "metric:string,q1:double,median:double,q3:double,low:double,high:double",
    )
    value = f"v / {SCALE}D"
    inside = f"{value} BETWEEN low AND high"
    boxes = agg(
        counts.join(fences.hint("broadcast"), "metric", "left"),
        ["metric", "q1", "median", "q3"],
        whisker_low=f"min({value}) FILTER (WHERE {inside})",
        whisker_high=f"max({value}) FILTER (WHERE {inside})",
        outliers=f"coalesce(sum(n) FILTER (WHERE NOT ({inside})), 0)",
    )
    return boxes.selectExpr(
        *_named_metric(), "round(q1, 6) AS q1", "round(median, 6) AS median", "round(q3, 6) AS q3",
        "whisker_low", "whisker_high", "outliers",
    )


def categorical_columns(staging: Frames) -> dict[str, list[str]]:
    found = {}
    for name in staging:
        if name in NOT_CATEGORICAL_TABLES:
            continue
        text = [f.name for f in staging[name].schema if isinstance(f.dataType, T.StringType)]
        found[name] = [c for c in text if "id" not in c and not c.endswith("zip_code_prefix") and c not in FREE_TEXT]
    return {name: cols for name, cols in found.items() if cols}


def categorical_summary(staging: Frames) -> DataFrame:
    """Distinct values and the most frequent one (ties: the smallest value)."""
    counts = _value_counts(staging, categorical_columns(staging), "{c}")
    tops = agg(
        counts, ["metric"], unique_values="count(v)", top="min(named_struct('n', -n, 'v', v)) FILTER (WHERE v IS NOT NULL)"
    )
    return tops.selectExpr(
        *_named_metric(), "unique_values", "top.v AS most_frequent_value", "coalesce(-top.n, 0) AS most_frequent_count"
    )


def top_categories(staging: Frames, k: int = 10) -> DataFrame:
    """The ``k`` most frequent values per categorical column, NULL counted as a value."""
    counts = _value_counts(staging, categorical_columns(staging), "{c}")
    place = "row_number() OVER (PARTITION BY metric ORDER BY n DESC, v ASC NULLS LAST)"
    ranked = add(counts, place=place).filter(f"place <= {k}")
    return ranked.selectExpr(*_named_metric(), "place", "v AS value", "n AS frequency")


def id_columns(staging: Frames) -> dict[str, list[str]]:
    found = {name: [c for c in staging[name].columns if c.lower().endswith("_id") or c.lower() == "id"] for name in staging}
    return {name: cols for name, cols in found.items() if cols}


def identifier_profile(staging: Frames) -> DataFrame:
    """Is each id column unique in its table?"""
    counts = _value_counts(staging, id_columns(staging), "CAST({c} AS STRING)")
    sums = agg(
        counts,
        ["metric"],
        row_count="sum(n)",
        non_null_count="coalesce(sum(n) FILTER (WHERE v IS NOT NULL), 0)",
        unique_values="count(v)",
        duplicate_values="sum(n - 1)",
    )
    return sums.selectExpr(
        "split_part(metric, '.', 1) AS dataset", "split_part(metric, '.', 2) AS id_column", "row_count", "non_null_count",
        "unique_values", "duplicate_values", "non_null_count = unique_values AS appears_unique_in_table",
    )
