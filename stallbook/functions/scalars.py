"""SQL expression helpers shared by the plans.

Each helper takes and returns expression text for ``selectExpr`` and ``expr``. Text is
parsed in one call, where chained Python columns would cross into the JVM once per operator.

Money is carried as whole cents (bigint) between shuffles: sums stay exact and stay inside
generated code, where wide decimals would not. It turns back into decimals at the output.
Sums overflow loudly, never silently, because ANSI mode is on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cents(amount: str) -> str:
    return f"CAST(CAST({amount} AS DECIMAL(10,2)) * 100 AS BIGINT)"


def money(cents_expr: str) -> str:
    return f"CAST(CAST({cents_expr} AS DECIMAL(20,0)) * 0.01BD AS DECIMAL(20,2))"


def ratio(num: str, den: str, digits: int, num_type: str = "DECIMAL(26,2)") -> str:
    """Exact decimal division rounded half away from zero; NULL when ``den`` is zero."""
    quotient = f"CAST({num} AS {num_type}) / nullif(CAST({den} AS DECIMAL(20,0)), 0BD)"
    return f"CAST(round({quotient}, {digits}) AS DECIMAL(20,{digits}))"


def percent(part: str, whole: str, digits: int = 2) -> str:
    return ratio(f"CAST({part} AS DECIMAL(20,0)) * 100", whole, digits)


def mean_money(cents_sum: str, count: str) -> str:
    return ratio(cents_sum, f"({count}) * 100", 2)


def mean(total: str, count: str, digits: int) -> str:
    return ratio(total, count, digits, "DECIMAL(28,10)")


def whole_days(later: str, earlier: str) -> str:
    """Whole days between two timestamps, truncated toward zero."""
    return f"CAST(extract(DAY FROM ({later} - {earlier})) AS BIGINT)"


def month_of(ts: str) -> str:
    return f"trunc({ts}, 'MM')"


def months_between(later: str, earlier: str) -> str:
    return f"CAST((year({later}) - year({earlier})) * 12 + month({later}) - month({earlier}) AS INT)"


def micros(ts: str) -> str:
    return f"unix_micros(CAST({ts} AS TIMESTAMP))"


def pad_zip(code: str, width: int = 5) -> str:
    """Left-pad short codes with zeros; longer codes and NULL stay as they are."""
    text = f"CAST({code} AS STRING)"
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def blank_to_null(text: str) -> str:
    return f"CASE WHEN trim({text}) <> '' THEN {text} END"


def to_int(text: str) -> str:
    """Integers written with or without a decimal point; anything else becomes NULL."""
    number = f"try_cast({text} AS DOUBLE)"
    return f"CASE WHEN {number} = floor({number}) THEN try_cast({number} AS INT) END"


def to_ts(text: str) -> str:
    return f"CAST(try_to_timestamp({text}) AS TIMESTAMP_NTZ)"


def text_literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def add(df: DataFrame, **columns: str) -> DataFrame:
    """Add or replace columns given as expressions."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def _named(measures: dict[str, str]) -> list[Column]:
    return [F.expr(f"{text} AS {name}") for name, text in measures.items()]


def agg(df: DataFrame, keys: list[str], **measures: str) -> DataFrame:
    """Group by ``keys`` and aggregate expressions; keys may be ``"expression AS name"``."""
    return df.groupBy(*[F.expr(k) for k in keys]).agg(*_named(measures))


def agg_sets(df: DataFrame, grains: list[list[str]], keys: list[str], measures: dict[str, str]) -> DataFrame:
    """Aggregate at several grains in one pass; ``grouping_id()`` tells them apart."""
    return df.groupingSets(grains, *keys).agg(*_named(measures))
