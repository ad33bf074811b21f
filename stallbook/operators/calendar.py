"""Complete monthly series."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stallbook.functions.scalars import add


def fill_months(monthly: DataFrame, month: str, zero: list[str]) -> DataFrame:
    """Insert the calendar months missing between the first and last row of a monthly table.

    ``monthly`` has one row per month. Each row expands to itself plus the gap that follows,
    so the table is read once. In inserted rows ``zero`` columns hold 0 and the rest NULL.
    """
    reach = add(monthly, _last=f"coalesce(add_months(lead({month}) OVER (ORDER BY {month}), -1), {month})")
    grown = add(reach, _month=f"explode(sequence({month}, _last, interval 1 month))")
    out = [f"_month AS {month}"]
    for name, dtype in monthly.dtypes:
        if name != month:
            rest = f"CAST(0 AS {dtype})" if name in zero else "NULL"
            out.append(f"CASE WHEN _month = {month} THEN {name} ELSE {rest} END AS {name}")
    return grown.selectExpr(*out).select(*monthly.columns)
