"""Exact ROW_NUMBER, RANK and running SUM over a whole table, spread over many tasks."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stallbook.functions.scalars import add, agg
from stallbook.operators.materialize import materialize

ROWS_PER_RANGE = 1_000_000


def with_global_order(
    df: DataFrame,
    order: list[str],
    row_number: str | None = None,
    rank: str | None = None,
    running: dict[str, str] | None = None,
    rows: int | None = None,
    rows_per_range: int | None = None,
) -> DataFrame:
    """Number a table along ``order`` (ascending, unique) without a single sorting task.

    The table is dealt out by ranges of ``order``, as many as its rows need, sorted inside them
    and stored once with the range and the place in it. What lies before a range comes from
    per-range totals, which are combined on the map side. ``rank`` ranks by the first order
    column only, ties sharing a rank. ``running`` maps output names to the integer columns to
    accumulate.
    """
    running = running or {}
    total = df.count() if rows is None else rows
    ranges = max(1, math.ceil(total / (rows_per_range or ROWS_PER_RANGE)))
    dealt = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    # The id holds the partition in its upper bits and the place in the partition in the lower 33.
    numbered = dealt.withColumn("_at", F.monotonically_increasing_id())
    placed = add(numbered, _range="CAST(shiftright(_at, 33) AS INT)", _row="(_at & 8589934591L) + 1").drop("_at")
    placed = materialize(placed, "ranges")

    local = {f"_sum_{out}": f"sum({col}) OVER (PARTITION BY _range ORDER BY _row ROWS UNBOUNDED PRECEDING)" for out, col in running.items()}
    if rank:
        local["_rank"] = f"rank() OVER (PARTITION BY _range ORDER BY {order[0]})"
    placed = add(placed, **local) if local else placed
    outputs = {out: f"_base_{out} + _sum_{out}" for out in running}
    if row_number:
        outputs[row_number] = "CAST(_base + _row AS BIGINT)"
    if rank:
        continued = f"_before IS NOT NULL AND {order[0]} <=> _start"
        outputs[rank] = f"CAST(CASE WHEN {continued} THEN _start_rank ELSE _base + _rank END AS BIGINT)"
    joined = placed.join(_offsets(placed, order[0], running, bool(rank)), "_range")
    return joined.selectExpr(*df.columns, *[f"{text} AS {out}" for out, text in outputs.items()])


def _offsets(placed: DataFrame, first: str, running: dict[str, str], ranked: bool) -> DataFrame:
    """One row per range: totals before it, and the rank of the value that it starts with, if a range before ends with it."""
    sums = {f"_tot_{out}": f"sum({col})" for out, col in running.items()}
    # The largest rank inside a range is the place of its last value's first row.
    last = {"_last": f"max({first})", "_last_at": "max(_rank)"} if ranked else {}
    totals = agg(placed, ["_range"], _n="count(1)", **sums, **last)
    before = "OVER (ORDER BY _range ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    bases = {"_base": f"coalesce(sum(_n) {before}, 0)", **{f"_base_{out}": f"coalesce(sum(_tot_{out}) {before}, 0)" for out in running}}
    chained = add(totals, **bases)
    if not ranked:
        return chained.select("_range", *bases)
    edged = add(chained, _edge_rank="min(_base + _last_at) OVER (PARTITION BY _last)")
    return edged.selectExpr(
        "_range",
        *bases,
        "lag(_range) OVER (ORDER BY _range) AS _before",
        "lag(_last) OVER (ORDER BY _range) AS _start",
        "lag(_edge_rank) OVER (ORDER BY _range) AS _start_rank",
    )
