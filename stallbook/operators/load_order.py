"""Number the rows of a stored table in the order they were stored, without a shuffle or a sort."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stallbook.functions.scalars import add, agg
from stallbook.operators.materialize import materialize


def with_load_order(stored: DataFrame, key: str) -> DataFrame:
    """``stored``, the rows of one written folder, with ``key``: 1..n by part file, then by row of the file.

    A row's number is the rows in the files before its own plus its place in that file, which the reader knows. The counts per
    file need no column of the table; there is one row per file, so their sums fit one task, and whether they are broadcast is left
    to the planner's size check. Part files come in the order of the tasks that wrote them, which is the order of the
    source's blocks where nothing was shuffled before the write. The numbers stay the same for as long as the files stand. The
    sums are stored, so that the planner knows their size before it would deal out the rows of a join.
    """
    placed = stored.selectExpr("*", "_metadata.file_name AS _file", "_metadata.row_index AS _place")
    counts = agg(placed, ["_file"], _rows="count(1)")
    part = "try_cast(regexp_extract(_file, '^part-([0-9]+)', 1) AS BIGINT)"
    before = f"sum(_rows) OVER (ORDER BY {part}, _file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    starts = materialize(add(counts, _before=f"coalesce({before}, 0)").drop("_rows"), "starts")
    return placed.join(starts, "_file").selectExpr(*stored.columns, f"_before + _place + 1 AS {key}")
