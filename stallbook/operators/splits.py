"""Split points: cut an ordered table into even ranges without sorting it.

A sample of order keys is sorted and thinned to a few thousand split points. The points are
frozen into the plan as a literal, so the range of a row depends on that row alone: any
sample gives exact results downstream and a retried task computes the same ranges. Selection
cuts again inside the ranges it wants for as long as they are too long, so the number of points
is the fan-out of one round, not a bound on the ranges of a table.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from stallbook.functions.scalars import text_literal

ROWS_PER_RANGE = 250_000
FAN_OUT = 4096
SAMPLES_PER_RANGE = 24


def _key_type(df: DataFrame, order: list[str]) -> str:
    plain = (T.LongType, T.IntegerType, T.ShortType, T.StringType, T.BooleanType)
    for c in order:
        if not isinstance(df.schema[c].dataType, plain):
            raise TypeError(f"order column {c} must be an integer or a string")
    return "struct<" + ",".join(f"`{c}`:{df.schema[c].dataType.simpleString()}" for c in order) + ">"


def find_splits(df: DataFrame, order: list[str], rows: int, rows_per_range: int | None = None) -> list[tuple]:
    """At most ``FAN_OUT - 1`` ascending, distinct keys; empty when one range is enough."""
    per_range = rows_per_range or ROWS_PER_RANGE
    ranges = min(FAN_OUT, math.ceil(rows / per_range))
    if ranges <= 1:
        return []
    fraction = min(1.0, SAMPLES_PER_RANGE * ranges / rows)
    sample = [tuple(r) for r in df.select(*order).sample(fraction, seed=11).orderBy(*order).collect()]
    picked = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    return [key for i, key in enumerate(picked) if i == 0 or key != picked[i - 1]]


def count_not_after(points: list[tuple], df: DataFrame, order: list[str], values: list[str] | None = None) -> str:
    """Expression: how many of the ascending ``points`` are <= the row's key (two-level search).

    ``values`` are the expressions compared with ``order``; by default the columns themselves.
    """
    if not points:
        return "0"
    key_type = _key_type(df, order)
    fields = zip(order, values or order)
    key = "named_struct(" + ", ".join(f"'{c}', {v}" for c, v in fields) + ")"
    width = math.isqrt(len(points) - 1) + 1
    chunks = [points[i : i + width] for i in range(0, len(points), width)]

    def literal(value: list, dtype: str) -> str:
        return f"from_json({text_literal(json.dumps(value))}, '{dtype}')"

    def reached(array: str) -> str:
        return f"size(filter({array}, point -> point <= {key}))"

    def named(point: tuple) -> dict:
        return dict(zip(order, point))

    if len(chunks) == 1:
        return reached(literal([named(p) for p in points], f"array<{key_type}>"))
    heads = literal([named(c[0]) for c in chunks], f"array<{key_type}>")
    table = literal([[named(p) for p in c] for c in chunks], f"array<array<{key_type}>>")
    chunk = reached(heads)
    fine = reached(f"get({table}, {chunk} - 1)")
    return f"CASE WHEN {chunk} = 0 THEN 0 ELSE ({chunk} - 1) * {width} + {fine} END"
