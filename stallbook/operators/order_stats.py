"""Exact order statistics and NTILE without a global sort.

The rows at given ranks are found by selection: count rows per range, keep only the ranges
that hold a wanted rank, cut those again while they are long, then order them. NTILE first
brackets all its ranks with quantile sketches in one pass and selects inside the brackets only.
It then needs no shuffle of the table at all, because the first row of each tile decides the
tile of every row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from stallbook.functions.scalars import add, agg, text_literal
from stallbook.operators import splits
from stallbook.operators.materialize import materialize, observed
from stallbook.operators.splits import count_not_after, find_splits

# A wanted range this many times longer than asked for is cut again.
SLACK = 4
# Items a sketch keeps per level (some 200 kB each), and how far, as a share of the rows, a bracket
# reaches to either side of a rank: twice the error that 99 % of such sketches stay below.
SKETCH_ITEMS = 8192
BRACKET = 0.001


def select_at_ranks(
    df: DataFrame,
    group: str,
    order: list[str],
    ranks_of: Callable[[str, int], list[int]],
    weight: str | None = None,
    rows_per_range: int | None = None,
) -> dict[str, dict[int, tuple]]:
    """For each group, the order key found at each wanted rank (1-based).

    ``df`` must give the same rows every time it is read and ``order`` must be unique within
    a group. A row counts ``weight`` times. Groups are few (metrics, columns), rows are not;
    only per-range counts of one round and the selected keys reach the driver.
    """
    per_range = rows_per_range or splits.ROWS_PER_RANGE
    rows = df.selectExpr(f"CAST({group} AS STRING) AS _slot", *order, f"CAST({weight or 1} AS BIGINT) AS _w")
    full = ["_slot", *order]
    left = rows.count()
    # slot -> {rank inside the slot: (group, rank)}; the first round's ranks follow from its counts
    wanted: dict[str, dict[int, tuple[str, int]]] | None = None
    while True:
        points = find_splits(rows, full, left, per_range)
        ranged = add(rows, _range=f"CAST({count_not_after(points, rows, full)} AS INT)")
        sizes = [tuple(r) for r in agg(ranged, ["_slot", "_range"], n="sum(_w)", rows="count(1)").collect()]
        if wanted is None:
            names = {s[0] for s in sizes}
            totals = {name: sum(n for slot, _, n, _ in sizes if slot == name) for name in names}
            wanted = {name: {k: (name, k) for k in ranks_of(name, totals[name])} for name in names}
        inside: dict[tuple[str, int], dict[int, tuple[str, int]]] = {}
        longest = kept_rows = 0
        before: dict[str, int] = {}
        for slot, range_id, n, count in sorted(sizes):
            at = before.get(slot, 0)
            here = {k - at: target for k, target in wanted.get(slot, {}).items() if at < k <= at + n}
            before[slot] = at + n
            if here:
                inside[slot, range_id] = here
                longest, kept_rows = max(longest, count), kept_rows + count
        if not inside:
            return {}
        kept = ranged.filter(" OR ".join(f"(_slot = {text_literal(slot)} AND _range = {range_id})" for slot, range_id in inside))
        rows = kept.selectExpr("concat(_slot, '#', _range) AS _slot", *order, "_w")
        wanted = {f"{slot}#{range_id}": here for (slot, range_id), here in inside.items()}
        if longest <= SLACK * per_range or kept_rows >= left:
            break
        left = kept_rows

    def holds(slot: str) -> str:
        any_rank = " OR ".join(f"(_upto >= {k} AND _upto - _w < {k})" for k in wanted[slot])
        return f"(_slot = {text_literal(slot)} AND ({any_rank}))"

    upto = f"sum(_w) OVER (PARTITION BY _slot ORDER BY {', '.join(order)} ROWS UNBOUNDED PRECEDING)"
    found: dict[str, dict[int, tuple]] = {}
    for r in add(rows, _upto=upto).filter(" OR ".join(holds(slot) for slot in wanted)).collect():
        for local, (name, rank) in wanted[r["_slot"]].items():
            if r["_upto"] - r["_w"] < local <= r["_upto"]:
                found.setdefault(name, {})[rank] = tuple(r[c] for c in order)
    return found


def tile_starts(total: int, tiles: int) -> list[int]:
    """Rank of the first row of tiles 2..n; larger tiles come first."""
    size, extra = divmod(total, tiles)
    starts = [t * size + min(t, extra) + 1 for t in range(1, tiles)]
    return [s for s in starts if s <= total]


def _brackets(df: DataFrame, tiles: dict[str, tuple[str, int]]) -> tuple[dict[str, list[int]], dict[str, list[tuple[int, int]]]]:
    """Wanted ranks per metric, and for each the values it should lie between: one pass, a sketch per metric."""
    sketches = {
        f"_s{i}": f"kll_sketch_agg_bigint(CAST({value} AS BIGINT), {SKETCH_ITEMS})"
        for i, (value, _) in enumerate(tiles.values())
    }
    sums = materialize(agg(df, [], _total="count(1)", **sketches), "sketches")
    total = sums.first()["_total"]
    ranks = {metric: tile_starts(total, n) for metric, (_, n) in tiles.items()}

    def quantiles(sketch: str, shares: list[float]) -> str:
        return f"kll_sketch_get_quantile_bigint({sketch}, array({', '.join(f'{min(max(s, 0), 1):.12f}D' for s in shares)}))"

    asked = {}
    for i, metric in enumerate(tiles):
        if ranks[metric]:
            asked[f"_low{i}"] = quantiles(f"_s{i}", [(k - 1) / total - BRACKET for k in ranks[metric]])
            asked[f"_high{i}"] = quantiles(f"_s{i}", [k / total + BRACKET for k in ranks[metric]])
    row = add(sums, **asked).select("_total", *asked).first()
    between = {m: list(zip(row[f"_low{i}"], row[f"_high{i}"])) if ranks[m] else [] for i, m in enumerate(tiles)}
    return ranks, between


def _first_rows(
    df: DataFrame, key: str, tiles: dict[str, tuple[str, int]], rows_per_range: int | None
) -> dict[str, dict[int, tuple]] | None:
    """The (value, key) that starts each tile, or None when a bracket misses its rank.

    Reads ``df`` twice: for the sketches, and to store the rows inside the brackets while those
    below each are counted. The rest works on the stored rows.
    """
    ranks, between = _brackets(df, tiles)
    columns, below, entries = {}, {}, []
    ranks_in: dict[str, list[int]] = {}
    metric_of: dict[str, str] = {}
    for i, (metric, (value, _)) in enumerate(tiles.items()):
        spans: list[list[int]] = []
        for rank, (low, high) in zip(ranks[metric], between[metric]):
            if spans and low <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], high)
            else:
                spans.append([low, high])
            slot = f"{i}#{len(spans)}"
            ranks_in.setdefault(slot, []).append(rank)
            metric_of[slot] = metric
        if not spans:
            continue
        columns[f"_v{i}"] = f"CAST({value} AS BIGINT)"
        lows = [(low,) for low, _ in spans]
        columns[f"_at{i}"] = count_not_after(lows, df.selectExpr(f"CAST({value} AS BIGINT) AS _v"), ["_v"], [columns[f"_v{i}"]])
        highs = "array(" + ", ".join(f"{high}L" for _, high in spans) + ")"
        below |= {f"{i}#{at + 1}": f"count_if(_at{i} <= {at})" for at in range(len(spans))}
        inside = f"_at{i} > 0 AND _v{i} <= get({highs}, _at{i} - 1)"
        entries.append(f"IF({inside}, named_struct('_slot', concat('{i}#', _at{i}), '_value', _v{i}, '_key', {key}), NULL)")
    if not entries:
        return {}
    located = df.selectExpr(key, *[f"{text} AS {name}" for name, text in columns.items()])
    watched, counted = observed(located, {f"b{n}": text for n, text in enumerate(below.values())}, "rows below brackets")
    stored = materialize(watched.selectExpr(f"inline(array_compact(array({', '.join(entries)})))"), "brackets")
    counts = counted()
    before = {slot: counts[f"b{n}"] for n, slot in enumerate(below)}
    local = {slot: sorted(rank - before[slot] for rank in inside) for slot, inside in ranks_in.items()}
    found = select_at_ranks(stored, "_slot", ["_value", "_key"], lambda slot, n: local[slot], rows_per_range=rows_per_range)
    starts: dict[str, dict[int, tuple]] = {}
    for slot, inside in ranks_in.items():
        for rank in inside:
            at = found.get(slot, {}).get(rank - before[slot])
            if at is None:
                return None
            starts.setdefault(metric_of[slot], {})[rank] = at
    return starts


def with_ntiles(
    df: DataFrame, key: str, tiles: dict[str, tuple[str, int]], rows_per_range: int | None = None
) -> DataFrame:
    """Add ``NTILE(n) OVER (ORDER BY value, key)`` columns: ``{name: (value column, n)}``.

    ``df`` must be stable (read from storage). Values are non-null integers and ``key`` is
    unique, so ties are broken the same way on every run. Where a sketch was further off than
    its bracket, which the counts show, all rows go through the selection instead.
    """
    wanted = {name: (value, n) for name, (value, n) in tiles.items() if n > 1}
    entries = ", ".join(
        f"named_struct('_metric', '{name}', '_value', CAST({value} AS BIGINT), '_key', {key})"
        for name, (value, _) in tiles.items()
    )
    long = df.selectExpr(f"inline(array({entries}))")
    starts = _first_rows(df, key, wanted, rows_per_range) if wanted else {}
    if starts is None:
        starts = select_at_ranks(
            long,
            "_metric",
            ["_value", "_key"],
            lambda metric, n: tile_starts(n, tiles[metric][1]),
            rows_per_range=rows_per_range,
        )
    made = {}
    for name, (value, _) in tiles.items():
        firsts = [starts[name][k] for k in sorted(starts.get(name, {}))]
        passed = count_not_after(firsts, long, ["_value", "_key"], [f"CAST({value} AS BIGINT)", key])
        made[name] = f"CAST(1 + {passed} AS INT)"
    return add(df, **made)


def quantile_ranks(total: int, probs: list[float]) -> list[int]:
    """Ranks that surround each quantile position (linear interpolation)."""
    ranks: set[int] = set()
    for p in probs:
        low = int((total - 1) * p)
        ranks |= {low + 1, min(low + 2, total)}
    return sorted(ranks) if total else []
