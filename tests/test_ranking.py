"""The distributed rank operators against plain single-partition windows."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from stallbook.operators import order_stats
from stallbook.operators.materialize import materialize
from stallbook.operators.order_stats import select_at_ranks, tile_starts, with_ntiles
from stallbook.operators.ranking import with_global_order
from stallbook.operators.splits import count_not_after, find_splits


def tied(spark, rows=4000, seed=3, keys="long"):
    rnd = random.Random(seed)
    data = []
    for i in range(rows):
        value = 1 if rnd.random() < 0.6 else rnd.choice([-7, 0, 2, 3, 50, 10**12])
        key = i if keys == "long" else f"k{rnd.random():.9f}-{i}"
        data.append((value, key, rnd.randint(-5, 99)))
    rnd.shuffle(data)
    return materialize(spark.createDataFrame(data, f"v long, k {keys}, m long").repartition(5), "tied")


@pytest.mark.parametrize("keys", ["long", "string"])
@pytest.mark.parametrize("per_range", [97, 700, 100_000])
def test_row_number_rank_running_sum(spark, keys, per_range):
    df = tied(spark, keys=keys)
    got = with_global_order(df, ["v", "k"], "rn", "rk", {"so_far": "m"}, rows_per_range=per_range)
    w = Window.orderBy("v", "k")
    want = df.select(
        "v", "k", "m", F.row_number().over(w).cast("long").alias("rn"),
        F.rank().over(Window.orderBy("v")).cast("long").alias("rk"),
        F.sum("m").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("so_far"),
    )
    cols = want.columns
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.collect()))


def test_rank_when_one_value_fills_many_ranges(spark):
    df = materialize(spark.range(5000).select(F.lit(9).cast("long").alias("v"), F.col("id").alias("k")), "flat")
    out = with_global_order(df, ["v", "k"], "rn", "rk", rows_per_range=100)
    assert out.select(F.min("rk"), F.max("rk"), F.max("rn")).first() == (1, 1, 5000)


@pytest.mark.parametrize("n", [1, 3, 5, 100])
@pytest.mark.parametrize("per_range", [150, 100_000])
def test_ntile_equals_window(spark, n, per_range):
    df = tied(spark, rows=1503)
    got = with_ntiles(df, "k", {"t": ("v", n), "u": ("m", 5)}, rows_per_range=per_range)
    want = df.select("k", F.ntile(n).over(Window.orderBy("v", "k")), F.ntile(5).over(Window.orderBy("m", "k")))
    assert sorted(map(tuple, got.select("k", "t", "u").collect())) == sorted(map(tuple, want.collect()))


def test_tiles_select_inside_brackets_only(spark, monkeypatch):
    df = materialize(spark.range(60_000).selectExpr("id AS k", "(id * 7919) % 60013 AS v", "id % 3 AS m"), "spread")
    selected = []

    def watched(rows, *rest, **named):
        selected.append(rows.count())
        return select_at_ranks(rows, *rest, **named)

    monkeypatch.setattr(order_stats, "select_at_ranks", watched)
    got = with_ntiles(df, "k", {"t": ("v", 5)})
    # Four brackets of two thousandths of the rows each, with room for the sketch's error.
    assert len(selected) == 1 and selected[0] < 60_000 * 4 * 0.004
    want = df.select("k", F.ntile(5).over(Window.orderBy("v", "k")))
    assert sorted(map(tuple, got.select("k", "t").collect())) == sorted(map(tuple, want.collect()))


def test_tiles_stay_exact_when_brackets_miss(spark, monkeypatch):
    df = materialize(spark.range(9_000).selectExpr("id AS k", "(id * 7919) % 9001 AS v"), "missed")
    monkeypatch.setattr(order_stats, "SKETCH_ITEMS", 8)
    monkeypatch.setattr(order_stats, "BRACKET", 0.0)
    got = with_ntiles(df, "k", {"t": ("v", 100)})
    want = df.select("k", F.ntile(100).over(Window.orderBy("v", "k")))
    assert sorted(map(tuple, got.select("k", "t").collect())) == sorted(map(tuple, want.collect()))


def test_fewer_rows_than_tiles(spark):
    df = materialize(spark.createDataFrame([(10, 1), (5, 2), (7, 3)], "v long, k long"), "three")
    got = {r.k: r.t for r in with_ntiles(df, "k", {"t": ("v", 100)}).collect()}
    assert got == {2: 1, 3: 2, 1: 3}
    empty = df.filter("v < 0")
    assert with_ntiles(empty, "k", {"t": ("v", 5)}).count() == 0


def test_tile_sizes_differ_by_at_most_one():
    for total in (1, 4, 5, 6, 99, 1234):
        for tiles in (1, 3, 5, 100):
            edges = [1, *tile_starts(total, tiles), total + 1]
            sizes = [b - a for a, b in zip(edges, edges[1:])]
            assert sum(sizes) == total and max(sizes) - min(sizes) <= 1 and sizes == sorted(sizes, reverse=True)


@pytest.mark.parametrize("per_range", [60, 100_000])
def test_weighted_selection(spark, per_range):
    rows = [("a", i, i % 7 + 1) for i in range(500)] + [("b", 3, 10_000)]
    df = materialize(spark.createDataFrame(rows, "g string, v long, w long"), "weighted")
    flat = [i for i in range(500) for _ in range(i % 7 + 1)]
    found = select_at_ranks(df, "g", ["v"], lambda g, n: [1, n // 2, n], "w", rows_per_range=per_range)
    assert found["a"] == {1: (0,), len(flat) // 2: (flat[len(flat) // 2 - 1],), len(flat): (499,)}
    assert found["b"] == {1: (3,), 5000: (3,), 10_000: (3,)}


def test_search_is_monotone_for_any_points(spark):
    df = spark.range(300).select(F.col("id").alias("v"))
    for points in ([(5,)], [(i * 3,) for i in range(50)], [(i,) for i in range(0, 300, 7)]):
        got = df.selectExpr("v", f"{count_not_after(points, df, ['v'])} AS c").collect()
        assert all(r.c == sum(p[0] <= r.v for p in points) for r in got)
    assert find_splits(df, ["v"], 300, 1000) == []


def test_items_are_numbered_in_one_shuffle_unless_an_order_is_hot(spark, monkeypatch):
    from stallbook.sources import bench_tables

    rows = [(order, line, 7, 3, Decimal(line), None, Decimal(1)) for order, n in ((1, 4), (2, 1), (5000, 2), (5001, 3), (None, 5)) for line in range(n, 0, -1)]
    rows += [rows[0], (None, None, None, None, None, None, None)]
    columns = "order_id bigint, line int, product_id bigint, supplier_id bigint, price decimal(10,2), shipping_limit_date timestamp_ntz, freight_value decimal(10,2)"
    frame = spark.createDataFrame(rows, columns).repartition(3)

    def told(df):
        return sorted((tuple(r) for r in df.collect()), key=repr)

    hot = told(bench_tables.numbered_items(frame, hot_rows=2))
    monkeypatch.setattr(bench_tables, "with_global_order", None)  # nothing is stored without a hot order
    plain = bench_tables.numbered_items(frame)
    assert plain._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert told(plain) == hot
    numbers = {key: sorted(r[1] for r in hot if r[0] == key) for key in {r[0] for r in hot}}
    assert numbers == {1: [1, 2, 3, 4, 5], 2: [1], 5000: [1, 2], 5001: [1, 2, 3], None: [1, 2, 3, 4, 5, 6]}
    assert {r[0] for r in hot if r[3] == 100000} == {5001, 1}


def test_numbers_are_counted_before_they_are_worked_out(spark, monkeypatch):
    from stallbook.quality import profile

    keys, plain_agg = [], profile.agg
    monkeypatch.setattr(profile, "agg", lambda df, by, **sums: keys.append(by) or plain_agg(df, by, **sums))
    frame = spark.createDataFrame([(Decimal("1.50"), 2, 0.1), (Decimal("1.50"), 2, 0.1000000001), (None, None, None), (Decimal("-3.00"), 9, 5.0)], "price decimal(10,2), n int, share double")
    got = sorted((tuple(r) for r in profile.numeric_counts({"t": frame}).collect()), key=repr)
    assert keys[:3] == [["price"], ["n"], ["share"]]
    assert got == sorted([
        ("t.price", 1_500_000, 2), ("t.price", -3_000_000, 1), ("t.price", None, 1), ("t.n", 2_000_000, 2), ("t.n", 9_000_000, 1), ("t.n", None, 1),
        ("t.share", 100_000, 2), ("t.share", 5_000_000, 1), ("t.share", None, 1),
    ], key=repr)
