"""Cleaning rules and the quality jobs on hand-made rows."""

import datetime as dt
from decimal import Decimal as D

from stallbook.params import Params
from stallbook.operators.load_order import with_load_order
from stallbook.operators.materialize import materialize, scratch_path
from stallbook.plans.warehouse import build_warehouse, clean, dim_date, in_load_order, with_surrogate_keys
from stallbook.quality import checks, profile, validation
from tests.fixtures import shop, staging

P = Params()


def test_dim_date(spark):
    rows = {r.full_date: r for r in dim_date(spark, P.calendar_start, P.calendar_end).collect()}
    assert len(rows) == 1461
    day = rows[dt.date(2016, 1, 2)]
    assert (day.date_key, day.week_of_year, day.weekday_name, day.is_weekend) == (20160102, 53, "Saturday", True)
    assert (day.month_name, day.quarter, rows[dt.date(2019, 12, 30)].week_of_year) == ("January", 1, 1)


def test_geolocation_bounds_and_ties(spark):
    def at(lat, lng, city="b", state="SP", zip_code="1"):
        return {"zip_code_prefix": zip_code, "lat": lat, "lng": lng, "city": city, "state": state}

    rows = [at(-34, -75), at(6, -32, "a"), at(6.000001, -40, "c"), at(-30, -31.9, "c"), at(0, -50, None, "RJ", "2"), at(1, -50, "z", "RJ", "2")]
    got = {r.zip_code_prefix: r for r in clean(staging(spark, geolocation=rows), P)["dim_geolocation"].collect()}
    assert (got["00001"].avg_lat, got["00001"].avg_lng, got["00001"].city) == (D("-14.000000"), D("-53.500000"), "a")
    assert (got["00002"].city, got["00002"].avg_lat) == ("z", D("0.500000"))


def test_products(spark):
    manual = P.manual_categories[0]
    frames = staging(
        spark,
        products=[
            {"product_id": "p1", "product_category_name": manual[0], "product_weight_g": 0},
            {"product_id": "p2", "product_category_name": "cat", "product_weight_g": 5},
            {"product_id": "p3", "product_category_name": "new"}, {"product_id": "p4"},
        ],
        category_translation=[
            {"product_category_name": manual[0], "product_category_name_english": "from the file"},
            {"product_category_name": "cat", "product_category_name_english": "category"},
        ],
    )
    got = {r.product_id: r for r in clean(frames, P)["dim_product"].collect()}
    assert [got[p].product_category_name_english for p in ("p1", "p2", "p3", "p4")] == [manual[1], "category", None, None]
    assert (got["p1"].product_weight_g, got["p2"].product_weight_g) == (None, D("5.00"))


def test_shipping_limit_and_instalments(spark):
    rows = shop(("o1", "a", "2018-01-01 00:00:00", "s", 1), ("o2", "a", "2018-01-01 00:00:00", "s", 1), payments=[("o1", 1, "card", 0, 5)])
    for item, limit in zip(rows["order_items"], ("2018-03-02 00:00:00", "2018-03-02 00:00:01")):
        item["shipping_limit_date"] = limit
    rows["order_items"].append({**rows["order_items"][1], "order_id": "unknown", "order_item_id": 7})
    cleaned = clean(staging(spark, **rows), P)
    limits = {r.order_id: r.shipping_limit_date for r in cleaned["fact_order_items"].collect()}
    assert limits["o1"] == dt.datetime(2018, 3, 2) and limits["o2"] is None and limits["unknown"] is not None
    assert cleaned["fact_payments"].first().payment_installments == 1


def test_surrogate_keys_and_dates_out_of_the_calendar(spark):
    rows = shop(("o2", "a", "2018-01-01 00:00:00", "s", 1), ("o1", "a", "2020-01-01 00:00:00", "s", 1))
    tables = with_surrogate_keys(clean(staging(spark, **rows), P), P)
    got = {r.order_id: r for r in tables["dim_order"].collect()}
    assert (got["o1"].order_key, got["o2"].order_key) == (1, 2)
    assert (got["o1"].purchase_date_key, got["o2"].purchase_date_key) == (None, 20180101)
    assert {r.order_item_key for r in tables["fact_order_items"].collect()} == {1, 2}
    assert tables["dim_customer"].first().geolocation_key is None


def test_numbers_follow_files_and_rows(spark):
    rows = [(7 * i % 100,) for i in range(100)]
    stored = materialize(spark.createDataFrame(rows, "v int").coalesce(1), "one")
    assert [(r.k, r.v) for r in with_load_order(stored, "k").orderBy("k").collect()] == [(i, v) for i, (v,) in enumerate(rows, 1)]
    path = scratch_path(spark, "many")
    spark.range(0, 1_000, 1, 9).where("id % 7 <> 3").write.option("maxRecordsPerFile", 40).parquet(path)
    many = with_load_order(spark.read.parquet(path), "k")
    got = [(r.k, r.id) for r in many.orderBy("k").collect()]
    assert got == [(i, v) for i, v in enumerate((v for v in range(1_000) if v % 7 != 3), 1)]
    assert sorted(map(tuple, many.select("k", "id").collect())) == got  # the same again
    # A few files: their sums are broadcast from the start, and no row is dealt out for its number.
    text = many._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    empty = materialize(spark.range(0), "none")
    assert with_load_order(empty, "k").collect() == []


def test_loaded_keys_need_no_sort(spark):
    rows = shop(("o2", "a", "2018-01-01 00:00:00", "s", 1), ("o1", "a", "2017-01-01 00:00:00", "r", 1), ("o3", "b", "2017-01-01 00:00:00", "s", 2))
    frames = {t: df.coalesce(1) for t, df in staging(spark, **rows).items()}
    keyed = with_surrogate_keys(clean(in_load_order(frames), P), P)
    for table, df in keyed.items():
        text = df._jdf.queryExecution().executedPlan().toString()
        assert table == "dim_geolocation" or "rangepartitioning" not in text
    tables = build_warehouse(frames, P)
    orders = {r.order_key: r for r in tables["dim_order"].collect()}
    assert [orders[k].order_id for k in (1, 2, 3)] == ["o2", "o1", "o3"]
    customers = {r.customer_key: r.customer_id for r in tables["dim_customer"].collect()}
    sellers = {r.seller_key: r.seller_id for r in tables["dim_seller"].collect()}
    products = {r.product_key: r.product_id for r in tables["dim_product"].collect()}
    assert all(customers[r.customer_key] == r.customer_id for r in orders.values())
    for r in tables["fact_order_items"].collect():
        assert (orders[r.order_key].order_id, sellers[r.seller_key], products[r.product_key]) == (r.order_id, r.seller_id, r.product_id)
    assert {r.order_item_key for r in tables["fact_order_items"].collect()} == {1, 2, 3}


def test_checks_report_one_of_each(spark):
    rows = shop(("o1", "a", "2018-01-01 00:00:00", "s", 1), ("o2", "a", "2018-01-01 00:00:00", "s", None))
    rows["order_items"].append({"order_id": "lost", "order_item_id": 2, "product_id": "p-s", "seller_id": "s", "price": -1, "freight_value": 0})
    rows["orders"][0]["order_approved_at"] = "2017-12-31 00:00:00"
    frames = staging(spark, **rows)
    orphans = {(r.child_table, r.child_key): r.orphaned_values for r in checks.orphaned_keys(frames).collect()}
    assert orphans[("order_items", "order_id")] == 1 and sum(orphans.values()) == 1
    first = checks.sequence_violations(frames).first()
    assert (first.rows_with_both_timestamps, first.sequence_violations, first.violation_percentage) == (1, 1, 100)
    assert [r.asDict() for r in checks.orders_without_items(frames).collect()] == [{"order_status": "delivered", "order_count": 1}]
    negative = {r.column_name: r.negative_count for r in checks.negative_values(frames).collect()}
    assert negative["price"] == 1 and sum(negative.values()) == 1
    assert {r.order_id for r in checks.orders_without_payment(frames).collect()} == {"o1", "o2"}
    tables = with_surrogate_keys(clean(frames, P), P)
    broken = {r.reference: r.orphaned_rows for r in validation.referential_integrity(tables).filter("NOT passed").collect()}
    assert broken == {"fact_order_items.order_key": 1}
    rules = {r.rule: r.violations for r in validation.business_rules(tables, P).filter("NOT passed").collect()}
    assert rules == {"price above zero": 1}
    assert validation.required_columns(tables).filter("NOT passed").count() == 0


def test_profiles(spark):
    rows = shop(*[(f"o{i}", "a", "2018-01-01 00:00:00", "s", v) for i, v in enumerate([1, 2, 3, 4, 100])])
    rows["sellers"] = rows["sellers"] * 3
    frames = staging(spark, **rows)
    shapes = {r.dataset: r for r in profile.dataset_shapes(frames).collect()}
    assert (shapes["sellers"].row_count, shapes["sellers"].duplicate_rows, shapes["sellers"].duplicate_percentage) == (3, 2, D("66.67"))
    price = profile.numeric_summary(frames).filter("column_name = 'price'").first()
    assert (price["count"], price.mean, price.median, price.q1, price.q3, price.max) == (5, 22.0, 3.0, 2.0, 4.0, 100.0)
    assert abs(price.std - 43.617657) < 1e-9
    box = profile.box_plots(frames).filter("column_name = 'price'").first()
    assert (box.whisker_low, box.whisker_high, box.outliers) == (1.0, 4.0, 1)
    bars = {r.bin: r.frequency for r in profile.histograms(frames).filter("column_name = 'price'").collect()}
    assert len(bars) == 40 and (bars[0], bars[1], bars[39]) == (3, 1, 1)
    flat = profile.histograms(frames).filter("column_name = 'freight_value' AND frequency > 0").first()
    assert (flat.bin, flat.bin_start, flat.bin_end) == (20, 0.0, 0.025)
    split = profile.numeric_summary(frames, rows_per_range=2).filter("column_name = 'price'").first()
    assert split == price
    ids = {(r.dataset, r.id_column): r for r in profile.identifier_profile(frames).collect()}
    assert ids[("sellers", "seller_id")].duplicate_values == 2 and ids[("orders", "order_id")].appears_unique_in_table
    top = profile.categorical_summary(frames).filter("column_name = 'order_status'").first()
    assert (top.unique_values, top.most_frequent_value, top.most_frequent_count) == (1, "delivered", 5)
