"""CSV files, catalog loads, exports and snapshots."""

import datetime as dt
import random
from decimal import Decimal as D

import pytest

from stallbook import registry
from stallbook.models.features import write_snapshot
from stallbook.operators import materialize as materialize_module
from stallbook.operators.materialize import scratch_root
from stallbook.params import Params
from stallbook.operators.remembered import remembered
from stallbook.plans import loading
from stallbook.plans.reports import REPORTS, query_views, view_frames
from stallbook.plans.warehouse import IntegrityError, build_warehouse, clean
from stallbook.schemas import WAREHOUSE
from stallbook.quality import validation
from stallbook.sources import catalog, csv_files, csv_records, versions
from stallbook.sources.csv_files import FILES, LoadError, read_staging
from tests.fixtures import shop, staging

P = Params()

CSV = {
    "orders": "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_delivered_carrier_date,"
    "order_delivered_customer_date,order_estimated_delivery_date\n"
    "o1,c1,delivered,2018-01-05 10:00:00,not a date,,  ,2018-01-20 00:00:00\n",
    "customers": "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state\n"
    "c1,u1,1234,x,SP\nc2,u2,01234,x,SP\nc3,u3,,x,SP\nc4,u4,123456,x,SP\n",
    "order_items": "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
    "o1,1,p1,s1,2018-01-08 00:00:00,10.50,3.25\n",
    "payments": "order_id,payment_sequential,payment_type,payment_installments,payment_value\no1,1,card,3.0,10.5\no1,2,NA,4,1\n",
    "reviews": "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,"
    'review_answer_timestamp\nr1,o1,5,,"first line\nsecond, with ""quotes""",2018-01-09 00:00:00,2018-01-10 00:00:00\n',
    "products": "product_id,product_category_name,product_name_lenght,product_description_lenght,product_photos_qty,"
    "product_weight_g,product_length_cm,product_height_cm,product_width_cm\np1,cat,40.0,287,,0,16,10,14\n",
    "sellers": "seller_id,seller_zip_code_prefix,seller_city,seller_state\ns1,01234,x,SP\n",
    "geolocation": "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city,geolocation_state\n"
    "1234,-23.5,-46.6,sao paulo,SP\n",
    "category_translation": "product_category_name,product_category_name_english\ncat,category\n",
}


def write_files(folder, skip=()):
    for table, text in CSV.items():
        if table not in skip:
            prefix = "" if table == "category_translation" else "shop_"
            (folder / f"{prefix}{FILES[table]}").write_text(text)
    return str(folder)


def test_read_staging(spark, tmp_path):
    frames = read_staging(spark, write_files(tmp_path))
    order = frames["orders"].first()
    assert (order.order_approved_at, order.order_delivered_customer_date) == (None, None)
    assert order.order_purchase_timestamp == dt.datetime(2018, 1, 5, 10)
    zips = [r.customer_zip_code_prefix for r in frames["customers"].orderBy("customer_id").collect()]
    assert zips == ["01234", "01234", None, "123456"]
    item = frames["order_items"].first()
    assert (item.price, item.freight_value) == (D("10.50"), D("3.25"))
    assert [r.payment_installments for r in frames["payments"].orderBy("payment_sequential").collect()] == [3, 4]
    (review,) = frames["reviews"].collect()
    assert review.review_comment_message == 'first line\nsecond, with "quotes"' and review.review_comment_title is None
    product = frames["products"].first()
    assert (product.product_name_length, product.product_photos_qty, product.product_weight_g) == (40, None, D("0.00"))
    assert frames["geolocation"].first().zip_code_prefix == "01234"


def test_all_problems_are_reported_together(spark, tmp_path):
    folder = write_files(tmp_path, skip=("sellers", "orders", "products"))
    (tmp_path / "shop_products_dataset.csv").write_text("product_id\np1\n")
    with pytest.raises(LoadError) as caught:
        read_staging(spark, folder)
    assert all(t in str(caught.value) for t in ("sellers:", "orders:", "products: columns not found"))
    assert "order_items" not in str(caught.value)
    # The other tables are there all the same.
    assert set(caught.value.frames) == set(FILES) - {"sellers", "orders", "products"}
    assert caught.value.frames["payments"].count() == 2


def test_every_file_of_a_table_is_read_by_its_own_header(spark, tmp_path):
    write_files(tmp_path)
    (tmp_path / "other_sellers_dataset.csv").write_text("seller_state,seller_city,seller_id,seller_zip_code_prefix\nRJ,y,s2,99\n")
    rows = read_staging(spark, str(tmp_path))["sellers"].orderBy("seller_id").collect()
    assert [tuple(r) for r in rows] == [("s1", "01234", "x", "SP"), ("s2", "00099", "y", "RJ")]


def test_part_files_of_a_folder_are_read_by_their_own_headers(spark, tmp_path):
    """Two column orders over many files: one job finds the headers, and there is one scan per header."""
    parts = tmp_path / "x_sellers_dataset.csv"
    parts.mkdir()
    orders = (["seller_id", "seller_zip_code_prefix", "seller_city", "seller_state"], ["seller_state", "seller_city", "seller_id", "seller_zip_code_prefix"])
    for i in range(60):
        row = {"seller_id": f"s{i}", "seller_zip_code_prefix": "7", "seller_city": "rome", "seller_state": "LA"}
        names = orders[i % 2]
        (parts / f"part-{i:03} %41.csv").write_text(f"{','.join(names)}\n{','.join(row[n] for n in names)}\n")
    (parts / "part-900.csv").write_text("")
    (parts / "_SUCCESS").write_text("")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    found = csv_files.files_by_header(spark, [str(parts)])
    # One job reads the headers, another one looks whether the empty file has one.
    assert len(tracker.getJobIdsForGroup("headers")) <= 2
    assert sorted(map(len, found.values())) == [30, 30] and set(found) == {tuple(o) for o in orders}
    raw = csv_files.read_raw(spark, [str(parts)], "sellers")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert raw._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 2
    rows = {tuple(r) for r in csv_files.to_staging(raw, "sellers").collect()}
    assert rows == {(f"s{i}", "00007", "rome", "LA") for i in range(60)}


def review_file(path, breaks="\n"):
    rng = random.Random(3)
    texts = ["", "plain", f'"a{breaks}b ""q"" {breaks}{breaks}, c"', '"x\r\ny"', '""', "  sp ", '"{}"', f'"it{breaks}goes on{breaks * 30}to here"', '"""quoted"""']
    lines = [CSV["reviews"].split("\n")[0]]
    for i in range(3_000):
        lines.append(f"r{i},o{i},{i % 5 + 1},,{rng.choice(texts)},2018-01-09 00:00:00,2018-01-10 00:00:00")
        lines += [""] * (rng.random() < 0.01) + ["r,bad,row"] * (rng.random() < 0.01)
    lines.append('r9,o9,1,,"never closed,2018-01-09 00:00:00,2018-01-10 00:00:00')
    lines += [f"r{i},o{i},1,,x,," for i in range(5)]
    path.write_text("\n".join(lines), newline="")
    return path.stat().st_size


def test_one_large_file_of_free_text_is_read_by_many_tasks(spark, tmp_path):
    size = review_file(tmp_path / "x_order_reviews_dataset.csv")
    path = [str(tmp_path / "x_order_reviews_dataset.csv")]
    whole = csv_files.read_raw(spark, path, "reviews")
    wanted, lost = sorted(map(str, whole.collect())), sorted(map(str, csv_files.lost_values(whole, "reviews").collect()))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 20))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        assert csv_records.numbered_lines(spark, path).select("_start").distinct().count() >= 20
        cut = csv_files.read_raw(spark, path, "reviews")
        assert sorted(map(str, cut.collect())) == wanted
        assert sorted(map(str, csv_files.lost_values(cut, "reviews").collect())) == lost
        with pytest.raises(LoadError, match="bad rows"):
            read_staging(spark, str(tmp_path), ["reviews"])
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def rows_read(spark):
    """Rows that all stages so far have read from files."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).inputRecords() for i in range(stages.size()))


def test_a_load_reads_each_file_once_and_counts_what_it_changes(spark, tmp_path):
    folder = write_files(tmp_path)
    head = CSV["customers"].split("\n")[0]
    (tmp_path / "more_customers_dataset.csv").write_text(head + "\n" + "".join(f"k{i},p{i},77777,x,SP\n" for i in range(100_000)))
    before = rows_read(spark)
    load = csv_files.load_staging(spark, folder, ["customers"])
    # Every row once, and of each file what fills a pipe while its header is looked at.
    assert 100_004 <= rows_read(spark) - before < 120_000 and load.frames["customers"].count() == 100_004
    loaded = loading.load_folder(spark, folder, P)
    assert loaded.tables["dim_customer"].count() == 100_004
    staged = read_staging(spark, folder)
    wanted = {r.metric: r.value for r in validation.cleaning_counters(staged, clean(staged, P), P).collect()}
    assert {m: n for m, n in loaded.counters.items() if ": lost" not in m} == wanted and wanted["customers_without_location"] == 100_002
    assert loaded.counters["orders: lost order_approved_at"] == 1


def test_a_failed_load_leaves_the_former_rows(spark):
    catalog.reset_databases(spark, ("swap",))
    spark.sql("CREATE TABLE swap.t (a BIGINT) USING parquet COMMENT 'kept'")
    catalog.load_table(spark.range(5).toDF("a"), "swap.t")
    early = spark.table("swap.t")
    with pytest.raises(Exception, match="half way"):
        catalog.load_table(spark.range(100, numPartitions=4).selectExpr("CASE WHEN id > 80 THEN raise_error('half way') ELSE id END AS a"), "swap.t")
    assert spark.table("swap.t").count() == 5 and len(versions.stored_versions(spark, "swap.t")) == 1

    def none_above(df):
        if df.where("a > 8").count():
            raise ValueError("too large")

    with pytest.raises(ValueError, match="too large"):
        versions.replace_table(spark.range(10).toDF("a"), "swap.t", check=none_above)
    assert spark.table("swap.t").count() == 5
    versions.replace_table(spark.range(7).toDF("a"), "swap.t", check=none_above)
    # The former version still serves those who planned before the switch; older ones go.
    assert (spark.table("swap.t").count(), early.count(), len(versions.stored_versions(spark, "swap.t"))) == (7, 5, 2)
    catalog.load_table(spark.range(8).toDF("a"), "swap.t")
    assert spark.table("swap.t").count() == 8 and len(versions.stored_versions(spark, "swap.t")) == 2
    assert "kept" in str(spark.sql("DESCRIBE EXTENDED swap.t").collect())
    assert [t.name for t in spark.catalog.listTables("swap")] == ["t"]
    spark.sql("DROP DATABASE swap CASCADE")


def test_bucketed_loads_write_a_file_per_bucket_and_join_in_place(spark):
    catalog.reset_databases(spark, ("bkt",))
    rows = spark.range(0, 4_000, numPartitions=40).selectExpr("CAST(id AS STRING) AS order_id", "id AS v")
    hot = rows.unionByName(spark.range(0, 9_000, numPartitions=40).selectExpr("'7' AS order_id", "id AS v"))
    tables = {"dim_order": rows, "fact_order_items": hot}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for t, df in tables.items():
            versions.replace_table(df, f"bkt.{t}", 16, "order_id", rows_per_file=1_000)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        files = {t: len(spark.table(f"bkt.{t}").inputFiles()) for t in tables}
        assert files == {"dim_order": 16, "fact_order_items": 16 + 9}
        joined = spark.table("bkt.fact_order_items").join(spark.table("bkt.dim_order"), "order_id")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 13_000
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        catalog.clear_all(spark, "bkt")
        assert spark.table("bkt.dim_order").count() == 0 and catalog.bucketing(spark, "bkt.dim_order") == (16, "order_id")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP DATABASE bkt CASCADE")


def test_clearing_leaves_the_views_of_the_session_alone(spark):
    catalog.reset_databases(spark, ("shy",))
    catalog.load_table(spark.range(2).toDF("seller_id"), "shy.dim_seller")
    catalog.register_views({"dim_date": spark.range(3).toDF("date_key")})
    try:
        catalog.clear_all(spark, "shy")
        assert (spark.table("shy.dim_seller").count(), spark.table("dim_date").count()) == (0, 3)
    finally:
        spark.catalog.dropTempView("dim_date")
        spark.sql("DROP DATABASE shy CASCADE")


def test_sql_over_views_leaves_no_views_behind(spark, monkeypatch):
    rows = shop(("o1", "a", "2018-01-05 10:00:00", "s", 100), ("o2", "b", "2018-03-05 10:00:00", "s", 50))
    monkeypatch.setattr(registry, "source_frames", lambda *_, **__: staging(spark, **rows))
    found = registry.sql_over_views(spark, "")
    assert not {"dim_customer", "dim_order", "vw_customer_health"} & {t.name for t in spark.catalog.listTables()}
    assert sum(r.orders for r in found.collect()) == 2


def test_views_follow_the_stored_tables(spark):
    catalog.reset_databases(spark, ("live",))
    sales = [("o1", "a", "2018-01-05 10:00:00", "s", 100), ("o2", "b", "2018-03-05 10:00:00", "s", 50)]
    text = "SELECT count(*) AS n FROM vw_seller_performance p JOIN vw_customer_health h ON p.total_orders >= 1"
    seen = []
    for more in ([], [], [("o3", "c", "2018-03-06 10:00:00", "t", 70)]):
        if more or not seen:
            sales += more
            catalog.load_all(build_warehouse(staging(spark, **shop(*sales)), P), "live")
        seen.append(query_views(spark, "live", text, P).first().n)
    assert seen == [2, 2, 6]
    spark.sql("DROP DATABASE live CASCADE")


def test_results_are_reused_until_a_source_changes(spark, tmp_path):
    path, built = str(tmp_path / "t"), []
    spark.range(3).write.parquet(path)

    def total(params=1):
        return remembered(spark, "total", [spark.read.parquet(path)], params, lambda: built.append(1) or spark.read.parquet(path).count())

    assert [total(), total(), len(built)] == [3, 3, 1]
    spark.range(4).write.mode("append").parquet(path)
    assert [total(), total(), len(built)] == [7, 7, 2]
    assert [total(2), len(built)] == [7, 3]


def test_bad_rows_and_values_fail_their_table(spark, tmp_path):
    write_files(tmp_path)
    (tmp_path / "b_sellers_dataset.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\ns2,1,x,SP,extra\n")
    (tmp_path / "b_order_payments_dataset.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\no9,1,card,4.6,abc\no9,2,card,1,\n"
    )
    with pytest.raises(LoadError) as caught:
        read_staging(spark, str(tmp_path))
    text = str(caught.value)
    assert "sellers: 1 bad rows" in text and "payments: 1 bad values of payment_installments, 1 bad values of payment_value" in text
    assert "products" not in text and "orders:" not in text


def test_missing_tokens_and_blanks(spark, tmp_path):
    write_files(tmp_path)
    head = CSV["reviews"].split("\n")[0]
    (tmp_path / "b_order_reviews_dataset.csv").write_text(f"{head}\nr2,o1,4,N/A,  ,NaN,null\n")
    row = read_staging(spark, str(tmp_path))["reviews"].filter("review_id = 'r2'").first()
    assert (row.review_comment_title, row.review_comment_message, row.review_creation_date) == (None, "  ", None)
    (tmp_path / "b_products_dataset.csv").write_text(CSV["products"].replace("p1,cat,40.0", "p2,cat,3.7"))
    assert read_staging(spark, str(tmp_path))["products"].filter("product_id = 'p2'").first().product_name_length is None


def test_warehouse_is_loaded_cleared_and_exported(spark, tmp_path):
    rows = shop(("o1", "a", "2018-01-05 10:00:00", "s", 100), ("o2", "b", "2018-03-05 10:00:00", "s", 50))
    catalog.reset_databases(spark, ("wh_test",))
    tables = build_warehouse(staging(spark, **rows), P)
    for _ in range(2):
        catalog.load_all(tables, "wh_test", buckets=4)
    stored = catalog.read_tables(spark, "wh_test")
    assert {t: stored[t].columns for t in WAREHOUSE} == WAREHOUSE
    assert (stored["dim_order"].count(), stored["dim_date"].count()) == (2, 1461)
    # Reports read the stored tables as they read the lazy ones.
    lazy = REPORTS["new_vs_returning_revenue"](clean(staging(spark, **rows), P), P).collect()
    assert sorted(map(str, REPORTS["new_vs_returning_revenue"](stored, P).collect())) == sorted(map(str, lazy))
    joined = stored["fact_order_items"].join(stored["dim_order"].hint("merge"), "order_id")
    assert "hashpartitioning" not in joined._jdf.queryExecution().executedPlan().toString()

    catalog.register_views(view_frames(stored, P))
    assert spark.sql("SELECT count(*) AS n FROM vw_customer_health").first().n == 2
    catalog.export_all({"dim_seller": stored["dim_seller"]}, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "dim_seller")).first().seller_id == "s"
    catalog.clear_all(spark, "wh_test")
    assert spark.table("wh_test.dim_order").count() == 0
    spark.sql("DROP DATABASE wh_test CASCADE")


def test_failed_loads_are_collected(spark):
    catalog.reset_databases(spark, ("wh_bad",))
    good = spark.range(1)
    with pytest.raises(LoadError, match="broken"):
        catalog.load_all({"broken": good.selectExpr("raise_error('no')"), "fine": good}, "wh_bad")
    assert spark.table("wh_bad.fine").count() == 1
    spark.sql("DROP DATABASE wh_bad CASCADE")


def test_empty_strings_become_null(spark):
    df = spark.createDataFrame([("", 1), ("x", 2)], "a string, b int")
    assert [r.a for r in catalog.empty_strings_to_null(df).orderBy("b").collect()] == [None, "x"]


def test_integrity_errors_stop_the_load(spark):
    rows = shop(("o1", "a", "2018-01-05 10:00:00", "s", 100))
    rows["order_items"].append({**rows["order_items"][0], "order_item_id": 9, "seller_id": "nobody"})
    rows["orders"].append(rows["orders"][0])
    with pytest.raises(IntegrityError) as caught:
        build_warehouse(staging(spark, **rows), P)
    assert "dim_order(order_id): 1 repeated" in str(caught.value)
    assert "fact_order_items.seller_key: " in str(caught.value)


def test_snapshot_keeps_the_table_definition(spark):
    catalog.reset_databases(spark, ("snap",))
    spark.sql("CREATE TABLE snap.ml_x (k STRING, v INT, computed_at TIMESTAMP_NTZ) USING parquet COMMENT 'kept'")
    for v in (1, 2):
        write_snapshot(spark.createDataFrame([("a", v)], "k string, v int"), "snap.ml_x")
    (row,) = spark.table("snap.ml_x").collect()
    assert row.v == 2 and row.computed_at is not None
    assert "kept" in str(spark.sql("DESCRIBE EXTENDED snap.ml_x").collect())
    write_snapshot(spark.range(2), "snap.ml_new")
    assert spark.table("snap.ml_new").columns == ["id", "computed_at"]
    spark.sql("DROP DATABASE snap CASCADE")


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")


def test_scratch_tables_can_be_cleared(spark, monkeypatch):
    monkeypatch.setattr(materialize_module, "_WRITTEN", {})
    stored = materialize_module.materialize(spark.range(3), "gone")
    assert stored.count() == 3 and materialize_module.clear_scratch(spark) == 1
    with pytest.raises(Exception, match="(?i)not.?exist|not.?found"):
        spark.read.parquet(stored.inputFiles()[0]).count()


def test_staging_converts_a_value_once(spark, tmp_path, monkeypatch):
    """The counts of lost values look at what the stored columns got, and are the same as those of a pass of their own."""
    (tmp_path / "a_order_payments_dataset.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1,voucher,4.6,10.50\no2,abc,NULL,3.0,1e3,x\no3,,boleto,N/A,ten\no4,2\n"
    )
    raw = csv_files.read_raw(spark, csv_files.locate(spark, str(tmp_path), "payments"), "payments")
    watched, plain = [], csv_files.observed

    def noted(df, metrics, label):
        watched.append(metrics)
        return plain(df, metrics, label)

    monkeypatch.setattr(csv_files, "observed", noted)
    stored, lost, _ = csv_files.store_staging(raw, "payments")
    assert not [text for metrics in watched for text in metrics.values() if "cast" in text.lower()]
    assert lost == {r.column_name: r.lost for r in csv_files.lost_values(raw, "payments").collect()}
    assert lost == {"order_id": 0, "payment_sequential": 1, "payment_type": 0, "payment_installments": 1, "payment_value": 1, "_broken_row": 2}
    assert sorted(map(str, stored.collect())) == sorted(map(str, csv_files.to_staging(raw, "payments").collect()))


def test_stored_versions_are_compressed_like_intermediate_tables(spark):
    catalog.reset_databases(spark, ("packed",))
    frame = spark.range(100).selectExpr("id AS order_id", "'delivered' AS order_status")
    for _ in range(2):
        versions.replace_table(frame, "packed.plain")
        versions.replace_table(frame, "packed.dealt", 4, "order_id")
    for table in ("packed.plain", "packed.dealt"):
        files = spark.table(table).inputFiles()
        assert files and all(name.endswith(".zstd.parquet") for name in files)
        assert spark.table(table).count() == 100
    spark.sql("DROP DATABASE packed CASCADE")
