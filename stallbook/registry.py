"""Every query by name: ``(spark, folder of benchmark tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stallbook.models import features
from stallbook.operators.materialize import materialize, scratch_path
from stallbook.operators.remembered import remembered
from stallbook.params import BENCH_PARAMS as P
from stallbook.plans import loading, warehouse
from stallbook.plans.bases import Frames
from stallbook.plans.reports import REPORTS, present
from stallbook.quality import checks, profile, validation
from stallbook.sources import catalog, csv_files
from stallbook.sources.bench_tables import base_frames, raw_date_frames, source_frames
from stallbook.sources.catalog import register_views

Query = Callable[[SparkSession, str], DataFrame]


def plain_numbers(df: DataFrame) -> DataFrame:
    """Decimals as double and every integer as bigint, the types other engines compare in."""
    out = []
    for f in df.schema:
        if isinstance(f.dataType, T.DecimalType):
            out.append(f"CAST(`{f.name}` AS DOUBLE) AS `{f.name}`")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            out.append(f"CAST(`{f.name}` AS BIGINT) AS `{f.name}`")
        else:
            out.append(f"`{f.name}`")
    return df.selectExpr(*out)


def _report(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain_numbers(REPORTS[name](warehouse.report_frames(source_frames(spark, sf_dir, number_items=False), P), P))

    return run


def _on_sources(job: Callable[[Frames], DataFrame], number_items: bool = False) -> Query:
    return lambda spark, sf_dir: plain_numbers(job(source_frames(spark, sf_dir, number_items)))


def _on_cleaned(job: Callable[[Frames], DataFrame], number_items: bool = False) -> Query:
    return lambda spark, sf_dir: plain_numbers(job(warehouse.clean(source_frames(spark, sf_dir, number_items), P)))


def built_warehouse(spark: SparkSession, sf_dir: str) -> Frames:
    """The stored warehouse of a folder of tables: built once in a session for as long as the tables' files stand."""
    return remembered(
        spark, f"warehouse of {sf_dir}", base_frames(spark, sf_dir).values(), P,
        lambda: warehouse.build_warehouse(source_frames(spark, sf_dir), P, check=False),
    )


def _on_warehouse(job: Callable[[Frames], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain_numbers(job(built_warehouse(spark, sf_dir)))


def _on_report(name: str, job: Callable[[DataFrame], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        frames = warehouse.report_frames(source_frames(spark, sf_dir, number_items=False), P)
        return plain_numbers(job(REPORTS[name](frames, P)))

    return run


def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Export the sources as CSV under their file names and header names, read them back, and sum a hash of every column."""
    sources = source_frames(spark, sf_dir)
    folder = scratch_path(spark, "csv")
    header_names = {new: old for old, new in csv_files.RENAMES.items()}
    for table, file_name in csv_files.FILES.items():
        raw = sources[table].withColumnsRenamed(header_names)
        csv_files.export_csv(raw, f"{folder}/source_{file_name}")
    return column_checksums(csv_files.read_staging(spark, folder))


def mixed_part_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sums from folders whose part files order their columns in two ways."""
    sources = source_frames(spark, sf_dir)
    folder = scratch_path(spark, "mixed")
    header_names = {new: old for old, new in csv_files.RENAMES.items()}
    for table, file_name in csv_files.FILES.items():
        # Both halves read it, so what takes a shuffle to make is stored.
        raw = materialize(sources[table], f"halved-{table}") if table in ("order_items", "customers") else sources[table]
        raw = raw.withColumnsRenamed(header_names)
        half = f"pmod(xxhash64(`{raw.columns[0]}`), 2) = 0"
        turned = [*raw.columns[2:], *raw.columns[1::-1]]
        csv_files.export_csv(raw.where(half), f"{folder}/{file_name}")
        csv_files.export_csv(raw.where(f"NOT coalesce({half}, false)").select(*turned), f"{folder}/{file_name}", mode="append")
    return column_checksums(csv_files.read_staging(spark, folder))


def column_checksums(staged: Frames) -> DataFrame:
    def sums(table: str) -> DataFrame:
        measures = [f"named_struct('column_name', '{c}', 'filled', count({c}), 'checksum', coalesce(sum({text_sum(c)}), 0))" for c in staged[table].columns]
        return staged[table].selectExpr("count(1) AS row_count", f"array({', '.join(measures)}) AS all").selectExpr(
            f"'{table}' AS table_name", "row_count", "inline(all)"
        )

    return profile.union_all([sums(t) for t in staged])


def text_sum(column: str) -> str:
    """A number from the text of a value that other engines can compute too."""
    return f"CAST(conv(substr(md5(CAST({column} AS STRING)), 1, 8), 16, 10) AS BIGINT)"


def planted_defects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads with defects: two files of sellers with other column orders, unreadable values, missing tables."""
    sources = source_frames(spark, sf_dir, number_items=False)
    folder = scratch_path(spark, "defects")
    sellers, file = sources["sellers"], csv_files.FILES
    csv_files.export_csv(sellers, f"{folder}/a_{file['sellers']}")
    csv_files.export_csv(sellers.select(*reversed(sellers.columns)), f"{folder}/b_{file['sellers']}")
    payments = sources["payments"].selectExpr(
        "order_id", "payment_sequential", "CASE WHEN payment_type = 'voucher' THEN 'N/A' ELSE payment_type END AS payment_type",
        "CASE WHEN payment_installments = 7 THEN '4.6' ELSE string(payment_installments) END AS payment_installments",
        "CASE WHEN payment_installments = 0 THEN 'abc' ELSE string(payment_value) END AS payment_value",
    )
    csv_files.export_csv(payments, f"{folder}/a_{file['payments']}")
    products = sources["products"].selectExpr(
        "* EXCEPT (product_photos_qty, product_category_name)", "CASE WHEN product_photos_qty = 1 THEN '3.7' ELSE concat(product_photos_qty, '.0') END AS product_photos_qty",
        "coalesce(product_category_name, '  ') AS product_category_name",
    )
    csv_files.export_csv(products, f"{folder}/a_{file['products']}")
    names = ["sellers", "payments", "products", "orders"]
    frames, problems = csv_files.scan_staging(spark, folder, names)
    failed = {p.split(":", 1)[0] for p in problems}
    found = [t for t in names if csv_files.locate(spark, folder, t)]
    lost = profile.union_all([csv_files.lost_values(csv_files.read_raw(spark, csv_files.locate(spark, folder, t), t), t) for t in found])
    counts = profile.union_all([frames[t].selectExpr(f"'{t}' AS table_name", "'rows' AS what", "count(1) AS n") for t in frames])
    blanks = frames["products"].selectExpr("'products'", "'blank category'", "count_if(trim(product_category_name) = '')")
    state = profile.small_table(spark, [{"table_name": t, "what": "failed", "n": int(t in failed)} for t in names], "table_name:string,what:string,n:bigint")
    return profile.union_all([counts, blanks, state, lost.filter("lost > 0").selectExpr("table_name", "concat('lost ', column_name)", "lost")])


def stored_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reset a database, load the warehouse into it twice, clear it; rows per table after each, read from the catalog."""
    name = "stallbook_check"
    catalog.reset_databases(spark, (name,))
    tables = built_warehouse(spark, sf_dir)

    def counts(step: str) -> list[dict]:
        stored = catalog.read_tables(spark, name)
        rows = profile.union_all([stored[t].selectExpr(f"'{t}' AS table_name", "count(1) AS n") for t in stored]).collect()
        return [{"table_name": r.table_name, "step": step, "row_count": r.n} for r in rows]

    found = []
    for step in ("loaded", "loaded again"):
        catalog.load_all(tables, name, buckets=8)
        found += counts(step)
    catalog.clear_all(spark, name)
    found += counts("cleared")
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return profile.small_table(spark, found, "table_name:string,step:string,row_count:bigint")


def failed_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after a load, after one that fails half way, and as seen by a reader from before a switch to other rows."""
    name = "stallbook_failing"
    catalog.reset_databases(spark, (name,))
    tables = built_warehouse(spark, sf_dir)
    catalog.load_all(tables, name, buckets=8)
    early = catalog.read_tables(spark, name)
    found = []

    def counts(step: str, stored: Frames) -> None:
        rows = profile.union_all([stored[t].selectExpr(f"'{t}' AS table_name", "count(1) AS n") for t in stored]).collect()
        found.extend({"table_name": r.table_name, "step": step, "row_count": r.n} for r in rows)

    counts("loaded", early)
    key = {t: tables[t].columns[0] for t in tables}
    broken = {t: tables[t].where(f"assert_true(pmod(xxhash64(`{key[t]}`), 2) = 0) IS NULL") for t in tables}
    try:
        catalog.load_all(broken, name, buckets=8)
    except csv_files.LoadError as problem:
        failed = {line.split(":", 1)[0] for line in str(problem).split("; ")} & set(tables)
        found.extend({"table_name": t, "step": "reported", "row_count": int(t in failed)} for t in tables)
    counts("after failure", catalog.read_tables(spark, name))
    catalog.load_all({t: tables[t].where(f"pmod(xxhash64(`{key[t]}`), 2) = 0") for t in tables}, name, buckets=8)
    counts("seen by an early reader", early)
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return profile.small_table(spark, found, "table_name:string,step:string,row_count:bigint")


def load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaning counters as the load itself reports them."""
    loaded = loading.load_frames(source_frames(spark, sf_dir), P, check=False)
    return profile.small_table(spark, [{"metric": m, "value": n} for m, n in loaded.counters.items()], "metric:string,value:bigint")


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outlier list written as a snapshot twice: the second one replaces the first and keeps the table."""
    name = "stallbook_snapshot"
    catalog.reset_databases(spark, (name,))
    frames = warehouse.report_frames(source_frames(spark, sf_dir, number_items=False), P)
    found = materialize(features.seller_outliers(REPORTS["seller_performance"](frames, P)), "outliers")
    for _ in range(2):
        features.write_snapshot(found, f"{name}.ml_outliers")
    stored = spark.table(f"{name}.ml_outliers").drop("computed_at")
    kept = materialize(plain_numbers(stored), "snapshot")
    spark.sql(f"DROP DATABASE {name} CASCADE")
    return kept


def blank_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Missing comments written as empty text come out of the load's cleaning as NULL again."""
    reviews = source_frames(spark, sf_dir, number_items=False)["reviews"]
    blank = reviews.selectExpr("coalesce(review_comment_title, '') AS title", "coalesce(review_comment_message, '') AS message")
    return catalog.empty_strings_to_null(blank).selectExpr("count(1) AS row_count", "count(title) AS titles", "count(message) AS messages")


def display_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The retention report as it is shown, with the place of each row."""
    frames = warehouse.report_frames(source_frames(spark, sf_dir, number_items=False), P)
    shown = present("retention", REPORTS["retention"](frames, P))
    placed = shown.coalesce(1).withColumn("place", F.monotonically_increasing_id() + 1)  # one row per month pair
    return plain_numbers(placed.select("place", "cohort_month", "period_number", "retained_customers"))


def sql_over_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports and tables registered as views and joined in SQL."""
    frames = warehouse.report_frames(source_frames(spark, sf_dir, number_items=False), P)
    views = {
        "dim_customer": frames["dim_customer"],
        "dim_order": frames["dim_order"],
        "vw_customer_health": REPORTS["customer_health"](frames, P),
    }
    register_views(views)
    found = spark.sql(
        "SELECT h.customer_status, o.order_status, count(*) AS orders FROM dim_order o "
        "JOIN dim_customer c ON c.customer_id = o.customer_id "
        "LEFT JOIN vw_customer_health h ON h.customer_unique_id = c.customer_unique_id "
        "GROUP BY h.customer_status, o.order_status"
    )
    for view in views:  # the plan holds what they stand for; left in the session, they would hide tables of these names
        spark.catalog.dropTempView(view)
    return found


def _table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cleaned = warehouse.clean(source_frames(spark, sf_dir), P)
        return plain_numbers(warehouse.with_surrogate_keys(cleaned, P)[name])

    return run


QUERIES: dict[str, Query] = {f"v{i}_{name}": _report(name) for i, name in enumerate(REPORTS, 1)}

QUERIES |= {
    "s1_csv_round_trip": csv_round_trip,
    "s1_mixed_part_files": mixed_part_files,
    "s6_planted_defects": planted_defects,
    "s7_failed_loads": failed_loads,
    "s10_empty_strings": blank_texts,
    "s14_sql_over_views": sql_over_views,
    "s16_stored_loads": stored_loads,
    "m5_snapshots": snapshots,
    "r37_display_order": display_order,
    "t1_dim_date": _on_sources(lambda s: warehouse.dim_date_covering(s["orders"])),
    "t2_dim_geolocation": _table("dim_geolocation"),
    "t3_dim_customer": _table("dim_customer"),
    "t4_dim_seller": _table("dim_seller"),
    "t5_dim_product": _table("dim_product"),
    "t6_dim_order": _table("dim_order"),
    "t7_fact_order_items": _table("fact_order_items"),
    "t8_fact_payments": _table("fact_payments"),
    "t9_fact_reviews": _table("fact_reviews"),
    "t10_duplicate_keys": _on_cleaned(warehouse.duplicate_keys, number_items=True),
    "t10_load_order": _on_warehouse(lambda w: w["dim_order"].select("order_id", "order_key")),
    "t10_key_ranges": _on_warehouse(warehouse.key_ranges),
    "t11_unresolved_references": _on_warehouse(warehouse.unresolved_references),
    "q1_dataset_shapes": _on_sources(profile.dataset_shapes, number_items=True),
    "q2_column_completeness": _on_sources(profile.column_completeness, number_items=True),
    "q3_date_conversion": lambda spark, sf_dir: plain_numbers(profile.date_conversion(raw_date_frames(spark, sf_dir))),
    "q4_date_ranges": _on_sources(profile.date_ranges),
    "q5_numeric_summary": _on_sources(profile.numeric_summary),
    "q6_histograms": _on_sources(profile.histograms),
    "q7_box_plots": _on_sources(profile.box_plots),
    "q8_categorical_summary": _on_sources(profile.categorical_summary),
    "q9_top_categories": _on_sources(profile.top_categories),
    "q10_identifier_profile": _on_sources(profile.identifier_profile, number_items=True),
    "q11_duplicated_reviews": _on_sources(lambda s: checks.duplicated_rows(s["reviews"], "review_id")),
    "q12_orphaned_keys": _on_sources(checks.orphaned_keys),
    "q13_sequence_violations": _on_sources(checks.sequence_violations),
    "q14_shipping_outliers": _on_sources(checks.shipping_outliers, number_items=True),
    "q14_shipping_outlier_summary": _on_sources(checks.shipping_outlier_summary),
    "q14_outlier_seller_years": _on_sources(checks.outlier_seller_years),
    "q14_out_of_bounds": _on_sources(lambda s: checks.out_of_bounds(s, P)),
    "q14_out_of_bounds_summary": _on_sources(lambda s: checks.out_of_bounds_summary(s, P)),
    "q14_out_of_bounds_states": _on_sources(lambda s: checks.out_of_bounds_states(s, P)),
    "q14_zero_installments_by_type": _on_sources(checks.zero_installments_by_type),
    "q14_zero_installment_history": _on_sources(checks.zero_installment_history),
    "q14_zero_weight_products": _on_sources(checks.zero_weight_products),
    "q14_dearest_items": _on_sources(checks.dearest_items, number_items=True),
    "q14_largest_payments": _on_sources(checks.largest_payments),
    "q14_items_of_largest_payment": _on_sources(checks.items_of_largest_payment, number_items=True),
    "q14_untranslated_categories": _on_sources(checks.untranslated_categories),
    "q14_orders_without_payment": _on_sources(checks.orders_without_payment),
    "q14_delivered_without_date": _on_sources(checks.delivered_without_date),
    "q14_orders_without_items": _on_sources(checks.orders_without_items),
    "q14_negative_values": _on_sources(checks.negative_values),
    "q15_row_counts": lambda spark, sf_dir: plain_numbers(
        validation.row_counts(warehouse.report_frames(source_frames(spark, sf_dir, number_items=False), P), P.row_ranges)
    ),
    "q16_referential_integrity": _on_warehouse(validation.referential_integrity),
    "q17_required_columns": _on_warehouse(validation.required_columns),
    "q18_business_rules": _on_warehouse(lambda w: validation.business_rules(w, P)),
    "q19_untranslated_products": _on_cleaned(validation.untranslated_products),
    "q19_order_status_shares": _on_cleaned(validation.order_status_shares),
    "q19_price_summary": _on_cleaned(validation.price_summary),
    "q19_payment_type_shares": _on_cleaned(validation.payment_type_shares),
    "q19_review_score_shares": _on_cleaned(validation.review_score_shares),
    "q20_cleaning_counters": _on_sources(lambda s: validation.cleaning_counters(s, warehouse.clean(s, P), P)),
    "q20_load_counters": load_counters,
    "m1_seller_outliers": _on_report("seller_performance", features.seller_outliers),
    "m2_seller_clusters": _on_report("seller_performance", features.seller_clusters),
    "m3_category_clusters": _on_report("product_customer_affinity", features.category_clusters),
    "m4_review_drivers": _on_report("seller_performance", features.review_drivers),
    "m2_seller_cluster_facts": _on_report(
        "seller_performance",
        lambda r: features.cluster_facts(features.seller_clusters(r), "seller_id", features.SELLER_FEATURES, features.SELLER_NAMES),
    ),
    "m3_category_cluster_facts": _on_report(
        "product_customer_affinity",
        lambda r: features.cluster_facts(features.category_clusters(r), "category", features.CATEGORY_FEATURES, features.CATEGORY_NAMES),
    ),
    "m4_review_driver_facts": _on_report("seller_performance", lambda r: features.driver_facts(features.review_drivers(r))),
}
