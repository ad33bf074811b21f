"""Registry of the reports and their presentation order."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.operators.remembered import remembered
from stallbook.params import Params
from stallbook.plans.bases import Frames
from stallbook.plans.views import customers, market, sellers
from stallbook.sources.catalog import read_tables, register_views

Report = Callable[[Frames, Params], DataFrame]

REPORTS: dict[str, Report] = {
    "rfm": customers.rfm,
    "clv": customers.clv,
    "retention": customers.retention,
    "seller_performance": sellers.seller_performance,
    "regional_analysis": market.regional_analysis,
    "customer_health": customers.customer_health,
    "seller_health": sellers.seller_health,
    "new_vs_returning_revenue": customers.new_vs_returning_revenue,
    "pareto_analysis": sellers.pareto,
    "delivery_experience": market.delivery_experience,
    "product_customer_affinity": market.product_affinity,
    "payment_behaviour": market.payment_behaviour,
    "review_response_intelligence": market.review_response,
}


# Display order; "-" marks a descending column. NULLs come last either way.
DISPLAY: dict[str, str] = {
    "rfm": "-rfm_composite -total_spend",
    "clv": "-projected_clv_12m -historical_clv",
    "retention": "cohort_month period_number",
    "seller_performance": "-performance_score -total_revenue",
    "regional_analysis": "-total_revenue",
    "customer_health": "customer_status -last_order_month",
    "seller_health": "metric_type order_month seller_type",
    "new_vs_returning_revenue": "order_month",
    "pareto_analysis": "entity_type revenue_rank",
    "delivery_experience": "dimension -total_orders",
    "product_customer_affinity": "-total_revenue",
    "payment_behaviour": "dimension -pct_of_orders",
    "review_response_intelligence": "dimension -review_count",
}


def run_report(name: str, frames: Frames, params: Params) -> DataFrame:
    return REPORTS[name](frames, params)


def present(name: str, result: DataFrame) -> DataFrame:
    """A report in its display order. Kept apart: a sort of a big result is paid only on request."""
    keys = DISPLAY[name].split()
    return result.orderBy(*[F.desc_nulls_last(k[1:]) if k[0] == "-" else F.asc_nulls_last(k) for k in keys])


def view_frames(frames: Frames, params: Params) -> dict[str, DataFrame]:
    """Every report under its view name, for ``register_views``.

    Over a stored warehouse most are plans that follow its tables. Those that rank (rfm, clv, seller_performance,
    pareto_analysis) or share a stored base (seller_health, regional_analysis) hold intermediate results of the time
    of this call: they are snapshots. ``query_views`` makes them again when the tables have changed.
    """
    return {f"vw_{name}": report(frames, params) for name, report in REPORTS.items()}


def query_views(spark: SparkSession, database: str, text: str, params: Params) -> DataFrame:
    """Run SQL over ``vw_`` views of a stored warehouse, which show its tables' rows of now.

    A view named in ``text`` is registered anew if a file of the tables has changed since it was; otherwise its stored
    intermediate results are used again.
    """
    tables = read_tables(spark, database)
    for name in sorted(set(re.findall(r"\bvw_(\w+)", text)) & set(REPORTS)):
        remembered(spark, f"view vw_{name} of {database}", tables.values(), params, lambda name=name: register_views({f"vw_{name}": run_report(name, tables, params)}))
    return spark.sql(text)
