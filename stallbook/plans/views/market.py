"""Market reports: regions, delivery, categories, payments, reviews.

Each big table is read once and reduced to a small table of sums at the finest grain of the
report; coarser grains and shares are rolled up from that small table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from stallbook.functions.scalars import (
    add, agg, agg_sets, cents, mean, mean_money, micros, money, percent, ratio, whole_days,
)
from stallbook.operators.materialize import materialize
from stallbook.operators.top import first_per_group, leaders_per_group
from stallbook.params import Params
from stallbook.plans.bases import (
    VALUE, Frames, delivered, order_values, person_orders, review_scores, seller_orders,
)

NO_CATEGORY = "uncategorised"
ARRIVED, DUE, BOUGHT = "order_delivered_customer_date", "order_estimated_delivery_date", "order_purchase_timestamp"


def _sums(columns: list[str]) -> dict[str, str]:
    return {c: f"sum({c})" for c in columns}


def _running_share(df: DataFrame, key: str) -> DataFrame:
    """Add ``total`` and ``so_far`` of ``value``, largest first. For small results only."""
    return add(
        df,
        total="sum(value) OVER ()",
        so_far=f"sum(value) OVER (ORDER BY value DESC, {key} ASC NULLS LAST ROWS UNBOUNDED PRECEDING)",
    )


def regional_analysis(w: Frames, params: Params) -> DataFrame:
    lines = person_orders(w).join(review_scores(w["fact_reviews"]), "order_id", "left")
    # Persons first: the distinct count becomes a row count and a big state is split by person.
    people = agg(
        lines,
        ["customer_state", "customer_unique_id"],
        orders="count(1)",
        price="sum(price_cents)",
        freight="sum(freight_cents)",
        days=f"sum({whole_days(ARRIVED, BOUGHT)})",
        day_rows=f"count({ARRIVED} - {BOUGHT})",
        on_time=f"count_if({ARRIVED} <= {DUE})",
        timed=f"count({ARRIVED} - {DUE})",
        score="sum(order_score)",
        scored="count(order_score)",
    )
    demand = agg(people, ["customer_state"], unique_customers="count(customer_unique_id)", **_sums(people.columns[2:]))

    places = w["dim_seller"].select("seller_id", "seller_state")
    sold = seller_orders(w).selectExpr("seller_id", "order_id", f"{VALUE} AS sold_cents")
    sold = sold.join(places, "seller_id").filter("seller_state IS NOT NULL")
    sold = materialize(sold.withColumnRenamed("seller_state", "customer_state"), "seller-orders")
    # Orders and sellers first: distinct counts become row counts.
    state_orders = agg(agg(sold, ["customer_state", "order_id"], n="count(1)"), ["customer_state"], seller_orders="count(1)")
    state_sellers = agg(
        agg(sold, ["customer_state", "seller_id"], cents="sum(sold_cents)"),
        ["customer_state"],
        total_sellers="count(1)",
        seller_cents="sum(cents)",
    )
    supply = state_orders.join(state_sellers, "customer_state")
    # A handful of states from here on.
    ranked = _running_share(add(demand, value="price + freight"), "customer_state")
    return ranked.join(supply, "customer_state", "left").selectExpr(
        "customer_state AS state", "unique_customers", "orders AS total_orders",
        f"{money('value')} AS total_revenue",
        f"{mean_money('value', 'orders')} AS avg_order_value",
        f"{money('price')} AS total_product_revenue",
        f"{money('freight')} AS total_freight_revenue",
        f"{percent('value', 'total')} AS revenue_share_pct",
        f"{percent('so_far', 'total')} AS cumulative_revenue_pct",
        f"{mean('days', 'day_rows', 1)} AS avg_delivery_days",
        f"{percent('on_time', 'timed')} AS on_time_rate",
        f"{mean('score', 'scored', 2)} AS avg_review_score",
        "coalesce(total_sellers, 0) AS total_sellers",
        f"{money('coalesce(seller_cents, 0)')} AS seller_total_revenue",
        "coalesce(seller_orders, 0) AS seller_total_orders",
        f"{ratio('orders', 'coalesce(total_sellers, 0)', 1)} AS orders_per_seller",
    )


def delivery_experience(w: Frames, params: Params) -> DataFrame:
    timed = delivered(w["dim_order"]).filter(f"{ARRIVED} IS NOT NULL AND {DUE} IS NOT NULL")
    people = w["dim_customer"].select("customer_id", "customer_state")
    orders = timed.join(people, "customer_id").join(review_scores(w["fact_reviews"]), "order_id", "left")
    # One row per state, status and number of days: delivery days repeat heavily.
    spread = agg(
        orders,
        [
            "customer_state",
            f"CASE WHEN {ARRIVED} <= {DUE} THEN 'On-Time' ELSE 'Late' END AS status",
            f"{whole_days(ARRIVED, BOUGHT)} AS days",
        ],
        n="count(1)",
        early=f"count_if({ARRIVED} <= {DUE} - interval {params.early_days} days)",
        vs_due=f"sum({whole_days(ARRIVED, DUE)})",
        score="sum(order_score)",
        scored="count(order_score)",
    )
    late, prompt = "FILTER (WHERE status = 'Late')", "FILTER (WHERE status = 'On-Time')"
    measures = {
        "grain": "grouping_id()",
        "total_orders": "sum(n)",
        "avg_delivery_days": mean("sum(days * n)", "sum(n) FILTER (WHERE days IS NOT NULL)", 1),
        "min_delivery_days": "CAST(min(days) AS DECIMAL(20,1))",
        "max_delivery_days": "CAST(max(days) AS DECIMAL(20,1))",
        "median_delivery_days": "CAST(round(CAST(percentile(days, 0.5D, n) AS DECIMAL(20,6)), 1) AS DECIMAL(20,1))",
        "on_time_rate": percent(f"coalesce(sum(n) {prompt}, 0)", "sum(n)"),
        "early_delivery_rate": percent("sum(early)", "sum(n)"),
        "late_delivery_rate": percent(f"coalesce(sum(n) {late}, 0)", "sum(n)"),
        "avg_days_vs_estimate": mean("sum(vs_due)", "sum(n)", 1),
        "avg_review_score": mean("sum(score)", "sum(scored)", 2),
        "avg_review_on_time": mean(f"sum(score) {prompt}", f"sum(scored) {prompt}", 2),
        "avg_review_late": mean(f"sum(score) {late}", f"sum(scored) {late}", 2),
    }
    out = agg_sets(spread, [[], ["customer_state"], ["status"]], ["customer_state", "status"], measures)
    # Grouping ids of (customer_state, status): 3 = neither, 1 = state only, 2 = status only.
    return out.selectExpr(
        "CASE grain WHEN 3 THEN 'Overall' WHEN 1 THEN 'By State' ELSE 'On-time vs Late' END AS dimension",
        "CASE grain WHEN 3 THEN 'National' WHEN 1 THEN customer_state ELSE status END AS dimension_value",
        *list(measures)[1:],
    )


def category_of(w: Frames) -> DataFrame:
    return w["dim_product"].selectExpr(
        "product_id", f"coalesce(product_category_name_english, '{NO_CATEGORY}') AS category"
    )


def product_affinity(w: Frames, params: Params) -> DataFrame:
    people = w["dim_customer"].select("customer_id", "customer_unique_id", "customer_state")
    # Joined with people last, so that the join with lines below shuffles both of its sides
    # and an order with very many lines can be split.
    orders = (
        delivered(w["dim_order"])
        .join(review_scores(w["fact_reviews"]), "order_id", "left")
        .join(people, "customer_id")
        .selectExpr(
            "order_id", "customer_unique_id", "customer_state", "order_score", f"{whole_days(ARRIVED, BOUGHT)} AS days"
        )
    )
    # Lines of one product within one order merge before any join.
    lines = order_values(w["fact_order_items"], "product_id").join(category_of(w), "product_id")
    sold = lines.join(orders, "order_id")
    # Orders and products of a category are both counted once. Each sold row yields one row
    # for its order and one for its product, so the joins above run a single time.
    order_cols = ["customer_unique_id", "customer_state", "order_score", "days", "items", "price_cents", "freight_cents"]
    types = dict(sold.dtypes)
    own = ", ".join(f"'{c}', {c}" for c in order_cols)
    blank = ", ".join(f"'{c}', CAST(NULL AS {types[c]})" for c in order_cols)
    marks = sold.selectExpr(
        "category",
        f"inline(array(named_struct('is_order', true, 'id', order_id, {own}), "
        f"named_struct('is_order', false, 'id', product_id, {blank})))",
    )
    once = agg(
        marks,
        ["category", "is_order", "id", "customer_unique_id", "customer_state", "order_score", "days"],
        **_sums(["items", "price_cents", "freight_cents"]),
    )
    shoppers = agg(
        once,
        ["category", "customer_unique_id", "customer_state"],
        orders="count_if(is_order)",
        products="count_if(NOT is_order)",
        items="sum(items)",
        price="sum(price_cents)",
        freight="sum(freight_cents)",
        days="sum(days)",
        day_rows="count(days)",
        score="sum(order_score)",
        scored="count(order_score)",
        fives="count_if(order_score = 5)",
        ones="count_if(order_score = 1)",
    )
    # A person has one row per state lived in; count the person on one of them.
    person = "PARTITION BY category, customer_unique_id ORDER BY customer_state ASC NULLS LAST"
    marked = add(
        shoppers,
        of_person=f"sum(orders) OVER ({person} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
        counted=f"row_number() OVER ({person}) = 1 AND customer_unique_id IS NOT NULL",
    )
    measures = shoppers.columns[3:]
    by_state = agg(
        marked,
        ["category", "customer_state"],
        **_sums(measures),
        people="count_if(counted)",
        repeat_customers="count_if(counted AND of_person >= 2)",
    )
    # Categories x states is small: total it per category next to the leading state.
    summed = [*measures, "people", "repeat_customers"]
    placed = add(
        by_state,
        place="row_number() OVER (PARTITION BY category ORDER BY orders DESC, customer_state ASC NULLS LAST)",
        **{f"all_{c}": f"sum({c}) OVER (PARTITION BY category)" for c in summed},
    )
    leading = placed.filter("place = 1").selectExpr(
        "category", "customer_state AS top_customer_state", "orders AS top_state_orders",
        *[f"all_{c} AS {c}" for c in summed], "all_price + all_freight AS value",
    )
    ranked = add(_running_share(leading, "category"), share=percent("value", "total"))
    return ranked.selectExpr(
        "category", "orders AS total_orders", "items AS total_items", "products AS unique_products",
        "people AS unique_customers",
        f"{money('value')} AS total_revenue",
        f"{mean_money('value', 'items')} AS avg_item_value",
        f"{money('price')} AS total_product_revenue",
        f"{money('freight')} AS total_freight_revenue",
        f"{percent('freight', 'value')} AS freight_pct_of_revenue",
        f"{mean('days', 'day_rows', 1)} AS avg_delivery_days",
        "share AS revenue_share_pct",
        f"{percent('so_far', 'total')} AS cumulative_revenue_pct",
        f"{mean('score', 'scored', 2)} AS avg_review_score",
        "scored AS total_reviews",
        f"{percent('fives', 'scored')} AS pct_5_star",
        f"{percent('ones', 'scored')} AS pct_1_star",
        "people AS total_category_customers",
        "repeat_customers",
        f"{percent('repeat_customers', 'people')} AS category_repeat_rate_pct",
        "top_customer_state", "top_state_orders",
        "CASE WHEN share >= 5 THEN 'High Revenue' WHEN share >= 1 THEN 'Mid Revenue' ELSE 'Long Tail' END AS revenue_tier",
    )


# Instalment bands by inclusive upper bound, first match wins.
BANDS = [("2-3", 3), ("4-6", 6), ("7-12", 12)]


def instalment_band(count: str) -> str:
    steps = " ".join(f"WHEN {count} <= {upper} THEN '{label}'" for label, upper in BANDS)
    return f"CASE WHEN {count} = 1 THEN '1 (Single)' {steps} ELSE '12+' END"


def payment_behaviour(w: Frames, params: Params) -> DataFrame:
    first = first_per_group(
        w["fact_payments"], ["order_id"], ["payment_sequential", "payment_type", "payment_installments", "payment_value"]
    )
    values = order_values(w["fact_order_items"]).selectExpr("order_id", f"{VALUE} AS value")
    # Only delivered orders contribute money, so only they need their items.
    paid = delivered(w["dim_order"]).select("order_id").join(values, "order_id")
    cross = agg(
        first.join(paid, "order_id", "left"),
        ["payment_type", f"{instalment_band('payment_installments')} AS band"],
        n="count(order_id)",
        instalments="sum(CAST(payment_installments AS BIGINT))",
        counted="count(payment_installments)",
        single="count_if(payment_installments = 1)",
        multi="count_if(payment_installments > 1)",
        high="count_if(payment_installments > 6)",
        value="sum(value)",
        valued="count(value)",
    )
    measures = {"grain": "grouping_id()", **_sums(cross.columns[2:])}
    grains = [["payment_type"], ["band"], ["payment_type", "band"]]
    sums = agg_sets(cross, grains, ["payment_type", "band"], measures)
    whole = "OVER (PARTITION BY grain)"
    average = mean_money("value", "valued")
    # Grouping ids of (payment_type, band): 1 = type only, 2 = band only, 0 = both.
    return sums.selectExpr(
        "CASE grain WHEN 1 THEN 'By Payment Type' WHEN 2 THEN 'By Instalment Band' ELSE 'Cross' END AS dimension",
        "CASE grain WHEN 2 THEN band ELSE payment_type END AS dimension_value",
        "CASE grain WHEN 0 THEN band END AS sub_dimension",
        "n AS order_count",
        f"{money('value')} AS total_payment_value",
        f"{average} AS avg_payment_value",
        f"{average} AS avg_order_item_total",
        f"{mean('instalments', 'counted', 2)} AS avg_instalments",
        "single AS single_instalment_orders",
        "multi AS multi_instalment_orders",
        f"{percent('single', 'n')} AS pct_single_instalment",
        f"{percent('high', 'n')} AS pct_high_instalment",
        f"{percent('n', f'sum(n) {whole}')} AS pct_of_orders",
        f"{percent('value', f'sum(value) {whole}')} AS pct_of_revenue",
    )


def review_response(w: Frames, params: Params) -> DataFrame:
    # The dearest item of each order; only the tied leaders need their category.
    priced = w["fact_order_items"].selectExpr(
        "order_id", "product_id", f"{cents('price')} + {cents('freight_value')} AS value"
    )
    priced = agg(priced, ["order_id", "product_id", "value"], _n="count(1)").drop("_n")
    dearest = leaders_per_group(priced, ["order_id"], ["value DESC NULLS LAST"]).join(category_of(w), "product_id", "left")
    named = {"category": f"coalesce(category, '{NO_CATEGORY}')"}
    # Leaders of one order share their value. Grouping by it as well leaves one row per order
    # but no order_id partitioning, so the join below can split an order with very many reviews.
    tops = agg(add(dearest, **named), ["order_id", "value"], category="min(category)")
    reviews = w["fact_reviews"].selectExpr(
        "review_id", "order_id", "review_score", "review_creation_date",
        f"{micros('review_answer_timestamp')} - {micros('review_creation_date')} AS wait",
        "review_comment_message IS NOT NULL AS commented",
    )
    one = first_per_group(
        add(reviews.join(tops, "order_id", "left"), **named),
        ["review_id"],
        [
            "value DESC NULLS LAST", "order_id", "category", "review_creation_date", "wait ASC NULLS LAST",
            "review_score", "commented",
        ],
    )
    hours = f"CAST({ratio('wait', '3600000000', 1, 'DECIMAL(20,0)')} AS DECIMAL(18,1))"
    cells = agg(
        add(one, hours=hours),
        ["review_score", "category"],
        n="count(1)",
        hours="sum(hours)",
        answered="count(hours)",
        commented="count_if(commented)",
    )
    scored = add(
        cells,
        band="CASE WHEN review_score >= 4 THEN 'Positive (4-5)' WHEN review_score = 3 THEN 'Neutral (3)' ELSE 'Negative (1-2)' END",
        points="CAST(review_score AS BIGINT) * n",
        fives="CASE WHEN review_score = 5 THEN n ELSE 0 END",
        ones="CASE WHEN review_score = 1 THEN n ELSE 0 END",
    )
    measures = {"grain": "grouping_id()", **_sums(["n", "hours", "answered", "commented", "points", "fives", "ones"])}
    keys = ["review_score", "band", "category"]
    sums = agg_sets(scored, [[k] for k in keys], keys, measures)
    # Grouping ids of (review_score, band, category): 3 = score, 5 = band, 6 = category.
    placed = add(
        sums,
        total="sum(n) OVER (PARTITION BY grain)",
        so_far="sum(n) OVER (PARTITION BY grain ORDER BY review_score DESC NULLS FIRST ROWS UNBOUNDED PRECEDING)",
    )
    labels = (
        "CASE grain WHEN 3 THEN array('Score Distribution', 'Response Time') WHEN 5 THEN array('By Score Band') "
        "ELSE array('By Category') END"
    )
    return add(placed, dimension=f"explode({labels})").selectExpr(
        "dimension",
        "CASE grain WHEN 3 THEN CAST(review_score AS STRING) WHEN 5 THEN band ELSE category END AS dimension_value",
        "CAST(NULL AS STRING) AS sub_dimension",
        "n AS review_count",
        f"CASE WHEN dimension IN ('Score Distribution', 'By Score Band') THEN {percent('n', 'total')} END AS pct_of_total",
        f"CASE WHEN dimension = 'Score Distribution' THEN {percent('so_far', 'total')} END AS cumulative_pct",
        f"{mean('hours', 'answered', 1)} AS avg_response_hours",
        "commented AS reviews_with_comment",
        f"{percent('commented', 'n')} AS pct_with_comment",
        "answered AS reviews_with_response",
        f"{percent('answered', 'n')} AS pct_with_response",
        f"CASE WHEN grain <> 3 THEN {mean('points', 'n', 2)} END AS avg_review_score",
        f"CASE WHEN grain = 6 THEN {percent('fives', 'n')} END AS pct_5_star",
        f"CASE WHEN grain = 6 THEN {percent('ones', 'n')} END AS pct_1_star",
    )
