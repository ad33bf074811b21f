"""Model outputs on top of the seller and category reports.

The features, their scaling and the forest's target are not prescribed; the choices below
are ours and are listed in ``ASSUMPTIONS``. Training runs on Spark ML over report rows, which
are one per seller or category.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame

from stallbook.functions.scalars import add, agg
from stallbook.operators.materialize import materialize
from stallbook.quality.profile import small_table
from stallbook.sources.versions import replace_table

ASSUMPTIONS = (
    "quality is the mean review score; only sellers with enough orders for a score take part",
    "features are standardised to zero mean and unit variance",
    "the forest explains the mean review score of a seller",
)

SELLER_FEATURES = ["total_revenue", "avg_review_score", "on_time_rate", "avg_delivery_days", "cancellation_rate"]
CATEGORY_FEATURES = ["total_revenue", "avg_review_score", "category_repeat_rate_pct", "avg_delivery_days"]
FOREST_FEATURES = ["avg_delivery_days", "on_time_rate", "cancellation_rate", "avg_order_value", "total_orders"]

# Z-score cuts of the outlier list, and cluster names with the mean that earns each.
REVENUE_Z, QUALITY_Z = 0.5, -0.5
SELLER_NAMES = [("Elite", "avg_review_score", True), ("Non-Elite", "avg_review_score", False)]
CATEGORY_NAMES = [
    ("Revenue Core", "total_revenue", True),
    ("Trouble Spot", "avg_review_score", False),
    ("Small & Sticky", "category_repeat_rate_pct", True),
    ("Small & Well-Reviewed", "avg_review_score", True),
]


def scored_sellers(performance: DataFrame) -> DataFrame:
    return performance.filter("performance_score IS NOT NULL")


def seller_outliers(performance: DataFrame) -> DataFrame:
    """Sellers who sell a lot and are rated badly."""
    sellers = scored_sellers(performance).selectExpr(
        "seller_id", "CAST(total_revenue AS DOUBLE) AS revenue", "CAST(avg_review_score AS DOUBLE) AS quality"
    )
    # The moments are one row, read as a scalar subquery.
    measured = performance.sparkSession.sql(
        "SELECT *, (SELECT named_struct('mr', avg(revenue), 'sr', stddev_samp(revenue), 'mq', avg(quality), "
        "'sq', stddev_samp(quality)) FROM {sellers}) AS m FROM {sellers}",
        sellers=sellers,
    )
    z = measured.selectExpr(
        "seller_id", "revenue AS total_revenue", "quality AS avg_review_score",
        "(revenue - m.mr) / nullif(m.sr, 0) AS revenue_z", "(quality - m.mq) / nullif(m.sq, 0) AS quality_z",
    )
    kept = z.filter(f"revenue_z > {REVENUE_Z} AND quality_z < {QUALITY_Z}")
    return add(kept, revenue_z="round(revenue_z, 6)", quality_z="round(quality_z, 6)")


def _clusters(rows: DataFrame, key: str, features: list[str], k: int, names: list[tuple[str, str, bool]], seed: int) -> DataFrame:
    data = rows.selectExpr(key, *[f"coalesce(CAST({f} AS DOUBLE), 0D) AS {f}" for f in features])
    data = materialize(data, "features")  # fitting reads the rows many times, the report behind them once
    stages = [
        VectorAssembler(inputCols=features, outputCol="raw_features"),
        StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True),
        KMeans(k=k, seed=seed, maxIter=300, tol=0.0, featuresCol="features", predictionCol="cluster_label"),
    ]
    labelled = Pipeline(stages=stages).fit(data).transform(data).select(key, *features, "cluster_label")
    # The numbers k-means gives are arbitrary: name clusters by ranking their means.
    means = agg(labelled, ["cluster_label"], **{f: f"avg({f})" for f in features}).collect()
    left = {r["cluster_label"]: r for r in means}
    named = []
    for name, metric, highest in names:
        if left:
            pick = (max if highest else min)(sorted(left), key=lambda c: left[c][metric])
            named.append({"cluster_label": pick, "cluster_name": name})
            del left[pick]
    labels = small_table(rows.sparkSession, named, "cluster_label:int,cluster_name:string")
    return labelled.join(labels.hint("broadcast"), "cluster_label").select(key, *features, "cluster_label", "cluster_name")


def seller_clusters(performance: DataFrame, seed: int = 42) -> DataFrame:
    return _clusters(scored_sellers(performance), "seller_id", SELLER_FEATURES, 2, SELLER_NAMES, seed)


def category_clusters(affinity: DataFrame, seed: int = 42) -> DataFrame:
    return _clusters(affinity, "category", CATEGORY_FEATURES, 4, CATEGORY_NAMES, seed)


def review_drivers(performance: DataFrame, seed: int = 42) -> DataFrame:
    """Feature importances of a random forest, most important first."""
    data = scored_sellers(performance).selectExpr(
        "CAST(avg_review_score AS DOUBLE) AS label", *[f"coalesce(CAST({f} AS DOUBLE), 0D) AS {f}" for f in FOREST_FEATURES]
    )
    data = materialize(data, "features")
    features = VectorAssembler(inputCols=FOREST_FEATURES, outputCol="features").transform(data)
    model = RandomForestRegressor(numTrees=50, maxDepth=6, seed=seed, subsamplingRate=0.8).fit(features)
    ordered = sorted(zip(FOREST_FEATURES, model.featureImportances.toArray()), key=lambda p: (-p[1], p[0]))
    rows = [{"importance_rank": i, "feature": f, "importance": float(v)} for i, (f, v) in enumerate(ordered, 1)]
    return small_table(performance.sparkSession, rows, "importance_rank:int,feature:string,importance:double")


def cluster_facts(clusters: DataFrame, key: str, features: list[str], names: list[tuple[str, str, bool]]) -> DataFrame:
    """One row that any correct clustering shares: row and cluster counts, every row nearest to its own
    cluster's mean (in standardised features), and each name on the best mean left when its turn came."""
    stored = materialize(clusters, "clusters")
    spread = stored.selectExpr(*[f"coalesce(nullif(stddev_samp({f}), 0), 1) AS {f}" for f in features]).first()
    # At most as many rows as there are names.
    means = {r["cluster_name"]: r for r in agg(stored, ["cluster_name"], **{f: f"avg({f})" for f in features}).collect()}
    left, in_order = dict(means), True
    for name, metric, highest in names:
        if name in left:
            in_order &= left[name][metric] == (max if highest else min)(r[metric] for r in left.values())
            del left[name]

    def gap(name: str) -> str:
        return " + ".join(f"pow(({f} - {float(means[name][f])!r}D) / {float(spread[f])!r}D, 2)" for f in features)

    nearest = "least(" + ", ".join(gap(n) for n in means) + ", double('inf'))" if means else "0D"
    own = "CASE cluster_name " + " ".join(f"WHEN '{n}' THEN {gap(n)}" for n in means) + " END" if means else "0D"
    return stored.selectExpr(
        "count(1) AS row_count", f"{len(means)} AS cluster_count", f"coalesce(bool_and({own} <= {nearest} + 1e-9D), true) AS all_nearest",
        f"{str(in_order).lower()} AS names_in_order",
    )


def driver_facts(drivers: DataFrame) -> DataFrame:
    """One row: how many features, all importances 0 or more, and their sum."""
    return drivers.selectExpr("count(1) AS features", "bool_and(importance >= 0) AS none_negative", "round(sum(importance), 6) AS total_importance")


def stamped(result: DataFrame) -> DataFrame:
    """Mark a snapshot with the time it was computed."""
    return add(result, computed_at="localtimestamp()")


def write_snapshot(result: DataFrame, table: str) -> None:
    """Replace a snapshot's rows at once and keep the definition of an existing table."""
    spark = result.sparkSession
    snapshot = stamped(result)
    if spark.catalog.tableExists(table):
        snapshot = snapshot.to(spark.table(table).schema)
    replace_table(snapshot, table)
