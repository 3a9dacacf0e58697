"""Price and promotion scenarios, and price recommendations.

Scenarios unfold from arrays of literals on each group row, and one model
transform scores all groups and scenarios together.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, half_up, pct, ratio
from shelfwise.operators.errors import risk_flags
from shelfwise.operators.features import FEATURES, SERIES, TARGET, WEEK
from shelfwise.operators.models import predict

PRICE_STEPS = tuple(round(0.60 + 0.05 * i, 2) for i in range(12))


def _literal(values: Sequence) -> Column:
    return F.array(*[F.lit(v) for v in values])


def zone() -> Column:
    return band("discount_pct", labels.DISCOUNT_ZONE_EDGES, labels.DISCOUNT_ZONES)


def group_means(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Mean feature row per group: the starting point of its scenarios."""
    keep = [c for c in FEATURES if c not in by]
    return rows.groupBy(*by).agg(*[half_up(F.avg(c), 6).alias(c) for c in keep])


def _at_price(df: DataFrame, new_price: Column) -> DataFrame:
    """Set a price and bring discount and ratio in line with it."""
    return df.withColumn("price", new_price).withColumns(
        {
            "discount_pct": half_up(F.greatest(pct(F.col("base_price") - F.col("price"), "base_price"), F.lit(0.0)), 6),
            "price_ratio": half_up(ratio("price", "base_price"), 6),
        }
    )


def _at_levers(df: DataFrame, priority: Sequence[str]) -> DataFrame:
    count = (F.col("feature") + F.col("display") + F.col("tpr_only")).cast("double")
    return df.withColumns(
        {
            "promotion_count": count,
            "promotion_intensity": half_up(count / 3, 6),
            "priority_promo_intensity": F.when(F.upper("category").isin(*priority), count).otherwise(0.0),
        }
    )


def price_grid(groups: DataFrame, changes: Sequence[float] = labels.PRICE_CHANGES) -> DataFrame:
    """Each group row at every price change (percent)."""
    spread = groups.withColumn("price_change_pct", F.explode(_literal([float(c) for c in changes])))
    priced = _at_price(spread, half_up(F.col("price") * (1 + F.col("price_change_pct") / 100), 6))
    return priced.withColumn("discount_zone", zone())


def score_prices(
    model: Model, groups: DataFrame, by: Sequence[str], changes: Sequence[float] = labels.PRICE_CHANGES,
    risky_category: str = labels.RISK_CATEGORY,
) -> DataFrame:
    """Units, revenue, risk and revenue change against the unchanged price."""
    scored = predict(model, price_grid(groups, changes))
    revenue = F.col("prediction") * F.col("price")
    base = F.max(F.when(F.col("price_change_pct") == 0, revenue)).over(Window.partitionBy(*by))
    flagged = risk_flags(
        scored.withColumn("_rev", revenue).withColumn("_base", base),
        "prediction", "sales_last_4_week", risky_category=risky_category,
    )
    return flagged.select(
        *by,
        "price_change_pct",
        half_up("price", 2).alias("new_price"),
        half_up("discount_pct", 2).alias("discount_pct"),
        "discount_zone",
        half_up("prediction", 1).alias("predicted_units"),
        half_up("_rev", 2).alias("predicted_revenue"),
        half_up(pct(F.col("_rev") - F.col("_base"), "_base"), 2).alias("revenue_change_pct"),
        "flag_high_discount",
        "flag_risky_category",
        "flag_demand_spike",
        "risk_score",
        "high_uncertainty",
    )


def best_price(scenarios: DataFrame, by: Sequence[str]) -> DataFrame:
    """Best scenario per group: certain ones first, then highest revenue."""
    order = [F.asc("high_uncertainty"), F.desc("predicted_revenue"), F.asc("price_change_pct")]
    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return scenarios.withColumn("_place", place).filter("_place = 1").drop("_place")


def promo_grid(groups: DataFrame, priority: Sequence[str] = labels.PRIORITY_CATEGORIES) -> DataFrame:
    """Each group row under the eight lever combinations."""
    combos = F.array(
        *[
            F.struct(
                F.lit(name).alias("scenario"), F.lit(float(f)).alias("feature"), F.lit(float(d)).alias("display"),
                F.lit(float(t)).alias("tpr_only"),
            )
            for name, f, d, t in labels.PROMO_SCENARIOS
        ]
    )
    rest = groups.drop("feature", "display", "tpr_only")
    spread = rest.withColumn("_c", F.explode(combos)).select(*rest.columns, "_c.*")
    return _at_levers(spread, priority)


def score_promos(
    model: Model, groups: DataFrame, by: Sequence[str], priority: Sequence[str] = labels.PRIORITY_CATEGORIES
) -> DataFrame:
    return predict(model, promo_grid(groups, priority)).select(
        *by,
        "scenario",
        F.col("promotion_count").cast("int").alias("promotion_count"),
        half_up("prediction", 1).alias("predicted_units"),
        half_up(F.col("prediction") * F.col("price"), 2).alias("predicted_revenue"),
    )


# ---------------------------------------------------------------- recommendations


def next_week_rows(features: DataFrame, by: Sequence[str] = ("store_num", "category")) -> DataFrame:
    """Latest row per group with the history features of the week after it.

    The history is rebuilt with the definition used for training: single lags
    and rolling means of the row's own store-product series.
    """
    w = Window.partitionBy(*SERIES).orderBy(WEEK)
    x = F.col(TARGET)
    zero = F.lit(0.0)
    ahead = features.withColumns(
        {
            "sales_last_1_week": x,
            "sales_last_2_week": F.coalesce(F.lag(x, 1).over(w), zero),
            "sales_last_4_week": F.coalesce(F.lag(x, 3).over(w), zero),
            "sales_last_8_week": F.coalesce(F.lag(x, 7).over(w), zero),
            "rolling_mean_4w": half_up(F.avg(x).over(w.rowsBetween(-3, 0)), 6),
            "rolling_std_4w": F.coalesce(half_up(F.stddev_samp(x).over(w.rowsBetween(-3, 0)), 6), zero),
            "moving_avg_8w": half_up(F.avg(x).over(w.rowsBetween(-7, 0)), 6),
            "has_history": F.lit(1.0),
        }
    )
    rest = [c for c in features.columns if c not in by]
    latest = ahead.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(WEEK, "upc")).alias("_r"))
    return latest.select(*by, "_r.*")


def recommendation_grid(
    latest: DataFrame,
    months: Sequence[int] = (6,),
    price_steps: Sequence[float] = PRICE_STEPS,
    priority: Sequence[str] = labels.PRIORITY_CATEGORIES,
) -> DataFrame:
    """Every price step x lever combination x month for each group row."""
    timed = latest.drop("month", "quarter", "holiday_season").withColumn(
        "month", F.explode(_literal([float(m) for m in months]))
    )
    timed = timed.withColumns(
        {
            "quarter": F.floor((F.col("month") - 1) / 3).cast("double") + 1,
            "holiday_season": F.col("month").isin(*[float(m) for m in labels.HOLIDAY_MONTHS]).cast("double"),
        }
    )
    steps = timed.withColumn("price_step", F.explode(_literal(list(price_steps))))
    priced = _at_price(steps, half_up(F.col("price_step") * F.col("base_price"), 6))
    return promo_grid(priced, priority).withColumn("discount_zone", zone())


def recommend(
    regressor: Model,
    classifier: Model,
    features: DataFrame,
    by: Sequence[str] = ("store_num", "category"),
    months: Sequence[int] = (6,),
    priority: Sequence[str] = labels.PRIORITY_CATEGORIES,
    risky_category: str = labels.RISK_CATEGORY,
) -> DataFrame:
    """Scored grid of all groups with a place per group: certain scenarios
    first, then by revenue."""
    latest = next_week_rows(features, by)
    base = predict(regressor, latest).select(
        *by, (F.col("prediction") * F.col("price")).alias("_base_revenue")
    )
    grid = recommendation_grid(latest, months, priority=priority)
    scored = predict(regressor, grid).drop("features").withColumnRenamed("prediction", "predicted_units")
    rated = classifier.transform(scored).withColumn("high_sales_probability", vector_to_array("probability")[1])
    flagged = risk_flags(rated, "predicted_units", "rolling_mean_4w", risky_category=risky_category)
    out = flagged.join(base, list(by)).withColumn("_rev", F.col("predicted_units") * F.col("price"))
    order = [F.asc("high_uncertainty"), F.desc("_rev"), F.asc("price"), F.asc("scenario")]
    return out.select(
        *by,
        "month",
        F.row_number().over(Window.partitionBy(*by, "month").orderBy(*order)).alias("place"),
        half_up("price", 2).alias("price"),
        half_up("discount_pct", 1).alias("discount_pct"),
        "scenario",
        *[F.col(c).cast("int").alias(c) for c in ("feature", "display", "tpr_only")],
        half_up("predicted_units", 1).alias("predicted_units"),
        half_up("_rev", 2).alias("predicted_revenue"),
        half_up(pct(F.col("_rev") - F.col("_base_revenue"), "_base_revenue"), 2).alias("revenue_lift_pct"),
        half_up("high_sales_probability", 3).alias("high_sales_probability"),
        "discount_zone",
        "flag_high_discount",
        "flag_risky_category",
        "flag_demand_spike",
        "risk_score",
        "high_uncertainty",
    )


def cluster_strategy(profile: DataFrame) -> DataFrame:
    """Clusters above the mean cluster revenue are premium."""
    premium, sensitive = labels.CLUSTER_STRATEGY
    level = F.avg("total_revenue").over(Window.partitionBy())
    return profile.select(
        "cluster", F.when(F.col("total_revenue") > level, premium).otherwise(sensitive).alias("cluster_strategy")
    )


def best_per_cluster(recommended: DataFrame, clusters: DataFrame, profile: DataFrame, category: str | None = None) -> DataFrame:
    """Best scenario per month and category of each cluster's representative: its lowest-numbered store with the category."""
    chosen = recommended if category is None else recommended.filter(F.col("category") == category)
    sold = chosen.select("category", "store_num").distinct().join(clusters.select("store_num", "cluster"), "store_num")
    first = sold.groupBy("cluster", "category").agg(F.min("store_num").alias("store_num"))
    return (
        chosen.filter("place = 1")
        .join(first, ["category", "store_num"])
        .join(cluster_strategy(profile), "cluster")
        .withColumnRenamed("store_num", "representative_store")
    )


def promo_landscape(recommended: DataFrame, clusters: DataFrame, category: str | None = None, top: int = 4) -> DataFrame:
    """Best lever combinations per category, month and cluster by their highest
    mean revenue over the cluster's stores."""
    chosen = recommended if category is None else recommended.filter(F.col("category") == category)
    by = ["category", "month", "cluster"]
    per_price = (
        chosen.join(clusters.select("store_num", "cluster"), "store_num")
        .groupBy(*by, "scenario", "discount_pct")
        .agg(F.avg("predicted_revenue").alias("_rev"))
    )
    best = per_price.groupBy(*by, "scenario").agg(
        half_up(F.max("_rev"), 2).alias("best_revenue"), F.max_by("discount_pct", "_rev").alias("discount_pct")
    )
    place = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("best_revenue"), "scenario"))
    return best.withColumn("place", place).filter(F.col("place") <= top)
