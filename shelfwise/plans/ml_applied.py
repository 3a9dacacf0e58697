"""Forecast (TS10-13), cluster (CL), rule (AR), error (ER), scenario (SC) and
recommendation (RC) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.operators import cluster, errors, forecast, models, rules, scenario
from shelfwise.operators.features import FEATURES, WEEK
from shelfwise.plans import ml
from shelfwise.plans.context import PRIORITY, RISKY, Context, query
from shelfwise.sources.marts import cut_lineage, stored_model, stored_result

CATEGORY = ["category"]


def weekly_units(cx: Context):
    return cx.features.groupBy("category", WEEK).agg(F.sum("units").alias("total_units"))


def portfolio_units(cx: Context):
    return cx.features.groupBy(WEEK).agg(F.sum("units").alias("total_units"))


@query("ts10_moving_average")
def moving_average(cx: Context):
    return forecast.moving_average(weekly_units(cx), CATEGORY, "total_units")


@query("ts10_moving_average_metrics")
def moving_average_metrics(cx: Context):
    out = forecast.moving_average(portfolio_units(cx), [], "total_units")
    return models.regression_metrics(out, (), "actual")


def series_model(cx: Context):
    """The boosted forecast model over all categories, fitted once."""
    fit = lambda: forecast.fit_boosted(weekly_units(cx), CATEGORY, "total_units")[0]
    return stored_model(cx.spark, cx.sf_dir, "forecast", fit)


@query("ts11_boosted_one_step")
def boosted_one_step(cx: Context):
    return forecast.one_step(weekly_units(cx), CATEGORY, "total_units", model=series_model(cx))


@query("ts11_boosted_recursive")
def boosted_recursive(cx: Context):
    return forecast.recursive(weekly_units(cx), CATEGORY, "total_units", model=series_model(cx))


@query("ts12_forecast_comparison")
def forecast_comparison(cx: Context):
    weekly = weekly_units(cx)
    args = (weekly, CATEGORY, "total_units")
    model = series_model(cx)
    return forecast.compare(
        {
            "Moving Average": ("12 weeks", forecast.moving_average(*args)),
            "Seasonal Naive": ("12 weeks", forecast.seasonal_naive(*args)),
            "Fourier Regression": ("12 weeks", forecast.fourier_regression(*args)),
            "Seasonal Smoothing": ("12 weeks", forecast.seasonal_smoothing(*args)),
            "Boosted (recursive)": ("12 weeks", forecast.recursive(*args, model=model)),
            "Boosted (one step)": ("1 week", forecast.one_step(*args, model=model)),
        }
    )


@query("ts13_seasonal_naive")
def seasonal_naive(cx: Context):
    return forecast.seasonal_naive(weekly_units(cx), CATEGORY, "total_units")


@query("ts13_seasonal_smoothing")
def seasonal_smoothing(cx: Context):
    return forecast.seasonal_smoothing(weekly_units(cx), CATEGORY, "total_units")


@query("ts13_fourier_regression")
def fourier_regression(cx: Context):
    return forecast.fourier_regression(weekly_units(cx), CATEGORY, "total_units")


# ---------------------------------------------------------------- clusters

CLUSTERS = 3


def scaled_profile(cx: Context):
    """Standardised profile, read back from a table: the fits re-read it often."""
    return cluster.standardise(cut_lineage(cluster.store_profile(cx.star), "store_profile"))


def clustered(cx: Context):
    return cluster.assign(scaled_profile(cx), CLUSTERS)


@query("cl1_store_profile")
def store_profile(cx: Context):
    return cluster.store_profile(cx.star)


@query("cl2_choose_k")
def choose_k(cx: Context):
    return cluster.choose_k(scaled_profile(cx))


@query("cl3_cluster_profile")
def cluster_profile(cx: Context):
    return cluster.cluster_profile(clustered(cx))


@query("cl4_principal_axes")
def principal_axes(cx: Context):
    return cluster.principal_axes(scaled_profile(cx))


@query("cl5_cluster_by_segment")
def cluster_by_segment(cx: Context):
    return cluster.cluster_by_segment(clustered(cx))


@query("cl6_merged_rows")
def merged_rows(cx: Context):
    """Every row of the model table with its store's cluster."""
    return cluster.merge_clusters(cx.features, clustered(cx)).select(WEEK, "store_num", "upc", "category", "units", "cluster")


@query("cl6_rows_with_cluster")
def rows_with_cluster(cx: Context):
    merged = cluster.merge_clusters(cx.features, clustered(cx))
    return merged.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("store_num").alias("stores"),
        F.count(F.when(F.col("cluster").isNull(), 1)).alias("rows_without_cluster"),
    )


# ---------------------------------------------------------------- rules


@query("ar1_lever_activation")
def lever_activation(cx: Context):
    return rules.activation(cx.star.fact)


def lever_sets(cx: Context):
    return rules.frequent_sets(rules.lever_baskets(cx.star.fact))


@query("ar2_lever_itemsets")
def lever_itemsets(cx: Context):
    return rules.itemsets(lever_sets(cx))


@query("ar3_lever_rules")
def lever_rules(cx: Context):
    """All rules; the test levers are independent, so any lift is kept."""
    return rules.rules(lever_sets(cx), min_lift=0.0)


@query("ar3_top_rules")
def top_rules(cx: Context):
    found = rules.rules(lever_sets(cx), min_lift=0.0)
    ties = ["antecedents", "consequents"]
    by_lift = found.orderBy(F.desc("lift"), *ties).limit(5).withColumn("ranked_by", F.lit("lift"))
    by_confidence = found.orderBy(F.desc("confidence"), *ties).limit(5).withColumn("ranked_by", F.lit("confidence"))
    return by_lift.unionByName(by_confidence)


BASKET_SUPPORT = 0.001


def manufacturer_sets(cx: Context):
    """Manufacturers bought together in an order, sets of any size.

    Order baskets keep their size when the data grow; a store-week of the test
    tables fills up with the whole catalogue.
    """
    part = cx.table("part").select("p_partkey", F.upper("p_brand").alias("item"))
    lines = cx.table("lineitem").select("l_orderkey", "l_partkey").join(part, F.col("l_partkey") == F.col("p_partkey"))
    return rules.frequent_sets(rules.baskets_of(lines, ["l_orderkey"], "item"), BASKET_SUPPORT)


@query("ar2_basket_itemsets")
def basket_itemsets(cx: Context):
    return rules.itemsets(manufacturer_sets(cx))


@query("ar3_basket_rules")
def basket_rules(cx: Context):
    return rules.rules(manufacturer_sets(cx))


@query("ar2_store_week_itemsets")
def store_week_itemsets(cx: Context):
    """Sets of up to three products sold together in a store and week, in at least 1 of 1,000."""
    baskets = rules.baskets_of(cx.star.fact.withColumn("item", F.col("upc").cast("string")), ["date_key", "store_num"], "item")
    return rules.itemsets(rules.frequent_sets(baskets, BASKET_SUPPORT, max_size=3))


# ---------------------------------------------------------------- errors

KEY = [WEEK, "store_num", "upc"]


def baseline_errors(cx: Context):
    return errors.error_frame(ml.baseline(cx))


@query("er1_error_rows")
def error_rows(cx: Context):
    return baseline_errors(cx).select(*KEY, "actual", "predicted", "error", "abs_error", "error_pct", "smape_error")


@query("er1_error_summary")
def error_summary(cx: Context):
    return errors.error_summary(baseline_errors(cx))


@query("er2_error_by_discount")
def error_by_discount(cx: Context):
    return errors.error_by(
        baseline_errors(cx).withColumn("discount_bucket", errors.discount_bucket()), "discount_bucket"
    )


@query("er2_error_by_category")
def error_by_category(cx: Context):
    return errors.error_by(baseline_errors(cx), "category")


@query("er2_error_by_segment")
def error_by_segment(cx: Context):
    return errors.error_by(baseline_errors(cx), "seg_value_name")


@query("er3_largest_errors")
def largest_errors(cx: Context):
    out = errors.largest_errors(baseline_errors(cx), KEY)
    return out.select(*KEY, "category", "actual", "predicted", "abs_error")


@query("er3_extreme_groups")
def extreme_groups(cx: Context):
    return errors.extreme_groups(errors.error_by(baseline_errors(cx), "category"), "category")


@query("er4_risk_flags")
def risk_flags(cx: Context):
    flagged = errors.risk_flags(baseline_errors(cx), risky_category=RISKY)
    return flagged.groupBy("risk_level", "risk_score", "high_uncertainty").agg(
        F.count(F.lit(1)).alias("row_count"),
        *[
            F.count(F.when(F.col(c), 1)).alias(c)
            for c in ("flag_high_discount", "flag_risky_category", "flag_demand_spike")
        ],
    )


@query("er4_flagged_rows")
def flagged_rows(cx: Context):
    flagged = errors.risk_flags(baseline_errors(cx), risky_category=RISKY)
    marks = [F.col(c).cast("boolean").alias(c) for c in ("flag_high_discount", "flag_risky_category", "flag_demand_spike")]
    return flagged.select(
        "week_end_date", "store_num", "upc", *marks, F.col("risk_score").cast("bigint").alias("risk_score"), "risk_level"
    )


# ---------------------------------------------------------------- scenarios

GROUP = ["category", "seg_value_name"]


@query("sc1_price_grid")
def price_grid(cx: Context):
    """Prices, discounts and zones of every scenario, before any model."""
    grid = scenario.price_grid(scenario.group_means(cx.features, GROUP))
    return grid.select(*GROUP, "price_change_pct", "price", "discount_pct", "price_ratio", "discount_zone")


def price_scenarios_for(cx: Context, by: list[str], rows):
    model = ml.boosted_model(cx)
    return scenario.score_prices(model, scenario.group_means(rows, by), by, risky_category=RISKY)


@query("sc1_price_scenarios")
def price_scenarios(cx: Context):
    return price_scenarios_for(cx, GROUP, cx.features)


@query("sc2_best_price_per_cluster")
def best_price_per_cluster(cx: Context):
    by = ["category", "cluster"]
    rows = cluster.merge_clusters(cx.features, clustered(cx))
    return scenario.best_price(price_scenarios_for(cx, by, rows), by)


@query("sc3_promo_grid")
def promo_grid(cx: Context):
    grid = scenario.promo_grid(scenario.group_means(cx.features, GROUP), PRIORITY)
    cols = ["scenario", "feature", "display", "tpr_only", "promotion_count", "promotion_intensity"]
    return grid.select(*GROUP, *cols, "priority_promo_intensity")


@query("sc3_promo_scenarios")
def promo_scenarios(cx: Context):
    model = ml.boosted_model(cx)
    return scenario.score_promos(model, scenario.group_means(cx.features, GROUP), GROUP, PRIORITY)


MONTHS = tuple(range(1, 13))


def recommended(cx: Context):
    """Every group's scored grid for every month, built once."""
    train, _ = models.time_split(ml.labelled(cx))
    forest = models.classifiers(trees=ml.TREES)["Random Forest"]
    label = stored_model(cx.spark, cx.sf_dir, f"high-sales-{ml.TREES}", lambda: models.fit(train, forest, FEATURES))
    build = lambda: scenario.recommend(
        ml.boosted_model(cx), label, cx.features, months=MONTHS, priority=PRIORITY, risky_category=RISKY
    )
    return stored_result(cx.spark, cx.sf_dir, "recommended", build)


@query("rc1_next_week_rows")
def next_week_rows(cx: Context):
    cols = ["sales_last_1_week", "sales_last_2_week", "sales_last_4_week", "sales_last_8_week", "rolling_mean_4w"]
    return scenario.next_week_rows(cx.features).select("store_num", "category", WEEK, "upc", "base_price", *cols)


@query("rc1_price_grid")
def recommendation_grid(cx: Context):
    grid = scenario.recommendation_grid(scenario.next_week_rows(cx.features), (6,), priority=PRIORITY)
    cols = ["scenario", "price_step", "price", "discount_pct", "price_ratio", "month", "quarter", "holiday_season"]
    return grid.select("store_num", "category", *cols, "promotion_count", "discount_zone")


@query("rc1_recommendations")
def recommendations(cx: Context):
    return recommended(cx)


@query("rc2_best_per_cluster")
def best_per_cluster(cx: Context):
    clusters = clustered(cx)
    return scenario.best_per_cluster(recommended(cx), clusters, cluster.cluster_profile(clusters))


@query("rc2_promo_landscape")
def promo_landscape(cx: Context):
    return scenario.promo_landscape(recommended(cx), clustered(cx))
