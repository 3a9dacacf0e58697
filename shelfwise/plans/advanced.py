"""Advanced business questions (AQ)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import count_where, growth_pct, half_up, mean, mean_where, pct, sum_where
from shelfwise.operators import pairs
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.trend import growth_over, lag_of, series
from shelfwise.plans.context import Context, query
from shelfwise.plans.product import PRODUCT


@query("aq1_champion_classes")
def champion_classes(cx: Context):
    on = F.col("is_promoted")
    split = (
        cx.sales("product")
        .groupBy(*PRODUCT)
        .agg(
            F.round(sum_where(on, "spend"), 2).alias("promo_revenue"),
            F.round(sum_where(~on, "spend"), 2).alias("baseline_revenue"),
            F.round(F.sum("spend"), 2).alias("total_revenue"),
            half_up(pct(count_where(on), F.count(F.lit(1))), 2).alias("promo_rate_pct"),
        )
    )
    every = Window.partitionBy()
    base_high = F.col("baseline_revenue").cast("double") >= F.col("_mb")
    total_high = F.col("total_revenue").cast("double") >= F.col("_mt")
    rare = F.col("promo_rate_pct") < labels.CHAMPION_PROMO_CUT
    champion, promo, sleeper, struggler = labels.CHAMPIONS
    return (
        split.withColumn("_mt", F.median(F.col("total_revenue").cast("double")).over(every))
        .withColumn("_mb", F.median(F.col("baseline_revenue").cast("double")).over(every))
        .select(
            *split.columns,
            half_up(pct("promo_revenue", "total_revenue"), 2).alias("promo_revenue_share_pct"),
            F.when(base_high & total_high & rare, champion)
            .when(total_high & ~rare, promo)
            .when(base_high & ~total_high, sleeper)
            .otherwise(struggler)
            .alias("champion_class"),
        )
    )


@query("aq2_store_vs_category_average")
def store_vs_category(cx: Context):
    actual = kpi_rollup(cx.sales("product"), ["store_num", "category"], ["total_revenue=actual_revenue"])
    level = actual.groupBy("category").agg(half_up(mean("actual_revenue"), 2).alias("avg_store_category_revenue"))
    a, b = F.col("actual_revenue").cast("double"), F.col("avg_store_category_revenue")
    above, near, below = labels.PERFORMANCE_FLAGS
    return (
        actual.join(level, "category")
        .select(
            "*",
            half_up(a - b, 2).alias("vs_avg_delta"),
            growth_pct(a, b).alias("vs_avg_pct"),
            F.when(a >= b * 1.2, above).when(a >= b * 0.8, near).otherwise(below).alias("performance_flag"),
        )
        .join(cx.star.store.select("store_num", "store_name", "seg_value_name"), "store_num")
    )


@query("aq3_price_gap_pairs")
def price_gap_pairs(cx: Context):
    return pairs.price_gap_pairs(cx.sales("product"))


def store_cohorts(sales: DataFrame) -> DataFrame:
    """Revenue per store by start cohort; a store is early when its first
    quarter is the first or the next quarter of the panel."""
    quarter_no = F.col("year") * 4 + F.col("quarter")
    start = sales.groupBy("store_num").agg(F.min(quarter_no).alias("_start"))
    first = start.agg(F.min("_start")).scalar()
    early, later = labels.COHORTS
    cohort = start.select(
        "store_num", F.when(F.col("_start") <= first + 1, early).otherwise(later).alias("cohort")
    )
    out = kpi_rollup(
        sales.join(cohort, "store_num"),
        ["cohort", "year", "quarter"],
        ["store_count=active_stores", "total_revenue=quarterly_revenue", "revenue_per_store"],
    )
    w = series(["year", "quarter"], ["cohort"])
    return out.select(
        "*",
        lag_of("revenue_per_store", w).alias("prior_quarter_rps"),
        growth_over("revenue_per_store", w).alias("qoq_rps_growth_pct"),
    )


@query("aq4_store_cohorts")
def store_cohorts_query(cx: Context):
    return store_cohorts(cx.sales("calendar"))


def combined_roi(sales: DataFrame) -> DataFrame:
    """Fully promoted rows against unpromoted rows of the same product."""
    by = ["category", "description"]
    none, full = F.col("promo_type") == "NONE", F.col("promo_type") == "COMBINED"
    wide = (
        sales.withColumn("_gone", F.col("price_gap") * F.col("units"))
        .groupBy(*by)
        .agg(
            half_up(mean_where(none, "units"), 2).alias("baseline_units"),
            half_up(mean_where(full, "units"), 2).alias("combined_units"),
            half_up(mean_where(none, "spend"), 4).alias("baseline_revenue"),
            half_up(mean_where(full, "spend"), 4).alias("combined_revenue"),
            half_up(mean_where(full, "_gone"), 4).alias("combined_foregone_rev"),
        )
        .filter("baseline_units IS NOT NULL AND combined_units IS NOT NULL")
    )
    net = F.col("combined_revenue") - F.col("combined_foregone_rev")
    return wide.select(
        "*",
        growth_pct("combined_units", "baseline_units").alias("unit_lift_pct"),
        half_up(net, 4).alias("net_revenue"),
        half_up(pct(net, "combined_revenue"), 2).alias("net_margin_pct"),
        F.when(net > F.col("baseline_revenue"), labels.ROI_POSITIVE)
        .otherwise(labels.ROI_NEGATIVE)
        .alias("roi_verdict"),
    )


@query("aq5_combined_promo_roi")
def combined_roi_query(cx: Context):
    return combined_roi(cx.sales("product"))


def dead_zones(sales: DataFrame, stores: DataFrame, quarters: int = 3) -> DataFrame:
    """Store-categories that did not grow for ``quarters`` quarters in a row."""
    by = ["store_num", "category"]
    w = series(["year", "quarter"], by)
    quarterly = kpi_rollup(sales, [*by, "year", "quarter"], ["total_revenue=qtr_revenue"])
    flat = F.coalesce((F.col("qtr_revenue") <= lag_of("qtr_revenue", w)).cast("int"), F.lit(0))
    return (
        quarterly.withColumn("_flat", flat)
        .withColumn("consec_flat_qtrs", F.sum("_flat").over(w.rowsBetween(1 - quarters, 0)))
        .filter(F.col("consec_flat_qtrs") == quarters)
        .withColumn("alert", F.lit(labels.DEAD_ZONE))
        .drop("_flat")
        .join(stores.select("store_num", "store_name", "seg_value_name"), "store_num")
    )


@query("aq6_dead_zones")
def dead_zones_query(cx: Context):
    return dead_zones(cx.sales("product", "calendar"), cx.star.store)
