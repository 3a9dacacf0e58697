"""Final report tables (FR)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, choose, count_where, half_up, mean, ratio
from shelfwise.operators.report import metric_rows, shown
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.plans.context import Context, query
from shelfwise.plans.kpis import REVENUE_SHARE
from shelfwise.plans.product import abc


@query("fr1_executive_rows")
def executive_rows(cx: Context):
    """Headline rows as text; the counts in the insight are computed."""
    one = kpi_rollup(
        cx.sales("product"),
        [],
        [
            "total_revenue:4", "total_units", "total_visits", "total_hhs", "avg_basket_value:2", "avg_discount_pct:1",
            "promo_rate_pct:1", "week_count", "store_count", "product_count", "category_count",
        ],
    )
    scope = F.format_string(
        "Across %d weeks, %d stores, %d products, %d categories",
        "week_count", "store_count", "product_count", "category_count",
    )
    per_week = F.format_string("Average %d units/week", half_up(ratio("total_units", "week_count"), 0).cast("bigint"))
    dollars = lambda c: F.concat(F.lit("$"), c)
    percent = lambda c: F.concat(shown(c, 1), F.lit("%"))
    millions = dollars(F.concat(shown(half_up(F.col("total_revenue").cast("double") / 1e6, 3), 3), F.lit("M")))
    return metric_rows(
        one,
        [
            (F.lit("Total Portfolio Revenue"), millions, scope),
            (F.lit("Total Units Sold"), shown("total_units"), per_week),
            (F.lit("Total Customer Visits"), shown("total_visits"), F.lit("Baskets holding at least one product")),
            (F.lit("Total Households Reached"), shown("total_hhs"), F.lit("Reach and loyalty")),
            (F.lit("Average Basket Value"), dollars(shown("avg_basket_value", 2)), F.lit("Revenue per visit")),
            (F.lit("Average Discount"), percent("avg_discount_pct"), F.lit("Mean over product-store-weeks")),
            (F.lit("Promotion Rate"), percent("promo_rate_pct"), F.lit("Share of promoted product-store-weeks")),
        ],
        ["metric", "value", "insight"],
    )


@query("fr2_category_strategy")
def category_strategy(cx: Context):
    out = kpi_rollup(
        cx.sales("product"),
        ["category"],
        ["total_revenue", "total_units", "avg_price", "avg_discount_pct", "avg_basket_value", "promo_rate_pct"],
        REVENUE_SHARE,
        {"rank": ("revenue", [])},
    )
    return out.withColumn(
        "category_strategy", choose("rank", labels.CATEGORY_STRATEGY, labels.CATEGORY_STRATEGY_OTHER)
    )


@query("fr3_pricing_health")
def pricing_health(cx: Context):
    return (
        cx.sales("product")
        .groupBy("category")
        .agg(
            F.min("price").alias("min_shelf_price"),
            F.max("price").alias("max_shelf_price"),
            half_up(mean("price"), 4).alias("avg_shelf_price"),
            half_up(mean("base_price"), 4).alias("avg_base_price"),
            mean("discount_pct").alias("_d"),
            F.round(F.max("discount_pct"), 2).alias("max_discount_pct"),
            count_where(F.col("price") > F.col("base_price")).alias("price_above_base_rows"),
        )
        .withColumn("avg_discount_pct", half_up("_d", 2))
        .withColumn("pricing_health", band("_d", labels.PRICING_HEALTH_EDGES, labels.PRICING_HEALTH))
        .drop("_d")
    )


@query("fr4_best_volume_band")
def best_volume_band(cx: Context):
    banded = cx.sales("product").withColumn(
        "price_band", band("price", labels.REPORT_BAND_EDGES, labels.REPORT_BANDS)
    )
    out = kpi_rollup(
        banded,
        ["category", "price_band"],
        ["total_units", "avg_units=avg_units_per_row"],
        ranks={"volume_rank": ("units", ["category"])},
    )
    return out.filter("volume_rank = 1")


@query("fr5_promo_effectiveness")
def promo_effectiveness(cx: Context):
    out = kpi_rollup(
        cx.sales("product"),
        ["category", "promo_type"],
        ["avg_units"],
        ranks={"lift_rank": ("avg_units_raw", ["category"])},
    )
    return out.withColumn(
        "effectiveness_label", choose("lift_rank", labels.EFFECTIVENESS, labels.EFFECTIVENESS_OTHER)
    )


@query("fr6_promo_dependency_flags")
def dependency_flags(cx: Context, top: int = 20):
    out = (
        cx.sales("product")
        .groupBy("description", "category")
        .agg(ratio(count_where(F.col("is_promoted")), F.count(F.lit(1))).alias("_r"))
    )
    health = band("_r", labels.PROMO_HEALTH_EDGES, labels.PROMO_HEALTH, right_closed=True)
    flagged = out.select(
        F.col("description").alias("product"),
        "category",
        half_up(F.col("_r") * 100, 2).alias("promo_rate_pct"),
        health.alias("promo_health"),
    )
    return flagged.orderBy(F.desc("promo_rate_pct"), "product").limit(top)


@query("fr7_segment_performance")
def segment_performance(cx: Context):
    out = kpi_rollup(
        cx.sales("store"),
        ["seg_value_name"],
        ["store_count", "total_revenue", "revenue_per_store", "avg_basket_value", "avg_discount_pct"],
    )
    return out.withColumn("segment_insight", choose("seg_value_name", labels.SEGMENT_INSIGHT))


@query("fr8_abc_summary")
def abc_summary(cx: Context):
    classes = (
        abc(cx.sales("product"))
        .groupBy("abc_class")
        .agg(F.count(F.lit(1)).alias("product_count"), F.sum(F.round("_rev", 2)).alias("class_revenue"))
    )
    return classes.select(
        "*",
        share_pct("product_count", digits=1).alias("pct_of_sku_count"),
        share_pct("class_revenue").alias("class_revenue_share_pct"),
        choose("abc_class", labels.ABC_ACTION).alias("strategic_action"),
    )


@query("fr9_household_baskets")
def household_baskets(cx: Context):
    out = kpi_rollup(
        cx.sales("product").filter("hhs > 0"),
        ["category"],
        [
            "total_visits=_v", "total_hhs=_h", "avg_revenue_per_hh=avg_spend_per_hh", "avg_units_per_hh",
            "avg_visits_per_hh", "avg_basket_value",
        ],
    )
    insight = band(ratio("_v", "_h"), labels.REPORT_FREQUENCY_EDGES, labels.REPORT_FREQUENCY, right_closed=True)
    return out.withColumn("frequency_insight", insight).drop("_v", "_h")
