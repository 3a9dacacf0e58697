"""Rule-based segmentation (SG) of products, stores, categories, households."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, choose, half_up
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.scale import global_ntile
from shelfwise.operators.share import class_of_running_share
from shelfwise.operators.trend import growth_over, series
from shelfwise.plans.context import Context, query
from shelfwise.plans.customer import household_ratios
from shelfwise.plans.product import PRODUCT
from shelfwise.plans.store import STORE


@query("sg1_abc_promo_matrix")
def abc_promo_matrix(cx: Context):
    base = kpi_rollup(cx.sales("product"), PRODUCT, ["total_revenue:4=_rev", "avg_discount_pct", "promo_rate_pct"])
    classed = class_of_running_share(base, "_rev", ["upc"], labels.ABC_CUTS, labels.ABC_CLASSES, "abc_class")
    level = band("promo_rate_pct", labels.PROMO_LEVEL_EDGES, labels.PROMO_LEVELS)
    cells = {f"{a}|{p}": text for (a, p), text in labels.STRATEGIC_CELLS.items()}
    return classed.withColumn("promo_dependency", level).select(
        *PRODUCT,
        F.round("_rev", 2).alias("total_revenue"),
        "avg_discount_pct",
        "promo_rate_pct",
        "abc_class",
        "promo_dependency",
        choose(F.concat_ws("|", "abc_class", "promo_dependency"), cells).alias("strategic_cell"),
    )


@query("sg2_store_quadrants")
def store_quadrants(cx: Context):
    base = kpi_rollup(cx.sales("store"), STORE, ["total_revenue", "avg_basket_value"])
    every = Window.partitionBy()
    rev, basket = F.col("total_revenue").cast("double"), F.col("avg_basket_value")
    mid_rev, mid_basket = F.median(rev).over(every), F.median(basket).over(every)
    high_rev, high_basket = F.col("_hr"), F.col("_hb")
    names = labels.STORE_QUADRANTS
    gap = F.pow((rev - F.col("_mr")) / F.nullif(F.col("_mr"), F.lit(0.0)), 2) + F.pow(
        (basket - F.col("_mb")) / F.nullif(F.col("_mb"), F.lit(0.0)), 2
    )
    return (
        base.withColumn("_mr", mid_rev)
        .withColumn("_mb", mid_basket)
        .withColumn("_hr", rev >= F.col("_mr"))
        .withColumn("_hb", basket >= F.col("_mb"))
        .select(
            *base.columns,
            half_up("_mr", 2).alias("median_revenue"),
            half_up("_mb", 4).alias("median_basket_value"),
            F.when(high_rev & high_basket, names[True, True])
            .when(high_rev, names[True, False])
            .when(high_basket, names[False, True])
            .otherwise(names[False, False])
            .alias("store_quadrant"),
            half_up(F.sqrt(gap), 4).alias("distance_from_median"),
        )
    )


@query("sg3_category_lifecycle")
def category_lifecycle(cx: Context):
    yearly = kpi_rollup(cx.sales("product"), ["category", "year"], ["total_revenue=annual_revenue"])
    growth = yearly.withColumn("_g", growth_over("annual_revenue", series("year", ["category"])))
    out = growth.groupBy("category").agg(
        half_up(F.avg("_g"), 2).alias("avg_yoy_growth_pct"),
        F.min("_g").alias("min_yoy"),
        F.max("_g").alias("max_yoy"),
    )
    g = F.col("avg_yoy_growth_pct")
    stage = lambda i: (
        F.when(g > labels.LIFECYCLE_GROWTH_ABOVE, labels.LIFECYCLE[0][i])
        .when(g >= labels.LIFECYCLE_MATURE_FROM, labels.LIFECYCLE[1][i])
        .otherwise(labels.LIFECYCLE[2][i])
    )
    return out.filter(g.isNotNull()).withColumns({"lifecycle_stage": stage(0), "recommended_strategy": stage(1)})


@query("sg4_price_consistency")
def price_consistency(cx: Context):
    base = kpi_rollup(
        cx.sales("product"),
        ["upc", "description", "category"],
        ["avg_price", "min_price", "max_price", "price_stddev", "price_cv_pct"],
    )
    return base.withColumns(
        {
            "price_consistency": band("price_cv_pct", labels.CONSISTENCY_EDGES, labels.CONSISTENCY),
            "price_tier": band("avg_price", labels.PRICE_TIER_EDGES, labels.PRICE_TIERS),
        }
    )


@query("sg5_household_value")
def household_value(cx: Context):
    base = household_ratios(cx.sales("product", "store"))
    tiled = global_ntile(base, "spend_per_hh", ["store_num", "upc"], 4, "spend_quartile")
    return tiled.withColumn("hh_value_segment", choose("spend_quartile", labels.HH_VALUE))


@query("sg6_cluster_features")
def cluster_features(cx: Context):
    by = ["store_num", "upc", "description", "category", "seg_value_name", "state"]
    return kpi_rollup(
        cx.sales("product", "store").filter("hhs > 0"),
        by,
        [
            "total_revenue", "avg_revenue=avg_weekly_revenue", "avg_units:4=avg_weekly_units",
            "avg_row_units_per_hh=avg_units_per_hh", "avg_price", "avg_discount_pct:4", "price_stddev",
            "avg_row_basket_value=avg_basket_value", "avg_row_spend_per_hh=avg_spend_per_hh", "avg_visits_per_hh",
            "feature_share=feature_rate", "display_share=display_rate", "tpr_share=tpr_rate",
            "promo_share=overall_promo_rate",
        ],
    )
