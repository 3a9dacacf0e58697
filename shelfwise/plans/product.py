"""Product analysis (P): ranking, Pareto, ABC, share, deciles, momentum."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import choose, growth_pct, half_up
from shelfwise.operators.rank import rank_asc, rank_desc, tile_desc
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import class_of_running_share, share_pct
from shelfwise.plans.context import Context, query

PRODUCT = ["upc", "description", "category", "manufacturer"]


@query("p1_product_ranking")
def product_ranking(cx: Context):
    return kpi_rollup(
        cx.sales("product"),
        ["upc", "description", "category", "sub_category", "manufacturer", "product_size"],
        [
            "total_revenue", "total_units", "total_visits", "total_hhs", "avg_price", "min_price", "max_price",
            "avg_discount_pct", "promo_rate_pct",
        ],
        {"portfolio_revenue_share_pct": ("revenue", [])},
        {"revenue_rank": ("revenue", [])},
    )


def pareto(sales: DataFrame) -> DataFrame:
    """80/95 classes by running share, with the share of SKUs used so far."""
    classed = class_of_running_share(
        kpi_rollup(sales, PRODUCT, ["total_revenue:4=_rev"]),
        "_rev", ["upc"], labels.PARETO_CUTS, labels.PARETO_CLASSES, "pareto_class",
    )
    return classed.select(
        "revenue_rank",
        *PRODUCT,
        F.round("_rev", 2).alias("product_revenue"),
        half_up(F.col("value_share") * 100, 2).alias("revenue_share_pct"),
        half_up(F.col("running_share") * 100, 2).alias("cumulative_share_pct"),
        "pareto_class",
        half_up(F.col("revenue_rank") * 100.0 / classed.select(F.count(F.lit(1))).scalar(), 1).alias("sku_count_pct"),
    )


@query("p2_pareto")
def pareto_query(cx: Context):
    return pareto(cx.sales("product"))


def abc(sales: DataFrame) -> DataFrame:
    """A/B/C on the running revenue share (70/90)."""
    return class_of_running_share(
        kpi_rollup(sales, PRODUCT, ["total_revenue:4=_rev", "total_units"]),
        "_rev", ["upc"], labels.ABC_CUTS, labels.ABC_CLASSES, "abc_class",
    )


@query("p3_abc_strategy")
def abc_strategy(cx: Context):
    return abc(cx.sales("product")).select(
        "revenue_rank",
        *PRODUCT,
        F.round("_rev", 2).alias("total_revenue"),
        "total_units",
        half_up(F.col("value_share") * 100, 2).alias("revenue_share_pct"),
        half_up(F.col("running_share") * 100, 2).alias("cumulative_pct"),
        "abc_class",
        choose("abc_class", labels.ABC_STRATEGY).alias("abc_strategy"),
    )


@query("p4_category_market_share")
def market_share(cx: Context):
    out = kpi_rollup(
        cx.sales("product"),
        ["category", "description", "manufacturer"],
        ["total_revenue:4=_rev", "total_revenue=product_revenue"],
    )
    return out.select(
        "*",
        share_pct("_rev", "category").alias("category_market_share_pct"),
        rank_desc("_rev", "category").alias("category_revenue_rank"),
        F.round(F.sum("_rev").over(Window.partitionBy("category")), 2).alias("category_total_revenue"),
    ).drop("_rev")


@query("p5_top_bottom_per_category")
def top_bottom_per_category(cx: Context, n: int = 5):
    ranked = kpi_rollup(
        cx.sales("product"),
        ["category", "description", "manufacturer", "product_size"],
        ["total_revenue:4=_rev", "total_revenue", "total_units", "avg_price"],
    ).select("*", rank_desc("_rev", "category").alias("_top"), rank_asc("_rev", "category").alias("_low"))
    is_top = F.col("_top") <= n
    return (
        ranked.filter(is_top | (F.col("_low") <= n))
        .withColumn("performance_band", F.when(is_top, f"TOP {n}").otherwise(f"BOTTOM {n}"))
        .withColumn("band_rank", F.when(is_top, F.col("_top")).otherwise(F.col("_low")))
        .drop("_rev", "_top", "_low")
    )


@query("p6_revenue_deciles")
def revenue_deciles(cx: Context):
    revenue = kpi_rollup(cx.sales("product"), ["upc", "description", "category"], ["total_revenue"])
    return revenue.select(
        "*",
        tile_desc(10, "total_revenue", ["upc"]).alias("revenue_decile"),
        share_pct("total_revenue").alias("revenue_share_pct"),
    )


def momentum(sales: DataFrame, calendar: DataFrame, weeks: int = 52) -> DataFrame:
    """Last ``weeks`` weeks against the ``weeks`` before them, in one pass.

    The prior window is (max-2n, max-n], exactly n weeks.
    """
    last = calendar.agg(F.max("week_of_year")).scalar()
    seq = F.col("week_of_year")
    recent = seq > last - weeks
    prior = (seq > last - 2 * weeks) & ~recent
    by = ["upc", "description", "category"]
    split = (
        sales.filter(seq > last - 2 * weeks)
        .groupBy(*by)
        .agg(
            F.sum(F.when(recent, F.col("spend"))).alias("now"),
            F.sum(F.when(prior, F.col("spend"))).alias("before"),
        )
        .filter(F.col("now").isNotNull())
    )
    return split.select(
        *by,
        F.round("now", 2).alias("revenue_last_52w"),
        F.round("before", 2).alias("revenue_prior_52w"),
        growth_pct("now", "before").alias("revenue_change_pct"),
        F.when(F.col("now") < F.col("before"), labels.TREND_DECLINING)
        .when(F.col("now") > F.col("before"), labels.TREND_GROWING)
        .otherwise(labels.TREND_STABLE)
        .alias("trend_label"),
    )


@query("p7_product_momentum")
def product_momentum(cx: Context):
    return momentum(cx.sales("product", "calendar"), cx.star.calendar)


@query("p8_purchase_intensity")
def purchase_intensity(cx: Context):
    return kpi_rollup(
        cx.sales("product").filter("hhs > 0"),
        ["description", "category", "manufacturer"],
        [
            "avg_units_per_hh=units_per_hh", "avg_revenue_per_hh=spend_per_hh", "avg_visits_per_hh=visits_per_hh",
            "total_revenue",
        ],
        ranks={"intensity_rank": ("intensity", [])},
    )
