"""Core KPI tables (M), by portfolio, category, segment, state, manufacturer."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import half_up, ratio
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.plans.context import Context, query

REVENUE_SHARE = {"revenue_share_pct": ("revenue", [])}
REVENUE_RANK = {"revenue_rank": ("revenue", [])}


@query("m1_portfolio_kpis")
def portfolio(cx: Context):
    out = kpi_rollup(
        cx.sales("product"),
        [],
        [
            "total_revenue", "total_units", "total_visits", "total_hhs", "avg_basket_value", "avg_basket_size",
            "avg_revenue_per_hh", "avg_units_per_hh", "avg_price=avg_selling_price", "avg_base_price",
            "avg_discount_pct:4", "promo_rate_pct", "feature_rate_pct", "display_rate_pct", "tpr_rate_pct",
            "combined_promo_rate_pct", "row_count=total_rows", "week_count=total_weeks",
            "store_count=total_stores", "product_count=total_products", "category_count=total_categories",
        ],
    )
    return out.withColumn("total_revenue_mm", half_up(F.col("total_revenue").cast("double") / 1e6, 3))


@query("m2_category_kpis")
def by_category(cx: Context):
    return cx.marts.rollup(
        ["category"],
        [
            "total_revenue", "total_units", "total_visits", "total_hhs", "avg_basket_value", "avg_price",
            "avg_discount_pct", "promo_rate_pct",
        ],
        REVENUE_SHARE,
        {**REVENUE_RANK, "units_rank": ("units", [])},
    )


SEGMENT_MEASURES = [
    "store_count", "total_revenue", "revenue_per_store", "avg_basket_value", "avg_basket_size",
    "avg_revenue_per_hh", "avg_price", "avg_discount_pct", "promo_rate_pct",
]


@query("m3_segment_kpis")
def by_segment(cx: Context):
    return cx.marts.rollup(["seg_value_name"], SEGMENT_MEASURES, REVENUE_SHARE)


@query("m4_state_kpis")
def by_state(cx: Context):
    measures = [
        "store_count", "total_revenue", "revenue_per_store", "avg_basket_value", "avg_price",
        "avg_discount_pct", "promo_rate_pct",
    ]
    return cx.marts.rollup(["state"], measures, REVENUE_SHARE, REVENUE_RANK)


@query("m5_manufacturer_kpis")
def by_manufacturer(cx: Context):
    measures = [
        "product_count", "category_count=categories_present", "total_revenue", "total_units", "avg_price",
        "avg_discount_pct", "promo_rate_pct",
    ]
    return cx.marts.rollup(["manufacturer"], measures, REVENUE_SHARE, REVENUE_RANK)


@query("m6_basket_metrics")
def basket_metrics(cx: Context):
    bought = cx.sales("product", "store").filter("visits > 0 AND hhs > 0")
    measures = [
        "avg_row_units_per_hh=avg_units_per_hh", "max_row_units_per_hh=max_units_per_hh",
        "avg_row_basket_value=avg_revenue_per_visit", "max_row_basket_value=max_revenue_per_visit",
        "avg_row_spend_per_hh=avg_spend_per_hh", "avg_visits_per_hh",
    ]
    return kpi_rollup(bought, ["category", "seg_value_name"], measures)


def period_type():
    return F.when(F.col("is_promoted"), labels.PERIODS[0]).otherwise(labels.PERIODS[1])


@query("m7_promoted_vs_baseline")
def promoted_vs_baseline(cx: Context):
    measures = [
        "row_count", "total_revenue", "total_units", "avg_units=avg_units_per_row", "avg_price",
        "avg_discount_pct", "avg_basket_value",
    ]
    split = cx.sales("product").withColumn("period_type", period_type())
    return kpi_rollup(split, ["category", "period_type"], measures)


def revenue_per_area(sales, stores, by, per_row: bool = False):
    """Revenue per square foot by group.

    The area of a store counts once, however many fact rows it has.  With
    ``per_row`` the area is summed per fact row instead (parity option).
    """
    sized = stores.filter("sales_area_size_num > 0")
    facts = sales.filter("sales_area_size_num > 0")
    revenue = kpi_rollup(facts, by, ["store_count", "total_revenue:4=_revenue"])
    if per_row:
        area = facts.groupBy(*by).agg(F.sum("sales_area_size_num").alias("_area"))
    else:
        sold = sized.join(facts.select("store_num").distinct(), "store_num", "left_semi")
        area = sold.groupBy(*by).agg(
            F.sum("sales_area_size_num").alias("_area"),
            half_up(F.avg("sales_area_size_num"), 0).alias("avg_sqft"),
            half_up(F.avg("avg_weekly_baskets"), 0).alias("avg_weekly_baskets"),
        )
    return (
        revenue.join(area, list(by))
        .withColumn("total_revenue", F.round("_revenue", 2))
        .withColumn("revenue_per_sqft", half_up(ratio("_revenue", "_area"), 6))
        .drop("_revenue", "_area")
    )


@query("m8_revenue_per_sqft")
def per_sqft(cx: Context):
    return revenue_per_area(cx.sales("store"), cx.star.store, ["seg_value_name", "store_size_band"])
