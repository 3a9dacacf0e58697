"""Pricing (PR): ranges, bands, discount depth, elasticity, premiums."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.expr import count_where, half_up, mean, pct, sum_where
from shelfwise.operators import price
from shelfwise.operators.benchmark import against_member
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.plans.context import Context, query


@query("pr1_price_range")
def price_range(cx: Context):
    return kpi_rollup(
        cx.sales("product"),
        ["description", "category", "manufacturer", "product_size"],
        [
            "min_price", "max_price", "avg_price", "avg_base_price", "price_range", "avg_discount_pct",
            "max_discount_pct", "total_units", "price_cv_pct",
        ],
    )


@query("pr2_price_bands")
def price_bands(cx: Context):
    return kpi_rollup(
        cx.sales("product").withColumn("price_band", price.price_band()),
        ["category", "price_band"],
        [
            "row_count", "total_units", "avg_units=avg_units_per_row", "total_revenue",
            "avg_price=avg_price_in_band", "avg_discount_pct",
        ],
        {"pct_of_category_revenue": ("revenue", ["category"])},
    )


@query("pr3_discount_depth")
def discount_depth(cx: Context):
    return kpi_rollup(
        cx.sales("product").withColumn("discount_bucket", price.discount_bucket()),
        ["category", "discount_bucket"],
        [
            "row_count", "total_units", "avg_units=avg_units_per_row",
            "avg_discount_pct=avg_discount_in_bucket", "total_revenue",
        ],
        {"pct_of_rows": ("rows", ["category"])},
    )


@query("pr4_elasticity_proxy")
def elasticity(cx: Context):
    return price.elasticity_proxy(cx.sales("product"))


@query("pr5_lift_by_discount_tier")
def lift_by_tier(cx: Context):
    return price.lift_by_tier(cx.sales("product"))


@query("pr6_price_gap")
def price_gap(cx: Context):
    cut = F.col("price") < F.col("base_price")
    return (
        cx.sales("product")
        .groupBy("description", "category")
        .agg(
            half_up(mean("base_price"), 4).alias("avg_base_price"),
            half_up(mean("price"), 4).alias("avg_actual_price"),
            half_up(mean("price_gap"), 4).alias("avg_price_gap"),
            half_up(mean("discount_pct"), 2).alias("avg_discount_pct"),
            count_where(cut).alias("weeks_discounted"),
            F.count(F.lit(1)).alias("total_weeks"),
            half_up(pct(count_where(cut), F.count(F.lit(1))), 2).alias("pct_weeks_discounted"),
            F.round(sum_where(cut, "spend"), 2).alias("revenue_at_discount"),
            F.round(sum_where(~cut, "spend"), 2).alias("revenue_at_full_price"),
        )
    )


@query("pr7_price_by_segment")
def price_by_segment(cx: Context):
    by = ["category", "seg_value_name"]
    measures = ["avg_price", "avg_base_price", "avg_discount_pct", "min_price", "max_price"]
    sales = cx.sales("product", "store")
    out = sales.groupBy(*by).agg(mean("price").alias("_p"))
    premium = against_member(
        out, ["category"], F.col("seg_value_name") == "VALUE", "_p", "price_premium_vs_value", 4
    ).drop("_p")
    return kpi_rollup(sales, by, measures).join(premium, by)
