"""Multi-step queries (CT): lift branches, attribution, spine, gaps, podium."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import choose, half_up
from shelfwise.operators import promo
from shelfwise.operators.gaps import zero_filled, zero_runs, zero_weeks
from shelfwise.operators.rank import position_desc
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.star import week_spine
from shelfwise.plans.context import Context, query
from shelfwise.plans.product import PRODUCT, abc


@query("ct1_promo_vs_baseline")
def promo_vs_baseline(cx: Context):
    out = promo.promo_lift(cx.star.fact).select(
        "upc",
        "promo_type",
        F.col("baseline_avg_units").alias("baseline_units"),
        F.col("promo_avg_units").alias("promo_units"),
        "units_lift_pct",
        F.col("baseline_avg_price").alias("baseline_price"),
        F.col("promo_avg_price").alias("promo_price"),
        F.col("price_reduction_pct").alias("price_cut_pct"),
        F.col("baseline_row_count").alias("baseline_weeks"),
        F.col("promo_row_count").alias("promo_weeks"),
    )
    return out.join(cx.star.product.select(*PRODUCT), "upc")


@query("ct2_abc_attribution")
def abc_attribution(cx: Context):
    return cx.sales("product").transform(abc).select(
        "revenue_rank",
        "abc_class",
        *PRODUCT,
        F.round("_rev", 2).alias("total_revenue"),
        "total_units",
        half_up(F.col("value_share") * 100, 2).alias("revenue_share_pct"),
        half_up(F.col("running_share") * 100, 2).alias("cumulative_pct"),
    )


@query("ct3_week_spine")
def spine(cx: Context):
    day = F.col("wk_date")
    return week_spine(cx.transactions).withColumnRenamed("week_end_date", "wk_date").select(
        "*",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("iso_week_num"),
    )


@query("ct4_zero_weeks")
def zero_week_counts(cx: Context):
    """Zero rows by category, segment and week (the rows themselves number
    stores x products x weeks; ``zero_weeks`` returns them)."""
    return zero_weeks(cx.star).groupBy("category", "seg_value_name", "week_end_date").agg(
        F.count(F.lit(1)).alias("zero_rows"), F.sum("units").alias("units"), F.sum("spend").alias("spend")
    )


@query("ct4_zero_week_runs")
def zero_week_runs(cx: Context):
    """The weeks without sales of every store and product, a row per run of weeks."""
    return zero_runs(cx.star)


@query("ct4_zero_filled_panel")
def zero_filled_profile(cx: Context):
    """The zero-filled panel per store: every product has every week once."""
    return zero_filled(cx.star).groupBy("store_num").agg(
        F.count(F.lit(1)).alias("panel_rows"),
        F.count(F.when(F.col("is_zero_week"), 1)).alias("zero_rows"),
        F.sum("units").alias("units"),
        half_up(F.sum("units") / F.count(F.lit(1)), 4).alias("avg_units_per_panel_row"),
    )


@query("ct5_yearly_podium")
def yearly_podium(cx: Context, places: int = 3):
    by = ["year", "category", "description", "manufacturer"]
    annual = kpi_rollup(cx.sales("product"), by, ["total_revenue:4=_rev", "total_revenue=annual_revenue"])
    place = position_desc("_rev", ["description"], "year", "category")
    return (
        annual.withColumn("podium_position", place)
        .filter(F.col("podium_position") <= places)
        .withColumn("medal", choose("podium_position", labels.MEDALS))
        .drop("_rev")
    )
