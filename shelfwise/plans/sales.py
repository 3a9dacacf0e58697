"""Sales trends (S) by week, month, quarter, year, category and segment."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up, ratio
from shelfwise.operators.rank import top_bottom
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.operators.trend import growth_over, lag_of, running_total, series
from shelfwise.plans.context import Context, query


@query("s1_weekly_trend")
def weekly_trend(cx: Context):
    by = ["week_end_date", "year", "quarter", "month", "week_of_year", "is_holiday_season"]
    weekly = cx.marts.rollup(
        by,
        [
            "total_revenue:4=_rev", "total_revenue=weekly_revenue", "total_units=weekly_units",
            "total_visits=weekly_visits", "total_hhs=weekly_hhs", "avg_basket_value", "avg_price",
            "avg_discount_pct", "promoted_rows", "promo_rate_pct",
        ],
    )
    w = series("week_end_date")
    return weekly.select(
        "*",
        lag_of("weekly_revenue", w).alias("prev_week_revenue"),
        growth_over("_rev", w).alias("wow_revenue_growth_pct"),
    ).drop("_rev")


@query("s2_monthly_trend")
def monthly_trend(cx: Context):
    monthly = kpi_rollup(
        cx.sales("calendar"),
        ["year", "month", "month_name"],
        [
            "total_revenue=monthly_revenue", "total_units=monthly_units", "total_visits=monthly_visits",
            "avg_discount_pct",
        ],
    )
    w = series(["year", "month"])
    return monthly.select(
        "*",
        lag_of("monthly_revenue", w).alias("prev_month_revenue"),
        growth_over("monthly_revenue", w).alias("mom_revenue_growth_pct"),
        lag_of("monthly_revenue", w, 12).alias("same_month_last_year"),
        growth_over("monthly_revenue", w, 12).alias("yoy_revenue_growth_pct"),
        running_total("monthly_revenue", w).alias("cumulative_revenue"),
    )


@query("s3_quarterly_trend")
def quarterly_trend(cx: Context):
    quarterly = kpi_rollup(
        cx.sales("calendar"),
        ["year", "quarter"],
        [
            "total_revenue=quarterly_revenue", "total_units=quarterly_units",
            "total_visits=quarterly_visits", "avg_discount_pct", "promo_rate_pct",
        ],
    )
    w, value = series(["year", "quarter"]), "quarterly_revenue"
    return quarterly.select(
        F.concat_ws("-Q", F.col("year").cast("string"), F.col("quarter").cast("string")).alias("year_quarter"),
        "*",
        lag_of(value, w).alias("prev_quarter_revenue"),
        growth_over(value, w).alias("qoq_revenue_growth_pct"),
        lag_of(value, w, 4).alias("same_q_last_year"),
        growth_over(value, w, 4).alias("yoy_quarterly_growth_pct"),
        share_pct(value, "year").alias("pct_of_annual_revenue"),
    )


@query("s4_annual_summary")
def annual_summary(cx: Context):
    annual = kpi_rollup(
        cx.sales(),
        ["year"],
        [
            "total_revenue=annual_revenue", "total_units=annual_units", "total_visits=annual_visits",
            "total_hhs=annual_hhs", "week_count=weeks_in_year",
        ],
    )
    w = series("year")
    return annual.select(
        "*",
        half_up(ratio("annual_revenue", "weeks_in_year"), 2).alias("avg_weekly_revenue"),
        lag_of("annual_revenue", w).alias("prior_year_revenue"),
        growth_over("annual_revenue", w).alias("yoy_revenue_growth_pct"),
        growth_over("annual_units", w).alias("yoy_units_growth_pct"),
    )


@query("s5_category_quarter_mix")
def category_quarter_mix(cx: Context):
    mix = kpi_rollup(
        cx.sales("calendar", "product"),
        ["year", "quarter", "category"],
        ["total_revenue:4=_rev", "total_revenue=revenue"],
        {"pct_of_quarter_revenue": ("revenue", ["year", "quarter"])},
    )
    before = lag_of("_rev", series(["year", "quarter"], ["category"]))
    return mix.withColumn("revenue_vs_prev_quarter", F.round(F.col("_rev") - before, 2)).drop("_rev")


@query("s6_holiday_split")
def holiday_split(cx: Context):
    measures = [
        "week_count", "total_revenue", "revenue_per_week=avg_weekly_revenue", "total_units",
        "avg_discount_pct", "promo_rate_pct",
    ]
    return kpi_rollup(cx.sales("calendar"), ["is_holiday_season"], measures)


@query("s7_segment_yoy")
def segment_yoy(cx: Context):
    yearly = kpi_rollup(
        cx.sales("store"), ["year", "seg_value_name"], ["total_revenue:4=_rev", "total_revenue=revenue"]
    )
    w = series("year", ["seg_value_name"])
    return yearly.select(
        "*",
        lag_of("revenue", w).alias("prior_year_revenue"),
        growth_over("_rev", w).alias("yoy_growth_pct"),
    ).drop("_rev")


@query("s8_best_and_worst_weeks")
def best_and_worst_weeks(cx: Context):
    weekly = kpi_rollup(
        cx.sales("calendar"),
        ["week_end_date", "year", "month_name", "is_holiday_season"],
        ["total_revenue=weekly_revenue", "total_units=weekly_units", "avg_discount_pct", "promo_rate_pct"],
    )
    return top_bottom(
        weekly, "weekly_revenue", ("TOP 10", 10), ("BOTTOM 10", 10), ["week_end_date"], "rank_group", "week_rank"
    )
