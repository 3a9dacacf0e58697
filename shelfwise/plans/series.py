"""Time series (TS) and window-function queries (W)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import choose, growth_pct, half_up, pct, sum_where
from shelfwise.operators.rank import dense_rank_desc, position_desc, rank_desc, tile_desc
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.operators.trend import (
    calendar_lag, calendar_mean, calendar_series, growth_over, lag_of, rolling_mean, rolling_std, running_total, seasonal_index, series, whole, z_scores,
)
from shelfwise.plans.context import Context, query
from shelfwise.plans.promotion import TEST_CATEGORIES

WEEK = "week_end_date"


@query("ts1_weekly_series")
def weekly_series(cx: Context):
    weekly = kpi_rollup(
        cx.sales("calendar"),
        [WEEK, "year", "quarter", "month", "week_of_year", "is_holiday_season"],
        [
            "total_revenue=weekly_revenue", "total_units=weekly_units", "total_visits=weekly_visits",
            "avg_discount_pct:4",
        ],
    )
    w, value = series(WEEK), "weekly_revenue"
    return weekly.select(
        "*",
        lag_of(value, w).alias("prev_week_revenue"),
        lag_of(value, w, -1).alias("next_week_revenue"),
        (F.col(value) - lag_of(value, w)).alias("wow_revenue_delta"),
        growth_over(value, w).alias("wow_revenue_pct"),
        *[rolling_mean(value, w, n).alias(f"rolling_{n}w_avg_revenue") for n in (4, 12, 52)],
        running_total(value, w).alias("cumulative_revenue"),
        lag_of(value, w, 52).alias("same_week_last_year"),
        growth_over(value, w, 52).alias("yoy_weekly_growth_pct"),
        F.first(value).over(whole(WEEK)).alias("first_week_revenue"),
        F.last(value).over(whole(WEEK)).alias("last_week_revenue"),
    )


def category_weeks(cx: Context) -> DataFrame:
    return kpi_rollup(
        cx.sales("calendar", "product"), [WEEK, "category"], ["total_revenue:4=_rev", "total_revenue=weekly_revenue"]
    )


@query("ts2_category_rolling")
def category_rolling(cx: Context):
    w = series(WEEK, ["category"])
    return category_weeks(cx).select(
        "*",
        rolling_mean("_rev", w, 4).alias("cat_rolling_4w_avg"),
        rolling_mean("_rev", w, 12).alias("cat_rolling_12w_avg"),
        share_pct("_rev", WEEK).alias("pct_of_weekly_portfolio"),
    ).drop("_rev")


@query("ts3_seasonal_index")
def seasonal(cx: Context):
    weekly = kpi_rollup(
        cx.sales("calendar"), [WEEK, "year", "week_num", "month_name"], ["total_revenue=weekly_revenue"]
    )
    return seasonal_index(weekly, ["week_num", "month_name"], "weekly_revenue")


@query("ts4_weekly_anomalies")
def anomalies(cx: Context):
    weekly = kpi_rollup(
        cx.sales("calendar"),
        [WEEK, "year", "month_name", "is_holiday_season"],
        ["total_revenue=weekly_revenue", "total_units=weekly_units"],
    )
    return z_scores(weekly, "weekly_revenue", labels.ANOMALY_Z, (labels.ANOMALY, labels.NORMAL))


@query("ts5_model_features")
def model_features(cx: Context):
    by = [WEEK, "year", "quarter", "month", "week_num", "week_of_year", "is_holiday_season"]
    sales = cx.sales("calendar", "product")
    weekly = kpi_rollup(
        sales,
        by,
        [
            "total_revenue:4", "total_units", "avg_discount_pct:4", "feature_rows=feature_count",
            "display_rows=display_count", "tpr_rows=tpr_only_count", "promoted_rows=promo_rows",
        ],
    )
    split = sales.groupBy(WEEK).agg(
        *[sum_where(F.col("category") == c, "spend").alias(f"{c.lower()}_revenue") for c in TEST_CATEGORIES]
    )
    w, value = series(WEEK), "total_revenue"
    return weekly.join(split, WEEK).select(
        "*",
        *[lag_of(value, w, n).alias(f"lag_{n}w_revenue") for n in (1, 4, 13, 52)],
        rolling_mean(value, w, 4, 4).alias("rolling_4w_mean"),
        rolling_mean(value, w, 12, 4).alias("rolling_12w_mean"),
        rolling_std(value, w, 12).alias("rolling_12w_std"),
    )


@query("w1_three_ranks")
def three_ranks(cx: Context):
    out = kpi_rollup(
        cx.sales("product"), ["category", "description"], ["total_revenue:4=_rev", "total_revenue"]
    )
    return out.select(
        "*",
        position_desc("_rev", ["description"], "category").alias("row_num_in_category"),
        rank_desc("_rev", "category").alias("rank_in_category"),
        dense_rank_desc("_rev", "category").alias("dense_rank_in_category"),
    ).drop("_rev")


@query("w2_store_tiers")
def store_tiers(cx: Context):
    out = kpi_rollup(
        cx.sales("store"),
        ["store_num", "store_name", "seg_value_name"],
        ["total_revenue:4=_rev", "total_revenue"],
    )
    return (
        out.withColumn("revenue_quartile", tile_desc(4, "_rev", ["store_num"]))
        .withColumn("revenue_decile", tile_desc(10, "_rev", ["store_num"]))
        .withColumn("store_tier", choose("revenue_quartile", labels.STORE_TIERS))
        .drop("_rev")
    )


@query("w3_category_lags")
def category_lags(cx: Context):
    w, value = series(WEEK, ["category"]), "weekly_revenue"
    return category_weeks(cx).drop("_rev").select(
        "*",
        lag_of(value, w).alias("prev_week_revenue"),
        lag_of(value, w, 4).alias("revenue_4w_ago"),
        lag_of(value, w, 52).alias("revenue_52w_ago"),
        lag_of(value, w, -1).alias("next_week_revenue"),
        (F.col(value) - lag_of(value, w)).alias("wow_delta"),
        growth_over(value, w).alias("wow_pct_change"),
    )


@query("w3_calendar_lags")
def calendar_lags(cx: Context):
    """As the row lags, by calendar weeks: a week without sales of the category gives null."""
    w, value = calendar_series(WEEK, ["category"]), "weekly_revenue"
    return category_weeks(cx).drop("_rev").select(
        "*",
        calendar_lag(value, w).alias("prev_week_revenue"),
        calendar_lag(value, w, 4).alias("revenue_4w_ago"),
        calendar_lag(value, w, 52).alias("revenue_52w_ago"),
        calendar_lag(value, w, -1).alias("next_week_revenue"),
        growth_pct(value, calendar_lag(value, w)).alias("wow_pct_change"),
    )


@query("ts1_calendar_series")
def calendar_trend(cx: Context):
    """Weekly revenue per store and category against the calendar weeks before; most of these series have gaps."""
    by = [WEEK, "store_num", "category"]
    weekly = cx.marts.rollup(by, ["total_revenue:4=_rev", "total_revenue=weekly_revenue"])
    w = calendar_series(WEEK, ["store_num", "category"])
    return weekly.select(
        "*",
        calendar_lag("weekly_revenue", w).alias("prev_week_revenue"),
        calendar_lag("weekly_revenue", w, 52).alias("same_week_last_year"),
        *[calendar_mean("_rev", w, 1 - n).alias(f"rolling_{n}w_avg_revenue") for n in (4, 12, 52)],
    ).drop("_rev")


@query("w4_first_last_peak")
def first_last_peak(cx: Context):
    weekly = kpi_rollup(cx.sales("calendar"), [WEEK], ["total_revenue=weekly_revenue"])
    value, all_weeks = "weekly_revenue", whole(WEEK)
    return weekly.select(
        "*",
        F.first(value).over(all_weeks).alias("first_week_revenue"),
        F.last(value).over(all_weeks).alias("last_week_revenue"),
        F.max(value).over(all_weeks).alias("all_time_peak_revenue"),
    ).select(
        "*",
        growth_pct(value, "first_week_revenue").alias("growth_vs_first_week_pct"),
        half_up(pct(value, "all_time_peak_revenue"), 2).alias("pct_of_peak"),
    )


@query("w5_running_totals")
def running_totals(cx: Context):
    weekly = kpi_rollup(
        cx.sales("calendar"),
        [WEEK, "year", "week_of_year"],
        ["total_revenue:4=_rev", "total_revenue=weekly_revenue", "total_units=_units"],
    )
    w = series(WEEK)
    total = F.sum("_rev").over(Window.partitionBy())
    return weekly.select(
        "*",
        F.round(running_total("_rev", w), 2).alias("cumulative_revenue"),
        F.round(running_total("_rev", series(WEEK, ["year"])), 2).alias("ytd_revenue"),
        running_total("_units", w).alias("cumulative_units"),
        half_up(pct(running_total("_rev", w), total), 2).alias("cumulative_pct_of_total"),
    ).drop("_rev", "_units")


@query("w6_moving_averages")
def moving_averages(cx: Context):
    w = series(WEEK, ["category"])
    above = F.col("_rev").cast("double") > rolling_mean("_rev", w, 12, None)
    return category_weeks(cx).select(
        "*",
        *[rolling_mean("_rev", w, n).alias(f"ma_{n}w") for n in (4, 8, 12)],
        F.when(above, labels.ABOVE_MA).otherwise(labels.BELOW_MA).alias("vs_ma_12w"),
    ).drop("_rev")


def missing_weeks(sales: DataFrame, calendar: DataFrame, top: int = 50) -> DataFrame:
    """Product-store pairs with the most weeks without a sale.

    The rank comes from counts per number of missing weeks (at most as many
    as there are weeks), so the pairs themselves are never globally sorted.
    """
    weeks = calendar.select(F.count(F.lit(1))).scalar()
    by = ["description", "category", "store_num"]
    gaps = (
        kpi_rollup(sales, by, ["week_count=weeks_with_sales", "total_revenue"])
        .withColumn("total_weeks", weeks)
        .withColumn("missing_weeks", F.col("total_weeks") - F.col("weeks_with_sales"))
        .filter("missing_weeks > 0")
    )
    above = Window.orderBy(F.desc("missing_weeks")).rowsBetween(Window.unboundedPreceding, -1)
    ranks = (
        gaps.groupBy("missing_weeks")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("missing_weeks", (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).alias("missing_weeks_rank"))
    )
    worst = gaps.orderBy(F.desc("missing_weeks"), "description", "store_num").limit(top)
    return worst.join(ranks, "missing_weeks")


@query("w6_calendar_averages")
def calendar_averages(cx: Context):
    w = calendar_series(WEEK, ["category"])
    return category_weeks(cx).select(
        "*", *[calendar_mean("_rev", w, 1 - n).alias(f"ma_{n}w") for n in (4, 8, 12)]
    ).drop("_rev")


@query("w7_missing_weeks")
def missing_weeks_query(cx: Context):
    return missing_weeks(cx.sales("product"), cx.star.calendar)


@query("w8_nested_shares")
def nested_shares(cx: Context):
    return kpi_rollup(
        cx.sales("product", "store"),
        ["category", "description", "seg_value_name"],
        ["total_revenue=product_segment_revenue"],
        {
            "pct_of_category_revenue": ("revenue", ["category"]),
            "pct_of_segment_revenue": ("revenue", ["seg_value_name"]),
            "pct_of_total_revenue": ("revenue", []),
        },
    )
