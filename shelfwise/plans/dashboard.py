"""KPI dashboard (KD)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import growth_pct
from shelfwise.operators.rank import top_bottom
from shelfwise.operators.report import metric_rows, shown, winner
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.operators.trend import growth_over, lag_of, series
from shelfwise.plans.context import Context, query
from shelfwise.plans.kpis import REVENUE_RANK, REVENUE_SHARE

# Metric -> decimals in the text value; None shows a whole number.
_SHOWN = {
    "total_revenue": 2,
    "total_units": None,
    "total_visits": None,
    "total_hhs": None,
    "total_stores": None,
    "total_products": None,
    "total_weeks": None,
    "avg_basket_value": 4,
    "avg_basket_size": 4,
    "avg_revenue_per_hh": 4,
    "avg_selling_price": 4,
    "avg_discount_pct": 4,
    "promo_rate_pct": 2,
    "feature_rate_pct": 2,
    "display_rate_pct": 2,
    "tpr_rate_pct": 2,
}


@query("kd1_headline_metrics")
def headline_metrics(cx: Context):
    totals = kpi_rollup(
        cx.sales(),
        [],
        [
            "total_revenue", "total_units", "total_visits", "total_hhs", "store_count=total_stores",
            "product_count=total_products", "week_count=total_weeks", "avg_basket_value", "avg_basket_size",
            "avg_revenue_per_hh", "avg_price=avg_selling_price", "avg_discount_pct:4", "promo_rate_pct",
            "feature_rate_pct", "display_rate_pct", "tpr_rate_pct",
        ],
    )
    # The only pass over the fact is for the distinct counts; all else comes from marts.
    revenue = lambda by: cx.marts.rollup([by], ["total_revenue:4=spend"])
    yearly = revenue("year").withColumnRenamed("spend", "r")
    last = cx.star.calendar.agg(F.max("year")).scalar()
    year_revenue = lambda back: F.coalesce(
        F.round(yearly.filter(F.col("year") == last - back).agg(F.sum("r")).scalar(), 2), F.lit(0)
    )
    extra = totals.select(
        "*",
        growth_pct(year_revenue(0), year_revenue(1)).alias("yoy_revenue_growth_pct"),
        winner(revenue("category"), "category").alias("best_category"),
        winner(revenue("description"), "description").alias("best_product"),
        winner(revenue("store_name"), "store_name").alias("best_store"),
        winner(revenue("state"), "state").alias("best_state"),
    )
    rows = [(F.lit(k), shown(k, d)) for k, d in _SHOWN.items()]
    rows.append((F.lit("yoy_revenue_growth_pct"), shown("yoy_revenue_growth_pct", 2)))
    rows += [(F.lit(k), F.col(k)) for k in ("best_category", "best_product", "best_store", "best_state")]
    labelled = [(k, v, F.lit(labels.DASHBOARD_LABELS[name])) for (k, v), name in zip(rows, labels.DASHBOARD_LABELS)]
    return metric_rows(extra, labelled, ["metric", "value", "label"])


@query("kd2_category_scorecard")
def category_scorecard(cx: Context):
    return kpi_rollup(
        cx.sales("product"),
        ["category"],
        [
            "total_revenue", "total_units", "total_visits", "total_hhs", "avg_price", "avg_discount_pct",
            "avg_basket_value", "avg_revenue_per_hh", "promo_rate_pct",
        ],
        REVENUE_SHARE,
        REVENUE_RANK,
    )


@query("kd3_recent_weeks")
def recent_weeks(cx: Context, weeks: int = 8):
    """Last weeks with growth inside that window.  The weeks are picked from
    the calendar first, so only their fact rows are read."""
    sold = cx.star.fact.select("date_key").distinct().orderBy(F.desc("date_key")).limit(weeks)
    weekly = kpi_rollup(
        cx.sales("calendar").join(sold, "date_key", "left_semi"),
        ["week_end_date", "year", "week_of_year"],
        [
            "total_revenue=weekly_revenue", "total_units=weekly_units", "avg_basket_value", "avg_discount_pct",
            "promo_rate_pct",
        ],
    )
    w = series("week_end_date")
    return weekly.select(
        "*",
        lag_of("weekly_revenue", w).alias("prev_week"),
        growth_over("weekly_revenue", w).alias("wow_growth_pct"),
    )


@query("kd4_segment_scorecard")
def segment_scorecard(cx: Context):
    return kpi_rollup(
        cx.sales("store"),
        ["seg_value_name"],
        ["store_count", "total_revenue", "revenue_per_store", "avg_basket_value", "avg_discount_pct", "promo_rate_pct"],
        REVENUE_SHARE,
    )


@query("kd5_product_movers")
def product_movers(cx: Context):
    base = kpi_rollup(
        cx.sales("product"),
        ["description", "category", "manufacturer"],
        ["total_revenue:4=_rev", "total_revenue", "total_units"],
    ).withColumn("portfolio_share_pct", share_pct("_rev"))
    return top_bottom(
        base, "_rev", ("TOP 10", 10), ("BOTTOM 5", 5), ["description"], "group_label", "rank_pos"
    ).drop("_rev")
