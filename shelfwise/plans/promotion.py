"""Promotion (PM): mix, lift, levers, dependency, return, calendar."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import count_where, half_up, mean_where, pct, ratio, sum_where
from shelfwise.operators import promo
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.plans.context import Context, query


@query("pm1_promo_mix")
def promo_mix(cx: Context):
    return kpi_rollup(
        cx.sales("product"),
        ["category", "promo_type"],
        [
            "row_count", "total_units", "avg_units=avg_units_per_row", "total_revenue",
            "avg_revenue=avg_revenue_per_row", "avg_price", "avg_discount_pct",
            "avg_row_basket_value=avg_basket_value",
        ],
        {"pct_of_category": ("rows", ["category"])},
    )


@query("pm2_promo_lift")
def promo_lift(cx: Context):
    names = cx.star.product.select("upc", "category", "description")
    return promo.promo_lift(cx.star.fact).drop("baseline_row_count").join(names, "upc").drop("upc")


@query("pm3_lever_comparison")
def lever_comparison(cx: Context):
    return promo.lever_comparison(cx.sales("product"), ["category"])


@query("pm4_segment_lift")
def segment_lift(cx: Context):
    by = ["seg_value_name", "category"]
    base, on = F.col("promo_type") == "NONE", F.col("is_promoted")
    out = cx.sales("product", "store").groupBy(*by).agg(
        mean_where(base, "units").alias("_b"),
        mean_where(on, "units").alias("_p"),
        half_up(mean_where(base, "price"), 4).alias("baseline_price"),
        half_up(mean_where(on, "price"), 4).alias("promo_price"),
    )
    # The lift is rounded as a fraction (4 digits) before it becomes a percentage.
    return out.select(
        *by,
        half_up("_b", 2).alias("baseline_units"),
        half_up("_p", 2).alias("promoted_units"),
        half_up(half_up(ratio("_p", "_b") - 1, 4) * 100, 2).alias("units_lift_pct"),
        "baseline_price",
        "promo_price",
    )


@query("pm5_promo_dependency")
def promo_dependency(cx: Context, cut: float = labels.DEPENDENCY_CUT):
    on = F.col("is_promoted")
    out = (
        cx.sales("product")
        .groupBy("description", "category", "manufacturer")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            count_where(on).alias("promoted_rows"),
            *[count_where(F.col(c) == 1).alias(f"{c}_weeks") for c in ("feature", "display", "tpr_only")],
            count_where(F.col("promo_type") == "COMBINED").alias("combined_weeks"),
            F.round(sum_where(on, "spend"), 2).alias("promo_revenue"),
            F.round(sum_where(~on, "spend"), 2).alias("baseline_revenue"),
        )
    )
    share = pct("promoted_rows", "total_rows")
    return out.withColumn("promo_rate_pct", half_up(share, 2)).withColumn(
        "promo_health", F.when(share > cut, labels.DEPENDENCY_HIGH).otherwise(labels.DEPENDENCY_OK)
    )


@query("pm6_promo_return")
def promo_return(cx: Context):
    return promo.promo_return(cx.sales("product"), ["category", "promo_type"])


def promo_calendar(sales, categories):
    """Which categories are on promotion in each week, one 0/1 column each."""
    on = F.col("is_promoted")
    by = ["week_end_date", "year", "quarter", "month_name", "is_holiday_season"]
    return sales.groupBy(*by).agg(
        *[
            F.max(F.when((F.col("category") == c) & on, 1).otherwise(0)).alias(f"{c.lower().replace(' ', '_')}_promo")
            for c in categories
        ],
        F.count_distinct(F.when(on, F.col("category"))).alias("categories_on_promo"),
        count_where(on).alias("promo_rows"),
        F.round(F.sum("spend"), 2).alias("total_revenue"),
    )


TEST_CATEGORIES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


@query("pm7_promo_calendar")
def promo_calendar_query(cx: Context):
    return promo_calendar(cx.sales("product", "calendar"), TEST_CATEGORIES)
