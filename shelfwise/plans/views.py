"""Named views (VW) and materialised marts (MV)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up, ratio
from shelfwise.operators.navigate import INPUTS, additive_columns, measures_over_mart
from shelfwise.operators.rank import rank_desc
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.operators.star import Star, mart_product_summary
from shelfwise.operators.trend import rolling_mean, series
from shelfwise.plans.context import Context, query
from shelfwise.sources.refresh import WeeklyMart
from shelfwise.sources.workspace import Workspace

WEEK = "week_end_date"


def fact_enriched(star: Star) -> DataFrame:
    return star.enriched()


def weekly_summary(star: Star) -> DataFrame:
    weekly = kpi_rollup(
        star.sales("calendar"),
        [WEEK, "year", "quarter", "month", "month_name", "week_of_year", "is_holiday_season"],
        [
            "total_revenue:4=_rev", "total_revenue", "total_units", "total_visits", "total_hhs",
            "avg_basket_value", "avg_price", "avg_discount_pct:4", "promo_rate_pct",
        ],
    )
    w = series(WEEK)
    return weekly.select(
        "*", *[rolling_mean("_rev", w, n).alias(f"rolling_{n}w_avg_revenue") for n in (4, 12)]
    ).drop("_rev")


def product_performance(star: Star) -> DataFrame:
    """Totals per product first, then the dimension and the ABC mart."""
    totals = kpi_rollup(
        star.fact,
        ["upc"],
        [
            "total_revenue:4", "total_units", "total_visits", "total_hhs", "avg_price", "avg_discount_pct:4",
            "promo_rate_pct", "avg_row_basket_value=avg_basket_value", "avg_row_units_per_hh=avg_units_per_hh",
        ],
    )
    info = star.product.select(
        "upc", F.col("description").alias("product_name"), "category", "sub_category", "manufacturer", "product_size"
    )
    return (
        totals.join(info, "upc")
        .select(
            "*",
            rank_desc("total_revenue").alias("portfolio_revenue_rank"),
            rank_desc("total_revenue", "category").alias("category_revenue_rank"),
            share_pct("total_revenue").alias("portfolio_share_pct"),
        )
        .join(mart_product_summary(star).select("upc", "abc_class"), "upc", "left")
    )


def store_performance(star: Star) -> DataFrame:
    totals = kpi_rollup(
        star.fact,
        ["store_num"],
        [
            "total_revenue:4", "total_units", "total_visits", "total_hhs", "avg_basket_value",
            "avg_discount_pct:4", "promo_rate_pct",
        ],
    )
    info = star.store.select(
        "store_num", "store_name", "city", "state", F.col("seg_value_name").alias("store_segment"),
        "store_size_band", "sales_area_size_num", "avg_weekly_baskets",
    )
    return totals.join(info, "store_num").select(
        "*",
        half_up(ratio("total_revenue", "sales_area_size_num"), 6).alias("revenue_per_sqft"),
        rank_desc("total_revenue").alias("global_revenue_rank"),
        rank_desc("total_revenue", "store_segment").alias("segment_rank"),
        rank_desc("total_revenue", "state").alias("state_rank"),
    )


def promotion_summary(star: Star) -> DataFrame:
    return kpi_rollup(
        star.sales("product"),
        ["category", "description", "promo_type"],
        [
            "row_count=total_rows", "avg_units", "avg_revenue", "avg_price", "avg_discount_pct",
            "avg_row_basket_value=avg_basket_value",
        ],
    ).withColumnRenamed("description", "product_name")


def category_state(star: Star) -> DataFrame:
    return kpi_rollup(
        star.sales("product", "store"),
        ["state", "category"],
        ["store_count", "total_revenue", "revenue_per_store", "avg_discount_pct", "avg_basket_value"],
    )


def mv_weekly_portfolio(star: Star) -> DataFrame:
    return kpi_rollup(
        star.sales("calendar"),
        [WEEK, "year", "quarter"],
        [
            "total_revenue", "total_units", "total_visits", "avg_basket_value", "avg_discount_pct:4",
            "promo_rate_pct",
        ],
    )


def mv_category_segment(star: Star) -> DataFrame:
    return kpi_rollup(
        star.sales("product", "store"),
        ["category", "seg_value_name"],
        ["total_revenue", "total_units", "avg_price", "avg_discount_pct:4"],
    )


def mv_product_summary(star: Star) -> DataFrame:
    return kpi_rollup(
        star.sales("product"),
        ["upc", "description", "category", "manufacturer"],
        ["total_revenue", "total_units", "avg_price", "avg_discount_pct:4", "promo_rate_pct"],
    )


VIEWS = {
    "vw_fact_enriched": fact_enriched,
    "vw_weekly_summary": weekly_summary,
    "vw_product_performance": product_performance,
    "vw_store_performance": store_performance,
    "vw_promotion_summary": promotion_summary,
    "vw_category_state": category_state,
}
#: Materialised results that are refreshed by week: dimensions, groups, measures.
REFRESHED = {
    "mv1_refreshed": (
        ["calendar"],
        [WEEK, "year", "quarter"],
        ["total_revenue", "total_units", "total_visits", "avg_basket_value", "avg_discount_pct:4", "promo_rate_pct"],
    ),
    "mv2_refreshed": (
        ["product", "store"], ["category", "seg_value_name"], ["total_revenue", "total_units", "avg_price", "avg_discount_pct:4"],
    ),
    "mv3_refreshed": (
        ["product"],
        ["upc", "description", "category", "manufacturer"],
        ["total_revenue", "total_units", "avg_price", "avg_discount_pct:4", "promo_rate_pct"],
    ),
}


def weekly_mart(star: Star, name: str, root: str) -> tuple[WeeklyMart, DataFrame]:
    """A mart of ``REFRESHED`` stored below ``root``, and the rows it is made of."""
    dims, by, measures = REFRESHED[name]
    rows = star.sales(*dims).select("date_key", *by, *[c for c in INPUTS if c not in by])
    return WeeklyMart(star.fact.sparkSession, root, by, additive_columns(), measures_over_mart(measures)), rows


def corrected(cx: Context, name: str) -> tuple[WeeklyMart, list]:
    """A mart stored before the last two weeks were corrected, then refreshed; and the weeks that were aggregated again."""
    mart, rows = weekly_mart(cx.star, name, Workspace(cx.spark, name).root)
    last = [r[0] for r in cx.star.fact.select("date_key").distinct().orderBy(F.desc("date_key")).limit(2).collect()]
    units = F.when(F.col("date_key").isin(last), F.col("units") + 1).otherwise(F.col("units"))
    mart.refresh(rows.withColumn("units", units))
    return mart, mart.refresh(rows)


MATERIALIZED = {
    "mv_weekly_portfolio": mv_weekly_portfolio,
    "mv_category_segment": mv_category_segment,
    "mv_product_summary": mv_product_summary,
}


def create_views(star: Star) -> list[str]:
    """Register every view under its name for Spark SQL."""
    for name, build in VIEWS.items():
        build(star).createOrReplaceTempView(name)
    return list(VIEWS)


@query("vw1_fact_enriched")
def vw1(cx: Context):
    out = fact_enriched(cx.star)
    return out.drop("year").withColumn("year", F.year("week_end_date"))


for _id, _name in (
    ("vw2_weekly_summary", "vw_weekly_summary"),
    ("vw3_product_performance", "vw_product_performance"),
    ("vw4_store_performance", "vw_store_performance"),
    ("vw5_promotion_summary", "vw_promotion_summary"),
    ("vw6_category_state", "vw_category_state"),
):
    query(_id)(lambda cx, build=VIEWS[_name]: build(cx.star))

for _id in REFRESHED:
    query(_id)(lambda cx, name=_id: corrected(cx, name)[0].read())


@query("io6_recomputed_weeks")
def recomputed_weeks(cx: Context):
    """Weeks that a refresh after a correction of the last two weeks aggregates again."""
    return cx.spark.createDataFrame([(w,) for w in corrected(cx, "mv2_refreshed")[1]], "date_key int")


for _id, _name in (
    ("mv1_weekly_portfolio", "mv_weekly_portfolio"),
    ("mv2_category_segment", "mv_category_segment"),
    ("mv3_product_summary", "mv_product_summary"),
):
    query(_id)(lambda cx, build=MATERIALIZED[_name]: build(cx.star))
