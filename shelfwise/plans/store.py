"""Store analysis (ST): ranking, segments, states, quartiles, efficiency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import choose, half_up, ratio
from shelfwise.operators.rank import rank_desc, tile_desc, top_bottom
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.plans.context import Context, query
from shelfwise.plans.kpis import REVENUE_SHARE, revenue_per_area

STORE = ["store_num", "store_name", "state", "seg_value_name"]


@query("st1_store_ranking")
def store_ranking(cx: Context):
    out = cx.marts.rollup(
        [*STORE, "city", "store_size_band", "sales_area_size_num"],
        [
            "total_revenue:4=_rev", "total_revenue", "total_units", "total_visits", "total_hhs",
            "avg_basket_value", "avg_basket_size", "avg_price", "avg_discount_pct", "promo_rate_pct",
        ],
        ranks={"revenue_rank": ("revenue", [])},
    )
    return out.withColumn("revenue_per_sqft", half_up(ratio("_rev", "sales_area_size_num"), 6)).drop("_rev")


@query("st2_segment_comparison")
def segment_comparison(cx: Context):
    by = ["seg_value_name"]
    sales = cx.sales("store")
    kpis = kpi_rollup(
        sales,
        by,
        [
            "store_count", "total_revenue", "revenue_per_store", "avg_basket_value", "avg_basket_size",
            "avg_revenue_per_hh=avg_spend_per_hh", "avg_price", "avg_discount_pct", "promo_rate_pct",
        ],
        REVENUE_SHARE,
    )
    area = revenue_per_area(sales, cx.star.store, by)
    return kpis.join(area.select(*by, "avg_sqft", "avg_weekly_baskets", "revenue_per_sqft"), by)


@query("st3_state_performance")
def state_performance(cx: Context):
    """State KPIs; the segment mix counts stores, not fact rows."""
    kpis = kpi_rollup(
        cx.sales("store"),
        ["state"],
        ["store_count", "total_revenue", "revenue_per_store", "avg_basket_value", "avg_discount_pct"],
        REVENUE_SHARE,
        {"state_revenue_rank": ("revenue", [])},
    )
    sold = cx.star.store.join(cx.star.fact.select("store_num").distinct(), "store_num", "left_semi")
    names = {"UPSCALE": "upscale", "MAINSTREAM": "mainstream", "VALUE": "value_stores"}
    mix = sold.groupBy("state").agg(
        *[F.count(F.when(F.col("seg_value_name") == k, 1)).alias(v) for k, v in names.items()]
    )
    return kpis.join(mix, "state")


@query("st4_top_bottom_stores")
def top_bottom_stores(cx: Context):
    ranked = kpi_rollup(
        cx.sales("store"),
        [*STORE, "sales_area_size_num"],
        ["total_revenue:4=_rev", "total_revenue", "avg_basket_value", "avg_discount_pct"],
    )
    return top_bottom(
        ranked, "_rev", ("TOP 10", 10), ("BOTTOM 10", 10), ["store_num"], "group_label", "rank", keep_ties=True
    ).drop("_rev")


@query("st5_store_quartiles")
def store_quartiles(cx: Context):
    out = kpi_rollup(
        cx.sales("store"),
        STORE,
        ["total_revenue:4=_rev", "total_revenue", "avg_basket_value", "avg_discount_pct", "promo_rate_pct"],
    )
    return out.withColumn("revenue_quartile", tile_desc(4, "_rev", ["store_num"])).drop("_rev")


def area_efficiency(sales: DataFrame) -> DataFrame:
    """Revenue per square foot of each store against its segment."""
    sized = sales.filter("sales_area_size_num > 0")
    per_store = kpi_rollup(
        sized, [*STORE, "sales_area_size_num"], ["total_revenue:4=_rev", "total_revenue"]
    ).withColumn("_density", ratio("_rev", "sales_area_size_num"))
    segment = per_store.groupBy("seg_value_name").agg(
        ratio(F.sum("_rev"), F.sum("sales_area_size_num")).alias("_segment")
    )
    return per_store.join(segment, "seg_value_name").select(
        rank_desc("_density").alias("efficiency_rank"),
        *STORE,
        "sales_area_size_num",
        "total_revenue",
        half_up("_density", 6).alias("revenue_per_sqft"),
        half_up(F.col("_density") - F.col("_segment"), 6).alias("vs_segment_avg_per_sqft"),
    )


@query("st6_area_efficiency")
def area_efficiency_query(cx: Context):
    return area_efficiency(cx.sales("store"))


@query("st7_leading_category")
def leading_category(cx: Context):
    ranked = kpi_rollup(
        cx.sales("product"),
        ["store_num", "category"],
        ["total_revenue=category_revenue"],
        ranks={"cat_rank_within_store": ("revenue", ["store_num"])},
    )
    role = choose("cat_rank_within_store", labels.CATEGORY_ROLES, labels.CATEGORY_ROLE_OTHER)
    return (
        ranked.filter("cat_rank_within_store = 1")
        .withColumn("category_role", role)
        .join(cx.star.store.select("store_num", "store_name", "seg_value_name"), "store_num")
    )


@query("st8_below_portfolio_basket")
def below_portfolio_basket(cx: Context):
    portfolio = cx.star.fact.agg(ratio(F.sum("spend"), F.sum("visits"))).scalar()
    per_store = cx.sales("store").groupBy(*STORE).agg(ratio(F.sum("spend"), F.sum("visits")).alias("_basket"))
    return per_store.filter(F.col("_basket") < portfolio).select(
        *STORE,
        half_up("_basket", 4).alias("avg_basket_value"),
        half_up(portfolio, 4).alias("portfolio_avg_basket"),
        half_up(F.col("_basket") - portfolio, 4).alias("diff_vs_portfolio_avg"),
    )
