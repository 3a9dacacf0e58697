"""Customer behaviour (CB): baskets, intensity, frequency, reach."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, choose, half_up, mean, ratio
from shelfwise.operators import pairs
from shelfwise.operators.benchmark import against_member, below_group
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.scale import global_ntile
from shelfwise.plans.context import Context, query
from shelfwise.plans.kpis import period_type


@query("cb1_basket_by_category_segment")
def basket_by_category_segment(cx: Context):
    return kpi_rollup(
        cx.sales("product", "store").filter("visits > 0 AND hhs > 0"),
        ["category", "seg_value_name"],
        [
            "avg_basket_size", "avg_basket_value", "avg_revenue_per_hh", "avg_units_per_hh",
            "avg_visits_per_hh", "total_units", "total_hhs", "total_revenue",
        ],
    )


HH_KEY = ["store_num", "upc", "category", "description", "seg_value_name"]


def household_ratios(sales: DataFrame, *extra: str) -> DataFrame:
    """Per store and product, units, spend and visits per household."""
    measures = [
        "avg_units_per_hh=units_per_hh", "avg_revenue_per_hh=spend_per_hh", "avg_visits_per_hh=visits_per_hh",
    ]
    return kpi_rollup(sales.filter("hhs > 0"), HH_KEY, [*measures, *extra])


@query("cb2_intensity_quintiles")
def intensity_quintiles(cx: Context):
    base = household_ratios(cx.sales("product", "store"), "total_revenue")
    tiled = global_ntile(base, "units_per_hh", ["store_num", "upc"], 5, "intensity_quintile")
    return tiled.withColumn("intensity_label", choose("intensity_quintile", labels.QUINTILES))


@query("cb3_visit_frequency")
def visit_frequency(cx: Context):
    out = kpi_rollup(
        cx.sales("product").filter("hhs > 0 AND visits > 0"),
        ["category"],
        [
            "total_visits=_v", "total_hhs", "avg_visits_per_hh", "avg_revenue_per_hh=avg_spend_per_hh",
            "avg_units_per_hh", "total_revenue",
        ],
    )
    frequency = band(ratio("_v", "total_hhs"), labels.FREQUENCY_EDGES, labels.FREQUENCY_BANDS)
    return out.withColumn("frequency_band", frequency).drop("_v")


@query("cb4_spend_per_hh_premium")
def spend_premium(cx: Context):
    by = ["seg_value_name", "category"]
    bought = cx.sales("product", "store").filter("hhs > 0")
    kpis = kpi_rollup(
        bought,
        by,
        [
            "store_count", "total_revenue:4=_r", "total_hhs=_h", "avg_revenue_per_hh=avg_spend_per_hh",
            "avg_units_per_hh", "avg_visits_per_hh",
        ],
    ).withColumn("_s", ratio("_r", "_h"))
    return against_member(
        kpis, ["category"], F.col("seg_value_name") == "VALUE", "_s", "premium_vs_value_stores", 4
    ).drop("_r", "_h", "_s")


@query("cb5_category_co_occurrence")
def co_occurrence(cx: Context):
    return pairs.co_occurrence(cx.sales("product"))


@query("cb6_units_per_visit_by_promo")
def units_per_visit(cx: Context):
    return kpi_rollup(
        cx.sales("product").filter("visits > 0").withColumn("promo_status", period_type()),
        ["category", "promo_status"],
        ["avg_basket_size=units_per_visit", "avg_basket_value=spend_per_visit", "hhs_per_visit", "row_count"],
    )


def reach_matrix(sales: DataFrame) -> DataFrame:
    """Reach x frequency of each category against all category-store-weeks."""
    cells = (
        sales.groupBy("category", "store_num", "date_key")
        .agg(F.sum("hhs").alias("hhs"), F.sum("visits").alias("visits"))
        .withColumn("freq", ratio("visits", "hhs"))
        .filter("hhs > 0")
    )
    reach, often = F.avg("hhs"), F.avg("freq")
    all_reach = cells.agg(reach).scalar()
    all_often = cells.agg(often).scalar()
    per_category = cells.groupBy("category").agg(
        reach.alias("_reach"), often.alias("_often"), mean("visits").alias("_visits")
    )
    high_reach, high_often = F.col("_reach") >= all_reach, F.col("_often") >= all_often
    matrix = labels.REACH_MATRIX
    name = (
        F.when(high_reach & high_often, matrix[True, True])
        .when(high_reach, matrix[True, False])
        .when(high_often, matrix[False, True])
        .otherwise(matrix[False, False])
    )
    return per_category.select(
        "category",
        half_up("_reach", 1).alias("avg_hhs_per_store_week"),
        half_up("_visits", 1).alias("avg_visits_per_store_week"),
        half_up("_often", 4).alias("avg_visit_frequency"),
        name.alias("customer_matrix_segment"),
    )


@query("cb7_reach_frequency_matrix")
def reach_matrix_query(cx: Context):
    return reach_matrix(cx.sales("product"))


@query("cb8_below_category_spend")
def below_category_spend(cx: Context):
    by = ["category", "seg_value_name", "state"]
    bought = cx.sales("product", "store").filter("hhs > 0")
    groups = kpi_rollup(
        bought, by, ["total_revenue:4=_r", "total_hhs=_h", "store_count", "total_revenue"]
    ).withColumn("_s", ratio("_r", "_h"))
    level = cx.sales("product").groupBy("category").agg(mean("spend_per_hh").alias("_level"))
    low = below_group(groups, level, ["category"], "_s", "_level")
    return low.withColumn("spend_per_hh", half_up("_s", 4)).drop("_r", "_h", "_s")
