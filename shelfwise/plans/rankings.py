"""Rankings (RK): multi-metric ranks, top-N, deciles, yearly shifts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import choose, half_up, mean
from shelfwise.operators.rank import cume_dist, dense_rank_desc, percent_rank, rank_desc, tile_desc
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.plans.context import Context, query
from shelfwise.plans.product import PRODUCT
from shelfwise.plans.store import STORE


@query("rk1_multi_metric_ranks")
def multi_metric_ranks(cx: Context):
    base = kpi_rollup(
        cx.sales("product"),
        PRODUCT,
        ["total_revenue", "total_units", "avg_price", "avg_discount_pct", "promo_rate_pct"],
    )
    ranks = {
        "revenue_rank": "total_revenue",
        "units_rank": "total_units",
        "price_rank": "avg_price",
        "discount_rank": "avg_discount_pct",
        "promo_freq_rank": "promo_rate_pct",
    }
    return base.select(
        "*",
        *[rank_desc(value).alias(name) for name, value in ranks.items()],
        rank_desc("total_revenue", "category").alias("category_revenue_rank"),
        rank_desc("total_units", "category").alias("category_units_rank"),
        percent_rank("total_revenue").alias("revenue_percentile"),
        cume_dist("total_revenue").alias("revenue_cume_dist"),
    ).drop("upc")


@query("rk2_top_n_per_category")
def top_n_per_category(cx: Context, n: int = 3):
    base = kpi_rollup(
        cx.sales("product"),
        ["category", "description", "manufacturer"],
        ["total_revenue:4=_rev", "total_revenue", "total_units", "avg_price"],
    )
    return base.withColumn("cat_rank", dense_rank_desc("_rev", "category")).filter(F.col("cat_rank") <= n).drop("_rev")


@query("rk3_top_stores_per_state")
def top_stores_per_state(cx: Context, n: int = 3):
    base = kpi_rollup(cx.sales("store"), STORE, ["total_revenue:4=_rev", "total_revenue", "avg_basket_value"])
    ranked = base.withColumn("state_rank", rank_desc("_rev", "state")).filter(F.col("state_rank") <= n)
    other = F.concat(F.lit(labels.STANDING_OTHER), F.col("state_rank").cast("string"))
    standing = F.coalesce(choose("state_rank", labels.STANDINGS), other)
    return ranked.withColumn("state_standing", standing).drop("_rev")


@query("rk4_decile_summary")
def decile_summary(cx: Context):
    base = kpi_rollup(
        cx.sales("product"), ["upc", "description", "category"], ["total_revenue:4=_rev", "total_revenue"]
    ).withColumn("decile", tile_desc(10, "_rev", ["upc"]))
    # One decile holds a tenth of the catalogue, never fact rows.
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("_rev")).alias("k"), "description")))
    out = base.groupBy("decile").agg(
        F.count(F.lit(1)).alias("products_in_decile"),
        F.min("total_revenue").alias("min_revenue"),
        F.max("total_revenue").alias("max_revenue"),
        half_up(mean("total_revenue"), 2).alias("avg_revenue"),
        F.sum("total_revenue").alias("decile_total_revenue"),
        F.array_join(F.transform(ordered, lambda s: s["description"]), ", ").alias("products"),
    )
    return out.withColumn("pct_of_portfolio_revenue", share_pct("decile_total_revenue"))


def yearly_rank_shift(sales: DataFrame) -> DataFrame:
    """Rank of each product per year against the year before; a product with no
    row in the previous calendar year is a new entry."""
    yearly = kpi_rollup(
        sales,
        ["year", "upc", "description", "category"],
        ["total_revenue=annual_revenue"],
        ranks={"current_rank": ("revenue", ["year"])},
    )
    before = yearly.select(
        (F.col("year") + 1).alias("year"), "upc", F.col("current_rank").alias("prior_year_rank")
    )
    now, then = F.col("current_rank"), F.col("prior_year_rank")
    return yearly.join(before, ["year", "upc"], "left").select(
        "*",
        F.coalesce(then - now, F.lit(0)).alias("rank_change"),
        F.when(then.isNull(), labels.SHIFT_NEW)
        .when(now < then, labels.SHIFT_UP)
        .when(now > then, labels.SHIFT_DOWN)
        .otherwise(labels.SHIFT_SAME)
        .alias("trend_direction"),
    )


@query("rk5_yearly_rank_shift")
def yearly_rank_shift_query(cx: Context):
    return yearly_rank_shift(cx.sales("product"))


@query("rk6_discount_percentiles")
def discount_percentiles(cx: Context):
    base = kpi_rollup(
        cx.sales("product"),
        ["upc", "description", "category"],
        ["avg_discount_pct:4", "max_discount_pct:4", "pct_rows_discounted"],
    )
    return base.select(
        "*",
        rank_desc("avg_discount_pct").alias("discount_rank"),
        percent_rank("avg_discount_pct", scale=100.0, digits=2).alias("discount_percentile"),
        cume_dist("avg_discount_pct", 100.0, 2).alias("discount_cume_dist_pct"),
    ).drop("upc")


@query("rk7_store_ranks")
def store_ranks(cx: Context):
    base = kpi_rollup(cx.sales("store"), STORE, ["total_revenue", "avg_basket_value"])
    value = "total_revenue"
    return base.select(
        "*",
        rank_desc(value).alias("global_rank"),
        rank_desc(value, "seg_value_name").alias("segment_rank"),
        rank_desc(value, "state").alias("state_rank"),
        percent_rank(value, scale=100.0, digits=1).alias("global_percentile"),
        percent_rank(value, "seg_value_name", scale=100.0, digits=1).alias("segment_percentile"),
    )
