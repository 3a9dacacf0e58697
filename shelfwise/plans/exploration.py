"""Exploration of dimensions and fact (X)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import count_where, half_up, mean, pct, sorted_text
from shelfwise.operators import explore, sketches
from shelfwise.operators.pairs import metro_pairs
from shelfwise.operators.report import metric_rows, shown
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.plans.context import Context, query

NUMERIC = ("units", "visits", "hhs", "spend", "price", "base_price", "discount_pct")


@query("x1_category_mix")
def category_mix(cx: Context):
    return cx.star.product.groupBy("category").agg(
        F.count_distinct("upc").alias("product_count"),
        F.count_distinct("manufacturer").alias("manufacturer_count"),
        F.count_distinct("sub_category").alias("sub_category_count"),
        sorted_text("manufacturer", ", ").alias("manufacturers"),
    )


@query("x2_product_catalogue")
def product_catalogue(cx: Context):
    cols = ["category", "sub_category", "manufacturer", "description", "product_size", "upc"]
    number = F.row_number().over(Window.orderBy("category", "manufacturer", "description"))
    return cx.star.product.select(number.alias("product_num"), *cols)


@query("x3_sub_category_products")
def sub_category_products(cx: Context):
    names = F.array_join(F.sort_array(F.collect_list("description")), " | ")
    return cx.star.product.groupBy("category", "sub_category").agg(
        F.count(F.lit(1)).alias("product_count"), names.alias("products")
    )


@query("x4_segment_distribution")
def segment_distribution(cx: Context):
    averages = cx.star.store.groupBy("seg_value_name").agg(
        half_up(mean("sales_area_size_num"), 0).alias("avg_sqft"),
        half_up(mean("avg_weekly_baskets"), 0).alias("avg_weekly_baskets"),
        half_up(mean("parking_space_qty"), 0).alias("avg_parking"),
    )
    return explore.member_share(cx.star.store, "seg_value_name").join(averages, "seg_value_name")


@query("x5_state_distribution")
def state_distribution(cx: Context):
    seg = F.col("seg_value_name")
    return cx.star.store.groupBy("state").agg(
        F.count(F.lit(1)).alias("store_count"),
        *[count_where(seg == s).alias(f"{s.lower()}_stores") for s in ("UPSCALE", "MAINSTREAM", "VALUE")],
        sorted_text("msa_code", ", ").alias("msa_codes"),
    )


@query("x6_size_band_profile")
def size_band_profile(cx: Context):
    return cx.star.store.groupBy("store_size_band", "seg_value_name").agg(
        F.count(F.lit(1)).alias("store_count"),
        half_up(mean("sales_area_size_num"), 0).alias("avg_sqft"),
        F.min("sales_area_size_num").alias("min_sqft"),
        F.max("sales_area_size_num").alias("max_sqft"),
        half_up(mean("avg_weekly_baskets"), 0).alias("avg_baskets"),
    )


@query("x7_store_roster")
def store_roster(cx: Context):
    return cx.star.store.select(
        "store_num",
        "store_name",
        "city",
        "state",
        "seg_value_name",
        "store_size_band",
        "sales_area_size_num",
        F.coalesce(F.col("parking_space_qty").cast("string"), F.lit("N/A")).alias("parking"),
        F.round("avg_weekly_baskets", 0).alias("avg_weekly_baskets"),
    )


@query("x8_metro_pairs")
def metro_pairs_query(cx: Context):
    return metro_pairs(cx.star.store)


@query("x9_calendar_overview")
def calendar_overview(cx: Context):
    return cx.star.calendar.agg(
        F.min("week_end_date").alias("first_week"),
        F.max("week_end_date").alias("last_week"),
        F.count(F.lit(1)).alias("total_weeks"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        F.count_distinct("year").alias("num_years"),
    )


@query("x9_weeks_per_quarter")
def weeks_per_quarter(cx: Context):
    return cx.star.calendar.groupBy("year", "quarter").agg(
        F.count(F.lit(1)).alias("weeks_in_quarter"),
        F.min("week_end_date").alias("quarter_start"),
        F.max("week_end_date").alias("quarter_end"),
    )


@query("x9_holiday_weeks")
def holiday_weeks(cx: Context):
    return cx.star.calendar.groupBy("is_holiday_season").agg(
        F.count(F.lit(1)).alias("week_count"),
        F.min("week_end_date").alias("first_week"),
        F.max("week_end_date").alias("last_week"),
    )


@query("x10_coverage")
def coverage(cx: Context):
    return explore.coverage(cx.star)


@query("x11_store_coverage")
def store_coverage(cx: Context):
    return explore.store_coverage(cx.star)


@query("x12_fact_profile")
def fact_profile(cx: Context):
    return kpi_rollup(
        cx.sales(),
        [],
        [
            "row_count=total_rows", "week_count=distinct_weeks", "store_count=distinct_stores",
            "product_count=distinct_upcs", "total_revenue", "avg_revenue=avg_spend_per_row", "min_spend",
            "max_spend", "total_units", "avg_units=avg_units_per_row", "promoted_rows", "promo_rate_pct",
            "avg_price", "avg_base_price", "avg_discount_pct:4",
        ],
    )


@query("x12_distinct_by_quarter")
def distinct_by_quarter(cx: Context):
    """Products sold per quarter and segment, exact, merged from the bitmaps of weeks and stores."""
    rows = cx.star.fact.select("date_key", "store_num", "upc").join(sketches.codes(cx.star.product, "upc"), "upc")
    mart = sketches.bitmap_mart(rows, ["date_key", "store_num"])
    mart = mart.join(cx.star.calendar.select("date_key", "year", "quarter"), "date_key")
    mart = mart.join(cx.star.store.select("store_num", "seg_value_name"), "store_num")
    return sketches.distinct_of_bitmaps(mart, ["year", "quarter", "seg_value_name"], "product_count")


PRICE_QUANTILES = {"price": {"median_price": 0.5, "p90_price": 0.9}}


@query("x12_sketched_by_year")
def sketched_by_year(cx: Context):
    """Products and price quantiles per year, estimated from the sketches of weeks."""
    mart = sketches.sketch_mart(cx.star.fact, ["date_key"], ["upc"], ["price"])
    mart = mart.withColumn("year", F.floor(F.col("date_key") / 10000).cast("int"))
    return sketches.of_sketches(mart, ["year"], ["upc"], PRICE_QUANTILES)


@query("x13_promo_distribution")
def promo_distribution(cx: Context):
    return kpi_rollup(
        cx.sales(),
        ["promo_type"],
        [
            "row_count", "total_units", "total_revenue", "avg_units=avg_units_per_row",
            "avg_revenue=avg_revenue_per_row", "avg_discount_pct",
        ],
        {"pct_of_rows": ("rows", [])},
    )


@query("x14_category_revenue")
def category_revenue(cx: Context):
    return kpi_rollup(
        cx.sales("product"),
        ["category"],
        ["row_count", "total_units", "total_revenue", "avg_price", "avg_discount_pct"],
        {"revenue_share_pct": ("revenue", [])},
    )


@query("x15_sales_rollup")
def sales_rollup(cx: Context):
    return explore.sales_rollup(cx.star)


@query("x16_discounted_categories")
def discounted_categories(cx: Context, above: float = 5):
    out = cx.sales("product").groupBy("category").agg(
        mean("discount_pct").alias("_d"),
        F.count(F.lit(1)).alias("total_rows"),
        count_where(F.col("discount_pct") > 0).alias("discounted_rows"),
    )
    return out.filter(F.col("_d") > above).select(
        "category",
        half_up("_d", 2).alias("avg_discount_pct"),
        "total_rows",
        "discounted_rows",
        half_up(pct("discounted_rows", "total_rows"), 2).alias("pct_rows_discounted"),
    )


@query("x17_members_without_facts")
def members_without_facts(cx: Context):
    return explore.members_without_facts(cx.star)


@query("x18_sales_cube")
def sales_cube(cx: Context):
    return explore.sales_cube(cx.star)


@query("x19_overview_metrics")
def overview_metrics(cx: Context):
    one = kpi_rollup(
        cx.sales("product"),
        [],
        [
            "row_count", "week_count", "store_count", "product_count", "category_count", "total_revenue",
            "total_units", "total_visits", "total_hhs",
        ],
    )
    rows = [(F.lit(c), shown(c, 2 if c == "total_revenue" else None)) for c in one.columns]
    return metric_rows(one, rows, ["metric", "value"])


@query("x20_numeric_profile")
def numeric_profile(cx: Context):
    return explore.describe_columns(cx.star.fact, NUMERIC)


@query("x21_sku_per_category")
def sku_per_category(cx: Context):
    return explore.member_share(cx.star.product, "category", 2, "sku_count")


@query("x21_segment_share")
def segment_share(cx: Context):
    return explore.member_share(cx.star.store, "seg_value_name", 2)


@query("x22_correlations")
def correlations(cx: Context):
    return explore.correlations(cx.star.fact, NUMERIC)


@query("x23_activation_rates")
def activation_rates(cx: Context):
    return explore.activation_rates(cx.sales("product"), "category")


@query("x24_price_histogram")
def price_histogram(cx: Context):
    return explore.histogram(cx.star.fact, "price", 30)


@query("x24_price_medians")
def price_medians(cx: Context):
    return explore.group_medians(cx.sales("product"), "category", "price")


@query("x24_weekly_units")
def weekly_units(cx: Context):
    return cx.sales("calendar").groupBy("week_end_date").agg(F.sum("units").alias("total_units"))
