"""Warehouse build steps (B): staging, dimensions, fact and marts."""

from __future__ import annotations


from shelfwise.operators import clean, star as st
from shelfwise.plans.context import Context, query
from shelfwise.sources import crosswalk


@query("b1_store_dedup_first")
def store_dedup_first(cx: Context):
    lookup = crosswalk.raw_store_lookup(cx.spark, cx.sf_dir)
    return clean.stage_stores(lookup.drop("s_suppkey"))


@query("b1_store_dedup_last")
def store_dedup_last(cx: Context):
    lookup = crosswalk.raw_store_lookup(cx.spark, cx.sf_dir)
    return clean.stage_stores(lookup, keep="last", order=("s_suppkey",)).drop("s_suppkey")


@query("b2_staged_products")
def staged_products(cx: Context):
    return clean.stage_products(crosswalk.raw_products(cx.spark, cx.sf_dir))


@query("b3_staged_transactions")
def staged_transactions(cx: Context):
    raw = crosswalk.delivered_transactions(cx.spark, cx.sf_dir)
    return clean.stage_transactions(raw, cx.star.product, cx.star.store)


@query("b3_model_transactions")
def model_transactions(cx: Context):
    return clean.clean_for_models(crosswalk.delivered_transactions(cx.spark, cx.sf_dir))


@query("b4_parking_fill")
def parking_fill(cx: Context):
    stores = crosswalk.raw_stores(cx.spark, cx.sf_dir)
    return clean.fill_parking(stores).select("store_num", "store_name", "parking_space_qty", "has_parking_data")


@query("b5_calendar")
def calendar(cx: Context):
    return cx.star.calendar


@query("b6_product_dimension")
def product_dimension(cx: Context):
    return cx.star.product


@query("b7_store_dimension")
def store_dimension(cx: Context):
    return cx.star.store


@query("b8_fact")
def fact(cx: Context):
    """The fact as planned from the source tables, without the stored copy."""
    raw = crosswalk.raw_transactions(cx.spark, cx.sf_dir)
    products, stores = (f(cx.spark, cx.sf_dir) for f in (crosswalk.raw_products, crosswalk.raw_stores))
    return st.build_star(raw, products, stores).fact


@query("b9_weekly_store_category_mart")
def weekly_store_category(cx: Context):
    return st.mart_weekly_store_category(cx.star)


@query("b9_category_report_from_mart")
def report_from_mart(cx: Context):
    return st.reaggregate_mart(st.mart_weekly_store_category(cx.star), "category")


@query("b10_product_summary_mart")
def product_summary(cx: Context):
    return st.mart_product_summary(cx.star)


@query("b11_store_summary_mart")
def store_summary(cx: Context):
    return st.mart_store_summary(cx.star)
