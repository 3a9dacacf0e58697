"""Feature queries (FE)."""

from __future__ import annotations

from shelfwise.operators import features as fe
from shelfwise.plans.context import PRIORITY, Context, query

KEY = ["week_end_date", "store_num", "upc"]


@query("fe1_master")
def master(cx: Context):
    return fe.master(cx.star).select(
        *KEY, "units", "spend", "category", "manufacturer", "store_name", "state", "seg_value_name"
    )


@query("fe2_price_features")
def price_features(cx: Context):
    return fe.price_features(fe.master(cx.star)).select(*KEY, "discount_pct", "price_gap", "price_ratio", "log_price")


@query("fe3_sales_features")
def sales_features(cx: Context):
    cols = ["revenue_per_visit", "units_per_hh", "spend_per_hh", "units_per_visit", "revenue_per_unit"]
    return fe.sales_features(fe.master(cx.star)).select(*KEY, *cols)


@query("fe4_time_features")
def time_features(cx: Context):
    cols = ["year", "month", "month_name", "quarter", "week_number", "season", "holiday_season"]
    return fe.time_features(fe.master(cx.star)).select(*KEY, *cols)


@query("fe5_lags")
def lags(cx: Context):
    out = fe.history_features(fe.master(cx.star), fill=False)
    return out.select(*KEY, *[f"sales_last_{n}_week" for n in fe.LAGS])


@query("fe6_rolling")
def rolling(cx: Context):
    out = fe.history_features(fe.master(cx.star), fill=False)
    return out.select(*KEY, "rolling_mean_4w", "rolling_std_4w", "moving_avg_8w")


@query("fe5_calendar_lags")
def calendar_lags(cx: Context):
    """Units of exactly so many weeks earlier; null where the product was not sold that week."""
    out = fe.history_features(fe.master(cx.star), fill=False, calendar=True)
    return out.select(*KEY, *[f"sales_last_{n}_week" for n in fe.LAGS])


@query("fe6_calendar_rolling")
def calendar_rolling(cx: Context):
    out = fe.history_features(fe.master(cx.star), fill=False, calendar=True)
    return out.select(*KEY, "rolling_mean_4w", "rolling_std_4w", "moving_avg_8w")


@query("fe7_filled_history")
def filled_history(cx: Context):
    out = fe.history_features(fe.master(cx.star))
    return out.select(*KEY, "has_history", *[f"sales_last_{n}_week" for n in fe.LAGS], "rolling_mean_4w")


@query("fe8_promo_features")
def promo_features(cx: Context):
    out = fe.promo_features(fe.master(cx.star), PRIORITY)
    return out.select(*KEY, "promotion_count", "promotion_intensity", "priority_promo_intensity")


@query("fe9_encodings")
def encodings(cx: Context):
    cols = [c for name in fe.ENCODED for c in (name, f"{name}_enc")]
    return fe.encode(fe.master(cx.star)).select(*cols).distinct()


@query("fe10_model_table")
def model_table(cx: Context):
    return cx.features
