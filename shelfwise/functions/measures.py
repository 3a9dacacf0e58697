"""Named KPI measures.

A measure is asked for by a spec ``name[:digits][=alias]``; totals stay exact
decimals, ratios are doubles rounded half-up.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions.expr import count_where, half_up, mean, pct, ratio

promoted = lambda: F.col("is_promoted")

# Unrounded additive totals, used for shares, ranks and re-aggregation.
RAW: dict[str, Callable[[], Column]] = {
    "revenue": lambda: F.sum("spend"),
    "units": lambda: F.sum("units"),
    "visits": lambda: F.sum("visits"),
    "hhs": lambda: F.sum("hhs"),
    "rows": lambda: F.count(F.lit(1)),
    "avg_units_raw": lambda: mean("units"),
    "intensity": lambda: ratio(F.sum("units"), F.sum("hhs")),
}


def _total(c: str) -> Callable[[int | None], Column]:
    return lambda d: F.sum(c) if d is None else F.round(F.sum(c), d)


def _mean(c: str) -> Callable[[int], Column]:
    return lambda d: half_up(mean(c), d)


def _per(num: str, den: str) -> Callable[[int], Column]:
    return lambda d: half_up(ratio(F.sum(num), F.sum(den)), d)


def _rate(cond: Callable[[], Column]) -> Callable[[int], Column]:
    return lambda d: half_up(pct(count_where(cond()), F.count(F.lit(1))), d)


def _distinct(c: str) -> Callable[[int | None], Column]:
    return lambda d: F.count_distinct(F.col(c))


# name -> (default digits, builder)
MEASURES: dict[str, tuple[int | None, Callable]] = {
    "total_revenue": (2, _total("spend")),
    "total_units": (None, _total("units")),
    "total_visits": (None, _total("visits")),
    "total_hhs": (None, _total("hhs")),
    "row_count": (None, lambda d: F.count(F.lit(1))),
    "avg_basket_value": (4, _per("spend", "visits")),
    "avg_basket_size": (4, _per("units", "visits")),
    "avg_revenue_per_hh": (4, _per("spend", "hhs")),
    "avg_units_per_hh": (4, _per("units", "hhs")),
    "avg_visits_per_hh": (4, _per("visits", "hhs")),
    "hhs_per_visit": (4, _per("hhs", "visits")),
    "avg_price": (4, _mean("price")),
    "avg_base_price": (4, _mean("base_price")),
    "avg_price_gap": (4, _mean("price_gap")),
    "avg_discount_pct": (2, _mean("discount_pct")),
    "avg_units": (2, _mean("units")),
    "avg_revenue": (4, _mean("spend")),
    "avg_row_basket_value": (4, _mean("revenue_per_visit")),
    "avg_row_units_per_hh": (4, _mean("units_per_hh")),
    "avg_row_spend_per_hh": (4, _mean("spend_per_hh")),
    "max_row_basket_value": (4, lambda d: F.round(F.max("revenue_per_visit"), d)),
    "max_row_units_per_hh": (4, lambda d: F.round(F.max("units_per_hh"), d)),
    "min_price": (4, lambda d: F.round(F.min("price"), d)),
    "max_price": (4, lambda d: F.round(F.max("price"), d)),
    "price_range": (4, lambda d: F.round(F.max("price") - F.min("price"), d)),
    "max_discount_pct": (2, lambda d: F.round(F.max("discount_pct"), d)),
    "price_stddev": (4, lambda d: half_up(F.stddev_samp(F.col("price").cast("double")), d)),
    "price_cv_pct": (
        2,
        lambda d: half_up(pct(F.stddev_samp(F.col("price").cast("double")), mean("price")), d),
    ),
    "min_spend": (4, lambda d: F.round(F.min("spend"), d)),
    "max_spend": (4, lambda d: F.round(F.max("spend"), d)),
    "promoted_rows": (None, lambda d: count_where(promoted())),
    "discounted_rows": (None, lambda d: count_where(F.col("discount_pct") > 0)),
    "promo_rate_pct": (2, _rate(promoted)),
    "feature_rate_pct": (2, _rate(lambda: F.col("feature") == 1)),
    "display_rate_pct": (2, _rate(lambda: F.col("display") == 1)),
    "tpr_rate_pct": (2, _rate(lambda: F.col("tpr_only") == 1)),
    "combined_promo_rate_pct": (2, _rate(lambda: F.col("promo_type") == "COMBINED")),
    "pct_rows_discounted": (2, _rate(lambda: F.col("discount_pct") > 0)),
    "feature_share": (4, _mean("feature")),
    "display_share": (4, _mean("display")),
    "tpr_share": (4, _mean("tpr_only")),
    "promo_share": (4, lambda d: half_up(ratio(count_where(promoted()), F.count(F.lit(1))), d)),
    "feature_rows": (None, lambda d: count_where(F.col("feature") == 1)),
    "display_rows": (None, lambda d: count_where(F.col("display") == 1)),
    "tpr_rows": (None, lambda d: count_where(F.col("tpr_only") == 1)),
    "combined_rows": (None, lambda d: count_where(F.col("promo_type") == "COMBINED")),
    "store_count": (None, _distinct("store_num")),
    "product_count": (None, _distinct("upc")),
    "week_count": (None, _distinct("date_key")),
    "category_count": (None, _distinct("category")),
    "revenue_per_store": (2, lambda d: half_up(ratio(F.sum("spend"), F.count_distinct("store_num")), d)),
    "revenue_per_week": (2, lambda d: half_up(ratio(F.sum("spend"), F.count_distinct("date_key")), d)),
}


def parse(spec: str) -> tuple[str, int | None, str]:
    """``name[:digits][=alias]`` -> (name, digits, alias)."""
    body, _, alias = spec.partition("=")
    name, _, digits = body.partition(":")
    return name, int(digits) if digits else None, alias or name


def measure(spec: str) -> Column:
    name, digits, alias = parse(spec)
    default, build = MEASURES[name]
    return build(default if digits is None else digits).alias(alias)


def pick(*specs: str) -> list[Column]:
    return [measure(s) for s in specs]
