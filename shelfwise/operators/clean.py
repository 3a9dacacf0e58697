"""Staging: deduplication, text cleaning and transaction repair."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expr import flag


def keep_one(df: DataFrame, key: Sequence[str], order: Sequence[str], keep: str = "first") -> DataFrame:
    """One row per key: the first (or last) in ``order``.

    An aggregate with map-side combine, not a window, so a key that repeats
    very often is reduced before the shuffle.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep is 'first' or 'last'")
    pick = F.min_by if keep == "first" else F.max_by
    rest = [c for c in df.columns if c not in key]
    chosen = df.groupBy(*key).agg(
        pick(F.struct(*rest), F.struct(*order, *[c for c in rest if c not in order])).alias("_row")
    )
    return chosen.select(*key, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def stage_stores(raw: DataFrame, keep: str = "first", order: Sequence[str] = ("seg_value_name",)) -> DataFrame:
    """One row per store: alphabetically first segment, or the last by ``order``."""
    return keep_one(raw, ["store_num"], order, keep)


def stage_products(raw: DataFrame) -> DataFrame:
    upper = {c: F.upper(F.trim(F.col(c))) for c in ("category", "manufacturer", "sub_category")}
    plain = {c: F.trim(F.col(c)) for c in ("description", "product_size")}
    return raw.withColumns({**upper, **plain})


def fill_parking(stores: DataFrame) -> DataFrame:
    """Missing parking takes the median over stores; a 0/1 column tells which."""
    median = stores.agg(F.median("parking_space_qty")).scalar()
    return stores.withColumn("has_parking_data", flag(F.col("parking_space_qty").isNotNull())).withColumn(
        "parking_space_qty", F.coalesce(F.col("parking_space_qty").cast("double"), median)
    )


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def stage_transactions(
    raw: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    units_per_visit: float = 10,
    visits_per_hh: float = 5,
) -> DataFrame:
    """Repaired transactions that match a product and a store.

    Nulls become 0, a missing price takes the base price, and spend of sold
    rows without spend is units times the repaired price.  Flags other than 1
    become 0.  Four columns tell what was repaired or looks extreme.
    """
    units, visits, hhs, spend = (_zero(c) for c in ("units", "visits", "hhs", "spend"))
    no_price = _zero("price") <= 0
    no_spend = (spend <= 0) & (units > 0)
    money = raw.schema["spend"].dataType
    price = F.when(no_price, _zero("base_price")).otherwise(F.col("price"))
    repaired = raw.withColumns(
        {
            "is_zero_spend": no_spend,
            "is_zero_price": no_price,
            "is_outlier_uv": (visits > 0) & (units > visits * F.lit(units_per_visit)),
            "is_outlier_vh": (hhs > 0) & (visits > hhs * F.lit(visits_per_hh)),
            "spend": F.when(no_spend, (units * price).cast(money)).otherwise(spend.cast(money)),
            "price": price,
            "base_price": F.coalesce("base_price", "price"),
            "units": units,
            "visits": visits,
            "hhs": hhs,
            **{c: flag(F.col(c) == 1) for c in ("feature", "display", "tpr_only")},
        }
    )
    return repaired.join(products.select("upc"), "upc", "left_semi").join(
        stores.select("store_num"), "store_num", "left_semi"
    ).select(*repaired.columns)


def clean_for_models(raw: DataFrame, drop_zero_units: bool = True) -> DataFrame:
    """Row policy of the modelling data: prices fill each other, rows without
    any price go, missing spend is price times units, unsold rows go."""
    money = raw.schema["spend"].dataType
    filled = raw.withColumns(
        {"price": F.coalesce("price", "base_price"), "base_price": F.coalesce("base_price", "price")}
    ).dropna(subset=["price", "base_price"])
    priced = filled.withColumn("price", F.when(F.col("price") <= 0, F.col("base_price")).otherwise(F.col("price")))
    repair = (F.col("spend") <= 0) & (F.col("price") > 0) & (F.col("units") > 0)
    out = priced.withColumn(
        "spend", F.when(repair, (F.col("price") * F.col("units")).cast(money)).otherwise(F.col("spend"))
    )
    return out.filter(F.col("units") > 0) if drop_zero_units else out
