"""Price operators: elasticity proxy, tier lift, bands."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, growth_pct, half_up, mean_where, pct
from shelfwise.operators.scale import tile_of_position


def price_band(c: str = "price"):
    return band(c, labels.PRICE_BAND_EDGES, labels.PRICE_BANDS)


def discount_bucket(c: str = "discount_pct"):
    """Contiguous right-closed buckets; negative discounts have their own."""
    inner = band(c, labels.DISCOUNT_EDGES, labels.DISCOUNT_BUCKETS, right_closed=True)
    return F.when(F.col(c) < 0, labels.DISCOUNT_ABOVE_BASE).otherwise(inner)


def discount_tier(c: str = "discount_pct"):
    inner = band(c, labels.TIER_EDGES, labels.TIERS, right_closed=True)
    return F.when(F.col(c) == 0, labels.TIER_BASELINE).otherwise(inner)


def price_quartiles(sales: DataFrame, ties: tuple[str, ...] = ("date_key", "store_num")) -> DataFrame:
    """Price quartile of every sold row within its product.

    A product may hold a third of all rows, so the quartile is not taken from
    a window over the product.  Rows are counted per (product, price, first
    tie key); cut positions come from prefix sums over those counts and only
    the rows inside one (product, price, first tie key) group are numbered.
    """
    key, first, rest = "upc", ties[0], list(ties[1:])
    by_tie = sales.groupBy(key, "price", first).agg(F.count(F.lit(1)).alias("_n"))
    by_price = by_tie.groupBy(key, "price").agg(F.sum("_n").alias("_m"))
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0)
    prices = by_price.select(
        key,
        "price",
        F.coalesce(F.sum("_m").over(Window.partitionBy(key).orderBy("price").rowsBetween(*before)), zero).alias(
            "_before"
        ),
        F.sum("_m").over(Window.partitionBy(key)).alias("_total"),
    )
    tied = by_tie.select(
        key,
        "price",
        first,
        F.coalesce(
            F.sum("_n").over(Window.partitionBy(key, "price").orderBy(first).rowsBetween(*before)), zero
        ).alias("_tied"),
    ).join(prices, [key, "price"])
    place = F.row_number().over(Window.partitionBy(key, "price", first).orderBy(*rest))
    return (
        sales.join(tied, [key, "price", first])
        .withColumn("_place", F.col("_before") + F.col("_tied") + place)
        .withColumn("price_quartile", tile_of_position(F.col("_place"), F.col("_total"), 4))
        .drop("_before", "_tied", "_total", "_place")
    )


def elasticity_proxy(sales: DataFrame) -> DataFrame:
    """Units and price in the lowest and highest price quartile per product.

    Both quartiles come from one conditional aggregate, not a self-join.
    """
    by = ["upc", "description", "category"]
    q = F.col("price_quartile")
    sides = (
        price_quartiles(sales.filter("units > 0"))
        .groupBy(*by)
        .agg(
            half_up(mean_where(q == 1, "price"), 4).alias("avg_low_price"),
            half_up(mean_where(q == 4, "price"), 4).alias("avg_high_price"),
            half_up(mean_where(q == 1, "units"), 4).alias("_low_units"),
            half_up(mean_where(q == 4, "units"), 4).alias("_high_units"),
        )
        .filter("avg_high_price IS NOT NULL")
    )
    price_change = pct(F.col("avg_high_price") - F.col("avg_low_price"), "avg_low_price")
    units_change = pct(F.col("_high_units") - F.col("_low_units"), "_low_units")
    proxy = units_change / F.nullif(price_change, F.lit(0.0))
    return sides.select(
        *by,
        "avg_low_price",
        "avg_high_price",
        half_up("_low_units", 2).alias("avg_units_at_low_price"),
        half_up("_high_units", 2).alias("avg_units_at_high_price"),
        half_up(price_change, 2).alias("pct_price_increase"),
        half_up(units_change, 2).alias("pct_units_change"),
        half_up(proxy, 4).alias("price_elasticity_proxy"),
        F.when(F.abs(proxy) > 1, labels.ELASTIC).otherwise(labels.INELASTIC).alias("elasticity_class"),
    )


def lift_by_tier(sales: DataFrame) -> DataFrame:
    """Average units per discount tier against the product's undiscounted rows."""
    by = ["category", "description"]
    tiers = (
        sales.withColumn("discount_tier", discount_tier())
        .groupBy(*by, "discount_tier")
        .agg(
            (F.sum("units").cast("double") / F.count("units")).alias("_avg"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )
    base = F.max(F.when(F.col("discount_tier") == labels.TIER_BASELINE, F.col("_avg"))).over(
        Window.partitionBy(*by)
    )
    return tiers.withColumn("_base", base).select(
        *by,
        "discount_tier",
        half_up("_avg", 2).alias("avg_units"),
        half_up("_base", 2).alias("baseline_units"),
        growth_pct("_avg", "_base").alias("units_lift_pct"),
        "row_count",
    )
