"""Promotion operators: lift against unpromoted rows, levers, return."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expr import growth_pct, half_up, mean, mean_where, pct, ratio


def promo_lift(sales: DataFrame, baseline: str = "NONE") -> DataFrame:
    """Product x promotion averages next to the product's baseline averages.

    The fact is aggregated once to product x promotion class; baseline and
    promoted sides are rows of that small result.
    """
    sides = sales.groupBy("upc", "promo_type").agg(
        mean("units").alias("units"),
        mean("spend").alias("revenue"),
        mean("price").alias("price"),
        F.count(F.lit(1)).alias("rows"),
    )
    is_base = F.col("promo_type") == baseline
    base = sides.filter(is_base).select(
        "upc", *[F.col(c).alias(f"base_{c}") for c in ("units", "revenue", "price", "rows")]
    )
    lifted = sides.filter(~is_base).join(base, "upc")
    return lifted.select(
        "upc",
        "promo_type",
        half_up("base_units", 2).alias("baseline_avg_units"),
        half_up("units", 2).alias("promo_avg_units"),
        growth_pct("units", "base_units").alias("units_lift_pct"),
        half_up("base_price", 4).alias("baseline_avg_price"),
        half_up("price", 4).alias("promo_avg_price"),
        half_up(pct(F.col("base_price") - F.col("price"), "base_price"), 2).alias("price_reduction_pct"),
        growth_pct("revenue", "base_revenue").alias("revenue_lift_pct"),
        F.col("base_rows").alias("baseline_row_count"),
        F.col("rows").alias("promo_row_count"),
    )


LEVERS = {
    "feature_only": "FEATURE_ONLY",
    "display_only": "DISPLAY_ONLY",
    "tpr_only": "TPR_ONLY",
    "combined": "COMBINED",
}


def lever_comparison(sales: DataFrame, by: list[str]) -> DataFrame:
    """Average units per lever and as a multiple of unpromoted rows, pivoted."""
    kind = F.col("promo_type")
    averages = sales.groupBy(*by).agg(
        mean_where(kind == "NONE", "units").alias("_base"),
        *[mean_where(kind == code, "units").alias(f"_{name}") for name, code in LEVERS.items()],
    )
    return averages.select(
        *by,
        half_up("_base", 2).alias("baseline_units"),
        *[half_up(f"_{name}", 2).alias(f"{name}_units") for name in LEVERS],
        *[
            half_up(ratio(f"_{name}", "_base"), 2).alias(f"{name.removesuffix('_only')}_lift_multiple")
            for name in LEVERS
        ],
    )


def promo_return(sales: DataFrame, by: list[str]) -> DataFrame:
    """Revenue given up on promoted rows (price gap x units) and what is left."""
    totals = (
        sales.filter("promo_type <> 'NONE'")
        .groupBy(*by)
        .agg(
            F.sum("units").alias("promo_units"),
            F.sum("spend").alias("promo_revenue"),
            F.sum(F.col("price_gap") * F.col("units")).alias("revenue_foregone"),
        )
        .withColumn("net_revenue", F.col("promo_revenue") - F.col("revenue_foregone"))
    )
    return totals.withColumns(
        {
            "cost_as_pct_of_revenue": half_up(pct("revenue_foregone", "promo_revenue"), 2),
            "net_margin_pct": half_up(pct("net_revenue", "promo_revenue"), 2),
        }
    )
