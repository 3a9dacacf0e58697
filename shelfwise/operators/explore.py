"""Profiles of the dimensions and the fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import half_up, pct
from shelfwise.operators.scale import group_quantiles
from shelfwise.operators.star import Star


def member_share(df: DataFrame, by: str, digits: int = 1, count: str = "store_count") -> DataFrame:
    out = df.groupBy(by).agg(F.count(F.lit(1)).alias(count))
    total = F.sum(count).over(Window.partitionBy())
    return out.withColumn("pct_of_total", half_up(pct(count, total), digits))


def coverage(star: Star) -> DataFrame:
    """Store-product pairs that sold, out of all possible pairs."""
    stores = star.store.select(F.count_distinct("store_num")).scalar()
    products = star.product.select(F.count_distinct("upc")).scalar()
    sold = star.fact.select("store_num", "upc").distinct()
    return sold.agg(F.count(F.lit(1)).alias("actual_combinations")).select(
        "actual_combinations", (stores * products).alias("possible_combinations")
    ).withColumn("coverage_pct", half_up(pct("actual_combinations", "possible_combinations"), 1))


def store_coverage(star: Star) -> DataFrame:
    """Products and categories each store sold; stores without sales stay."""
    products = star.product.select(F.count(F.lit(1))).scalar()
    pairs = star.fact.select("store_num", "upc").distinct().join(star.product.select("upc", "category"), "upc")
    sold = pairs.groupBy("store_num").agg(
        F.count_distinct("category").alias("categories_carried"), F.count(F.lit(1)).alias("unique_products_sold")
    )
    return (
        star.store.select("store_num", "store_name", "seg_value_name")
        .join(sold, "store_num", "left")
        .fillna(0, ["categories_carried", "unique_products_sold"])
        .withColumn("total_possible_products", products)
        .withColumn("product_coverage_pct", half_up(pct("unique_products_sold", "total_possible_products"), 1))
    )


def sales_rollup(star: Star) -> DataFrame:
    """Category, sub-category and product totals with their subtotals.  Labels
    follow the grouping level, so a real null never reads as a subtotal."""
    levels = ("category", "sub_category", "description")
    sums = star.sales("product").rollup(*levels).agg(
        F.round(F.sum("spend"), 2).alias("total_revenue"),
        F.sum("units").alias("total_units"),
        F.count_distinct("store_num").alias("stores_selling"),
        *[F.grouping(c).alias(f"_{c}") for c in levels],
    )
    shown = [
        F.when(F.col(f"_{c}") == 1, text).otherwise(F.col(c)).alias(name)
        for c, text, name in zip(levels, labels.ROLLUP_ALL, ("category", "sub_category", "product"))
    ]
    return sums.select(*shown, "total_revenue", "total_units", "stores_selling")


def sales_cube(star: Star) -> DataFrame:
    """Totals for every combination of category, state and year."""
    levels = ("category", "state", "year")
    keys = [F.col(c).cast("string").alias(c) for c in levels]
    sums = star.sales("product", "store").select(*keys, "spend", "units").cube(*levels).agg(
        F.round(F.sum("spend"), 2).alias("total_revenue"),
        F.sum("units").alias("total_units"),
        *[F.grouping(c).alias(f"_{c}") for c in levels],
    )
    return sums.select(
        *[F.when(F.col(f"_{c}") == 1, "ALL").otherwise(F.col(c)).alias(c) for c in levels],
        "total_revenue",
        "total_units",
    )


def members_without_facts(star: Star) -> DataFrame:
    """Products and stores that never appear in the fact."""
    status = F.lit(labels.NO_FACTS).alias("status")
    products = star.product.join(star.fact.select("upc").distinct(), "upc", "left_anti").select(
        F.col("upc").alias("member_key"), F.col("description").alias("member"), F.col("category").alias("grouping"), status
    )
    stores = star.store.join(star.fact.select("store_num").distinct(), "store_num", "left_anti").select(
        F.col("store_num").cast("bigint").alias("member_key"),
        F.col("store_name").alias("member"),
        F.col("seg_value_name").alias("grouping"),
        status,
    )
    return products.unionByName(stores)


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, std, min, quartiles, max, range and IQR per column.

    The columns unfold to (column, value) rows once; quartiles are exact and
    computed from value counts.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("v")) for c in columns])
    long = df.select(F.inline(pairs)).filter(F.col("v").isNotNull())
    basic = long.groupBy("column_name").agg(
        F.count("v").alias("count"),
        half_up(F.avg("v"), 2).alias("mean"),
        half_up(F.stddev_samp("v"), 2).alias("std"),
        F.round(F.min("v"), 4).alias("min"),
        F.round(F.max("v"), 4).alias("max"),
    )
    quart = group_quantiles(long, ["column_name"], "v", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return basic.join(quart, "column_name").select(
        "*",
        half_up(F.col("max") - F.col("min"), 4).alias("range"),
        half_up(F.col("q75") - F.col("q25"), 4).alias("iqr"),
    )


def correlations(df: DataFrame, columns: Sequence[str], digits: int = 3) -> DataFrame:
    """Pairwise Pearson correlations, all pairs in one aggregate."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    one = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).agg(
        *[half_up(F.corr(a, b), digits).alias(f"{a}|{b}") for a, b in pairs]
    )
    rows = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"`{a}|{b}`").alias("correlation"))
        for a, b in pairs
    ]
    return one.select(F.inline(F.array(*rows)))


def activation_rates(df: DataFrame, by: str, levers: Sequence[str] = ("feature", "display", "tpr_only")) -> DataFrame:
    """Share of rows with each lever on, one row per group and lever."""
    one = df.groupBy(by).agg(
        *[half_up(pct(F.sum(c), F.count(F.lit(1))), 2).alias(c) for c in levers]
    )
    return one.unpivot([by], list(levers), "promotion", "activation_rate_pct")


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum."""
    x = F.col(value).cast("double")
    lo, hi = df.agg(F.min(x)).scalar(), df.agg(F.max(x)).scalar()
    at = F.least(F.floor((x - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins), F.lit(bins - 1))
    return df.groupBy(F.coalesce(at, F.lit(0)).alias("bin")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.round(F.min(x), 4).alias("lowest"),
        F.round(F.max(x), 4).alias("highest"),
    )


def group_medians(df: DataFrame, by: str, value: str) -> DataFrame:
    """Box-plot figures of a value per group."""
    return group_quantiles(df, [by], value, {"q25": 0.25, "median": 0.5, "q75": 0.75})
