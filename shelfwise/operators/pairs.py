"""Operators that compare two members of the same group.

Inputs are aggregated first, so a group holds at most one row per member of a
dimension (category, product, store), never raw fact rows.  Pairs that meet in
many store-weeks come from products of store-week vectors (:mod:`gram`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up, mean, pct, ratio
from shelfwise.operators.gram import correlation, pair_stats


def metro_pairs(stores: DataFrame) -> DataFrame:
    """Pairs of stores in one metro area, each pair once."""
    cols = ("store_num", "store_name", "seg_value_name")
    names = {"store_num": "", "store_name": "_name", "seg_value_name": "_segment"}
    known = stores.filter("msa_code IS NOT NULL")

    def side(letter: str) -> DataFrame:
        return known.select("msa_code", *[F.col(c).alias(f"store_{letter}{names[c]}") for c in cols])

    return side("a").join(side("b"), "msa_code").filter("store_a < store_b")


def co_occurrence(sales: DataFrame) -> DataFrame:
    """How often two categories sell in the same store-week.

    One row per category and store-week goes in; pairs come from products of
    store-week vectors, not from a list of pairs per store-week.
    """
    cells = sales.groupBy("date_key", "store_num", "category").agg(F.sum("spend").alias("rev")).filter("rev > 0")
    own = cells.groupBy("category").agg(F.count(F.lit(1)).alias("_own"))
    cells = cells.withColumns({"_x": (F.col("rev") * 10_000).cast("long"), "_y": F.lit(0)})
    pairs = pair_stats(cells, [], ["date_key", "store_num"], "category", "_x", "_y").select(
        F.col("a").alias("category_a"),
        F.col("b").alias("category_b"),
        F.col("n").alias("co_occurrence_weeks"),
        half_up(ratio((F.col("xa") + F.col("xb")) / 10_000, "n"), 2).alias("avg_combined_weekly_revenue"),
    )
    return (
        pairs.join(own, F.col("category_a") == F.col("category"))
        .withColumn("pct_of_cat_a_weeks_with_b", half_up(pct("co_occurrence_weeks", "_own"), 2))
        .drop("category", "_own")
    )


def price_gap_pairs(sales: DataFrame, min_weeks: int = 10) -> DataFrame:
    """Two products of a category in the same store-week: price gap, who sells
    more, and the correlation of price gap and unit difference."""
    cells = sales.groupBy("date_key", "store_num", "category", "upc").agg(
        half_up(mean("price"), 4).cast("decimal(18,4)").alias("price"), F.sum("units").alias("units")
    )
    cells = cells.withColumn("_x", (F.col("price") * 10_000).cast("long"))
    stats = pair_stats(cells, ["category"], ["date_key", "store_num"], "upc", "_x", "units").filter(F.col("n") > min_weeks)
    names = sales.select("category", "upc", "description").distinct()
    name = lambda of, out: names.select("category", F.col("upc").alias(of), F.col("description").alias(out))
    return (
        stats.join(name("a", "product_a"), ["category", "a"])
        .join(name("b", "product_b"), ["category", "b"])
        .select(
            "category",
            "product_a",
            "product_b",
            F.col("n").alias("weeks_compared"),
            half_up(ratio((F.col("xa") - F.col("xb")) / 10_000, "n"), 4).alias("avg_price_gap"),
            half_up(ratio("ya", "n"), 2).alias("avg_units_a"),
            half_up(ratio("yb", "n"), 2).alias("avg_units_b"),
            F.col("a_wins").alias("weeks_a_wins"),
            F.col("b_wins").alias("weeks_b_wins"),
            half_up(correlation(), 4).alias("gap_unit_correlation"),
        )
    )
