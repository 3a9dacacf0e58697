"""Weeks without sales: the full panel against the fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.operators.star import Star


def zero_weeks(star: Star, active_only: bool = False) -> DataFrame:
    """Every store x product x week without a fact row, as a zero row.

    No panel is built and joined against: per (store, product) the sold weeks
    are gathered (at most one entry per calendar week) and the missing weeks
    are the difference to the calendar.  Pairs that never sold get the whole
    calendar; with ``active_only`` only pairs that sold at least once appear.
    """
    spine = star.calendar.agg(F.sort_array(F.collect_list("week_end_date"))).scalar()
    sold = star.fact.select(
        "store_num", "upc", F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("_week")
    )
    weeks = sold.groupBy("store_num", "upc").agg(F.collect_set("_week").alias("_sold"))
    stores = star.store.select("store_num", "seg_value_name")
    products = star.product.select("upc", "description", "category")
    if active_only:
        pairs = weeks.join(stores, "store_num").join(products, "upc")
    else:
        pairs = panel_pairs(stores, products).join(weeks, ["store_num", "upc"], "left")
    missing = F.array_except(spine, F.coalesce("_sold", F.array().cast("array<date>")))
    return pairs.select(
        "store_num", "upc", "description", "category", "seg_value_name", F.explode(missing).alias("week_end_date")
    ).select(
        "*",
        F.lit(0).cast("double").alias("spend"),
        F.lit(0).cast("bigint").alias("units"),
        F.lit(True).alias("is_zero_week"),
    )


def zero_runs(star: Star) -> DataFrame:
    """The zero rows folded to runs: per store and product each stretch of weeks without a fact row, in order.

    One row stands for all its weeks, so the result grows with the sales and
    the pairs, not with pairs x weeks.  Pairs that never sold have one run over
    the whole calendar.  Weeks are numbered as in the calendar, from 1.
    """
    weeks = star.calendar.select("date_key", F.col("week_of_year").cast("long").alias("_no"), "week_end_date")
    total = star.calendar.agg(F.max(F.col("week_of_year").cast("long"))).scalar()
    sold = star.fact.select("store_num", "upc", "date_key").join(weeks.drop("week_end_date"), "date_key")
    w = Window.partitionBy("store_num", "upc").orderBy("_no")
    before = F.coalesce(F.lag("_no").over(w), F.lit(0))
    after = F.when(F.lead("_no").over(w).isNull(), total + 1)
    ends = sold.select("store_num", "upc", F.array(F.struct(before.alias("a"), F.col("_no").alias("b")),
                                                   F.struct(F.col("_no").alias("a"), after.alias("b"))).alias("_e"))
    runs = ends.select("store_num", "upc", F.inline("_e")).where(F.col("b") > F.col("a") + 1)
    pairs = panel_pairs(star.store.select("store_num", "seg_value_name"), star.product.select("upc", "description", "category"))
    never = pairs.select("store_num", "upc").join(star.fact.select("store_num", "upc").distinct(), ["store_num", "upc"], "left_anti")
    runs = runs.union(never.select("store_num", "upc", F.lit(0).cast("long"), total + 1))
    runs = runs.select("store_num", "upc", (F.col("a") + 1).alias("first_no"), (F.col("b") - 1).alias("last_no"))
    day = lambda n, name: weeks.select(F.col("_no").alias(n), F.col("week_end_date").alias(name))
    return (
        runs.join(day("first_no", "first_week"), "first_no")
        .join(day("last_no", "last_week"), "last_no")
        .select("store_num", "upc", "first_week", "last_week", (F.col("last_no") - F.col("first_no") + 1).alias("zero_weeks"))
    )


def panel_pairs(stores: DataFrame, products: DataFrame) -> DataFrame:
    """All store x product pairs: each product row carries the list of stores
    (a small dimension folded to one value) and unfolds it in place."""
    listed = stores.agg(
        F.sort_array(F.collect_list(F.struct("store_num", "seg_value_name")))
    ).scalar()
    return products.withColumn("_s", F.explode(listed)).select(
        "_s.store_num", "upc", "description", "category", "_s.seg_value_name"
    )


def zero_filled(star: Star) -> DataFrame:
    """Fact rows and zero rows together: one row per store, product and week."""
    own = star.sales("product", "store").select(
        "store_num",
        "upc",
        "description",
        "category",
        "seg_value_name",
        F.to_date(F.col("date_key").cast("string"), "yyyyMMdd").alias("week_end_date"),
        F.col("spend").cast("double").alias("spend"),
        "units",
        F.lit(False).alias("is_zero_week"),
    )
    return own.unionByName(zero_weeks(star))
