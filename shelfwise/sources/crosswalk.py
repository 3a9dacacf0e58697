"""Raw panel tables derived from the order-line tables.

Stores are nations, products are (type, brand) pairs, weeks end on Saturday.
Promotion levers, store sizes and parking are synthetic but deterministic.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.expr import band, flag
from shelfwise.schema import MONEY

_CELL = ["week_end_date", "store_num", "upc"]
_TEN_THOUSANDTH = Decimal("0.0001")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def week_end(ts: str) -> Column:
    """Saturday of the Monday-based week that holds the timestamp."""
    return F.date_add(F.trunc(F.to_date(F.col(ts)), "week"), 5)


def upc_of(category: str, brand: str) -> Column:
    """Product code of a (type, brand) pair: 60 bits of a hash, no numbering pass.

    Null is told from every text.  That no two products share a code is checked
    when the star is stored, which fails otherwise.
    """
    part = lambda c: F.coalesce(F.concat(F.lit("1"), F.col(c)), F.lit("0"))
    key = F.md5(F.concat(part(category), F.lit("|"), part(brand)))
    return F.conv(F.substring(key, 1, 15), 16, 10).cast("bigint")


def _money(ten_thousandths: Column) -> Column:
    return (ten_thousandths.cast("decimal(20,0)") * F.lit(_TEN_THOUSANDTH)).cast(MONEY)


def _div_half_up(num: str, den: str) -> Column:
    """Integer division rounded half up, for non-negative numbers."""
    return F.expr(f"(2 * {num} + {den}) div (2 * {den})")


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with week, store, product, and money as exact integers.

    Joins carry no broadcast hint: part, supplier and orders grow with the
    data, so Spark broadcasts them only below its own size threshold.
    """
    line = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        week_end("l_shipdate").alias("week_end_date"),
        F.round("l_quantity").cast("bigint").alias("units"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"),
        F.round(F.col("l_discount") * 100).cast("bigint").alias("off_pct"),
        flag(F.col("l_returnflag") == "R").alias("feature"),
        flag(F.col("l_linestatus") == "O").alias("display"),
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", upc_of("p_type", "p_brand").alias("upc"), "p_type", "p_brand"
    )
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("store_num"))
    order = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", flag(F.col("o_orderpriority") == "1-URGENT").alias("tpr_only")
    )
    return (
        line.join(part, line.l_partkey == part.p_partkey)
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("gross", F.col("cents") * 100)
        .withColumn("net", F.col("cents") * (100 - F.col("off_pct")))
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Week x store x product panel.

    Visits are distinct orders and households distinct customers.  Instead of
    two DISTINCT aggregates (which copy every line once per distinct column)
    the lines fold in three steps: per order, per customer, per cell.  Each
    step combines before it shuffles, so a hot cell shrinks on the map side.
    """
    sums = [F.sum(c).alias(c) for c in ("units", "gross", "net")]
    levers = [F.max(c).alias(c) for c in ("feature", "display", "tpr_only")]
    lines = sales_lines(spark, sf_dir)
    per_order = lines.groupBy(*_CELL, "o_custkey", "l_orderkey").agg(*sums, *levers)
    per_customer = per_order.groupBy(*_CELL, "o_custkey").agg(
        *sums, *levers, F.count(F.lit(1)).alias("visits")
    )
    cells = per_customer.groupBy(*_CELL).agg(
        *sums, *levers, F.sum("visits").alias("visits"), F.count(F.lit(1)).alias("hhs")
    )
    sold = F.col("units") > 0
    return cells.select(
        *_CELL,
        "units",
        "visits",
        "hhs",
        _money(F.col("net")).alias("spend"),
        _money(F.when(sold, _div_half_up("net", "units"))).alias("price"),
        _money(F.when(sold, _div_half_up("gross", "units"))).alias("base_price"),
        "feature",
        "display",
        "tpr_only",
    )


def delivered_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel as an unclean delivery, for the checks and the repair steps.

    Returned lines count as units but bring no spend, visit or household, so
    cells of returned lines alone arrive with zero spend, no price and no
    visits.  Levers arrive as line counts, not as 0/1.
    """
    kept = F.col("feature") == 0
    sums = ("units", "gross", "net", "kept_units", "feature", "display", "tpr_only")
    lines = sales_lines(spark, sf_dir).withColumns(
        {"net": F.when(kept, F.col("net")).otherwise(0), "kept_units": F.when(kept, F.col("units")).otherwise(0),
         "kept": kept.cast("int")}
    )
    add = [F.sum(c).alias(c) for c in sums]
    per_order = lines.groupBy(*_CELL, "o_custkey", "l_orderkey").agg(*add, F.max("kept").alias("kept"))
    per_customer = per_order.groupBy(*_CELL, "o_custkey").agg(*add, F.sum("kept").alias("visits"))
    cells = per_customer.groupBy(*_CELL).agg(
        *add, F.sum("visits").alias("visits"), F.count(F.when(F.col("visits") > 0, 1)).alias("hhs")
    )
    priced, sold = F.col("kept_units") > 0, F.col("units") > 0
    return cells.select(
        *_CELL,
        "units",
        "visits",
        "hhs",
        _money(F.col("net")).alias("spend"),
        _money(F.when(priced, _div_half_up("net", "kept_units"))).alias("price"),
        _money(F.when(sold, _div_half_up("gross", "units"))).alias("base_price"),
        F.col("feature").cast("int").alias("feature"),
        F.col("display").cast("int").alias("display"),
        F.col("tpr_only").cast("int").alias("tpr_only"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .groupBy("p_type", "p_brand")
        .agg(F.max("p_size").alias("size"))
        .select(
            upc_of("p_type", "p_brand").alias("upc"),
            F.col("p_type").alias("category"),
            F.concat_ws(" ", "p_type", "p_brand").alias("description"),
            F.col("p_brand").alias("manufacturer"),
            # Brands are grouped by their first seven characters: that is the sub-category, not a shortened key.
            F.concat_ws(" ", F.col("p_type"), F.substring("p_brand", 1, 7)).alias("sub_category"),
            F.concat(F.lit("SIZE "), F.col("size").cast("string")).alias("product_size"),
        )
    )


def _segment(balance: Column) -> Column:
    return band(F.coalesce(balance, F.lit(0.0)), (3000, 6000), ("VALUE", "MAINSTREAM", "UPSCALE"))


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def raw_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per nation; the segment comes from the mean supplier balance."""
    balance = (
        table(spark, sf_dir, "supplier")
        .groupBy("s_nationkey")
        .agg((F.sum(_cents("s_acctbal")).cast("double") / 100.0 / F.count(F.lit(1))).alias("balance"))
    )
    return _store_attributes(
        table(spark, sf_dir, "nation")
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(balance, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .withColumn("seg_value_name", _segment(F.col("balance")))
    )


def raw_store_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store lookup as delivered: one row per supplier, so a store repeats with
    conflicting segments.  Input of the duplicate checks and of the dedup."""
    rows = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .withColumn("seg_value_name", _segment(F.col("s_acctbal")))
    )
    return _store_attributes(rows, "s_suppkey")


def _store_attributes(df: DataFrame, *extra: str) -> DataFrame:
    key = F.col("n_nationkey")
    return df.select(
        key.alias("store_num"),
        F.col("n_name").alias("store_name"),
        F.concat(F.lit("CITY "), F.col("n_name")).alias("city"),
        F.col("r_name").alias("state"),
        F.col("n_regionkey").alias("msa_code"),
        "seg_value_name",
        F.when(key != 7, 200 + 20 * key).cast("decimal(8,2)").alias("parking_space_qty"),
        (30000 + 1000 * key).cast("int").alias("sales_area_size_num"),
        (5000 + 250 * key).cast("decimal(12,2)").alias("avg_weekly_baskets"),
        *extra,
    )
