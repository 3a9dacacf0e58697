"""Star schema: calendar, product and store dimensions, fact, aggregate marts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, choose, half_up, pct, promo_mask, promo_type, ratio
from shelfwise.functions.measures import pick
from shelfwise.operators.share import class_of_running_share
from shelfwise.schema import MONEY


@dataclass(frozen=True)
class Star:
    """The four tables every analysis reads."""

    fact: DataFrame
    product: DataFrame
    store: DataFrame
    calendar: DataFrame

    def sales(self, *dims: str) -> DataFrame:
        """Fact joined to just the named dimensions.

        No broadcast hint: Spark broadcasts a dimension while it is below the
        configured size and otherwise shuffles, with skew splitting.
        """
        keys = {"product": "upc", "store": "store_num", "calendar": "date_key"}
        out = self.fact
        for dim in dims:
            side = getattr(self, dim)
            if dim == "calendar":
                side = side.drop("year")
            out = out.join(side, keys[dim])
        return out

    def enriched(self) -> DataFrame:
        """Fact with every dimension attribute; the base view of reports."""
        return self.sales("calendar", "product", "store")


def date_key(c: str | Column) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return (F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)).cast("int")


def week_spine(weeks: DataFrame, week: str = "week_end_date") -> DataFrame:
    """Every week from the first to the last, 7 days apart, numbered from 1."""
    ends = weeks.agg(F.min(week).alias("lo"), F.max(week).alias("hi"))
    return ends.select(
        F.posexplode(F.expr("sequence(lo, hi, interval 7 days)")).alias("_at", week)
    ).select((F.col("_at") + 1).alias("week_seq"), week)


def build_calendar(transactions: DataFrame) -> DataFrame:
    day = F.col("week_end_date")
    return week_spine(transactions).select(
        date_key(day).alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week_num"),
        F.col("week_seq").alias("week_of_year"),
        F.month(day).isin(*labels.HOLIDAY_MONTHS).alias("is_holiday_season"),
    )


def build_products(staged: DataFrame, codes: dict[str, str] | None = None) -> DataFrame:
    return staged.withColumn(
        "category_code",
        choose("category", codes or labels.CATEGORY_CODES, labels.CATEGORY_CODE_OTHER),
    )


def build_stores(staged: DataFrame) -> DataFrame:
    return staged.withColumns(
        {
            "store_size_band": band(
                "sales_area_size_num", labels.SIZE_EDGES, labels.SIZE_BANDS, null_label=labels.UNKNOWN
            ),
            "parking_band": band(
                "parking_space_qty", labels.PARKING_EDGES, labels.PARKING_BANDS, null_label=labels.UNKNOWN
            ),
        }
    )


def derive_metrics(staged: DataFrame) -> DataFrame:
    """Row-level ratios and promotion class; ratios are null on a 0 denominator."""
    base, price = F.col("base_price"), F.col("price")
    levers = ("feature", "display", "tpr_only")
    return staged.withColumns(
        {
            "discount_pct": F.coalesce(
                F.when(base > 0, half_up(pct(base - price, base), 4)), F.lit(0.0)
            ).cast("decimal(12,4)"),
            "price_gap": (base - price).cast(MONEY),
            "revenue_per_visit": half_up(ratio("spend", "visits"), 4).cast(MONEY),
            "units_per_hh": half_up(ratio("units", "hhs"), 4).cast(MONEY),
            "spend_per_hh": half_up(ratio("spend", "hhs"), 4).cast(MONEY),
            "promo_type": promo_type(*levers),
            "is_promoted": promo_mask(*levers) > 0,
        }
    )


_FACT_COLUMNS = (
    "date_key", "year", "store_num", "upc", "units", "visits", "hhs", "spend", "price", "base_price",
    "feature", "display", "tpr_only", "discount_pct", "price_gap", "revenue_per_visit",
    "units_per_hh", "spend_per_hh", "promo_type", "is_promoted",
)


def build_fact(
    staged: DataFrame, calendar: DataFrame | None = None, products: DataFrame | None = None, stores: DataFrame | None = None
) -> DataFrame:
    """Fact at week x store x product.

    The week key is computed, and staging already dropped rows without a
    product or store, so dimensions are only joined when they are passed in
    from elsewhere.
    """
    fact = derive_metrics(staged).withColumns(
        {"date_key": date_key("week_end_date"), "year": F.year("week_end_date")}
    )
    for dim, key in ((calendar, "date_key"), (products, "upc"), (stores, "store_num")):
        if dim is not None:
            fact = fact.join(dim.select(key), key, "left_semi")
    return fact.select(*_FACT_COLUMNS)


def build_star(transactions: DataFrame, products: DataFrame, stores: DataFrame) -> Star:
    """Raw tables to star schema; lazy, nothing runs here."""
    from shelfwise.operators import clean

    staged_products = clean.stage_products(products)
    staged_stores = clean.stage_stores(stores)
    staged = clean.stage_transactions(transactions, staged_products, staged_stores)
    return Star(
        fact=build_fact(staged),
        product=build_products(staged_products),
        store=build_stores(staged_stores),
        calendar=build_calendar(staged),
    )


def mart_weekly_store_category(star: Star) -> DataFrame:
    """Weekly store x category mart.

    Besides the published averages it keeps the sums and counts they come
    from, so coarser reports can be answered from the mart.
    """
    return (
        star.sales("product")
        .groupBy("date_key", "store_num", "category")
        .agg(
            *pick(
                "total_units", "total_visits", "total_hhs", "total_revenue:4=total_spend",
                "avg_price", "avg_discount_pct:4", "promoted_rows=promo_weeks", "row_count",
            ),
            F.sum("price").alias("price_sum"),
            F.sum("discount_pct").alias("discount_sum"),
        )
    )


def reaggregate_mart(mart: DataFrame, *by: str) -> DataFrame:
    """Coarser report from the weekly mart alone: sums add, averages are
    rebuilt from their sum and count columns."""
    rows = F.sum("row_count")
    return mart.groupBy(*by).agg(
        F.sum("total_units").alias("total_units"),
        F.round(F.sum("total_spend"), 2).alias("total_revenue"),
        half_up(ratio(F.sum("price_sum"), rows), 4).alias("avg_price"),
        half_up(ratio(F.sum("discount_sum"), rows), 2).alias("avg_discount_pct"),
        half_up(pct(F.sum("promo_weeks"), rows), 2).alias("promo_rate_pct"),
        half_up(ratio(F.sum("total_spend"), F.sum("total_visits")), 4).alias("avg_basket_value"),
    )


def mart_product_summary(star: Star) -> DataFrame:
    totals = (
        star.sales("product")
        .groupBy("upc", "description", "category")
        .agg(
            *pick(
                "total_revenue:4", "total_units", "total_visits", "avg_price", "avg_discount_pct:4",
                "promo_rate_pct=promo_weeks_pct",
            )
        )
    )
    return class_of_running_share(
        totals, "total_revenue", ["upc"], labels.ABC_CUTS, labels.ABC_CLASSES, "abc_class"
    ).drop("running_share", "value_share")


def mart_store_summary(star: Star) -> DataFrame:
    by = ["store_num", "store_name", "seg_value_name", "state", "sales_area_size_num"]
    return (
        star.sales("store")
        .groupBy(*by)
        .agg(*pick("total_revenue:4", "total_units", "total_visits", "avg_basket_value"))
        .withColumn("revenue_per_sqft", half_up(ratio("total_revenue", "sales_area_size_num"), 6))
        .withColumn("revenue_rank", F.rank().over(Window.orderBy(F.desc("total_revenue"))))
        .drop("sales_area_size_num")
    )
