"""Row features for the models: price, sales, time, history, promotion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import dbl, flag, half_up, pct, ratio, season
from shelfwise.operators.star import Star
from shelfwise.operators.trend import calendar_lag, calendar_series

SERIES = ("store_num", "upc")
WEEK = "week_end_date"
TARGET = "units"
ENCODED = ("store_num", "category", "seg_value_name")

# Model inputs, in the order they enter the feature vector.
FEATURES = (
    "price", "base_price", "discount_pct", "price_ratio", "feature", "display", "tpr_only", "promotion_count",
    "promotion_intensity", "priority_promo_intensity", "month", "quarter", "holiday_season", "store_num_enc",
    "category_enc", "seg_value_name_enc", "sales_last_1_week", "sales_last_2_week", "sales_last_4_week",
    "sales_last_8_week", "rolling_mean_4w", "rolling_std_4w", "moving_avg_8w", "has_history",
)
LAGS = (1, 2, 4, 8)
#: Text that a missing value is coded as.
MISSING = "nan"


def master(star: Star) -> DataFrame:
    """Fact rows with product and store attributes.  Left joins keep every
    sale; ``checks.join_cardinality`` tells whether a dimension multiplies rows."""
    week = F.to_date(F.col("date_key").cast("string"), "yyyyMMdd")
    return (
        star.fact.select(
            week.alias(WEEK), "store_num", "upc", "units", "visits", "hhs", "spend", "price", "base_price",
            "feature", "display", "tpr_only",
        )
        .join(star.product, "upc", "left")
        .join(star.store, "store_num", "left")
    )


def _or_zero(num: str, den: str, zero_div: str) -> Column:
    out = half_up(ratio(num, den), 6)
    return F.coalesce(out, F.lit(0.0)) if zero_div == "zero" else out


def price_features(df: DataFrame) -> DataFrame:
    base = F.col("base_price")
    gap = base - F.col("price")
    return df.withColumns(
        {
            "discount_pct": F.when(base > 0, half_up(pct(gap, base), 6)).otherwise(0.0),
            "price_gap": dbl(gap),
            "price_ratio": F.when(base > 0, half_up(ratio("price", base), 6)).otherwise(1.0),
            "log_price": half_up(F.log1p(dbl("price")), 6),
        }
    )


def sales_features(df: DataFrame, zero_div: str = "zero") -> DataFrame:
    """Ratios per visit, household and unit; 0 (or null) on a 0 denominator."""
    pairs = {
        "revenue_per_visit": ("spend", "visits"),
        "units_per_hh": ("units", "hhs"),
        "spend_per_hh": ("spend", "hhs"),
        "units_per_visit": ("units", "visits"),
        "revenue_per_unit": ("spend", "units"),
    }
    return df.withColumns({name: _or_zero(a, b, zero_div) for name, (a, b) in pairs.items()})


def time_features(df: DataFrame, week: str = WEEK) -> DataFrame:
    day = F.col(week)
    return df.withColumns(
        {
            "year": F.year(day),
            "month": F.month(day),
            "month_name": F.date_format(day, "MMMM"),
            "quarter": F.quarter(day),
            "week_number": F.weekofyear(day),
            "season": season(F.month(day)),
            "holiday_season": flag(F.month(day).isin(*labels.HOLIDAY_MONTHS)),
        }
    )


def history_features(
    df: DataFrame,
    keys: Sequence[str] = SERIES,
    order: str = WEEK,
    value: str = TARGET,
    fill: bool = True,
    calendar: bool = False,
) -> DataFrame:
    """Lags and rolling figures of the rows before the current one.

    No frame reaches the current row, so nothing of the target leaks.  One
    series holds at most one row per week.  Lags and frames count rows; with
    ``calendar`` they count weeks, and a week without a row has no value.
    """
    x = dbl(value)
    if calendar:
        w = calendar_series(order, keys)
        last4, last8 = w.rangeBetween(-4, -1), w.rangeBetween(-8, -1)
        cols = {f"sales_last_{n}_week": calendar_lag(x, w, n) for n in LAGS}
    else:
        w = Window.partitionBy(*keys).orderBy(order)
        last4, last8 = w.rowsBetween(-4, -1), w.rowsBetween(-8, -1)
        cols = {f"sales_last_{n}_week": F.lag(x, n).over(w) for n in LAGS}
    cols["rolling_mean_4w"] = half_up(F.avg(x).over(last4), 6)
    cols["rolling_std_4w"] = half_up(F.stddev_samp(x).over(last4), 6)
    cols["moving_avg_8w"] = half_up(F.avg(x).over(last8), 6)
    out = df.withColumns(cols).withColumn("has_history", flag(F.col("sales_last_1_week").isNotNull()))
    out = out.fillna(0.0, ["rolling_std_4w"])
    return out.fillna(0.0, list(cols)) if fill else out


def promo_features(df: DataFrame, priority: Sequence[str] = labels.PRIORITY_CATEGORIES) -> DataFrame:
    count = F.col("feature") + F.col("display") + F.col("tpr_only")
    return df.withColumns(
        {
            "promotion_count": count,
            "promotion_intensity": half_up(count / 3, 6),
            "priority_promo_intensity": F.when(F.upper("category").isin(*priority), count).otherwise(0),
        }
    )


def encode(df: DataFrame, columns: Sequence[str] = ENCODED) -> DataFrame:
    """Whole-number codes in the order of the values as text.

    Codes come from the distinct values of a column (a dimension), joined
    back without collecting labels on the driver.  A missing value is a value
    of its own, the text ``nan``, so that no row is lost.
    """
    for c in columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(MISSING))
        codes = df.select(text.alias("_v")).distinct().select(
            "_v", (F.row_number().over(Window.orderBy("_v")) - 1).alias(f"{c}_enc")
        )
        df = df.withColumn("_v", text).join(codes, "_v").drop("_v")
    return df


def model_table(star: Star, priority: Sequence[str] = labels.PRIORITY_CATEGORIES) -> DataFrame:
    """Keys, target and every model input, one row per fact row."""
    coded = encode(master(star))
    rows = promo_features(history_features(time_features(price_features(coded))), priority)
    inputs = [dbl(c).alias(c) for c in FEATURES if c not in ("month", "quarter")]
    return rows.select(
        WEEK, "store_num", "upc", "category", "seg_value_name", dbl(TARGET).alias(TARGET), dbl("spend").alias("spend"),
        *[dbl(c).alias(c) for c in ("month", "quarter")], *inputs,
    )
