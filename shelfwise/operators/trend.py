"""Ordered-period operators: lags, growth, rolling means, running totals.

All of them take already aggregated periods, so a window holds one row per
period of a series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfwise.functions.expr import growth_pct, half_up, mean


def series(order: Sequence[str] | str, partition: Sequence[str] = ()) -> WindowSpec:
    order = [order] if isinstance(order, str) else list(order)
    return Window.partitionBy(*partition).orderBy(*order)


def lag_of(value: str, w: WindowSpec, periods: int = 1) -> Column:
    return F.lag(value, periods).over(w) if periods > 0 else F.lead(value, -periods).over(w)


def growth_over(value: str, w: WindowSpec, periods: int = 1, digits: int = 2) -> Column:
    """Growth against the row ``periods`` earlier in the series, in percent."""
    return growth_pct(value, lag_of(value, w, periods), digits)


def rolling_mean(value: str, w: WindowSpec, rows: int, digits: int | None = 2) -> Column:
    """Mean over the last ``rows`` rows including the current one."""
    frame = w.rowsBetween(1 - rows, 0)
    out = F.sum(value).over(frame).cast("double") / F.count(value).over(frame)
    return out if digits is None else half_up(out, digits)


def rolling_std(value: str, w: WindowSpec, rows: int, digits: int = 4) -> Column:
    return half_up(F.stddev_samp(F.col(value).cast("double")).over(w.rowsBetween(1 - rows, 0)), digits)


def running_total(value: str, w: WindowSpec) -> Column:
    return F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, 0))


def whole(order: Sequence[str] | str, partition: Sequence[str] = ()) -> WindowSpec:
    return series(order, partition).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def week_index(week: str | Column) -> Column:
    """Whole weeks since the first Saturday of 1970: an axis for frames in weeks, whatever rows are missing."""
    day = F.col(week) if isinstance(week, str) else week
    return F.floor(F.datediff(day, F.lit("1970-01-03").cast("date")) / 7).cast("long")


def calendar_series(week: str, partition: Sequence[str] = ()) -> WindowSpec:
    """A series ordered by the number of its week, for RANGE frames; at most one row per week."""
    return Window.partitionBy(*partition).orderBy(week_index(week))


def calendar_lag(value: str | Column, w: WindowSpec, weeks: int = 1) -> Column:
    """The value exactly ``weeks`` weeks earlier (later if negative); null if that week has no row."""
    return F.max(value).over(w.rangeBetween(-weeks, -weeks))


def calendar_mean(value: str | Column, w: WindowSpec, first: int, last: int = 0, digits: int | None = 2) -> Column:
    """Mean over the rows of the weeks from ``first`` to ``last``, counted from the current one; null if there are none."""
    frame = w.rangeBetween(first, last)
    out = F.sum(value).over(frame).cast("double") / F.nullif(F.count(value).over(frame), F.lit(0))
    return out if digits is None else half_up(out, digits)


def lag_by_weeks(df: DataFrame, week: str, value: str, keys: Sequence[str], weeks: int, name: str) -> DataFrame:
    """Calendar lag: the value exactly ``weeks`` weeks earlier, null when that
    week has no row (a row lag would silently reach further back over gaps)."""
    earlier = df.select(
        *keys, F.date_add(F.col(week), 7 * weeks).alias(week), F.col(value).alias(name)
    )
    return df.join(earlier, [*keys, week], "left")


def week_gaps(df: DataFrame, week: str = "week_end_date", step: int = 7) -> DataFrame:
    """Consecutive distinct weeks that are not ``step`` days apart."""
    weeks = df.select(week).distinct()
    before = F.lag(week).over(Window.orderBy(week))
    days = F.datediff(F.col("next_week"), F.col("gap_after_week"))
    return (
        weeks.select(before.alias("gap_after_week"), F.col(week).alias("next_week"))
        .withColumn("days_between", days)
        .filter(F.col("days_between") != step)
    )


def seasonal_index(weekly: DataFrame, keys: Sequence[str], value: str, year: str = "year") -> DataFrame:
    """Level of each season key relative to the mean week."""
    overall = weekly.agg(mean(value)).scalar()
    x = F.col(value)
    return weekly.groupBy(*keys).agg(
        F.count_distinct(year).alias("years_observed"),
        half_up(mean(x), 2).alias("avg_revenue_this_week"),
        F.round(F.min(x), 2).alias("min_revenue_this_week"),
        F.round(F.max(x), 2).alias("max_revenue_this_week"),
        half_up(F.stddev_samp(x.cast("double")), 2).alias("stddev_revenue"),
        half_up(mean(x) / overall, 4).alias("seasonal_index"),
    )


def z_scores(df: DataFrame, value: str, threshold: float, names: tuple[str, str]) -> DataFrame:
    """Distance from the mean in standard deviations, flagged beyond threshold."""
    everything = Window.partitionBy()
    x = F.col(value).cast("double")
    mu = F.sum(value).over(everything).cast("double") / F.count(value).over(everything)
    sigma = F.stddev_samp(x).over(everything)
    z = (x - mu) / F.nullif(sigma, F.lit(0.0))
    return df.select(
        "*",
        half_up(mu, 2).alias("mean_revenue"),
        half_up(sigma, 2).alias("stddev_revenue"),
        half_up(z, 4).alias("z_score"),
        F.when(F.abs(z) > threshold, names[0]).otherwise(names[1]).alias("anomaly_flag"),
    )
