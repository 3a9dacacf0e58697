"""Prediction errors: per row, per group, extremes, risk flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, dbl, flag, half_up
from shelfwise.operators.models import smape_term
from shelfwise.operators.scale import group_quantiles


def error_frame(scored: DataFrame, actual: str = "units", predicted: str = "prediction") -> DataFrame:
    a, p = dbl(actual), dbl(predicted)
    return scored.withColumns(
        {
            "actual": a,
            "predicted": p,
            "error": half_up(a - p, 6),
            "abs_error": half_up(F.abs(a - p), 6),
            "error_pct": half_up(F.abs(a - p) / F.when(a > 0, a).otherwise(1.0) * 100, 6),
            "smape_error": half_up(smape_term(actual, predicted), 6),
        }
    )


def error_summary(errors: DataFrame) -> DataFrame:
    """Mean, median and 95th percentile of the absolute error, and SMAPE."""
    spread = group_quantiles(errors, [], "abs_error", {"median_abs_error": 0.5, "p95_abs_error": 0.95})
    return errors.agg(
        half_up(F.avg("abs_error"), 4).alias("mean_abs_error"), half_up(F.avg("smape_error"), 4).alias("overall_smape")
    ).withColumns({c: spread.select(c).scalar() for c in spread.columns})


def discount_bucket(c: str = "discount_pct") -> Column:
    """Right-closed buckets over (-1, 100]; values outside have no bucket."""
    x = F.col(c)
    inside = (x > -1) & (x <= 100)
    return F.when(inside, band(c, labels.ERROR_BUCKET_EDGES, labels.ERROR_BUCKETS, right_closed=True))


def error_by(errors: DataFrame, key: str) -> DataFrame:
    known = errors.filter(F.col(key).isNotNull())
    means = known.groupBy(key).agg(
        half_up(F.avg("abs_error"), 2).alias("mean_abs_error"),
        half_up(F.avg("smape_error"), 2).alias("mean_smape"),
        F.count("abs_error").alias("row_count"),
    )
    return means.join(group_quantiles(known, [key], "abs_error", {"median_abs_error": 0.5}, 2), key)


def largest_errors(errors: DataFrame, ties: Sequence[str], top: int = 10) -> DataFrame:
    return errors.orderBy(F.desc("abs_error"), *ties).limit(top)


def extreme_groups(by_group: DataFrame, key: str, value: str = "mean_smape") -> DataFrame:
    """Group with the worst and with the best error."""
    order = lambda sign: F.struct((sign * F.col(value)).alias("v"), F.col(key))
    one = by_group.agg(
        F.min_by(F.struct(key, value), order(-1)).alias("worst"), F.min_by(F.struct(key, value), order(1)).alias("best")
    )
    rows = [
        F.struct(F.lit(k).alias("standing"), F.col(f"{k}.{key}").alias("member"), F.col(f"{k}.{value}").alias(value))
        for k in ("worst", "best")
    ]
    return one.select(F.inline(F.array(*rows)))


def risk_flags(
    df: DataFrame,
    predicted: str = "predicted",
    level: str = "rolling_mean_4w",
    discount_above: float = labels.RISK_DISCOUNT,
    spike: float = labels.RISK_SPIKE,
    risky_category: str = labels.RISK_CATEGORY,
) -> DataFrame:
    """Three warnings, their sum, and a level; two or more are uncertain."""
    low, medium, high = labels.RISK_LEVELS
    flags = {
        "flag_high_discount": F.col("discount_pct") > discount_above,
        "flag_risky_category": F.upper("category") == risky_category,
        "flag_demand_spike": dbl(predicted) > spike * dbl(level),
    }
    scored = df.withColumns(flags).withColumn("risk_score", sum((flag(F.col(c)) for c in flags), F.lit(0)))
    score = F.col("risk_score")
    return scored.withColumns(
        {
            "high_uncertainty": score >= 2,
            "risk_level": F.when(score == 0, low).when(score == 1, medium).otherwise(high),
        }
    )
