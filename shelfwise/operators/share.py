"""Shares of a total and running-share (Pareto/ABC) classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import band, half_up, pct, ratio


def share_pct(value: str, *partition: str, digits: int = 2) -> Column:
    """Share of a row in the total of its partition (or of everything)."""
    return half_up(pct(value, F.sum(value).over(Window.partitionBy(*partition))), digits)


def class_of_running_share(
    df: DataFrame,
    value: str,
    tie_break: Sequence[str],
    cuts: Sequence[float],
    classes: Sequence[str],
    name: str,
) -> DataFrame:
    """Rank by value and classify on the running share of the total.

    Takes one row per product, so its windows run over the catalogue, not over
    the fact.  Ties are ordered by ``tie_break`` so results repeat.
    """
    by_value = Window.orderBy(F.desc(value))
    running = Window.orderBy(F.desc(value), *tie_break).rowsBetween(Window.unboundedPreceding, 0)
    total = F.sum(value).over(Window.partitionBy())
    return (
        df.withColumn("revenue_rank", F.rank().over(by_value))
        .withColumn("running_share", ratio(F.sum(value).over(running), total))
        .withColumn("value_share", ratio(value, total))
        .withColumn(name, band("running_share", cuts, classes, right_closed=True))
    )
