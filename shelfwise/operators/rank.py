"""Ranks and top/bottom selections over aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up


def rank_desc(value: str, *partition: str) -> Column:
    return F.rank().over(Window.partitionBy(*partition).orderBy(F.desc(value)))


def rank_asc(value: str, *partition: str) -> Column:
    return F.rank().over(Window.partitionBy(*partition).orderBy(F.asc(value)))


def dense_rank_desc(value: str, *partition: str) -> Column:
    return F.dense_rank().over(Window.partitionBy(*partition).orderBy(F.desc(value)))


def position_desc(value: str, ties: Sequence[str], *partition: str) -> Column:
    return F.row_number().over(Window.partitionBy(*partition).orderBy(F.desc(value), *ties))


def tile_desc(n: int, value: str, ties: Sequence[str]) -> Column:
    """n-tile over bounded rows; the tie-break makes it repeatable."""
    return F.ntile(n).over(Window.orderBy(F.desc(value), *ties))


def percent_rank(value: str, *partition: str, scale: float = 1.0, digits: int = 4) -> Column:
    w = Window.partitionBy(*partition).orderBy(F.asc(value))
    return half_up(F.percent_rank().over(w) * scale, digits)


def cume_dist(value: str, scale: float = 1.0, digits: int = 4) -> Column:
    return half_up(F.cume_dist().over(Window.orderBy(F.asc(value))) * scale, digits)


def top_bottom(
    df: DataFrame,
    value: str,
    top: tuple[str, int],
    bottom: tuple[str, int],
    ties: Sequence[str],
    label: str,
    rank: str,
    keep_ties: bool = False,
) -> DataFrame:
    """Best and worst rows under two labels.

    With ``keep_ties`` every row ranked within n stays (rank filter); else
    exactly n rows per side, ordered by value then ``ties``.
    """

    def side(name: str, n: int, descending: bool) -> DataFrame:
        order = F.desc(value) if descending else F.asc(value)
        ranked = df.select(
            F.lit(name).alias(label), F.rank().over(Window.orderBy(order)).alias(rank), "*"
        )
        if keep_ties:
            return ranked.filter(F.col(rank) <= n)
        return ranked.orderBy(order, *ties).limit(n)

    return side(*top, True).unionByName(side(*bottom, False))
