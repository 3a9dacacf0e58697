"""Comparing groups with a benchmark of a coarser group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up


def against_member(
    df: DataFrame, keys: Sequence[str], member: Column, value: str, name: str, digits: int
) -> DataFrame:
    """Difference to the value of one named member of each group (for example
    the VALUE segment of a category), over already aggregated rows."""
    base = F.max(F.when(member, F.col(value))).over(Window.partitionBy(*keys))
    return df.withColumn(name, half_up(F.col(value) - base, digits))


def below_group(df: DataFrame, bench: DataFrame, keys: Sequence[str], value: str, level: str) -> DataFrame:
    """Rows whose value is under the level of their group."""
    return df.join(bench, list(keys)).filter(F.col(value) < F.col(level)).drop(level)
