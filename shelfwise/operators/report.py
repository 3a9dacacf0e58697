"""Metric/value report tables assembled from one aggregate row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def metric_rows(one_row: DataFrame, rows: Sequence[tuple[Column, ...]], names: Sequence[str]) -> DataFrame:
    """Unfold a one-row aggregate into report rows, without re-reading it per
    metric."""
    structs = [F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows]
    return one_row.select(F.inline(F.array(*structs)))


def shown(c: str | Column, digits: int | None = None) -> Column:
    """Number as report text: whole, or with a fixed count of decimals."""
    x = F.col(c) if isinstance(c, str) else c
    if digits is None:
        return x.cast("bigint").cast("string")
    return F.format_string(f"%.{digits}f", x.cast("double"))


def literal_rows(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """Inline relation of a few literal rows."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def winner(df: DataFrame, by: str, value: str = "spend") -> Column:
    """Member with the largest total, ties to the alphabetically first."""
    totals = df.groupBy(by).agg(F.sum(value).alias("_v"))
    best = totals.agg(F.min_by(F.col(by), F.struct((-F.col("_v")).alias("v"), F.col(by))).alias("_best"))
    return best.scalar()
