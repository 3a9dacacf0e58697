"""Grouped KPI tables with shares and ranks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.measures import RAW, pick
from shelfwise.operators.share import share_pct

Spec = tuple[str, Sequence[str]]


def kpi_rollup(
    sales: DataFrame,
    by: Sequence[str],
    measures: Sequence[str],
    shares: Mapping[str, Spec] | None = None,
    ranks: Mapping[str, Spec] | None = None,
) -> DataFrame:
    """Aggregate ``sales`` by ``by``.

    ``shares`` and ``ranks`` map an output name to (raw total, partition): the
    windows run on unrounded totals of the aggregated rows.
    """
    shares, ranks = shares or {}, ranks or {}
    raws = sorted({raw for raw, _ in [*shares.values(), *ranks.values()]})
    hidden = [RAW[r]().alias(f"_{r}") for r in raws]
    grouped = sales.groupBy(*by) if by else sales.groupBy()
    out = grouped.agg(*pick(*measures), *hidden)
    for name, (raw, partition) in shares.items():
        out = out.withColumn(name, share_pct(f"_{raw}", *partition))
    for name, (raw, partition) in ranks.items():
        window = Window.partitionBy(*partition).orderBy(F.desc(f"_{raw}"))
        out = out.withColumn(name, F.rank().over(window))
    return out.drop(*[f"_{r}" for r in raws])
