"""Global ranks over row sets too large for one task.

An un-partitioned window sorts everything in a single task.  Here the place of
a row is put together from counts instead:

* rows before its value      - prefix sums over the distinct values,
* rows of the same value that tie-break earlier by the first tie key,
* a row number inside (value, first tie key).

Counting combines on the map side, so a value shared by a third of all rows
still becomes one count per (value, first tie key), and the only row-level
window is partitioned by (value, first tie key).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up

#: Buckets for each doubling of a value.
_PER_DOUBLING = 64


def value_bucket(x: Column) -> Column:
    """Bucket of a double, in the order of the values; equal steps of its logarithm on either side of 0.

    The cut points do not depend on the smallest and largest value, so an
    outlier or a heavy tail moves no other value into its neighbour's bucket.
    """
    far = F.floor(F.log2(F.abs(x)) * _PER_DOUBLING).cast("int") + 100_000
    return F.when(x == 0, F.lit(0)).otherwise(F.when(x > 0, far).otherwise(-far))


def _prefix_sums(counts: DataFrame, value: str, amount: str, name: str, descending: bool) -> DataFrame:
    """Sum of ``amount`` over all earlier values, in two levels.

    Bucket totals are prefix summed in one small window (a few thousand
    buckets at most), values inside their own bucket.
    """
    x = F.col(value).cast("double")
    bucket = value_bucket(-x if descending else x)
    order = F.desc(value) if descending else F.asc(value)
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0)
    bucketed = counts.withColumn("_bucket", bucket)
    totals = (
        bucketed.groupBy("_bucket")
        .agg(F.sum(amount).alias("_total"))
        .withColumn("_base", F.coalesce(F.sum("_total").over(Window.orderBy("_bucket").rowsBetween(*before)), zero))
        .drop("_total")
    )
    inside = F.coalesce(F.sum(amount).over(Window.partitionBy("_bucket").orderBy(order).rowsBetween(*before)), zero)
    return (
        bucketed.withColumn("_inside", inside)
        .join(totals, "_bucket")
        .withColumn(name, F.col("_base") + F.col("_inside"))
        .drop("_bucket", "_base", "_inside")
    )


def with_positions(df: DataFrame, value: str, ties: Sequence[str], descending: bool = True) -> DataFrame:
    """Add ``position`` (1..N, unique), ``rank_value`` and ``peers`` (rows that
    share the value).  ``value`` must not be null; ``ties`` must be unique
    within a value."""
    first, rest = ties[0], list(ties[1:])
    by_tie = df.groupBy(value, first).agg(F.count(F.lit(1)).alias("_n"))
    by_value = by_tie.groupBy(value).agg(F.sum("_n").alias("peers"))
    offsets = _prefix_sums(by_value, value, "peers", "_before", descending)
    earlier = Window.partitionBy(value).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    tie_offsets = by_tie.select(
        value, first, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_tied")
    ).join(offsets, value)
    local = Window.partitionBy(value, first).orderBy(*rest) if rest else None
    place = F.row_number().over(local) if local is not None else F.lit(1)
    return (
        df.join(tie_offsets, [value, first])
        .withColumn("position", F.col("_before") + F.col("_tied") + place)
        .withColumn("rank_value", F.col("_before") + 1)
        .drop("_before", "_tied")
    )


def tile_of_position(position, total, tiles: int):
    """ntile from a position: the first ``total mod tiles`` tiles hold one more."""
    small = F.floor(total / tiles)
    extra = total % tiles
    big_rows = extra * (small + 1)
    in_big = F.floor((position - 1) / (small + 1)) + 1
    in_small = extra + F.floor((position - 1 - big_rows) / F.greatest(small, F.lit(1))) + 1
    return F.when(position <= big_rows, in_big).otherwise(in_small).cast("int")


def global_ntile(
    df: DataFrame, value: str, ties: Sequence[str], tiles: int, name: str, descending: bool = True
) -> DataFrame:
    total = df.select(F.count(F.lit(1))).scalar()
    placed = with_positions(df, value, ties, descending)
    return placed.withColumn(name, tile_of_position(F.col("position"), total, tiles)).drop(
        "position", "rank_value", "peers"
    )


def global_percentiles(df: DataFrame, value: str, ties: Sequence[str]) -> DataFrame:
    """percent_rank and cume_dist of ``value`` in ascending order."""
    total = df.select(F.count(F.lit(1))).scalar()
    placed = with_positions(df, value, ties, descending=False)
    return placed.select(
        *df.columns,
        F.when(total > 1, (F.col("rank_value") - 1) / (total - 1)).otherwise(0.0).alias("percent_rank"),
        ((F.col("rank_value") - 1 + F.col("peers")) / total).alias("cume_dist"),
    )


def group_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, quantiles: dict[str, float], digits: int = 4
) -> DataFrame:
    """Exact interpolated quantiles per group, without gathering a group.

    Rows fold to counts per (group, value); the wanted positions are found
    with two-level prefix sums over those counts.  Nulls are left out.  Without
    keys the result is one row over everything.
    """
    keys = list(keys)
    x = F.col("_x")
    counts = (
        df.select(*keys, F.col(value).cast("double").alias("_x"))
        .filter(x.isNotNull())
        .groupBy(*keys, "_x")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    bucketed = counts.withColumn("_bucket", value_bucket(x))
    before = (Window.unboundedPreceding, -1)
    zero = F.lit(0)
    base = bucketed.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_t")).select(
        *keys,
        "_bucket",
        F.coalesce(F.sum("_t").over(Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(*before)), zero).alias(
            "_base"
        ),
        F.sum("_t").over(Window.partitionBy(*keys)).alias("_total"),
    )
    inside = F.coalesce(
        F.sum("_n").over(Window.partitionBy(*keys, "_bucket").orderBy("_x").rowsBetween(*before)), zero
    )
    placed = bucketed.withColumn("_inside", inside).join(base, [*keys, "_bucket"])
    first = F.col("_base") + F.col("_inside")
    last = first + F.col("_n") - 1

    def at(position):
        return F.max(F.when((position >= first) & (position <= last), x))

    picks, result = [], []
    for name, p in quantiles.items():
        spot = F.lit(float(p)) * (F.col("_total") - 1)
        picks += [
            at(F.floor(spot)).alias(f"_{name}_a"),
            at(F.ceil(spot)).alias(f"_{name}_b"),
            F.max(spot - F.floor(spot)).alias(f"_{name}_f"),
        ]
        a, b, f = F.col(f"_{name}_a"), F.col(f"_{name}_b"), F.col(f"_{name}_f")
        result.append(half_up(a + (b - a) * f, digits).alias(name))
    return placed.groupBy(*keys).agg(*picks).select(*keys, *result)
