"""Distinct counts and quantiles that merge: exact bitmaps and sketches beside the sums of a mart.

A distinct count of a mart's rows cannot be summed.  Kept as a bitmap over
dense codes it merges by OR and stays exact; kept as a HyperLogLog sketch it
merges in a fixed size, within a relative error of about 1.04 / sqrt(2 ** LG).
Quantiles are kept as KLL sketches, whose ranks are off by about 1.7 % at K.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up

LG, K = 12, 200


def codes(members: DataFrame, key: str, code: str = "code") -> DataFrame:
    """(key, code): the members of a dimension numbered from 1; a window over the dimension, not over facts."""
    one = members.select(key).where(F.col(key).isNotNull()).distinct()
    return one.select(key, F.row_number().over(Window.orderBy(key)).cast("long").alias(code))


def bitmap_mart(rows: DataFrame, by: Sequence[str], code: str = "code") -> DataFrame:
    """(by, bucket, bits): bitmaps of the codes of every group, a row per 32,768 codes."""
    bucket, bit = F.bitmap_bucket_number(code), F.bitmap_bit_position(code)
    return rows.where(F.col(code).isNotNull()).groupBy(*by, bucket.alias("bucket")).agg(F.bitmap_construct_agg(bit).alias("bits"))


def distinct_of_bitmaps(mart: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Exact distinct count per coarser group, from the bitmaps alone."""
    merged = mart.groupBy(*by, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*by).agg(F.sum(F.bitmap_count("bits")).alias(name))


def sketch_mart(rows: DataFrame, by: Sequence[str], distinct: Sequence[str], values: Sequence[str], lg: int = LG, k: int = K) -> DataFrame:
    """(by, <c>_hll, <c>_kll): a sketch per group of the distinct and of the numeric columns; nulls are left out."""
    return rows.groupBy(*by).agg(
        *[F.hll_sketch_agg(c, lg).alias(f"{c}_hll") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(f"{c}_kll") for c in values],
    )


def of_sketches(
    mart: DataFrame, by: Sequence[str], distinct: Sequence[str], quantiles: Mapping[str, Mapping[str, float]], digits: int = 4
) -> DataFrame:
    """Estimates per coarser group: ``<c>_distinct`` and, by name, the quantiles of each numeric column."""
    merged = mart.groupBy(*by).agg(
        *[F.hll_union_agg(f"{c}_hll").alias(f"{c}_hll") for c in distinct],
        *[F.kll_merge_agg_double(f"{c}_kll").alias(f"{c}_kll") for c in quantiles],
    )
    return merged.select(
        *by,
        *[F.hll_sketch_estimate(f"{c}_hll").alias(f"{c}_distinct") for c in distinct],
        *[
            half_up(F.kll_sketch_get_quantile_double(f"{c}_kll", F.lit(float(p))), digits).alias(name)
            for c, wanted in quantiles.items()
            for name, p in wanted.items()
        ],
    )
