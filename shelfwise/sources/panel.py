"""Reading the three panel tables and writing layers as Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from shelfwise.schema import RAW_TABLES


def read_raw(spark: SparkSession, path: str, table: str, fmt: str = "parquet", **options) -> DataFrame:
    """Read one raw table with its declared schema; nothing is inferred.

    CSV exports of the original workbook carry one header row, so ``header``
    defaults to true for them.
    """
    schema = RAW_TABLES[table]
    reader = spark.read.schema(schema)
    if fmt == "csv":
        options = {"header": "true", **options}
    return reader.format(fmt).options(**options).load(path).select(*schema.fieldNames())


def read_sources(spark: SparkSession, paths: dict[str, str], fmt: str = "parquet", **options) -> dict[str, DataFrame]:
    return {name: read_raw(spark, path, name, fmt, **options) for name, path in paths.items()}


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
) -> str:
    """Write a layer table.

    ``cluster_by`` range-partitions on the full key, so a hot week or product
    is cut into several files instead of one, and sorts inside each file so
    that row-group statistics prune.
    """
    if cluster_by:
        df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if mode == "overwrite" and partition_by:
        # Only the partitions present in df are replaced.
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return path


def bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int, order: Sequence[str] = ()) -> DataFrame:
    """``df`` as a table bucketed by ``keys`` and sorted within buckets.

    Joins and windows on all of the keys then need no shuffle.  The catalog of
    the session holds the bucketing; the files lie below ``path``.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer = df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys, *order).saveAsTable(name)
    return spark.table(name)
