"""Tables of one job below the shared folder, dropped when nothing reads them any more."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shelfwise.session import shared_dir
from shelfwise.sources.panel import write_table


class Workspace:
    """Written tables cut lineage: after a lost executor they are read again, not computed again."""

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.root = spark, f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        write_table(df, f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for name in names:
            path = where(f"{self.root}/{name}")
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
