"""Shared folder, tables written to cut lineage, and small helpers of the operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.session import tune


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor sees: ``spark.checkpoint.dir``.

    Where the setting is absent (tests, one machine) the session gets a folder
    of its own, once; on a cluster without the setting this fails.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    if jvm_dir.isDefined():
        return jvm_dir.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors see")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="shelfwise-llm-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def small_batches(spark: SparkSession) -> SparkSession:
    """Few rows per Arrow batch: texts are long, and a worker holds a batch at a time; joins split skewed keys."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    return tune(spark)


class Scratch:
    """Tables of one run, written as Parquet below the shared folder.

    A written table cuts lineage like a checkpoint, survives lost executors and
    has known sizes, so Spark plans the next join from them.
    """

    def __init__(self, spark: SparkSession, what: str):
        self.spark, self.name = spark, f"{what}-{uuid.uuid4().hex}"
        self.root = f"{shared_dir(spark)}/llm/{self.name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        # Small row groups: every writing task holds one in memory, and rows may carry whole texts.
        df.write.mode("overwrite").option("parquet.block.size", str(32 << 20)).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str) -> None:
        """Remove a table that no later step reads."""
        self._delete(f"{self.root}/{name}")

    def clear(self) -> None:
        """Remove all tables of the run."""
        self._delete(self.root)

    def _delete(self, name: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def hash32(text: Column) -> Column:
    """First 32 bits of the text's md5, as a long; the same in any SQL engine."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def key_text(column: Column) -> Column:
    """A value as text, one that no value has for null."""
    return F.when(column.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), column.cast("string")))


def packed(df: DataFrame, **more: Column) -> DataFrame:
    """The rows of ``df`` as one struct ``in`` beside other columns, so that no name can clash with theirs."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("in"), *[c.alias(n) for n, c in more.items()])


def unpacked(columns: list[str], **more: Column) -> list[Column]:
    """The columns of ``in`` and then the given ones; those take the place of input columns of the same name."""
    return [F.col("in").getField(c).alias(c) for c in columns if c not in more] + [c.alias(n) for n, c in more.items()]
