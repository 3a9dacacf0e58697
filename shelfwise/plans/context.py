"""What a registered query gets: the session, the tables, the star."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators.navigate import Navigator
from shelfwise.operators.star import Star
from shelfwise.sources import crosswalk, marts


# Categories of the test tables that play the priority and the risky category.
PRIORITY = ("ECONOMY", "PROMO")
RISKY = "ECONOMY"


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def star(self) -> Star:
        return marts.stored_star(self.spark, self.sf_dir)

    @cached_property
    def marts(self) -> Navigator:
        """Answers from the stored marts where they cover a request."""
        return marts.stored_marts(self.spark, self.sf_dir)

    def table(self, name: str) -> DataFrame:
        return crosswalk.table(self.spark, self.sf_dir, name)

    def sales(self, *dims: str) -> DataFrame:
        return self.star.sales(*dims)

    @cached_property
    def features(self) -> DataFrame:
        """Model table; the test categories stand in for the priority ones."""
        return marts.stored_features(self.spark, self.sf_dir, PRIORITY)

    @cached_property
    def transactions(self) -> DataFrame:
        """Fact with its week as a date, the shape of the transaction table."""
        return self.star.fact.withColumn("week_end_date", week_of_key("date_key"))


def week_of_key(key: str):
    return F.to_date(F.col(key).cast("string"), "yyyyMMdd")


def finish(df: DataFrame) -> DataFrame:
    """Report types: whole numbers as bigint, every other number as double."""
    out = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        out.append(c.alias(field.name))
    return df.select(*out)


Query = Callable[[Context], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query {name} registered twice")
        REGISTRY[name] = fn
        return fn

    return add


def runner(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return finish(REGISTRY[name](Context(spark, sf_dir)))

    run.__name__ = name
    return run
