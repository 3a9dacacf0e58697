"""Marts that are refreshed by week: only weeks whose rows changed are aggregated again.

A stored mart has two tables: ``state``, the mart's additive columns per week
and group, a folder per week; and ``marks``, a fingerprint per week, the sum of
hashes of its rows, whatever their order.  A refresh reads the fact once for
the fingerprints, compares them with the stored ones, aggregates the weeks that
differ and replaces their folders.  Marks are replaced last: a refresh that
breaks off is done again by the next.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.panel import write_table

#: Changed weeks that are named in the scan's filter; with more, all weeks are aggregated again.
NAMED_WEEKS = 520


def fingerprints(rows: DataFrame, week: str) -> DataFrame:
    """(week, mark, n): order-free sum of row hashes over all columns, and the number of rows."""
    mark = F.sum(F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns]).cast("decimal(38,0)"))
    return rows.groupBy(week).agg(mark.alias("mark"), F.count(F.lit(1)).alias("n"))


class WeeklyMart:
    """An additive mart over ``rows`` (fact rows with the columns of groups and measures, and no others).

    ``columns`` aggregate rows to additive columns, ``merged`` aggregate those
    again; the mart is ``merged`` by ``by`` over all weeks.
    """

    def __init__(self, spark: SparkSession, root: str, by: Sequence[str], columns: Sequence[Column], merged: Sequence[Column], week: str = "date_key"):
        self.spark, self.root, self.by, self.week = spark, root, list(by), week
        self.columns, self.merged = list(columns), list(merged)

    def _path(self, name: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _files(self):
        return self._path("").getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def changed_weeks(self, marks: DataFrame) -> tuple[list, list]:
        """(weeks to aggregate again, weeks that are gone); a week is a row of the calendar, so both are short."""
        if not self._files().exists(self._path("marks")):
            return [r[0] for r in marks.select(self.week).collect()], []
        old = self.spark.read.parquet(f"{self.root}/marks").select(
            F.col(self.week).alias("old"), F.col("mark").alias("old_mark"), F.col("n").alias("old_n")
        )
        both = marks.join(old, F.col(self.week).eqNullSafe(F.col("old")), "full").where(
            ~F.col("mark").eqNullSafe(F.col("old_mark")) | ~F.col("n").eqNullSafe(F.col("old_n"))
        )
        found = both.select(self.week, "old", F.col("n").isNull().alias("gone")).collect()
        return [r[self.week] for r in found if not r["gone"]], [r["old"] for r in found if r["gone"]]

    def delta(self, rows: DataFrame, weeks: list) -> DataFrame:
        """The additive state of the given weeks; their filter reaches the scan."""
        few = rows if len(weeks) > NAMED_WEEKS else rows.where(F.col(self.week).isin(weeks))
        return few.groupBy(self.week, *[c for c in self.by if c != self.week]).agg(*self.columns)

    def refresh(self, rows: DataFrame) -> list:
        """Bring the stored state up to ``rows``; returns the weeks that were aggregated again.

        ``rows`` must have no null week.
        """
        fresh = f"{self.root}/marks.new"
        write_table(fingerprints(rows, self.week), fresh)
        weeks, gone = self.changed_weeks(self.spark.read.parquet(fresh))
        if weeks:
            # One file a week: a week's groups are few beside its rows.
            write_table(self.delta(rows, weeks).repartition(self.week), f"{self.root}/state", partition_by=(self.week,))
        for week in gone:
            self._files().delete(self._path(f"state/{self.week}={week}"), True)
        self._files().delete(self._path("marks"), True)
        self._files().rename(self._path("marks.new"), self._path("marks"))
        return sorted(weeks)

    def read(self) -> DataFrame:
        """The mart, from its state alone; fails if no week was ever stored."""
        return self.spark.read.parquet(f"{self.root}/state").groupBy(*self.by).agg(*self.merged)
