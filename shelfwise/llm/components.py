"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str, rounds: int = 50) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is its smallest node.

    A large star hangs each node's larger neighbours on the smallest node
    around it, a small star does so with the smaller ones; no step brings a
    node's neighbours together in one row.  Each round writes its links, so
    lineage stays short.  Loops and repeated links do no harm; rows with a null
    are left out.  Ends when a round changes nothing.
    """
    written = []

    def keep(df: DataFrame) -> DataFrame:
        written.append(f"{name}{len(written)}")
        return scratch.table(df, written[-1])

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first())

    now = keep(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = state(now)
    for _ in range(rounds):
        both = now.union(now.select("b", "a").toDF("a", "b"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # After the large star every link goes from a larger to a smaller node.
        large = keep(large.where("a != b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = keep(small.where("a != b").union(least.toDF("a", "b")).distinct())
        for old in written[-3:-1]:
            scratch.drop(old)
        after = state(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return now.toDF("node", "component").union(roots)
