"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, its source's
target over its source's size.  Along a fixed order of the source's documents
the expected copies are summed up, one offset per source is added, and a
document is emitted once for each integer its interval crosses.  The order puts
similar sizes side by side, so the words taken differ from the target by about
the spread of sizes inside one size class, whatever the number of documents.

The running sum is rank times rate, so only ranks are needed.  A source's
documents are split by size class and by ranges of a hash of their id into
bins of a bounded number of rows; ranks come from one small prefix sum over bin
counts and a window inside each bin.  A source with a third of all rows is just
more bins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfwise.llm.common import Scratch, hash32, key_text, packed, read, unpacked
from shelfwise.llm.registry import query

WORD = r"[^\x20\x09-\x0D]+"
#: Rows of a bin, on average, at most.
BIN_ROWS = 50_000


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null and empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(totals: DataFrame, cap: int) -> DataFrame:
    """Target words per source from (source, source_size).

    Weights 1, 2, 3 repeat over the sources in code point order, null last.
    All words are shared by weight; a target stops at ``cap`` times the size
    and the excess goes to the others by weight.  With sources in order of
    cap over weight, the level of the uncapped ones is the first at which the
    next source stays below its cap.  One row per source goes in.
    """
    by_name = Window.orderBy("source")
    before = Window.orderBy("_limit", "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        totals.withColumn("_weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
        .withColumn("_limit", (F.col("source_size") * cap).cast("double") / F.col("_weight"))
        .withColumns(
            {
                "_place": F.row_number().over(Window.orderBy("_limit", "source")),
                "_left": F.sum("source_size").over(whole)
                - F.coalesce(F.sum(F.col("source_size") * cap).over(before), F.lit(0)),
                "_open": F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0)),
            }
        )
        .withColumn("_level", F.col("_left").cast("double") / F.col("_open"))
    )
    first = F.min(F.when(F.col("_level") <= F.col("_limit"), F.struct("_place", "_level"))).over(whole)
    return ranked.withColumn("_first", first).select(
        "source",
        "source_size",
        F.when(F.col("_place") < F.col("_first._place"), (F.col("source_size") * cap).cast("double"))
        .otherwise(F.col("_first._level") * F.col("_weight"))
        .alias("target"),
    )


def mix(
    df: DataFrame,
    scratch: Scratch,
    size: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    cap: int = 3,
    seed: str = "mix",
    bin_rows: int = BIN_ROWS,
) -> DataFrame:
    """All rows of ``df`` with size, source_size, target and copies (0 to ``cap``).

    ``size`` is a whole number per row, by default the words of the text.
    ``df`` is read twice (sizes per bin, then rows).  Null sources form one
    source of their own, null ids one hash value; equal rows are
    interchangeable, so their copies are shared out among them.  Size 0 gets
    copies like any other row.  No rows in, no rows out.  The four new columns
    take the place of input columns of the same names.
    """
    size = word_count(F.col(text_col)) if size is None else size.cast("long")
    placed = packed(
        df,
        id=F.col(id_col),
        source=key_text(F.col(source_col)),
        size=size,
        hash=hash32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))),
    ).withColumn("class", F.floor(F.sqrt(F.col("size").cast("double"))).cast("long"))
    per_class = placed.groupBy("source", "class").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    per_class = scratch.table(per_class, "classes")
    goals = targets(per_class.groupBy("source").agg(F.sum("words").alias("source_size")), cap)
    # Ranges of the hash per class, as many as its rows need.
    bins = per_class.select("source", "class", F.ceil(F.col("n") / bin_rows).alias("bins"))
    binned = placed.join(bins, ["source", "class"]).withColumn(
        "bin", F.floor(F.col("hash") * F.col("bins") / F.lit(4294967296)).cast("long")
    )
    order = Window.partitionBy("source").orderBy("class", "bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        binned.groupBy("source", "class", "bin")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("start", F.coalesce(F.sum("n").over(order), F.lit(0)))
        .join(goals, "source")
        .drop("n")
    )
    starts = scratch.table(starts, "starts")
    inside = Window.partitionBy("source", "class", "bin").orderBy("hash", "id", "size")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.col("source"))), 1, 4), 16, 10).cast("double") / 65536
    reach = lambda rank: F.floor(rank * F.col("rate") + F.col("offset"))
    copies = F.least(reach(F.col("rank")) - reach(F.col("rank") - 1), F.lit(cap).cast("long"))
    return (
        binned.withColumn("rank", F.row_number().over(inside))
        .join(starts, ["source", "class", "bin"])
        .withColumns({"rank": F.col("rank") + F.col("start"), "rate": rate, "offset": offset})
        .select(
            *unpacked(
                df.columns, size=F.col("size"), source_size=F.col("source_size"), target=F.col("target"), copies=copies
            )
        )
    )


def emit(df: DataFrame, scratch: Scratch, **options) -> DataFrame:
    """The rows of ``df``, each as often as ``mix`` takes it."""
    rows = packed(df, id=F.col(options.pop("id_col", "doc_id")), source=F.col(options.pop("source_col", "source")),
                  text=F.col(options.pop("text_col", "text")))
    mixed = mix(rows, scratch, id_col="id", **options).where("copies > 0")
    each = mixed.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    return each.select(*unpacked(df.columns))


SQL = r"""
WITH sized AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS sk,
    CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    CAST(('0x' || substr(md5(COALESCE(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) AS h
  FROM documents),
totals AS (SELECT sk, CAST(SUM(size) AS BIGINT) AS source_size FROM sized GROUP BY sk),
weighted AS (
  SELECT sk, source_size, (row_number() OVER (ORDER BY sk) - 1) % 3 + 1 AS w FROM totals),
limited AS (SELECT *, CAST(source_size * 3 AS DOUBLE) / w AS lim FROM weighted),
levels AS (
  SELECT sk, source_size, w, lim, row_number() OVER (ORDER BY lim, sk) AS place,
    CAST(SUM(source_size) OVER () - COALESCE(SUM(source_size * 3) OVER (ORDER BY lim, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
      / (SUM(w) OVER () - COALESCE(SUM(w) OVER (ORDER BY lim, sk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev
  FROM limited),
first AS (SELECT place AS p, lev AS l FROM levels WHERE lev <= lim ORDER BY place LIMIT 1),
goals AS (
  SELECT sk, source_size, CASE WHEN place < p THEN CAST(source_size * 3 AS DOUBLE) ELSE l * w END AS target
  FROM levels, first),
ranked AS (
  SELECT s.doc_id, s.size, s.sk, g.source_size, g.target,
    row_number() OVER (PARTITION BY s.sk ORDER BY floor(sqrt(CAST(s.size AS DOUBLE))), s.h, s.doc_id NULLS FIRST, s.size) AS k,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 0.0 END AS r,
    CAST(('0x' || substr(md5('mix|' || s.sk), 1, 4)) AS BIGINT) / 65536.0 AS u
  FROM sized s JOIN goals g USING (sk))
SELECT doc_id, size, source_size, target, copies, CAST(copies * size AS BIGINT) AS taken
FROM (SELECT *, CAST(LEAST(floor(k * r + CAST(u AS DOUBLE)) - floor((k - 1) * r + CAST(u AS DOUBLE)), 3) AS BIGINT) AS copies FROM ranked)
"""


@query("op7_mixing_systematic", SQL)
def op7_mixing_systematic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix by source weight takes from each document."""
    scratch = Scratch(spark, "mix")
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", word_count(F.col("text")).alias("words"))
    mixed = mix(scratch.table(docs, "sized"), scratch, F.col("words"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken")
    )
