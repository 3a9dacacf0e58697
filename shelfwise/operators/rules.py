"""Frequent item sets and association rules, level by level on vertical bitmaps.

Equal baskets fold to one with a count.  Each distinct basket has a place: a
block of up to 32,768 and a bit in it; its count is spread over bit planes, so
that a basket counted 5 times is a bit in plane 0 and one in plane 2.  An item
set is a row per plane and block with a bitmap of the baskets that hold it, and
its support is the sum of bits times 2 to the plane.

Sets of k + 1 items come from two frequent sets that differ in their last item
and have no infrequent subset; their bitmaps are the two bitmaps ANDed.  Pairs
would be too many that way where items are many: those of small baskets are
counted, and a pair stays a candidate if its count there plus what large
baskets can add is enough.  All of it is equi-joins and aggregates.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up, pct, ratio
from shelfwise.sources.workspace import Workspace

# Lever column -> item name.
ITEMS = {"feature": "feature_ad", "display": "in_store_display", "tpr_only": "temp_price_reduction"}
#: Bits of a bitmap, and the baskets a block is planned for.
BITS, PLANNED = 32_768, 30_000
#: Items of a basket whose pairs are counted one by one.
SMALL = 64
_AT = ["plane", "bucket", "part"]


def baskets_of(df: DataFrame, basket: list[str], item: str) -> DataFrame:
    """(items): sorted distinct items of every basket of a long table; rows without an item add none."""
    return df.groupBy(*basket).agg(F.array_sort(F.collect_set(item)).alias("items")).select("items")


def lever_baskets(df: DataFrame, levers: Mapping[str, str] = ITEMS) -> DataFrame:
    """(items): the levers of every promoted row."""
    on = F.array_compact(F.array(*[F.when(F.col(c) == 1, F.lit(name)) for c, name in levers.items()]))
    return df.select(F.array_sort(on).alias("items")).where(F.size("items") > 0)


def activation(df: DataFrame) -> DataFrame:
    """Share of promoted rows with each lever."""
    any_on = " + ".join(ITEMS) + " > 0"
    one = df.filter(any_on).agg(
        F.count(F.lit(1)).alias("baskets"), *[F.sum(c).alias(name) for c, name in ITEMS.items()]
    )
    rows = [
        F.struct(F.lit(n).alias("item"), half_up(pct(n, "baskets"), 2).alias("activation_rate_pct"), F.col("baskets"))
        for n in ITEMS.values()
    ]
    return one.select(F.inline(F.array(*rows)))


def _placed(folded: DataFrame, distinct: int) -> DataFrame:
    """(items, n, bucket, part, bit): each distinct basket's own bit."""
    buckets = distinct // PLANNED + 1
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("items")) - 1
    return (
        folded.withColumn("bucket", F.pmod(F.xxhash64("items"), F.lit(buckets)))
        .withColumn("_place", place)
        .select("items", "n", "bucket", F.floor(F.col("_place") / BITS).alias("part"), (F.col("_place") % BITS).alias("bit"))
    )


def _pairs(kept: DataFrame, least: float) -> DataFrame:
    """(items, a, b): pairs of items that may be in ``least`` baskets of ``kept`` (items, n).

    A pair in no small basket needs all its baskets among the large ones, so
    both its items have to be in as many of those.
    """
    every = "flatten(transform(items, (x, i) -> transform(slice(items, i + 2, size(items)), y -> array(x, y))))"
    small = kept.where(F.size("items") <= SMALL).select(F.explode(F.expr(every)).alias("items"), "n")
    small = small.groupBy("items").agg(F.sum("n").alias("n"))
    large = kept.where(F.size("items") > SMALL).select(F.explode("items").alias("item"), "n")
    large = large.groupBy("item").agg(F.sum("n").alias("more"))
    of = lambda name: large.select(F.col("item").alias(name), F.col("more").alias(f"{name}_more"))
    ends = small.select(F.col("items")[0].alias("x"), F.col("items")[1].alias("y"), "n")
    more = F.least(F.coalesce("x_more", F.lit(0)), F.coalesce("y_more", F.lit(0)))
    seen = ends.join(of("x"), "x", "left").join(of("y"), "y", "left").where(F.col("n") + more >= least).select("x", "y")
    # Spread over parts: all of them share the empty head.
    heavy = large.where(F.col("more") >= least)
    left = heavy.select(F.col("item").alias("x"), F.pmod(F.hash("item"), F.lit(64)).alias("part"))
    right = heavy.select(F.col("item").alias("y"), F.explode(F.sequence(F.lit(0), F.lit(63))).alias("part"))
    pairs = seen.union(left.join(right, "part").where("x < y").select("x", "y")).distinct()
    return pairs.select(F.array("x", "y").alias("items"), F.array("x").alias("a"), F.array("y").alias("b"))


def _candidates(found: DataFrame, size: int) -> DataFrame:
    """(items, a, b): sets of ``size`` + 1 items (3 or more) from frequent ones a and b, all subsets frequent."""
    head = F.slice("items", 1, size - 1)
    a = found.select(head.alias("head"), F.col("items").alias("a"))
    b = found.select(head.alias("head"), F.col("items").alias("b"))
    last = lambda c: F.element_at(c, -1)
    joined = a.join(b, "head").where(last("a") < last("b"))
    joined = joined.select(F.concat("a", F.slice("b", -1, 1)).alias("items"), "a", "b")
    without = F.transform(F.sequence(F.lit(1), F.lit(size - 1)), lambda i: F.filter("items", lambda _, at: at != i - 1))
    subsets = joined.select("items", F.explode(without).alias("subset"))
    kept = subsets.join(found.select(F.col("items").alias("subset")), "subset").groupBy("items").agg(F.count(F.lit(1)).alias("n"))
    return joined.join(kept.where(F.col("n") == size - 1).select("items"), "items", "left_semi")


def frequent_sets(baskets: DataFrame, min_support: float = 0.01, max_size: int | None = None) -> DataFrame:
    """(items, n, total): every item set in at least ``min_support`` of the baskets, with its count and theirs.

    ``baskets`` has a column ``items``, sorted arrays of distinct items; empty
    baskets count in the total.  ``max_size`` None goes on while sets are found.
    Only two numbers per level reach the driver.
    """
    work = Workspace(baskets.sparkSession, "itemsets")
    folded = work.table(baskets.groupBy("items").agg(F.count(F.lit(1)).alias("n")), "baskets")
    size = folded.agg(F.count(F.lit(1)).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()
    enough = F.col("n") >= min_support * F.lit(size["total"])
    singles = folded.select(F.explode("items").alias("item"), "n").groupBy("item").agg(F.sum("n").alias("n")).where(enough)
    singles = work.table(singles.select(F.array("item").alias("items"), "n"), "sets1")
    found = [singles]
    items = singles.select(F.col("items")[0].alias("item"))
    kept = folded.select("items", "n", F.explode("items").alias("item")).join(items, "item").groupBy("items", "n")
    kept = work.table(kept.agg(F.array_sort(F.collect_list("item")).alias("kept")).select(F.col("kept").alias("items"), "n"), "kept")
    planes = F.filter(F.sequence(F.lit(0), F.lit(62)), lambda p: F.col("n").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), p)) != 0)
    bits = (
        _placed(kept, size["distinct"])
        .select("bucket", "part", "bit", "items", F.explode(planes).alias("plane"))
        .select("plane", "bucket", "part", "bit", F.explode("items").alias("item"))
        .groupBy(F.array("item").alias("items"), *_AT)
        .agg(F.bitmap_construct_agg("bit").alias("bits"))
    )
    level, k = work.table(bits, "bits1"), 1
    while max_size is None or k < max_size:
        pairs = _candidates(found[-1], k) if k > 1 else _pairs(kept, min_support * size["total"])
        pairs = work.table(pairs, f"candidates{k}")
        both = pairs.select("items", F.explode(F.array("a", "b")).alias("of"))
        both = both.join(level.withColumnRenamed("items", "of"), "of").groupBy("items", *_AT)
        both = both.agg(F.count(F.lit(1)).alias("sides"), F.bitmap_and_agg("bits").alias("bits"))
        both = work.table(both.where((F.col("sides") == 2) & (F.bitmap_count("bits") > 0)).drop("sides"), f"all{k + 1}")
        weight = F.bitmap_count("bits") * F.pow(F.lit(2.0), "plane").cast("long")
        sets = both.groupBy("items").agg(F.sum(weight).alias("n")).where(enough)
        sets = work.table(sets, f"sets{k + 1}")
        if sets.isEmpty():
            break
        found.append(sets)
        level = work.table(both.join(sets.select("items"), "items", "left_semi"), f"bits{k + 1}")
        work.drop(f"bits{k}", f"candidates{k}", f"all{k + 1}")
        k += 1
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = work.table(out.withColumn("total", F.lit(size["total"]).cast("long")), "result")
    work.drop("baskets", "kept", f"bits{k}", f"candidates{k}", f"all{k + 1}", *[f"sets{i}" for i in range(1, k + 2)])
    return out


def _names(items: str | Column) -> Column:
    return F.array_join(items, ", ")


def itemsets(sets: DataFrame) -> DataFrame:
    """Report of :func:`frequent_sets`: names, size and support."""
    support = half_up(ratio("n", "total"), 6)
    return sets.select(_names("items").alias("itemset"), F.size("items").alias("items"), support.alias("support"))


def rules(sets: DataFrame, min_lift: float = 1.0) -> DataFrame:
    """Rules between disjoint parts of every frequent set, consequents of any size.

    Parts of a frequent set are frequent, so their counts come from the same
    table by two joins.
    """
    many = sets.where(F.size("items") > 1)
    part = lambda keep: F.filter("items", lambda _, at: F.call_function("getbit", F.col("mask"), at) == keep)
    masks = F.sequence(F.lit(1).cast("long"), F.call_function("shiftleft", F.lit(1).cast("long"), F.size("items")) - 2)
    split = many.select("items", "n", "total", F.explode(masks).alias("mask"))
    split = split.select("n", "total", part(1).alias("a"), part(0).alias("c"))
    side = lambda of, count: sets.select(F.col("items").alias(of), F.col("n").alias(count))
    joined = split.join(side("a", "n_a"), "a").join(side("c", "n_c"), "c")
    both, left, right = (ratio(n, "total") for n in ("n", "n_a", "n_c"))
    out = joined.select(
        _names("a").alias("antecedents"),
        _names("c").alias("consequents"),
        half_up(both, 6).alias("support"),
        half_up(ratio(both, left), 6).alias("confidence"),
        half_up(ratio(both, left * right), 6).alias("lift"),
    )
    return out.where(F.col("lift") >= min_lift)
