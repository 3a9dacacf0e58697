"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

1. Each text gets a signature; equal texts become one node.
2. Bands of the signature are hashed; in each bucket every node is paired with
   the bucket's smallest node, its hub.  Pairs whose signatures agree enough
   join to groups.  Nodes that are almost equal to their hub are done: whatever
   is similar to them agrees with the hub as well.  Where the others of a bucket
   are of more than one group, all of them are compared by signature, in tiles
   of a bounded number of nodes, and those that agree join their groups.
3. All pairs inside a group are compared exactly, as products of 0/1 matrices
   in numpy.  Groups are cut into tiles of a bounded number of texts, so a
   group of any size is many small tasks; a task returns at most one link per
   text.
4. Links join to classes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.bag_minhash import signatures
from shelfwise.llm.common import Scratch, packed, read, unpacked
from shelfwise.llm.components import components
from shelfwise.llm.registry import query
from shelfwise.llm.shingles import bags, mix64

SIMILARITY = 0.8
#: A pair at similarity 0.8 is missed by all bands with probability (1 - 0.8 ** 5) ** 26, 3 in 100,000.
BANDS, BAND_ROWS = 26, 5
#: Agreement of signatures that puts a pair into one group; far below the similarity asked for.
AGREEMENT = 0.45
#: Agreement with the hub from which a node needs no other partner in the bucket.  Differences of signatures add up at
#: most: what agrees with the node in 0.55 or more agrees with the hub in 0.45 or more; a pair at similarity 0.8 agrees
#: in less than 0.55 with probability 1 in 10 ** 10.
SETTLED = 0.9
#: Nodes on a side of a tile of signatures, at most.
SIGN_TILE = 1024
#: Texts on a side of a tile, at most.
TILE = 256
#: Characters that are hashed at once; some 60 bytes of memory each.
STEP_CHARS = 1 << 18
#: Share of a chunk's size that hashing fills on average.
FILL = 0.6
#: Columns of one matrix product.
COLUMNS = 8192


_SIGNED = T.StructType(
    [
        T.StructField("sign", T.BinaryType()),
        T.StructField("weight", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def steps(texts: list[str], chars: int = STEP_CHARS) -> Iterator[list[str]]:
    """The texts in runs of at most about ``chars`` characters, or of one text: bounds the memory of a step."""
    run, held = [], 0
    for text in texts:
        if run and held + len(text) > chars:
            yield run
            run, held = [], 0
        run.append(text)
        held += len(text)
    if run:
        yield run


@F.pandas_udf(_SIGNED)
def _sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    size = BANDS * BAND_ROWS
    for batch in batches:
        signs, weights, bands = [], [], []
        for texts in steps(batch.tolist()):
            sign, weight = signatures(texts, size)
            key = np.zeros((len(sign), BANDS), np.uint64)
            for row in range(BAND_ROWS):
                key = mix64(key + sign.reshape(len(sign), BANDS, BAND_ROWS)[:, :, row] + np.uint64(row + 1))
            key = mix64(key + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
            signs += [row.tobytes() for row in sign]
            weights.append(weight)
            bands += [list(k) if w else [] for k, w in zip(key, weight, strict=True)]
        yield pd.DataFrame({"sign": signs, "weight": np.concatenate(weights) if weights else [], "bands": bands})


@F.pandas_udf(T.DoubleType())
def _agreement(left: pd.Series, right: pd.Series) -> pd.Series:
    if not len(left):
        return pd.Series([], dtype=float)
    a, b = (np.frombuffer(b"".join(s), np.uint32).reshape(len(s), -1) for s in (left, right))
    return pd.Series((a == b).mean(1))


def overlap(texts: list[str], left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Multiset overlaps of all pairs left x right (numbers of texts), and the weights of either.

    The k-th copy of a shingle is an element of its own, so that overlaps of
    multisets are products of 0/1 rows; elements of one text only are left out.
    """
    owner, value, count = bags(texts)
    weight = np.bincount(owner, count, len(texts))
    nth = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    owner, value = np.repeat(owner, count), np.repeat(value, count)
    value = mix64(value + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, column, uses = np.unique(value, return_inverse=True, return_counts=True)
    shared = uses > 1
    keep = shared[column]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(left), len(right)), np.float64)
    for first in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, [first, first + COLUMNS])
        rows = np.zeros((len(texts), COLUMNS), np.float32)
        rows[owner[lo:hi], column[lo:hi] - first] = 1.0
        out += rows[left] @ rows[right].T
    return out, weight[left], weight[right]


def _links(near: np.ndarray, left: np.ndarray, right: np.ndarray, node: np.ndarray) -> pd.DataFrame:
    """Links (a, b) that connect the rows left x right where ``near``: at most one per row."""
    label = np.arange(len(node))
    while True:
        low = np.where(near, label[right][None, :], len(node)).min(1) if len(right) else label[left]
        new = label.copy()
        np.minimum.at(new, left, low)
        low = np.where(near, new[left][:, None], len(node)).min(0) if len(left) else new[right]
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    off = np.flatnonzero(label != np.arange(len(node)))
    return pd.DataFrame({"a": node[off], "b": node[label[off]]}, columns=["a", "b"]).astype("int64")


def _agree(sign: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Whether the signatures left x right agree enough; a component at a time, in a byte per pair."""
    out = np.zeros((len(left), len(right)), bool)
    for at in range(0, len(left), 256):
        rows = sign[left[at : at + 256]]
        same = np.zeros((len(rows), len(right)), np.uint8 if sign.shape[1] < 256 else np.uint16)
        for mine, other in zip(rows.T, sign[right].T, strict=True):
            same += mine[:, None] == other[None, :]
        out[at : at + 256] = same >= AGREEMENT * sign.shape[1]
    return out


def sign_links(tile: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that connect the nodes of a bucket whose signatures agree enough and whose groups differ.

    Buckets that share a tile are not compared with each other.
    """
    tile = tile.sort_values(["group", "node"]).reset_index(drop=True)
    bucket, linked = tile["group"].to_numpy(), tile["linked"].to_numpy()
    side, node = tile["side"].to_numpy(), tile["node"].to_numpy()
    sign = np.frombuffer(b"".join(tile["sign"]), np.uint32).reshape(len(tile), -1)
    begins = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(tile) else []
    found = []
    for lo, hi in zip(begins, [*begins[1:], len(tile)], strict=True):
        left = lo + np.flatnonzero(side[lo:hi] != 1)
        right = lo + np.flatnonzero(side[lo:hi] != 0)
        near = _agree(sign, left, right) & (linked[left][:, None] != linked[right][None, :])
        if near.any():
            found.append(_links(near, left - lo, right - lo, node[lo:hi]))
    return pd.concat(found) if found else pd.DataFrame({"a": [], "b": []}).astype("int64")


def tile_links(tile: pd.DataFrame, similarity: float = SIMILARITY) -> pd.DataFrame:
    """Links (a, b) that connect what is similar in one tile: at most one per text."""
    tile = tile.sort_values("node").reset_index(drop=True)
    left = np.flatnonzero(tile["side"] != 1)
    right = np.flatnonzero(tile["side"] != 0)
    group, node = tile["group"].to_numpy(), tile["node"].to_numpy()
    inter, wl, wr = overlap(tile["text"].tolist(), left, right)
    union = wl[:, None] + wr[None, :] - inter
    # Overlaps are whole numbers: half a unit in the last place cannot turn the comparison.
    near = (inter >= similarity * union - 1e-9) & (inter > 0) & (group[left][:, None] == group[right][None, :])
    return _links(near, left, right, node)


def tiles(members: DataFrame, size: int = TILE) -> DataFrame:
    """(group, node) dealt to tiles: (tile, side, group, node), at most ``size`` nodes on a side.

    Groups of up to half that size share packs: they are dealt to bins by hash,
    and sums of their sizes along a bin cut it into stretches of half the size;
    a pack holds the groups that begin in its stretch, so never more than
    ``size`` nodes.  A group of up to ``size`` nodes is a tile of its own.  A
    larger one is split into chunks by hash, filled to ``FILL`` of the size on
    average (more than ``size`` is some eight standard deviations away); each
    pair of chunks is a tile (sides 0 and 1), each chunk by itself another
    (side 2).
    """
    half = size // 2
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("_n"))
    bins = F.ceil(F.coalesce(F.sum(F.when(F.col("_n") <= half, F.col("_n"))), F.lit(0)) / (64 * size) + 1)
    n_bins = sizes.agg(bins.alias("_b")).first()["_b"]
    before = Window.partitionBy("_bin").orderBy("group").rowsBetween(Window.unboundedPreceding, -1)
    packs = (
        sizes.where(F.col("_n") <= half)
        .withColumn("_bin", F.pmod(F.xxhash64("group"), F.lit(n_bins)).cast("long"))
        .withColumn("_pack", F.floor(F.coalesce(F.sum("_n").over(before), F.lit(0)) / half))
    )
    none = F.lit(-1).cast("long")
    small = members.join(packs, "group").select(
        F.struct(F.col("_bin").alias("of"), F.col("_pack").alias("i"), none.alias("j")).alias("tile"),
        F.lit(2).alias("side"),
        "group",
        "node",
    )
    chunks = F.when(F.col("_n") <= size, 1).otherwise(F.ceil(F.col("_n") / (FILL * size))).cast("long")
    large = members.join(sizes.where(F.col("_n") > half), "group").withColumn("_chunks", chunks)
    large = large.withColumn("_own", F.pmod(F.xxhash64("node"), F.col("_chunks")))
    large = large.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_chunks") - 1))).select(
        F.struct(
            F.col("group").alias("of"), F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j")
        ).alias("tile"),
        F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1).alias("side"),
        "group",
        "node",
    )
    return small.union(large)


def strangers(paired: DataFrame, scored: DataFrame, linked: DataFrame, signs: DataFrame, scratch: Scratch) -> DataFrame:
    """Links (a, b) between the members of each bucket that their hub does not settle.

    Members of one group (``linked``) need no link, so a bucket whose members
    are all of one group is done.
    """
    rest = paired.join(scored.where(F.col("agreement") < SETTLED), ["node", "hub"]).select("band", "node")
    rest = rest.join(linked, "node", "left").select("band", "node", F.coalesce("component", "node").alias("linked"))
    rest = scratch.table(rest, "rest")
    mixed = rest.groupBy("band").agg(F.min("linked").alias("_a"), F.max("linked").alias("_b")).where("_a != _b")
    members = scratch.table(rest.join(mixed.select("band"), "band", "left_semi"), "strangers")
    dealt = tiles(members.select(F.col("band").alias("group"), "node"), SIGN_TILE)
    dealt = dealt.join(members.select("node", "linked").distinct(), "node").join(signs, "node")
    return dealt.groupBy("tile").applyInPandas(lambda tile: sign_links(tile), "a long, b long")


def classes(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with class_id, the smallest id of the row's class, and kept, true for one row per class.

    Rows with equal texts, or with a chain of similarities of 0.8 and more
    between them, are one class.  Texts without words, and nulls, are similar
    to nothing: each row is a class of its own with its own id.  The kept row
    has the smallest id (null last); of equal rows, one is kept.  The two new
    columns take the place of input columns of the same names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    signed = packed(df, row=F.monotonically_increasing_id(), key=F.unhex(F.md5(text)), signed=_sign(text))
    rows = scratch.table(signed, "rows")  # numbers each row once and for all
    row_id, row_text = F.col("in").getField(id_col), F.col("in").getField(text_col)
    worded = rows.where("signed.weight > 0")
    best = F.struct(row_id.isNull().alias("no_id"), row_id.alias("id"), F.col("row").alias("first"))
    nodes = scratch.table(
        worded.groupBy("key").agg(
            F.min("row").alias("node"), F.min(best).alias("best"), F.first("signed.sign").alias("sign"),
            F.first("signed.bands").alias("bands"),
        ),
        "nodes",
    )
    exploded = nodes.select("node", F.explode("bands").alias("band"))
    hubs = exploded.groupBy("band").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    paired = exploded.join(hubs.select("band", "hub"), "band").where("node != hub").select("band", "node", "hub")
    paired = scratch.table(paired, "paired")
    signs = nodes.select("node", "sign")
    scored = (
        paired.select("node", "hub").distinct()
        .join(signs, "node")
        .join(signs.toDF("hub", "hub_sign"), "hub")
        .select("node", "hub", _agreement("sign", "hub_sign").alias("agreement"))
    )
    scored = scratch.table(scored, "scored")
    agreed = scored.where(F.col("agreement") >= AGREEMENT).select(F.col("node").alias("a"), F.col("hub").alias("b"))
    linked = scratch.table(components(agreed, scratch, "linked"), "linked")
    more = scratch.table(strangers(paired, scored, linked, signs, scratch), "more")
    among = linked if more.isEmpty() else components(agreed.union(more), scratch, "group")
    groups = among.select(F.col("component").alias("group"), "node")
    groups = scratch.table(groups, "groups")
    texts = worded.join(groups.select(F.col("node").alias("row")), "row", "left_semi").select(
        F.col("row").alias("node"), row_text.cast("string").alias("text")
    )
    dealt = tiles(groups).join(texts, "node")
    links = dealt.groupBy("tile").applyInPandas(lambda tile: tile_links(tile), "a long, b long")
    joined = components(links, scratch, "class")
    member = nodes.join(joined, "node", "left").select("key", "best", F.coalesce("component", "node").alias("class"))
    heads = member.groupBy("class").agg(F.min("best").alias("head"))
    member = member.join(heads, "class").select(F.col("key").alias("own"), "head")
    out = rows.join(member, (F.col("key") == F.col("own")) & (F.col("signed.weight") > 0), "left")
    alone = F.col("head").isNull()
    return out.select(
        *unpacked(
            df.columns,
            class_id=F.when(alone, row_id).otherwise(F.col("head.id")),
            kept=alone | (F.col("head.first") == F.col("row")),
        )
    )


def distinct_texts(df: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``df`` with one row of each class."""
    rows = packed(df, id=F.col(id_col), text=F.col(text_col))
    return classes(rows, scratch, "id").where("kept").select(*unpacked(df.columns))


@query("op5_near_dup_bag_minhash")
def op5_near_dup_bag_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate class of every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return classes(docs, Scratch(spark, "near")).select("doc_id", "class_id", "kept")
