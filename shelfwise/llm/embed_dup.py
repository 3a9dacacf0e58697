"""Near-duplicate embeddings: int8 tile products with error bounds, full precision only where needed.

A vector u of length 1 is kept as s * q, q whole numbers from -127 to 127, plus
an error e.  For two vectors, the product of the q differs from the cosine by
no more than |s q| * |e'| + |e| (the other vector has length 1), so a pair whose
scaled product plus this bound stays below the threshold is surely apart.  All
other pairs are computed again in double precision.

Equal vectors of a label are one node.  Nodes of a label are dealt to chunks of
a bounded size; each pair of chunks is one task, which returns one row per
node: how many vectors it links to and one node it hangs on, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Scratch, read
from shelfwise.llm.components import components
from shelfwise.llm.registry import query

COSINE = 0.98
#: Nodes of a chunk, about.
CHUNK = 1024
#: Above all rounding of double precision in sums of this kind.
SLACK = 1e-9

_PACKED = T.BinaryType()


@F.pandas_udf(_PACKED)
def _pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """A vector's doubles; null if it is null, empty, zero or not finite throughout."""
    for batch in batches:
        out = []
        for vector in batch:
            x = None if vector is None else np.asarray(vector, dtype=object)
            if x is None or not len(x) or any(v is None for v in x):
                out.append(None)
                continue
            x = x.astype(np.float64) + 0.0  # no negative zeros
            out.append(x.tobytes() if np.isfinite(x).all() and x.any() else None)
        yield pd.Series(out, dtype=object)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length 1; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def quantised(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q as int8, scale s, |s q|, |e|) of each row."""
    scale = np.abs(u).max(1) / 127.0
    q = np.rint(u / scale[:, None]).astype(np.int8)
    kept = q * scale[:, None]
    return q, scale, np.sqrt((kept * kept).sum(1)), np.sqrt(((u - kept) ** 2).sum(1))


def near_pairs(u: np.ndarray, left: np.ndarray, right: np.ndarray, cosine: float = COSINE) -> np.ndarray:
    """Whether each pair left x right (rows of ``u``) reaches the cosine; exact in double precision."""
    q, scale, kept, error = quantised(u)
    # Products of int8 are whole numbers; the float type holds their sums exactly.
    exact = np.float32 if u.shape[1] * 127 * 127 < 1 << 24 else np.float64
    product = (q[left].astype(exact) @ q[right].astype(exact).T).astype(np.float64)
    upper = product * scale[left][:, None] * scale[right][None, :]
    upper += kept[left][:, None] * error[right][None, :] + error[left][:, None] + SLACK
    near = upper >= cosine
    a, b = np.nonzero(near)
    for at in range(0, len(a), 65536):
        i, j = a[at : at + 65536], b[at : at + 65536]
        near[i, j] = np.einsum("ij,ij->i", u[left[i]], u[right[j]]) >= cosine
    return near


def tile_links(tile: pd.DataFrame, cosine: float) -> pd.DataFrame:
    """(node, links, root) for the nodes of a tile with links: vectors linked to, and the tile's smallest node reached."""
    tile = tile.sort_values("node").reset_index(drop=True)
    left = np.flatnonzero(tile["side"].to_numpy() != 1)
    right = np.flatnonzero(tile["side"].to_numpy() != 0)
    u = unit(np.frombuffer(b"".join(tile["packed"]), np.float64).reshape(len(tile), -1))
    near = near_pairs(u, left, right, cosine)
    near[left[:, None] == right[None, :]] = False
    copies = tile["copies"].to_numpy()
    links = np.zeros(len(tile), np.int64)
    links[left] += near @ copies[right]
    if not (len(left) == len(right) and (left == right).all()):
        links[right] += copies[left] @ near
    label = np.arange(len(tile))
    while True:
        new = label.copy()
        if len(left) and len(right):
            np.minimum.at(new, left, np.where(near, label[right][None, :], len(tile)).min(1))
            np.minimum.at(new, right, np.where(near, new[left][:, None], len(tile)).min(0))
        new = new[new]
        if (new == label).all():
            break
        label = new
    has = np.flatnonzero(links > 0)
    node = tile["node"].to_numpy()
    return pd.DataFrame({"node": node[has], "links": links[has], "root": node[label[has]]})


def link_vectors(
    df: DataFrame,
    scratch: Scratch,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    chunk: int = CHUNK,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``df``.

    Only vectors with equal labels and lengths are compared.  A null label or a
    vector that is null, empty, zero or not finite in every place links with
    nothing and is a component of its own.  The component's id is its smallest
    id; ids of null are never smallest, rows that repeat an id repeat its result.
    """
    rows = scratch.table(
        df.select(
            F.col(id_col).alias("id"),
            F.col(label_col).alias("label"),
            F.monotonically_increasing_id().alias("row"),
            F.when(F.col(label_col).isNotNull(), _pack(vector_col)).alias("packed"),
        ).withColumn("key", F.unhex(F.md5("packed"))),
        "vectors",
    )
    nodes = scratch.table(
        rows.where("packed IS NOT NULL").groupBy("label", "key").agg(
            F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"),
            F.first("packed").alias("packed"),
        ),
        "nodes",
    )
    kind = F.struct("label", F.length("packed").alias("length"))
    sizes = nodes.groupBy(kind.alias("kind")).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("chunks"))
    dealt = (
        nodes.withColumn("kind", kind)
        .join(sizes, "kind")
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "kind",
            F.least("own", "other").alias("i"),
            F.greatest("own", "other").alias("j"),
            F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
            "node",
            "copies",
            "packed",
        )
    )
    found = scratch.table(
        dealt.groupBy("kind", "i", "j").applyInPandas(
            lambda tile: tile_links(tile, cosine), "node long, links long, root long"
        ),
        "found",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), scratch, "component")
    member = (
        nodes.select("label", "key", "node", "copies", "id")
        .join(links, "node", "left")
        .join(joined, "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    heads = member.groupBy("component").agg(F.min("id").alias("component_id"))
    member = member.join(heads, "component").select(
        "label", "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"
    )
    out = rows.select("id", "label", "key").join(member, ["label", "key"], "left")
    component = F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


SQL = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
ok AS (
  SELECT r, vec_id, label, e, sqrt(list_dot_product(e, e)) AS n FROM v
  WHERE label IS NOT NULL AND e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND list_dot_product(e, e) > 0),
links AS (
  SELECT a.r, b.r AS other FROM ok a JOIN ok b
    ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.98),
reach AS (SELECT r, r AS other FROM v UNION SELECT reach.r, l.other FROM reach JOIN links l ON l.r = reach.other),
smallest AS (SELECT reach.r, min(w.vec_id) AS component_id FROM reach JOIN v w ON w.r = reach.other GROUP BY reach.r),
counted AS (SELECT r, count(*) AS n FROM links GROUP BY r)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, s.component_id, v.vec_id IS NOT DISTINCT FROM s.component_id AS kept
FROM v JOIN smallest s USING (r) LEFT JOIN counted c USING (r)
"""


@query("op10_embedding_near_dup", SQL)
def op10_embedding_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings."""
    found = link_vectors(read(spark, sf_dir, "embeddings"), Scratch(spark, "vectors"))
    return found.withColumnRenamed("id", "vec_id")
