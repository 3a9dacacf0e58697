"""Centroid clustering with a vantage-point tree over the centroids.

Vectors are made whole numbers, so distances, ties and means are exact.  Each
round builds a vantage-point tree over the centroids on the driver and ships it
to the tasks; there every vector searches it best first, by its own bounds.
Tasks return one sum per centroid, never vectors.

A node of the tree holds one centroid, its vantage point, and splits the rest
of its set at the median distance from it; it keeps the least and the largest
distance of either half.  By the triangle inequality a half whose distances lie
in [lo, hi] holds nothing nearer to a vector at distance d than lo - d and
d - hi.  A half is skipped only where that bound is above the best distance
found; where they are equal it is still searched, so that of equally near
centroids the one with the smallest number is found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.llm.common import Scratch, read
from shelfwise.llm.registry import query

DIMS, SCALE = 64, 64
CENTROIDS, ROUNDS = 16, 3
#: Whole numbers beyond this would let a squared distance of 64 components leave a long.
LARGEST = 1 << 27
#: Above the rounding of square roots and of their sums and differences, as a share of the distances.
SLACK = 1e-9
#: Vectors that search the tree together.
STEP = 4096
#: Whole numbers are packed as unsigned and high byte first, so that the bytes order like the numbers.
_SHIFT = 1 << 31


@dataclass(frozen=True)
class Tree:
    """Vantage-point tree as arrays, a row per node; node 0 is the root.

    ``child`` holds the inner and the outer half's node or -1, ``lo`` and ``hi``
    the range of distances from the vantage point to the centroids of either.
    """

    centroids: np.ndarray
    point: np.ndarray
    child: np.ndarray
    lo: np.ndarray
    hi: np.ndarray

    @staticmethod
    def build(centroids: np.ndarray) -> Tree:
        k = len(centroids)
        point, child = np.zeros(k, np.int64), np.full((k, 2), -1)
        lo, hi = np.zeros((k, 2)), np.zeros((k, 2))
        todo, made = [(np.arange(k), -1, 0)], 0
        while todo:
            members, parent, side = todo.pop()
            node, made = made, made + 1
            if parent >= 0:
                child[parent, side] = node
            point[node] = members[0]
            rest = members[1:]
            away = np.sqrt(squared(centroids[rest], centroids[members[0]]).astype(float))
            order = np.argsort(away, kind="stable")
            half = (len(rest) + 1) // 2
            for side, part in enumerate((order[:half], order[half:])):
                if len(part):
                    lo[node, side], hi[node, side] = away[part].min(), away[part].max()
                    todo.append((np.sort(rest[part]), node, side))
        return Tree(centroids, point, child, lo, hi)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the nearest centroid, squared distance) of each vector; ties go to the smaller number.

        Every vector has a frontier of its own: nodes with a lower bound of the
        distance to anything below them.  Each turn, each vector visits the
        node of its least bound, until that bound is above its best distance.
        """
        n = len(vectors)
        best, number = np.full(n, np.iinfo(np.int64).max), np.full(n, len(self.point))
        bound, node = np.zeros((n, 1)), np.zeros((n, 1), np.int64)
        at = np.arange(n)
        while len(at):
            slot = bound.argmin(1)
            rows = np.arange(len(at))
            least = bound[rows, slot]
            # Inclusive: a node whose bound equals the best distance may hold a tie.
            live = least <= np.sqrt(best[at].astype(float)) * (1 + SLACK)
            live &= np.isfinite(least)
            if not live.all():
                at, bound, node, slot, least = at[live], bound[live], node[live], slot[live], least[live]
                rows = np.arange(len(at))
                if not len(at):
                    break
            visited = node[rows, slot]
            chosen = self.point[visited]
            exact = squared(vectors[at], self.centroids[chosen])
            better = (exact < best[at]) | ((exact == best[at]) & (chosen < number[at]))
            best[at], number[at] = np.where(better, exact, best[at]), np.where(better, chosen, number[at])
            away = np.sqrt(exact.astype(float))
            halves = []
            for side in (0, 1):
                lo, hi = self.lo[visited, side], self.hi[visited, side]
                gap = np.maximum(np.maximum(away - hi, lo - away) - SLACK * (away + hi), 0.0)
                halves.append(np.where(self.child[visited, side] >= 0, np.maximum(gap, least), np.inf))
            # The inner half takes the visited node's place in the frontier, the outer one a new place.
            bound[rows, slot], node[rows, slot] = halves[0], self.child[visited, 0]
            bound, node = np.column_stack([bound, halves[1]]), np.column_stack([node, self.child[visited, 1]])
        return number, best


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of whole numbers."""
    gap = a - b
    return np.einsum("ij,ij->i", gap, gap)


def whole_vectors(column: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows kept, their whole numbers): null vectors, other lengths, null, non-finite and too large components go."""
    column = column.cast(pa.list_(pa.float64()))
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    kept = np.flatnonzero(lengths == dims)
    flat = column.take(pa.array(kept)).flatten()
    x = np.floor(scale * flat.fill_null(float("nan")).to_numpy(zero_copy_only=False).reshape(-1, dims))
    good = (np.abs(x) <= LARGEST).all(1)  # false for what is not finite
    return kept[good], x[good].astype(np.int64)


def _whole(dims: int, scale: int):
    """mapInArrow function: (id, vector) to (id, whole)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, x = whole_vectors(batch.column(1), dims, scale)
            packed = pa.array([row.tobytes() for row in (x + _SHIFT).astype(">u4")], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(kept)), packed], ["id", "whole"])

    return run


def unpack(column: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column), ">u4").reshape(-1, dims).astype(np.int64) - _SHIFT


def _sums(shared, dims: int):
    """mapInArrow function: one row (cluster, n, total) per centroid that a task's vectors chose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        n, total = np.zeros(len(tree.point), np.int64), np.zeros((len(tree.point), dims), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, STEP):
                x = unpack(batch.column(0).slice(first, STEP).to_pylist(), dims)
                number, _ = tree.nearest(x)
                n += np.bincount(number, minlength=len(n))
                np.add.at(total, number, x)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_pydict(
            {"cluster": pa.array(used, pa.int32()), "n": n[used], "total": pa.array(list(total[used]), pa.list_(pa.int64()))}
        )

    return run


def _nearest(shared, dims: int):
    """mapInArrow function: (id, whole) to (id, cluster, distance)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, STEP):
                part = batch.slice(first, STEP)
                number, distance = tree.nearest(unpack(part.column(1).to_pylist(), dims))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(number, pa.int32()), pa.array(distance, pa.int64())], ["id", "cluster", "distance"]
                )

    return run


@dataclass(frozen=True)
class Clusters:
    """``assigned`` has (id, cluster, distance) of every kept vector, ``centroids`` a row of whole numbers each."""

    assigned: DataFrame
    centroids: np.ndarray


def cluster_vectors(
    df: DataFrame,
    scratch: Scratch,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = DIMS,
    scale: int = SCALE,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: str = "1",
) -> Clusters:
    """Lloyd's rounds over the vectors of ``df`` as whole numbers floor(scale * x).

    Kept are vectors of ``dims`` components, none null, non-finite or beyond
    2 ** 27 as a whole number (distances would leave a long); other rows have no
    result.  The first centroids are the ``k`` kept vectors with the smallest
    sha256 of ``seed:id``; rows with a null id never start one, repeated ids
    rank by their components.  With fewer vectors there are fewer centroids;
    without any the result is empty.  A centroid without vectors stays; rows
    that repeat count once each.  Other columns of ``df`` are not read.

    Only ``k`` rows of ``dims`` numbers reach the driver and are broadcast.
    """
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    kind = T.StructType([rows.schema["id"], T.StructField("whole", T.BinaryType())])
    whole = scratch.table(rows.mapInArrow(_whole(dims, scale), kind), "whole")
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = whole.where("id IS NOT NULL").select("whole", rank.alias("rank")).orderBy("rank", "whole").limit(k).collect()
    centroids = unpack([r["whole"] for r in first], dims)
    if not len(centroids):
        empty = whole.where("false").select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return Clusters(empty, centroids)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Tree.build(centroids))
        sums = whole.select("whole").mapInArrow(_sums(shared, dims), "cluster int, n long, total array<long>")
        exact = T.DecimalType(38, 0)  # a task's sums fit a long, those of all tasks may not
        totals = sums.groupBy("cluster").agg(
            F.sum("n").alias("n"), F.array(*[F.sum(F.get("total", F.lit(i)).cast(exact)) for i in range(dims)]).alias("total")
        )
        centroids = centroids.copy()
        for row in totals.collect():
            centroids[row["cluster"]] = [int(t) // row["n"] for t in row["total"]]
        shared.destroy()
    shared = spark.sparkContext.broadcast(Tree.build(centroids))
    kind = T.StructType([rows.schema["id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = scratch.table(whole.mapInArrow(_nearest(shared, dims), kind), "assigned")
    shared.destroy()
    scratch.drop("whole")
    return Clusters(assigned, centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """``assigned`` with its cluster's and the whole inertia, null where a sum leaves a long, and a hash of the centroid."""
    exact = F.sum(F.col("distance").cast(T.DecimalType(38, 0)))
    sums = {r["cluster"]: int(r["total"]) for r in found.assigned.groupBy("cluster").agg(exact.alias("total")).collect()}
    as_long = lambda n: n if n < 1 << 63 else None
    per = [
        (c, as_long(n), as_long(sum(sums.values())), ",".join(map(str, found.centroids[c].tolist()))) for c, n in sums.items()
    ]
    kind = "cluster int, cluster_inertia long, inertia long, components string"
    per = found.assigned.sparkSession.createDataFrame(per, kind).withColumn("centroid_sha256", F.sha2("components", 256))
    return found.assigned.join(F.broadcast(per.drop("components")), "cluster")  # a row per centroid


def _sql(rounds: int = ROUNDS) -> str:
    """Every round as two common tables: nearest centroid of each vector, then means."""
    parts = [
        "v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(64 * x) AS BIGINT)) AS x"
        " FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0)",
        "f AS (SELECT x, row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c FROM v WHERE vec_id IS NOT NULL),",
        "d AS (SELECT r, p.i, v.x[p.i] AS y FROM v, (SELECT unnest(range(1, 65)) AS i) p),",
        "c0 AS (SELECT c, p.i, f.x[p.i] AS y FROM f, (SELECT unnest(range(1, 65)) AS i) p WHERE c < 16)",
    ]
    text = "WITH " + parts[0] + ",\n" + "\n".join(parts[1:])
    for n in range(rounds + 1):
        text += f""",
s{n} AS (SELECT r, c, sum((d.y - k.y) * (d.y - k.y)) AS q FROM d JOIN c{n} k USING (i) GROUP BY r, c),
a{n} AS (SELECT r, c, q FROM s{n} QUALIFY row_number() OVER (PARTITION BY r ORDER BY q, c) = 1)"""
        if n < rounds:
            text += f""",
m{n} AS (SELECT c, i, CAST(sum(y) AS BIGINT) AS t, count(*) AS n FROM d JOIN a{n} USING (r) GROUP BY c, i),
c{n + 1} AS (SELECT c, i, coalesce((t - ((t % n) + n) % n) // n, y) AS y FROM c{n} LEFT JOIN m{n} USING (c, i))"""
    return (
        text
        + f"""
SELECT vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(q AS BIGINT) AS distance,
  CAST(sum(q) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia, CAST(sum(q) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} a JOIN v USING (r)
JOIN (SELECT c, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c) h ON h.c = a.c
"""
    )


@query("op11_vp_tree_clusters", _sql())
def op11_vp_tree_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster, distance and inertia of every embedding."""
    found = with_inertia(cluster_vectors(read(spark, sf_dir, "embeddings"), Scratch(spark, "clusters")))
    return found.select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
