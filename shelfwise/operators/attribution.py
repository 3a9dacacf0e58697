"""Exact additive contributions of the features to the predictions of fitted trees.

A tree's prediction for a row of which only some features are known is taken
along the paths: at a split on an unknown feature both sides count by their
share of training rows.  A feature's contribution is its mean marginal effect
over all orders in which features become known.  A leaf is reached along a path
with few features; for each, the row either passes all its splits on it or does
not, so the sum over orders is a small polynomial per leaf.  Contributions and
the base, the prediction with nothing known, add up to the prediction.

Trees travel as arrays (a few hundred kilobytes); rows are scored in Arrow
batches, all rows of a batch at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Leaf:
    """A leaf's value, and per feature of its path (number, low, high, share): the row passes if low < x <= high."""

    value: float
    conditions: list[tuple[int, float, float, float]]


def leaves_of(nodes: dict[int, dict], weight: float) -> list[Leaf]:
    """The leaves of a tree of nodes (value, count, left, right, feature, threshold), values times the tree's weight."""
    out, todo = [], [(0, {})]
    while todo:
        at, path = todo.pop()
        node = nodes[at]
        if node["left"] < 0:
            out.append(Leaf(node["value"] * weight, [(f, *c) for f, c in sorted(path.items())]))
            continue
        f, cut = node["feature"], node["threshold"]
        low, high, share = path.get(f, (-math.inf, math.inf, 1.0))
        for child, bounds in ((node["left"], (low, min(high, cut))), (node["right"], (max(low, cut), high))):
            todo.append((child, {**path, f: (*bounds, share * nodes[child]["count"] / node["count"])}))
    return out


def saved_leaves(spark: SparkSession, model: PipelineModel, path: str) -> list[list[Leaf]]:
    """The trees of the last stage of a pipeline saved at ``path``; a single tree counts as one, a forest by its mean."""
    last = model.stages[-1]
    stage = f"{path}/stages/{len(model.stages) - 1}_{last.uid}"
    data = spark.read.parquet(f"{stage}/data")
    fields = data.select("nodeData.*" if "nodeData" in data.columns else "*", *(["treeID"] if "treeID" in data.columns else [F.lit(0).alias("treeID")]))
    trees: dict[int, dict[int, dict]] = {}
    for r in fields.collect():
        trees.setdefault(r["treeID"], {})[r["id"]] = {
            "value": r["prediction"], "count": r["rawCount"], "left": r["leftChild"], "right": r["rightChild"],
            "feature": r["split"]["featureIndex"], "threshold": (r["split"]["leftCategoriesOrThreshold"] or [0.0])[0],
        }
    weights = list(getattr(last, "treeWeights", [1.0]))
    if "Forest" in type(last).__name__:
        weights = [w / sum(weights) for w in weights]
    return [leaves_of(nodes, weights[t]) for t, nodes in sorted(trees.items())]


def contributions(trees: list[list[Leaf]], x: np.ndarray) -> tuple[np.ndarray, float]:
    """(rows x features contributions, base) for the rows of ``x``."""
    out, base = np.zeros(x.shape), 0.0
    for leaf in (leaf for tree in trees for leaf in tree):
        m = len(leaf.conditions)
        base += leaf.value * math.prod(c[3] for c in leaf.conditions)
        if not m:
            continue
        passed = [((x[:, f] > low) & (x[:, f] <= high)).astype(float) for f, low, high, _ in leaf.conditions]
        weights = [math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)]
        for j, (f, _, _, share) in enumerate(leaf.conditions):
            # By the number of known features among the others: products of passing (known) or share (unknown).
            terms = [np.ones(len(x))] + [np.zeros(len(x)) for _ in range(m - 1)]
            for k, (_, _, _, other) in enumerate(leaf.conditions):
                if k != j:
                    for s in range(m - 1, 0, -1):
                        terms[s] = terms[s] * other + terms[s - 1] * passed[k]
                    terms[0] = terms[0] * other
            out[:, f] += leaf.value * (passed[j] - share) * sum(w * t for w, t in zip(weights, terms, strict=True))
    return out, base


def attribute(trees: list[list[Leaf]], rows: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """(keep, base, one column of contributions per feature) for every row; features must not be null."""
    kind = T.StructType(
        [*[rows.schema[c] for c in keep], T.StructField("base", T.DoubleType()), *[T.StructField(c, T.DoubleType()) for c in features]]
    )
    inputs = [F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[[f"_x{i}" for i in range(len(features))]].to_numpy(float)
            found, base = contributions(trees, x)
            own = batch[list(keep)].reset_index(drop=True)
            own["base"] = base
            yield pd.concat([own, pd.DataFrame(found, columns=list(features))], axis=1)

    return rows.select(*keep, *inputs).mapInPandas(run, kind)


def importance(attributed: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean and mean absolute contribution per feature, largest first."""
    pairs = [F.struct(F.lit(c).alias("feature_name"), F.col(c).alias("v")) for c in features]
    long = attributed.select(F.inline(F.array(*pairs)))
    out = long.groupBy("feature_name").agg(F.avg("v").alias("mean_contribution"), F.avg(F.abs("v")).alias("mean_abs_contribution"))
    return out.orderBy(F.desc("mean_abs_contribution"), "feature_name")
