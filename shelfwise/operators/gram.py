"""Statistics of all pairs of members that meet in a unit, without a row per pair and unit.

Members (products, categories) of a group have numbers x and y in units
(store-weeks).  A self-join lists every pair of every unit.  Here the cells of
a group are dealt to blocks of members and chunks of units; a task lays two
blocks over a chunk out as matrices, units x members, and multiplies them: with
P the presence, X and Y the numbers (0 where absent), P'P counts meetings, X'P
sums x over them, X'X gives products.  Tasks return a row per pair that meets,
so the shuffle grows with the cells and with the pairs of members.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.expr import ratio

#: Members of a block and units of a chunk, about.
BLOCK, CHUNK = 256, 4096
_SUMS = ("n", "xa", "xb", "ya", "yb", "a_wins", "b_wins")
_PRODUCTS = ("gg", "dd", "gd")


def _matrix(cells: pd.DataFrame, units: int, members: int, value) -> np.ndarray:
    out = np.zeros((units, members), np.int64)
    out[cells["_u"].to_numpy(), cells["_m"].to_numpy()] = value
    return out


def block_stats(cells: pd.DataFrame) -> pd.DataFrame:
    """(a, b, sums) of the pairs a < b between the two sides of a tile (side 0 x side 1, or side 2 with itself).

    Sums are whole numbers; products are doubles.
    """
    own = {}
    cells = cells.assign(_u=pd.factorize(cells["unit"])[0])
    units = int(cells["_u"].max()) + 1 if len(cells) else 0
    for side in (0, 1, 2):
        part = cells[cells["side"] == side]
        if len(part):
            codes, members = pd.factorize(part["member"], sort=True)
            part = part.assign(_m=codes)
            p = _matrix(part, units, len(members), 1)
            own[side] = (members, p, _matrix(part, units, len(members), part["x"]), _matrix(part, units, len(members), part["y"]))
    if 2 in own:
        left = right = own[2]
    elif 0 in own and 1 in own:
        left, right = own[0], own[1]
    else:
        return pd.DataFrame({c: [] for c in ("a", "b", *_SUMS, *_PRODUCTS)})
    (am, ap, ax, ay), (bm, bp, bx, by) = left, right
    meet = ap.T @ bp
    f = lambda m: m.astype(float)
    mul = lambda a, b: f(a).T @ f(b)
    xa, xb, ya, yb = ax.T @ bp, ap.T @ bx, ay.T @ bp, ap.T @ by
    gg = mul(f(ax) ** 2, bp) + mul(ap, f(bx) ** 2) - 2 * mul(ax, bx)
    dd = mul(f(ay) ** 2, bp) + mul(ap, f(by) ** 2) - 2 * mul(ay, by)
    gd = mul(f(ax) * ay, bp) + mul(ap, f(bx) * by) - mul(ax, by) - mul(ay, bx)
    wins, losses = np.zeros_like(meet), np.zeros_like(meet)
    for i in range(len(am)):
        both = (ap[:, i] > 0)[:, None] & (bp > 0)
        wins[i] = (both & (ay[:, i, None] > by)).sum(0)
        losses[i] = (both & (ay[:, i, None] < by)).sum(0)
    i, j = np.nonzero(meet)
    # A pair stands once, the smaller member first.
    a, b = np.asarray(am)[i], np.asarray(bm)[j]
    turned = a > b
    keep = (a != b) & ~(turned if 2 in own else np.zeros(len(a), bool))
    i, j, a, b, turned = i[keep], j[keep], a[keep], b[keep], turned[keep]
    pick = lambda m, other: np.where(turned, other[i, j], m[i, j])
    return pd.DataFrame(
        {
            "a": np.where(turned, b, a), "b": np.where(turned, a, b), "n": meet[i, j],
            "xa": pick(xa, xb), "xb": pick(xb, xa), "ya": pick(ya, yb), "yb": pick(yb, ya),
            "a_wins": pick(wins, losses), "b_wins": pick(losses, wins),
            "gg": gg[i, j], "dd": dd[i, j], "gd": gd[i, j],
        }
    )


def pair_stats(cells: DataFrame, group: Sequence[str], unit: Sequence[str], member: str, x: str, y: str) -> DataFrame:
    """(group, a, b, n, xa, xb, ya, yb, a_wins, b_wins, gg, dd, gd) for members a < b of a group that meet in a unit.

    ``cells`` has one row per group, unit and member with whole numbers x and y.
    n counts the units they meet in; the sums run over those: of x and y of
    either, units where one has more y, and of the squares and the product of
    the differences g = xa - xb and d = ya - yb.
    """
    groups = [f"_g{i}" for i in range(len(group))]
    rows = cells.select(
        *[F.col(c).alias(g) for c, g in zip(group, groups, strict=True)], F.xxhash64(*unit).alias("unit"),
        F.col(member).alias("member"), F.col(x).cast("long").alias("x"), F.col(y).cast("long").alias("y"),
    )
    count = lambda c, per, name: (
        rows.select(*groups, c).distinct().groupBy(*groups).agg(F.ceil(F.count(F.lit(1)) / per).alias(name))
    )
    members, units = count("member", BLOCK, "_blocks"), count("unit", CHUNK, "_chunks")
    if groups:
        dealt = rows.join(members.join(units, groups), groups)
    else:  # one row of two numbers
        dealt = rows.withColumns({"_blocks": members.scalar(), "_chunks": units.scalar()})
    dealt = dealt.withColumns({"_own": F.pmod(F.xxhash64("member"), F.col("_blocks")), "chunk": F.pmod(F.col("unit"), F.col("_chunks"))})
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1)))
    side = F.when(F.col("_own") == F.col("_other"), 2).when(F.col("_own") < F.col("_other"), 0).otherwise(1)
    dealt = dealt.select(
        *groups, "chunk", F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"), side.alias("side"),
        "unit", "member", "x", "y",
    )
    kind = T.StructType(
        [
            *[T.StructField(g, rows.schema[g].dataType) for g in groups],
            *[T.StructField(c, rows.schema["member"].dataType) for c in ("a", "b")],
            *[T.StructField(c, T.LongType()) for c in _SUMS],
            *[T.StructField(c, T.DoubleType()) for c in _PRODUCTS],
        ]
    )

    def run(tile_key: tuple, tile: pd.DataFrame) -> pd.DataFrame:
        found = block_stats(tile)
        for i, g in enumerate(groups):
            found[g] = [tile_key[i]] * len(found)
        return found[[*groups, "a", "b", *_SUMS, *_PRODUCTS]]

    parts = dealt.groupBy(*groups, "chunk", "i", "j").applyInPandas(run, kind)
    out = parts.groupBy(*groups, "a", "b").agg(*[F.sum(c).alias(c) for c in (*_SUMS, *_PRODUCTS)])
    return out.select(*[F.col(g).alias(c) for c, g in zip(group, groups, strict=True)], "a", "b", *_SUMS, *_PRODUCTS)


def correlation() -> Column:
    """Correlation of the differences, from a row of ``pair_stats``; null without variance."""
    c = lambda name: F.col(name).cast("double")
    n, g, d = c("n"), c("xa") - c("xb"), c("ya") - c("yb")
    cross = n * c("gd") - g * d
    spread = F.sqrt(F.greatest(n * c("gg") - g * g, F.lit(0.0))) * F.sqrt(F.greatest(n * c("dd") - d * d, F.lit(0.0)))
    return ratio(cross, spread)
