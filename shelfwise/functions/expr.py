"""Small, null-safe Column builders.  Everything here stays inside codegen."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfwise.functions import labels

# Decimal places kept beyond those asked for, so that a binary double such as
# 1.00499999999999989 rounds like the decimal 1.005 it stands for.
_HEADROOM = 4


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c: str | Column) -> Column:
    return col(c).cast("double")


def half_up(c: str | Column, digits: int) -> Column:
    """Round a double half away from zero, as the decimal it stands for.

    Numbers beyond the decimal's range, and NaN, round as doubles.
    """
    x = dbl(c)
    exact = F.round(x.try_cast(f"decimal(38,{digits + _HEADROOM})"), digits).cast("double")
    return F.coalesce(exact, F.round(x, digits))


def ratio(num: str | Column, den: str | Column, scale: float = 1.0) -> Column:
    """``num / den * scale`` as double; null when the denominator is 0 or null."""
    n = dbl(num) if scale == 1.0 else dbl(num) * F.lit(float(scale))
    return n / F.nullif(dbl(den), F.lit(0.0))


def pct(num: str | Column, den: str | Column) -> Column:
    return ratio(num, den, 100.0)


def growth_pct(now: str | Column, before: str | Column, digits: int = 2) -> Column:
    """Percentage change from ``before`` to ``now``; null without a base."""
    return half_up(pct(dbl(now) - dbl(before), before), digits)


def flag(cond: Column) -> Column:
    """0/1 for a condition; null conditions count as 0."""
    return F.coalesce(cond.cast("int"), F.lit(0))


def mean(c: str | Column) -> Column:
    """Average from an exact sum, so decimals do not lose scale on the way."""
    return dbl(F.sum(col(c))) / F.nullif(dbl(F.count(col(c))), F.lit(0.0))


def mean_where(cond: Column, c: str | Column) -> Column:
    return mean(F.when(cond, col(c)))


def sum_where(cond: Column, c: str | Column) -> Column:
    """Conditional sum that is 0 when nothing matches."""
    x = col(c)
    return F.coalesce(F.sum(F.when(cond, x)), F.lit(0))


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def band(
    c: str | Column,
    edges: Sequence[float],
    names: Sequence[str],
    right_closed: bool = False,
    null_label: str | None = None,
) -> Column:
    """Contiguous bands: ``names[i]`` up to ``edges[i]``, the last name beyond."""
    if len(names) != len(edges) + 1:
        raise ValueError("band needs one more name than edges")
    x = col(c)
    out = F.when(x.isNull(), F.lit(null_label))
    for edge, name in zip(edges, names):
        out = out.when(x <= F.lit(edge) if right_closed else x < F.lit(edge), F.lit(name))
    return out.otherwise(F.lit(names[-1]))


def choose(c: str | Column, mapping: Mapping, default: str | None = None) -> Column:
    """Translate the values of a column through a small fixed mapping."""
    x = col(c)
    out = None
    for key, name in mapping.items():
        out = F.when(x == F.lit(key), F.lit(name)) if out is None else out.when(x == F.lit(key), F.lit(name))
    return out.otherwise(F.lit(default))


def promo_mask(feature: str | Column, display: str | Column, tpr: str | Column) -> Column:
    """Three 0/1 levers packed as feature=4, display=2, tpr=1."""
    return (col(feature) * 4 + col(display) * 2 + col(tpr)).cast("int")


def promo_type(feature: str | Column, display: str | Column, tpr: str | Column) -> Column:
    names = F.array(*[F.lit(n) for n in labels.PROMO_BY_MASK])
    return F.element_at(names, promo_mask(feature, display, tpr) + 1)


def season(month: str | Column) -> Column:
    """Meteorological season of a month number."""
    names = F.array(*[F.lit(n) for n in labels.SEASONS])
    return F.element_at(names, F.floor((col(month) % 12) / 3).cast("int") + 1)


def sorted_text(c: str | Column, sep: str) -> Column:
    """Distinct values of a group, sorted and joined; for bounded dimension groups."""
    return F.array_join(F.sort_array(F.collect_set(col(c).cast("string"))), sep)
