"""Aggregate navigation: a report is answered from the coarsest mart that covers it.

A mart holds, per combination of its keys, additive columns: sums, counts,
least and greatest values.  Marts form a lattice: each is built from the
smallest finer one.  A request names grouping columns and measures; a mart
covers it if every column is one of its keys or an attribute of a dimension
whose key it has, and every measure can be put together again from its columns
(a distinct count needs the counted key).  Of the marts that cover a request
the one with the fewest rows answers, the fact only if there is none.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import count_where, half_up, pct, ratio
from shelfwise.functions.measures import MEASURES, RAW, parse
from shelfwise.operators.rollup import Spec, kpi_rollup
from shelfwise.operators.share import share_pct
from shelfwise.operators.star import Star

#: Mart -> keys, finest first; a later mart may be built from an earlier one.
LATTICE: dict[str, tuple[str, ...]] = {
    "store_week_category": ("date_key", "store_num", "category"),
    "product": ("upc", "category"),
    "store_week": ("date_key", "store_num"),
    "week": ("date_key",),
    "store": ("store_num",),
}
_KEYS = {"product": "upc", "store": "store_num", "calendar": "date_key"}

_SUMS = ("spend", "units", "visits", "hhs")
_MEANS = ("price", "base_price", "price_gap", "discount_pct")
_FLAGS: dict[str, Callable[[], Column]] = {
    "promoted": lambda: F.col("is_promoted"),
    "discounted": lambda: F.col("discount_pct") > 0,
    "feature_on": lambda: F.col("feature") == 1,
    "display_on": lambda: F.col("display") == 1,
    "tpr_on": lambda: F.col("tpr_only") == 1,
    "combined": lambda: F.col("promo_type") == "COMBINED",
}
_EXTREMES = {"price_min": F.min, "price_max": F.max, "spend_min": F.min, "spend_max": F.max, "discount_pct_max": F.max}


#: Fact columns that marts are made of.
INPUTS = (*_SUMS, *_MEANS, "is_promoted", "feature", "display", "tpr_only", "promo_type")


def additive_columns() -> list[Column]:
    """The columns of a mart, as aggregates over fact rows."""
    return [
        *[F.sum(c).alias(c) for c in _SUMS],
        F.count(F.lit(1)).alias("rows"),
        *[f(c).alias(f"{c}_{n}") for c in _MEANS for n, f in (("sum", F.sum), ("n", F.count))],
        *[count_where(cond()).alias(name) for name, cond in _FLAGS.items()],
        *[f(name.rsplit("_", 1)[0]).alias(name) for name, f in _EXTREMES.items()],
    ]


def merged_columns() -> list[Column]:
    """The same columns, from the rows of a finer mart."""
    sums = [*_SUMS, "rows", *[f"{c}_{n}" for c in _MEANS for n in ("sum", "n")], *_FLAGS]
    return [F.sum(c).alias(c) for c in sums] + [f(name).alias(name) for name, f in _EXTREMES.items()]


def _mean(c: str) -> Callable[[int], Column]:
    return lambda d: half_up(ratio(F.sum(f"{c}_sum"), F.sum(f"{c}_n")), d)


def _rate(flag: str) -> Callable[[int], Column]:
    return lambda d: half_up(pct(F.sum(flag), F.sum("rows")), d)


def _extreme(f: Callable, c: str) -> Callable[[int], Column]:
    return lambda d: F.round(f(c), d)


#: Measures that are other expressions over a mart than over the fact.
_REBUILT: dict[str, Callable] = {
    "row_count": lambda d: F.sum("rows"),
    "avg_price": _mean("price"),
    "avg_base_price": _mean("base_price"),
    "avg_price_gap": _mean("price_gap"),
    "avg_discount_pct": _mean("discount_pct"),
    "avg_units": lambda d: half_up(ratio(F.sum("units"), F.sum("rows")), d),
    "avg_revenue": lambda d: half_up(ratio(F.sum("spend"), F.sum("rows")), d),
    "promoted_rows": lambda d: F.sum("promoted"),
    "discounted_rows": lambda d: F.sum("discounted"),
    "feature_rows": lambda d: F.sum("feature_on"),
    "display_rows": lambda d: F.sum("display_on"),
    "tpr_rows": lambda d: F.sum("tpr_on"),
    "combined_rows": lambda d: F.sum("combined"),
    "promo_rate_pct": _rate("promoted"),
    "feature_rate_pct": _rate("feature_on"),
    "display_rate_pct": _rate("display_on"),
    "tpr_rate_pct": _rate("tpr_on"),
    "combined_promo_rate_pct": _rate("combined"),
    "pct_rows_discounted": _rate("discounted"),
    "min_price": _extreme(F.min, "price_min"),
    "max_price": _extreme(F.max, "price_max"),
    "min_spend": _extreme(F.min, "spend_min"),
    "max_spend": _extreme(F.max, "spend_max"),
    "max_discount_pct": _extreme(F.max, "discount_pct_max"),
}
#: Measures over sums, which read the same columns of fact and mart.
_SAME = (
    "total_revenue", "total_units", "total_visits", "total_hhs", "avg_basket_value", "avg_basket_size", "avg_revenue_per_hh",
    "avg_units_per_hh", "avg_visits_per_hh", "hhs_per_visit",
)
#: Measures that count distinct values, and the column they count.
_DISTINCT = {
    "store_count": "store_num", "product_count": "upc", "week_count": "date_key", "category_count": "category",
    "revenue_per_store": "store_num", "revenue_per_week": "date_key",
}
_RAW_SAME = ("revenue", "units", "visits", "hhs", "intensity")


def measures_over_mart(specs: Sequence[str]) -> list[Column]:
    """The measures as aggregates over rows of additive columns."""
    built = []
    for spec in specs:
        name, digits, alias = parse(spec)
        default, over_fact = MEASURES[name]
        if name not in _REBUILT and name not in _SAME and name not in _DISTINCT:
            raise ValueError(f"{name} cannot be put together from a mart")
        built.append(_REBUILT.get(name, over_fact)(default if digits is None else digits).alias(alias))
    return built


@dataclass(frozen=True)
class Mart:
    name: str
    keys: tuple[str, ...]
    table: DataFrame
    rows: int


def build_mart(star: Star, name: str, finer: DataFrame | None = None) -> DataFrame:
    """A mart of the lattice, from a finer one if given, else from the fact."""
    keys = LATTICE[name]
    if finer is not None:
        return finer.groupBy(*keys).agg(*merged_columns())
    dims = [dim for dim in _KEYS if any(k in getattr(star, dim).columns and k not in star.fact.columns for k in keys)]
    return star.sales(*dims).groupBy(*keys).agg(*additive_columns())


def finer_mart(name: str, built: Mapping[str, Mart]) -> Mart | None:
    """The smallest mart already there whose keys hold all of ``name``'s."""
    fits = [m for m in built.values() if set(LATTICE[name]) <= set(m.keys)]
    return min(fits, key=lambda m: m.rows, default=None)


class Navigator:
    """Answers KPI requests over a star from its marts."""

    def __init__(self, star: Star, marts: Sequence[Mart]):
        self.star, self.marts = star, sorted(marts, key=lambda m: m.rows)
        self.owner = {c: key for dim, key in _KEYS.items() for c in getattr(star, dim).columns if c != key}

    def _has(self, mart: Mart, column: str) -> bool:
        return column in mart.keys or self.owner.get(column) in mart.keys

    def choose(self, by: Sequence[str], measures: Sequence[str], raws: Sequence[str] = ()) -> Mart | None:
        """The mart with the fewest rows that covers the request; None if only the fact does."""
        names = [parse(m)[0] for m in measures]
        if any(n not in _REBUILT and n not in _SAME and n not in _DISTINCT for n in names) or set(raws) - {*_RAW_SAME, "rows"}:
            return None
        needed = [*by, *[_DISTINCT[n] for n in names if n in _DISTINCT]]
        return next((m for m in self.marts if all(self._has(m, c) for c in needed)), None)

    def rollup(
        self,
        by: Sequence[str],
        measures: Sequence[str],
        shares: Mapping[str, Spec] | None = None,
        ranks: Mapping[str, Spec] | None = None,
    ) -> DataFrame:
        """As ``kpi_rollup`` over the fact with the dimensions that ``by`` names."""
        shares, ranks = shares or {}, ranks or {}
        raws = sorted({raw for raw, _ in [*shares.values(), *ranks.values()]})
        mart = self.choose(by, measures, raws)
        names = [parse(m)[0] for m in measures]
        wanted = [*by, *[_DISTINCT[n] for n in names if n in _DISTINCT]]
        if mart is None:
            dims = [d for d, key in _KEYS.items() if any(self.owner.get(c) == key and c not in self.star.fact.columns for c in wanted)]
            return kpi_rollup(self.star.sales(*dims), by, measures, shares, ranks)
        rows = mart.table
        for dim, key in _KEYS.items():
            more = [c for c in dict.fromkeys(wanted) if c not in mart.keys and self.owner.get(c) == key]
            if more:
                rows = rows.join(getattr(self.star, dim).select(key, *more), key)
        hidden = [(F.sum("rows") if r == "rows" else RAW[r]()).alias(f"_{r}") for r in raws]
        out = rows.groupBy(*by).agg(*measures_over_mart(measures), *hidden)
        for name, (raw, partition) in shares.items():
            out = out.withColumn(name, share_pct(f"_{raw}", *partition))
        for name, (raw, partition) in ranks.items():
            out = out.withColumn(name, F.rank().over(Window.partitionBy(*partition).orderBy(F.desc(f"_{raw}"))))
        return out.drop(*[f"_{r}" for r in raws])
