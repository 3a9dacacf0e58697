"""Data validation.  Every check returns a DataFrame; none stops a job except
``require_many_to_one``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, count_where, half_up, mean, pct, ratio, sorted_text


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """Row count of each table against the expected one."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("table_name"),
                "row_count",
                F.lit(expected).cast("bigint").alias("expected_rows"),
                (F.col("row_count") - expected).alias("row_difference"),
            )
            for name, (df, expected) in tables.items()
        ]
    )


def _unfold(one_row: DataFrame, entries: Sequence[tuple[str, str]], key: str, value: str) -> DataFrame:
    """(name, column) entries of a one-row aggregate as rows."""
    structs = [F.struct(F.lit(name).alias(key), F.col(c).alias(value)) for name, c in entries]
    return one_row.select("*", F.inline(F.array(*structs))).select(
        *[c for c in one_row.columns if c.startswith("total")], key, value
    )


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls per column from a single pass."""
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[(F.count(F.lit(1)) - F.count(F.col(c))).alias(f"n_{c}") for c in columns],
    )
    long = _unfold(one, [(c, f"n_{c}") for c in columns], "column_name", "null_count")
    return long.select("column_name", "null_count", half_up(pct("null_count", "total"), 4).alias("null_pct"))


def missing_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Columns with nulls over several tables."""
    return union_all(
        [
            null_audit(df, df.columns)
            .filter("null_count > 0")
            .select(F.lit(name).alias("table_name"), "column_name", "null_count", half_up("null_pct", 2).alias("null_pct"))
            for name, df in tables.items()
        ]
    )


def rows_with_nulls(df: DataFrame, keys: Sequence[str], attributes: Mapping[str, str]) -> DataFrame:
    """Rows where any attribute is null; each attribute shows NULL or OK."""
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in attributes])
    status = [F.when(F.col(c).isNull(), "NULL").otherwise("OK").alias(name) for c, name in attributes.items()]
    return df.filter(any_null).select(*keys, *status)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("occurrence_count")).filter("occurrence_count > 1")


def rows_of_duplicates(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.join(duplicate_keys(df, key).drop("occurrence_count"), list(key), "left_semi")


def conflicting_duplicates(df: DataFrame, key: str, attribute: str, name: str) -> DataFrame:
    """Duplicate keys with the distinct attribute values they carry."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("occurrence_count"), sorted_text(attribute, " | ").alias(name))
        .filter("occurrence_count > 1")
    )


def orphans(fact: DataFrame, references: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """Fact rows whose key is missing in a dimension, counted per dimension.

    The fact folds to one row per key value before the anti-join, so a hot
    key travels once.
    """
    parts = []
    for issue, (fact_key, dim, dim_key) in references.items():
        per_key = fact.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
        known = dim.select(F.col(dim_key).alias("_k")).distinct()
        missing = per_key.join(known, "_k", "left_anti")
        parts.append(
            missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_count")).select(
                F.lit(issue).alias("issue_type"), "orphan_count"
            )
        )
    return union_all(parts)


def transaction_rules() -> dict[str, Column]:
    """Values that cannot be right, by name of the issue."""
    c = F.col
    lever = lambda name: ~c(name).isin(0, 1)
    return {
        "Negative Units": c("units") < 0,
        "Zero or Negative Price": c("price") <= 0,
        "Zero or Negative Spend (units>0)": (c("spend") <= 0) & (c("units") > 0),
        "Price > Base Price": c("price") > c("base_price") + F.lit(0.01).cast("decimal(18,4)"),
        "Negative Base Price": c("base_price") <= 0,
        "Feature Not 0 or 1": lever("feature"),
        "Display Not 0 or 1": lever("display"),
        "TPR Not 0 or 1": lever("tpr_only"),
        "HHS > Visits": c("hhs") > c("visits") + 5,
        "Visits > Units * 5": (c("visits") > c("units") * 5) & (c("units") > 0),
    }


def non_positive_rules(columns: Sequence[str] = ("units", "visits", "hhs", "spend", "price", "base_price")):
    return {f"{c} <= 0": F.col(c) <= 0 for c in columns}


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one pass."""
    one = df.agg(*[count_where(rule).alias(f"r{i}") for i, rule in enumerate(rules.values())])
    return _unfold(one, [(name, f"r{i}") for i, name in enumerate(rules)], "issue", "record_count")


def ratio_outliers(
    df: DataFrame, num: str, den: str, limit_ratio: float | None, name: str, ties: Sequence[str], top: int
) -> DataFrame:
    """Rows with the largest ratio (a top-k report), above a limit if given."""
    exact = ratio(num, den)
    out = df.withColumn("_x", exact).filter(F.col("_x").isNotNull())
    if limit_ratio is not None:
        out = out.filter(F.col("_x") > limit_ratio)
    return out.orderBy(F.desc("_x"), *ties).limit(top).withColumn(name, half_up("_x", 2)).drop("_x")


def date_range(df: DataFrame, expected_weeks: int, week: str = "week_end_date") -> DataFrame:
    weeks = F.count_distinct(week)
    return df.agg(
        F.min(week).alias("first_week"),
        F.max(week).alias("last_week"),
        weeks.alias("distinct_weeks"),
        F.lit(expected_weeks).alias("expected_weeks"),
        (weeks - expected_weeks).alias("week_difference"),
    )


def scorecard(df: DataFrame, units_per_visit: float = 10, visits_per_hh: float = 5) -> DataFrame:
    """Issue counts, issue rate and grade of a transaction table."""
    c = F.col
    one = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        count_where(c("spend").isNull()).alias("null_spend"),
        count_where(c("price").isNull() | (c("price") <= 0)).alias("bad_price"),
        count_where((c("spend") <= 0) & (c("units") > 0)).alias("zero_spend_with_units"),
        count_where(c("units") < 0).alias("negative_units"),
        count_where((c("visits") > 0) & (c("units") > c("visits") * units_per_visit)).alias("uv_outliers"),
        count_where((c("hhs") > 0) & (c("visits") > c("hhs") * visits_per_hh)).alias("vh_outliers"),
    )
    critical = c("null_spend") + c("bad_price") + c("zero_spend_with_units") + c("negative_units")
    rate = pct("total_critical_issues", "total_rows")
    return one.withColumn("total_critical_issues", critical).select(
        "*",
        half_up(rate, 4).alias("issue_rate_pct"),
        band(rate, labels.GRADE_EDGES, labels.GRADES).alias("quality_grade"),
    )


def consistency(df: DataFrame) -> DataFrame:
    """Visits below households, and price against spend per unit."""
    gap = F.abs(ratio("spend", "units") - F.col("price").cast("double"))
    return df.agg(
        count_where(F.col("visits") < F.col("hhs")).alias("visits_below_hhs"),
        half_up(mean(gap), 6).alias("mean_price_difference"),
        count_where(gap > 1).alias("rows_over_one_dollar"),
    )


def unmatched_keys(sides: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Keys of one table that another table never uses, both ways as asked."""
    parts = []
    for issue, left, left_key, right, right_key in sides:
        keys = left.select(F.col(left_key).cast("bigint").alias("key")).distinct()
        used = right.select(F.col(right_key).cast("bigint").alias("key")).distinct()
        parts.append(keys.join(used, "key", "left_anti").select(F.lit(issue).alias("issue"), "key"))
    return union_all(parts)


def join_cardinality(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Whether joining each dimension would keep the fact's row count.

    Dimension keys are counted once per key; the joined row count follows from
    key counts on both sides, without materialising the join.
    """
    parts = []
    for name, (dim, key) in dims.items():
        per_dim = dim.groupBy(key).agg(F.count(F.lit(1)).alias("_d"))
        per_fact = fact.groupBy(key).agg(F.count(F.lit(1)).alias("_f"))
        both = per_fact.join(per_dim, key, "left")
        parts.append(
            both.agg(
                F.sum("_f").alias("fact_rows"),
                F.sum(F.col("_f") * F.coalesce("_d", F.lit(1))).alias("joined_rows"),
                F.coalesce(F.max("_d"), F.lit(0)).alias("max_rows_per_key"),
            ).select(
                F.lit(name).alias("dimension"),
                "*",
                (F.col("fact_rows") == F.col("joined_rows")).alias("many_to_one"),
            )
        )
    return union_all(parts)


def require_many_to_one(dim: DataFrame, key: str) -> DataFrame:
    """The dimension itself, or an error when a key repeats."""
    repeated = duplicate_keys(dim, [key]).limit(1).collect()
    if repeated:
        raise ValueError(f"{key} is not unique: {repeated[0][key]!r} occurs {repeated[0]['occurrence_count']} times")
    return dim
