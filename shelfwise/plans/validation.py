"""Validation queries (V)."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfwise.functions.expr import count_where, half_up, mean
from shelfwise.operators import checks
from shelfwise.operators.report import metric_rows, shown
from shelfwise.operators.trend import week_gaps
from shelfwise.plans.context import Context, query
from shelfwise.schema import TRANSACTION_KEY
from shelfwise.sources import crosswalk, gate
from shelfwise.sources.workspace import Workspace

# Row and week counts the retail panel is documented to have.
EXPECTED_ROWS = {"transactions": 524950, "products": 58, "stores": 79}
EXPECTED_WEEKS = 156
# Visits per household above which a row is listed; the published 5 lists nothing on the test tables.
VISITS_PER_HH = 1
AUDITED = ("week_end_date", "store_num", "upc", "units", "visits", "hhs", "spend", "price", "base_price")


def delivered(cx: Context):
    return crosswalk.delivered_transactions(cx.spark, cx.sf_dir)


@query("v1_row_counts")
def row_counts(cx: Context):
    tables = {"transactions": cx.star.fact, "products": cx.star.product, "stores": cx.star.store}
    return checks.row_counts({k: (df, EXPECTED_ROWS[k]) for k, df in tables.items()})


@query("v2_null_audit")
def null_audit(cx: Context):
    return checks.null_audit(delivered(cx), AUDITED)


@query("v3_store_nulls")
def store_nulls(cx: Context):
    return checks.rows_with_nulls(
        cx.star.store,
        ["store_num", "store_name"],
        {
            "parking_space_qty": "parking_status",
            "sales_area_size_num": "area_status",
            "avg_weekly_baskets": "baskets_status",
        },
    )


@query("v4_duplicate_keys")
def duplicate_keys(cx: Context):
    return checks.duplicate_keys(cx.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("v4_duplicate_rows")
def duplicate_rows(cx: Context):
    line = cx.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return checks.rows_of_duplicates(line, ["l_orderkey", "l_linenumber"])


@query("v4_transaction_key")
def transaction_key(cx: Context):
    """The panel key must be unique: an empty result is the pass."""
    return checks.duplicate_keys(cx.transactions, list(TRANSACTION_KEY))


@query("v5_conflicting_segments")
def conflicting_segments(cx: Context):
    lookup = crosswalk.raw_store_lookup(cx.spark, cx.sf_dir)
    return checks.conflicting_duplicates(lookup, "store_num", "seg_value_name", "conflicting_segments")


@query("v6_orphans")
def orphans(cx: Context):
    return checks.orphans(
        cx.table("lineitem"),
        {
            "Missing Product": ("l_partkey", cx.table("part"), "p_partkey"),
            "Missing Store": ("l_suppkey", cx.table("supplier"), "s_suppkey"),
            "Missing Order": ("l_orderkey", cx.table("orders"), "o_orderkey"),
        },
    )


@query("v7_impossible_values")
def impossible_values(cx: Context):
    return checks.rule_counts(delivered(cx), checks.transaction_rules())


@query("v8_units_per_visit_outliers")
def units_per_visit_outliers(cx: Context):
    t = delivered(cx).join(cx.star.product.select("upc", "description", "category"), "upc", "left")
    cols = [*TRANSACTION_KEY, "description", "category", "units", "visits", "spend", "price"]
    return checks.ratio_outliers(t.select(*cols), "units", "visits", 10, "units_per_visit", TRANSACTION_KEY, 50)


@query("v8_top_units_per_visit")
def top_units_per_visit(cx: Context):
    cols = [*TRANSACTION_KEY, "units", "visits", "hhs", "display", "feature"]
    return checks.ratio_outliers(
        delivered(cx).select(*cols), "units", "visits", None, "units_per_visit", TRANSACTION_KEY, 10
    )


@query("v9_visits_per_hh_outliers")
def visits_per_hh_outliers(cx: Context):
    t = delivered(cx).join(cx.star.product.select("upc", "description"), "upc", "left")
    cols = [*TRANSACTION_KEY, "description", "visits", "hhs", "units"]
    return checks.ratio_outliers(t.select(*cols), "visits", "hhs", VISITS_PER_HH, "visits_per_hh", TRANSACTION_KEY, 50)


@query("v10_date_range")
def date_range(cx: Context):
    return checks.date_range(delivered(cx), EXPECTED_WEEKS)


@query("v11_week_gaps")
def gaps(cx: Context):
    return week_gaps(delivered(cx))


@query("v12_quality_scorecard")
def quality_scorecard(cx: Context):
    return checks.scorecard(delivered(cx))


@query("v13_non_positive_values")
def non_positive(cx: Context):
    return checks.rule_counts(delivered(cx), checks.non_positive_rules())


@query("v14_price_consistency")
def price_consistency(cx: Context):
    return checks.consistency(delivered(cx))


@query("v15_unmatched_keys")
def unmatched_keys(cx: Context):
    return checks.unmatched_keys(
        [
            ("product never sold", cx.star.product, "upc", cx.star.fact, "upc"),
            ("sold but unknown product", cx.star.fact, "upc", cx.star.product, "upc"),
            ("store never sold", cx.star.store, "store_num", cx.star.fact, "store_num"),
            ("sold in unknown store", cx.star.fact, "store_num", cx.star.store, "store_num"),
            ("customer without orders", cx.table("customer"), "c_custkey", cx.table("orders"), "o_custkey"),
        ]
    )


@query("v16_missing_summary")
def missing_summary(cx: Context):
    return checks.missing_summary({"transactions": delivered(cx), "products": cx.star.product, "stores": cx.star.store})


@query("v17_cleaning_report")
def cleaning_report(cx: Context):
    """Counts after cleaning, as text; imputed rows are counted where spend was
    repaired, not where it merely differs from units x price."""
    from shelfwise.operators.clean import stage_transactions

    staged = stage_transactions(delivered(cx), cx.star.product, cx.star.store)
    repaired = staged.agg(count_where(F.col("is_zero_spend"))).scalar()
    one = cx.star.fact.agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(F.col("is_promoted")).alias("promoted"),
        half_up(mean("discount_pct"), 2).alias("discount"),
    ).select(
        "*",
        repaired.alias("imputed"),
        *[
            getattr(cx.star, d).select(F.count(F.lit(1))).scalar().alias(d)
            for d in ("product", "store", "calendar")
        ],
    )
    rows = {
        "fact_sales rows": shown("rows"),
        "dim_product rows": shown("product"),
        "dim_store rows": shown("store"),
        "dim_calendar rows": shown("calendar"),
        "Rows with imputed spend": shown("imputed"),
        "Promoted rows": shown("promoted"),
        "Avg discount %": shown("discount", 2),
    }
    return metric_rows(one, [(F.lit(k), v) for k, v in rows.items()], ["metric", "value"])


@query("v18_join_cardinality")
def join_cardinality(cx: Context):
    return checks.join_cardinality(
        cx.star.fact,
        {
            "product": (cx.star.product, "upc"),
            "store": (cx.star.store, "store_num"),
            "calendar": (cx.star.calendar, "date_key"),
            "store lookup before dedup": (crosswalk.raw_store_lookup(cx.spark, cx.sf_dir), "store_num"),
        },
    )


def gated(cx: Context) -> gate.GateReport:
    """The delivery written through the gate; it does not stop here, so that its report can be read."""
    path = f"{Workspace(cx.spark, 'gate').root}/transactions"
    return gate.gated_write(delivered(cx), checks.transaction_rules(), path, stop=None)


@query("v12_gate_report")
def gate_report(cx: Context):
    """Rows that break each rule, broken rows and grade, as the gate saw them while it wrote."""
    found = gated(cx)
    rows = [(name, n, found.broken, found.rows, found.grade) for name, n in found.per_rule.items()]
    return cx.spark.createDataFrame(rows, "issue string, record_count long, broken_rows long, total_rows long, grade string")


@query("v7_quarantined_rows")
def quarantined_rows(cx: Context):
    """The rows in quarantine with the rules they break."""
    like = delivered(cx)
    rows = gate.read_part(like, gated(cx).path, gate.BROKEN)
    return rows.select(*TRANSACTION_KEY, "units", "spend", F.array_join("broken_rules", ", ").alias("broken_rules"))


@query("v12_rows_past_gate")
def rows_past_gate(cx: Context):
    """Totals of the rows that the gate let through."""
    rows = gate.read_part(delivered(cx), gated(cx).path, gate.SOUND)
    return rows.agg(F.count(F.lit(1)).alias("row_count"), F.sum("units").alias("units"), F.sum("spend").alias("spend"))
