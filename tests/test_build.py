"""Cleaning and star build on hand-made rows."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.functions.expr import band, half_up, promo_type, season
from shelfwise.operators import checks, clean, explore, star
from shelfwise.operators.gaps import zero_filled, zero_weeks
from shelfwise.operators.trend import lag_by_weeks, week_gaps
from shelfwise.schema import RAW_PRODUCTS, RAW_STORES, RAW_TRANSACTIONS
from shelfwise.sources import marts, panel

W1 = dt.date(2024, 1, 6)


def week(n: int) -> dt.date:
    return W1 + dt.timedelta(days=7 * n)


def tx(w=0, store=1, upc=10, units=3, visits=2, hhs=2, spend="7.5", price="2.5", base="3", f=0, d=0, t=0):
    dec = lambda v: None if v is None else D(v)
    return (week(w), store, upc, units, visits, hhs, dec(spend), dec(price), dec(base), f, d, t)


@pytest.fixture(scope="module")
def products(spark):
    rows = [
        (10, " bag snacks ", " Chips ", "acme", "salty", "1 OZ"),
        (11, "COLD CEREAL", "Flakes", "Acme", "flakes", "2 OZ"),
        (12, "SOMETHING", "Unsold", "Zed", "x", "3 OZ"),
    ]
    return spark.createDataFrame(rows, RAW_PRODUCTS)


@pytest.fixture(scope="module")
def stores(spark):
    rows = [
        (1, "One", "C1", "TX", 5, "UPSCALE", D("300"), 39999, D("100")),
        (1, "One", "C1", "TX", 5, "MAINSTREAM", D("300"), 39999, D("100")),
        (2, "Two", "C2", "TX", 5, "VALUE", None, 60000, D("200")),
        (3, "Three", "C3", "OH", None, "VALUE", D("499"), None, D("200")),
    ]
    return spark.createDataFrame(rows, RAW_STORES)


def staged(spark, products, stores, *rows):
    raw = spark.createDataFrame(list(rows), RAW_TRANSACTIONS)
    return clean.stage_transactions(raw, products, stores)


def test_spend_is_imputed_from_units_and_price(spark, products, stores):
    row = staged(spark, products, stores, tx(spend="0")).first()
    assert row.spend == D("7.5") and row.is_zero_spend and not row.is_zero_price


def test_zero_price_takes_base_price_for_price_and_spend(spark, products, stores):
    row = staged(spark, products, stores, tx(spend="0", price="0")).first()
    assert row.price == D("3") and row.is_zero_price and row.spend == D("9")


def test_prices_fill_each_other(spark, products, stores):
    rows = staged(spark, products, stores, tx(price=None), tx(w=1, base=None)).orderBy("week_end_date").collect()
    assert rows[0].price == D("3") and rows[1].base_price == D("2.5")


def test_nulls_flags_and_outliers(spark, products, stores):
    rows = staged(
        spark, products, stores, tx(f=2), tx(w=1, units=22), tx(w=2, visits=12, hhs=2), tx(w=3, units=None, visits=None)
    ).orderBy("week_end_date").collect()
    assert rows[0].feature == 0
    assert rows[1].is_outlier_uv and not rows[1].is_outlier_vh
    assert rows[2].is_outlier_vh
    assert rows[3].units == 0 and rows[3].visits == 0


def test_orphans_are_dropped_and_counted(spark, products, stores):
    raw = spark.createDataFrame([tx(), tx(upc=99), tx(store=77)], RAW_TRANSACTIONS)
    assert clean.stage_transactions(raw, products, stores).count() == 1
    found = checks.orphans(raw, {"product": ("upc", products, "upc"), "store": ("store_num", stores, "store_num")})
    assert {r.issue_type: r.orphan_count for r in found.collect()} == {"product": 1, "store": 1}


def test_store_dedup_keeps_first_segment(spark, stores):
    rows = {r.store_num: r.seg_value_name for r in clean.stage_stores(stores).collect()}
    assert rows == {1: "MAINSTREAM", 2: "VALUE", 3: "VALUE"}
    last = clean.keep_one(stores, ["store_num"], ["seg_value_name"], "last")
    assert {r.store_num: r.seg_value_name for r in last.collect()}[1] == "UPSCALE"


def test_conflicting_duplicates_listed(spark, stores):
    row = checks.conflicting_duplicates(stores, "store_num", "seg_value_name", "segs").first()
    assert (row.store_num, row.occurrence_count, row.segs) == (1, 2, "MAINSTREAM | UPSCALE")


def test_many_to_one_guard(spark, products, stores):
    checks.require_many_to_one(products, "upc")
    with pytest.raises(ValueError):
        checks.require_many_to_one(stores, "store_num")


def test_parking_takes_median(spark, stores):
    out = clean.fill_parking(clean.stage_stores(stores)).orderBy("store_num").collect()
    assert [r.parking_space_qty for r in out] == [300.0, 399.5, 499.0]
    assert [r.has_parking_data for r in out] == [1, 0, 1]


def test_model_cleaning_drops_rows_without_price_or_units(spark):
    raw = spark.createDataFrame([tx(price=None, base=None), tx(w=1, units=0), tx(w=2, spend="0")], RAW_TRANSACTIONS)
    rows = clean.clean_for_models(raw).collect()
    assert len(rows) == 1 and rows[0].spend == D("7.5")
    assert clean.clean_for_models(raw, drop_zero_units=False).count() == 2


@pytest.fixture(scope="module")
def small_star(spark, products, stores):
    raw = spark.createDataFrame(
        [tx(), tx(w=1, f=1, d=1, t=1), tx(w=3, visits=0, hhs=0), tx(upc=11, price="4", base="3", spend="12")],
        RAW_TRANSACTIONS,
    )
    return star.build_star(raw, products, stores)


def test_dimensions(small_star):
    names = {r.upc: (r.category, r.category_code, r.description) for r in small_star.product.collect()}
    assert names[10] == ("BAG SNACKS", "SNCK", "Chips")
    assert names[12][1] == "OTHR"
    bands = {r.store_num: (r.store_size_band, r.parking_band) for r in small_star.store.collect()}
    assert bands == {1: ("Small", "Medium"), 2: ("Large", "Unknown"), 3: ("Unknown", "Medium")}


def test_calendar_has_every_week(small_star):
    weeks = small_star.calendar.orderBy("week_end_date").collect()
    assert [r.week_of_year for r in weeks] == [1, 2, 3, 4]
    assert weeks[0].date_key == 20240106 and weeks[0].month_name == "January"


def test_fact_metrics(small_star):
    rows = {(r.date_key, r.upc): r for r in small_star.fact.collect()}
    plain, combined = rows[20240106, 10], rows[20240113, 10]
    assert plain.discount_pct == D("16.6667") and plain.price_gap == D("0.5") and plain.promo_type == "NONE"
    assert combined.promo_type == "COMBINED" and combined.is_promoted
    assert rows[20240127, 10].revenue_per_visit is None and rows[20240127, 10].units_per_hh is None
    assert rows[20240106, 11].discount_pct == D("-33.3333")


def test_all_lever_combinations(spark):
    rows = spark.createDataFrame(
        [(f, d, t) for f in (0, 1) for d in (0, 1) for t in (0, 1)], "feature int, display int, tpr_only int"
    ).withColumn("kind", promo_type("feature", "display", "tpr_only"))
    assert {(r.feature, r.display, r.tpr_only): r.kind for r in rows.collect()} == {
        (0, 0, 0): "NONE", (0, 0, 1): "TPR_ONLY", (0, 1, 0): "DISPLAY_ONLY", (1, 0, 0): "FEATURE_ONLY",
        (0, 1, 1): "DISPLAY_TPR", (1, 0, 1): "FEATURE_TPR", (1, 1, 0): "FEATURE_DISPLAY", (1, 1, 1): "COMBINED",
    }


def test_zero_weeks_and_filled_panel(small_star):
    sold = small_star.fact.count()
    panel_rows = small_star.store.count() * small_star.product.count() * small_star.calendar.count()
    assert zero_weeks(small_star).count() == panel_rows - sold
    filled = zero_filled(small_star)
    assert filled.count() == panel_rows
    assert filled.groupBy("store_num", "upc", "week_end_date").count().filter("count > 1").isEmpty()
    active = zero_weeks(small_star, active_only=True).collect()
    assert {(r.store_num, r.upc) for r in active} == {(1, 10), (1, 11)}
    assert len(active) == 1 + 3


def test_members_without_facts(small_star):
    rows = {(r.member_key, r.member) for r in explore.members_without_facts(small_star).collect()}
    assert rows == {(12, "Unsold"), (2, "Two"), (3, "Three")}


def test_week_gap(spark):
    df = spark.createDataFrame([(week(0),), (week(0),), (week(1),), (week(3),)], "week_end_date date")
    rows = week_gaps(df).collect()
    assert [(r.gap_after_week, r.next_week, r.days_between) for r in rows] == [(week(1), week(3), 14)]


def test_calendar_lag_does_not_reach_over_gaps(spark):
    df = spark.createDataFrame([("a", week(0), 1), ("a", week(1), 2), ("a", week(3), 4)], "k string, w date, v int")
    rows = {r.w: r.before for r in lag_by_weeks(df, "w", "v", ["k"], 1, "before").collect()}
    assert rows == {week(0): None, week(1): 1, week(3): None}


def test_outliers_of_visits_per_household(spark):
    df = spark.createDataFrame([(1, 12, 2), (2, 10, 2), (3, 5, 0)], "id int, visits int, hhs int")
    rows = checks.ratio_outliers(df, "visits", "hhs", 5, "visits_per_hh", ["id"], 50).collect()
    assert [(r.id, r.visits_per_hh) for r in rows] == [(1, 6.0)]


def test_mart_reaggregates_to_the_direct_report(small_star):
    from shelfwise.operators.rollup import kpi_rollup

    direct = kpi_rollup(
        small_star.sales("product"),
        ["category"],
        ["total_units", "total_revenue", "avg_price", "avg_discount_pct", "promo_rate_pct", "avg_basket_value"],
    )
    again = star.reaggregate_mart(star.mart_weekly_store_category(small_star), "category")
    key = lambda df: sorted(tuple(r) for r in df.select(sorted(df.columns)).collect())
    assert key(direct) == key(again)


def test_write_read_and_partition_refresh(spark, small_star, tmp_path):
    path = str(tmp_path / "fact")
    panel.write_table(small_star.fact, path, partition_by=("year",), cluster_by=("date_key", "store_num", "upc"))
    assert spark.read.parquet(path).count() == 4
    changed = small_star.fact.filter("upc = 11").withColumn("year", F.lit(2030))
    marts.refresh_mart(changed, path, ("year",))
    years = {r.year: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()}
    assert years == {2024: 4, 2030: 1}


def test_csv_source_uses_declared_schema(spark, products, tmp_path):
    path = str(tmp_path / "products")
    products.write.option("header", True).csv(path)
    back = panel.read_sources(spark, {"products": path}, "csv")["products"]
    assert back.schema == products.schema and back.count() == 3


def test_half_up_treats_binary_ties_as_ties(spark):
    df = spark.createDataFrame([(1.005,), (-1.005,), (2.675,), (0.0,)], "x double")
    assert [r[0] for r in df.select(half_up("x", 2)).collect()] == [1.01, -1.01, 2.68, 0.0]


def test_band_edges(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (5.005,), (None,)], "x double")
    left = [r[0] for r in df.select(band("x", (5,), ("low", "high"), null_label="none")).collect()]
    right = [r[0] for r in df.select(band("x", (5,), ("low", "high"), right_closed=True)).collect()]
    assert left == ["low", "high", "high", "none"] and right == ["low", "low", "high", None]


def test_seasons(spark):
    df = spark.range(1, 13)
    got = [r[0] for r in df.select(season("id")).collect()]
    assert got == ["Winter"] * 2 + ["Spring"] * 3 + ["Summer"] * 3 + ["Fall"] * 3 + ["Winter"]
    assert set(got) == set(labels.SEASONS)
