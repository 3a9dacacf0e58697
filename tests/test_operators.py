"""Ranks, shares, scale-out ranks, trends and comparisons on small rows."""

import collections
import datetime as dt
import itertools
import random
import statistics

import pytest
from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from shelfwise.functions import labels
from shelfwise.operators import errors, features, models, price, rules, scale
from shelfwise.operators.rank import dense_rank_desc, position_desc, rank_desc, top_bottom
from shelfwise.operators.share import class_of_running_share, share_pct
from shelfwise.plans.advanced import dead_zones
from shelfwise.plans.context import Context
from shelfwise.plans.rankings import yearly_rank_shift


def skewed(spark, n=600):
    """A third of the rows share one value, and one tie key holds most of them."""
    rnd = random.Random(5)
    rows = []
    for i in range(n):
        v = 7.25 if i % 3 == 0 else round(rnd.uniform(-50, 50), 1)
        rows.append((v, rnd.choice([1, 1, 1, 1, 2, 3]), i))
    return spark.createDataFrame(rows, "v double, store int, upc int")


@pytest.mark.parametrize("tiles", [4, 5, 7, 601, 1000])
def test_global_ntile_equals_window_ntile(spark, tiles):
    df = skewed(spark)
    plain = F.ntile(tiles).over(Window.orderBy(F.desc("v"), "store", "upc"))
    out = scale.global_ntile(df, "v", ["store", "upc"], tiles, "t").withColumn("w", plain)
    assert out.filter("t <> w").isEmpty() and out.count() == 600


def test_global_positions_and_percentiles(spark):
    df = skewed(spark)
    asc = Window.orderBy("v")
    placed = scale.with_positions(df, "v", ["store", "upc"], descending=False)
    check = placed.withColumn("p", F.row_number().over(Window.orderBy("v", "store", "upc"))).withColumn(
        "r", F.rank().over(asc)
    )
    assert check.filter("p <> position OR r <> rank_value").isEmpty()
    both = scale.global_percentiles(df, "v", ["store", "upc"]).select(
        "*", F.percent_rank().over(asc).alias("pr"), F.cume_dist().over(asc).alias("cd")
    )
    assert both.filter("abs(pr - percent_rank) > 1e-12 OR abs(cd - cume_dist) > 1e-12").isEmpty()


def test_single_value_everywhere(spark):
    df = spark.range(10).select(F.lit(1.0).alias("v"), F.lit(1).alias("store"), F.col("id").cast("int").alias("upc"))
    tiles = [r.t for r in scale.global_ntile(df, "v", ["store", "upc"], 3, "t").orderBy("upc").collect()]
    assert tiles == [1] * 4 + [2] * 3 + [3] * 3


def test_group_quantiles_are_exact(spark):
    df = skewed(spark).unionByName(spark.createDataFrame([(None, 9, 0), (4.0, 9, 1)], "v double, store int, upc int"))
    got = {r.store: r for r in scale.group_quantiles(df, ["store"], "v", {"q1": 0.25, "q2": 0.5}).collect()}
    for store in (1, 2, 3):
        xs = sorted(r.v for r in df.filter(f"store = {store}").collect())
        assert got[store].q1 == pytest.approx(statistics.quantiles(xs, n=4, method="inclusive")[0], abs=1e-4)
        assert got[store].q2 == pytest.approx(statistics.median(xs), abs=1e-4)
    assert got[9].q2 == 4.0
    whole = scale.group_quantiles(df, [], "v", {"q2": 0.5}).first().q2
    assert whole == pytest.approx(statistics.median(r.v for r in df.collect() if r.v is not None), abs=1e-4)


def test_price_quartiles_equal_window_quartiles(spark):
    rnd = random.Random(1)
    rows = [
        (1 if i % 3 else 2, 20240101 + i % 7, i, 5.0 if i % 3 == 1 else rnd.choice([1.0, 2.5, 9.0])) for i in range(300)
    ]
    df = spark.createDataFrame(rows, "upc int, date_key int, store_num int, price double")
    plain = F.ntile(4).over(Window.partitionBy("upc").orderBy("price", "date_key", "store_num"))
    assert price.price_quartiles(df).withColumn("w", plain).filter("price_quartile <> w").isEmpty()


def test_tied_ranks(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "k string, v int").select(
        "k", rank_desc("v").alias("r"), dense_rank_desc("v").alias("d"), position_desc("v", ["k"]).alias("p")
    )
    assert {r.k: (r.r, r.d, r.p) for r in df.collect()} == {"a": (1, 1, 1), "b": (1, 1, 2), "c": (3, 2, 3)}


def test_top_bottom_keeps_ties_only_when_asked(spark):
    df = spark.createDataFrame([("a", 5), ("b", 5), ("c", 1)], "k string, v int")
    args = (df, "v", ("TOP", 1), ("LOW", 1), ["k"], "side", "rank")
    assert top_bottom(*args).count() == 2
    assert top_bottom(*args, keep_ties=True).filter("side = 'TOP'").count() == 2


def test_running_share_classes(spark):
    df = spark.createDataFrame([(1, 60.0), (2, 10.0), (3, 20.0), (4, 10.0)], "upc int, v double")
    out = class_of_running_share(df, "v", ["upc"], labels.ABC_CUTS, labels.ABC_CLASSES, "c")
    assert {r.upc: r.c for r in out.collect()} == {1: "A", 3: "B", 2: "B", 4: "C"}


def test_shares_sum_to_hundred(spark, sf_dir):
    sales = Context(spark, sf_dir).sales("product")
    by = sales.groupBy("category", "upc").agg(F.sum("spend").alias("v"))
    sums = by.withColumn("s", share_pct("v", "category", digits=6)).groupBy("category").agg(F.sum("s").alias("s"))
    assert all(abs(r.s - 100) < 1e-3 for r in sums.collect())


def test_rank_shift_over_a_missing_year_is_new(spark):
    rows = [(2020, 1, "a", "c", 5.0, 1), (2022, 1, "a", "c", 5.0, 1), (2020, 2, "b", "c", 9.0, 1), (2021, 2, "b", "c", 1.0, 1)]
    df = spark.createDataFrame(rows, "year int, upc int, description string, category string, spend double, units int")
    got = {(r.year, r.upc): r.trend_direction for r in yearly_rank_shift(df).collect()}
    assert got[2022, 1] == labels.SHIFT_NEW and got[2021, 2] == labels.SHIFT_SAME


def test_dead_zone_alerts_at_the_third_quarter(spark):
    spend = [10.0, 9.0, 9.0, 8.0, 12.0]
    rows = [(1, "c", 2020 + i // 4, i % 4 + 1, s) for i, s in enumerate(spend)]
    sales = spark.createDataFrame(rows, "store_num int, category string, year int, quarter int, spend double")
    stores = spark.createDataFrame([(1, "One", "VALUE")], "store_num int, store_name string, seg_value_name string")
    found = [(r.year, r.quarter) for r in dead_zones(sales, stores).collect()]
    assert found == [(2020, 4)]


def test_discount_buckets_have_no_holes(spark):
    df = spark.createDataFrame([(-0.5,), (0.0,), (5.0,), (5.005,), (30.0,), (30.1,)], "discount_pct double")
    got = [r[0] for r in df.select(price.discount_bucket()).collect()]
    b = labels.DISCOUNT_BUCKETS
    assert got == [labels.DISCOUNT_ABOVE_BASE, b[0], b[1], b[2], b[5], b[6]]


def weeks(n):
    return [dt.date(2024, 1, 6) + dt.timedelta(days=7 * i) for i in range(n)]


def test_history_is_leak_free(spark):
    rows = [(1, 1, w, float(i + 1)) for i, w in enumerate(weeks(6))] + [(2, 1, weeks(1)[0], 9.0)]
    df = spark.createDataFrame(rows, "store_num int, upc int, week_end_date date, units double")
    got = {(r.store_num, r.units): r for r in features.history_features(df).collect()}
    first, last, lone = got[1, 1.0], got[1, 6.0], got[2, 9.0]
    assert (first.has_history, first.sales_last_1_week, first.rolling_mean_4w, first.rolling_std_4w) == (0, 0, 0, 0)
    assert (last.sales_last_1_week, last.sales_last_4_week, last.rolling_mean_4w) == (5.0, 2.0, 3.5)
    assert last.rolling_std_4w == pytest.approx(statistics.stdev([2, 3, 4, 5]), abs=1e-6)
    assert got[1, 2.0].rolling_std_4w == 0.0
    assert lone.has_history == 0 and lone.moving_avg_8w == 0.0


def test_zero_denominators(spark):
    df = spark.createDataFrame([(5.0, 0, 0, 0)], "spend double, visits int, hhs int, units int")
    zero = features.sales_features(df).first()
    assert zero.revenue_per_visit == 0.0 and zero.units_per_hh == 0.0
    assert features.sales_features(df, "null").first().revenue_per_visit is None


def test_metrics(spark):
    df = spark.createDataFrame([(0.0, 0.0), (2.0, 4.0)], "units double, prediction double")
    row = models.regression_metrics(df).first()
    assert (row.mae, row.rmse, row.r2) == (1.0, 1.4142, -1.0)
    assert row.smape_pct == pytest.approx((0 + 2 * 2 / 6 * 100) / 2, abs=1e-4)


def test_folds_never_split_a_week(spark):
    df = spark.createDataFrame([(w, i) for w in weeks(13) for i in range(3)], "week_end_date date, i int")
    starts = models.fold_starts(df, 5)
    assert len(starts) == 5 and starts[0][0] == weeks(13)[3] and starts[-1][1] == weeks(13)[12]
    assert all(a[1] < b[0] for a, b in zip(starts, starts[1:]))


def test_rules_from_combinations(spark):
    rows = [(1, 1, 0)] * 4 + [(1, 0, 0)] * 4 + [(0, 0, 1)] * 2 + [(0, 0, 0)] * 5
    df = spark.createDataFrame(rows, "feature int, display int, tpr_only int")
    sets = rules.frequent_sets(rules.lever_baskets(df))
    support = {r.itemset: r.support for r in rules.itemsets(sets).collect()}
    assert support["feature_ad"] == 0.8 and support["feature_ad, in_store_display"] == 0.4
    found = {(r.antecedents, r.consequents): r for r in rules.rules(sets).collect()}
    hit = found["in_store_display", "feature_ad"]
    assert (hit.confidence, hit.lift) == (1.0, 1.25)


def plain_sets(baskets, min_support):
    """Every subset of every basket, counted."""
    counts = collections.Counter(
        c for basket in baskets for size in range(1, len(basket) + 1) for c in itertools.combinations(sorted(basket), size)
    )
    return {c: n for c, n in counts.items() if n >= min_support * len(baskets)}


@pytest.mark.parametrize("bits", [rules.BITS, 7])
def test_item_sets_against_all_subsets(spark, monkeypatch, bits):
    """Any size of set, equal baskets, empty ones, bitmaps of one block and of many."""
    monkeypatch.setattr(rules, "BITS", bits)
    monkeypatch.setattr(rules, "PLANNED", max(bits // 3, 2))
    monkeypatch.setattr(rules, "SMALL", 64 if bits > 7 else 3)
    rng = random.Random(11)
    baskets = [rng.sample("abcdefghij", rng.randrange(0, 7)) for _ in range(300)]
    baskets += [["a", "b", "c", "d", "e"]] * 37 + [list("zyx")] * 3 + [[]] * 5
    df = spark.createDataFrame([(sorted(b),) for b in baskets], "items array<string>")
    want = plain_sets(baskets, 0.02)
    got = rules.frequent_sets(df, 0.02)
    rows = got.collect()
    assert {tuple(r["items"]): r["n"] for r in rows} == want and len(rows) == len(want)
    assert max(map(len, want)) == 5 and {r["total"] for r in rows} == {len(baskets)}
    pairs = rules.frequent_sets(df, 0.02, max_size=2).collect()
    assert {tuple(r["items"]) for r in pairs} == {c for c in want if len(c) <= 2}
    found = {(r.antecedents, r.consequents): r.confidence for r in rules.rules(got, min_lift=0.0).collect()}
    both = [(a, tuple(x for x in c if x not in a)) for c in want for k in range(1, len(c)) for a in itertools.combinations(c, k)]
    assert set(found) == {(", ".join(a), ", ".join(c)) for a, c in both}
    for a, c in both:
        assert found[", ".join(a), ", ".join(c)] == pytest.approx(want[tuple(sorted(a + c))] / want[a], abs=1e-6)
    assert rules.frequent_sets(df.limit(0)).collect() == []


def test_risk_levels(spark):
    df = spark.createDataFrame(
        [(35.0, "COLD CEREAL", 10.0, 2.0), (0.0, "x", 1.0, 2.0), (0.0, "cold cereal", 1.0, 2.0)],
        "discount_pct double, category string, predicted double, rolling_mean_4w double",
    )
    got = [(r.risk_score, r.risk_level, r.high_uncertainty) for r in errors.risk_flags(df).collect()]
    assert got == [(3, "High", True), (0, "Low", False), (1, "Medium", False)]


def test_error_bucket_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (10.0,), (10.5,), (101.0,)], "discount_pct double")
    assert [r[0] for r in df.select(errors.discount_bucket()).collect()] == [None, "0%", "0-10%", "10-20%", None]


def test_model_beats_the_mean_where_a_signal_exists(spark):
    rows = []
    for i, w in enumerate(weeks(40)):
        for upc in (1, 2):
            x = float((i * 7 + upc) % 5)
            rows.append((w, upc, "c", x, 3 * x + upc))
    df = spark.createDataFrame(rows, "week_end_date date, upc int, category string, x double, units double")
    train, test = models.time_split(df)
    table = models.compare_regressors(train, test, {"Decision Tree": models.regressors()["Decision Tree"]}, ["x", "upc"])
    mae = {r.model: r.mae for r in table.collect()}
    assert mae["Decision Tree"] < mae["Baseline (UPC Mean)"]


def test_model_comparisons_hold_their_metrics_not_their_models(spark):
    rows = []
    for i, w in enumerate(weeks(30)):
        for upc in (1, 2):
            x = float((i * 7 + upc) % 5)
            rows.append((w, upc, "c", x, 3 * x + upc, int(x > 2)))
    df = spark.createDataFrame(rows, "week_end_date date, upc int, category string, x double, units double, high_sales int")
    train, test = models.time_split(df)
    plan = lambda t: t._jdf.queryExecution().analyzed().toString()
    regressions = models.compare_regressors(train, test, {"Decision Tree": models.regressors()["Decision Tree"]}, ["x", "upc"])
    tree = {"Random Forest": models.classifiers(trees=3)["Random Forest"]}
    classes = models.compare_classifiers(train, test, tree, columns=["x", "upc"])
    assert "UDF" not in plan(regressions) and "UDF" not in plan(classes)
    assert sorted(r.model for r in regressions.collect()) == ["Baseline (UPC Mean)", "Decision Tree"]
    (row,) = classes.collect()
    assert row.model == "Random Forest" and row.accuracy == 1.0 and row.auc == 1.0


def uneven_panel(spark, partitions=4):
    """Weeks in order in a few partitions, the last one with few train rows."""
    rows = [(w, upc, "c", float((i * 7 + upc) % 5), float(3 * ((i * 7 + upc) % 5) + upc)) for i, w in enumerate(weeks(24)) for upc in range(1, 9)]
    kind = "week_end_date date, upc int, category string, x double, units double"
    return spark.createDataFrame(rows, kind).repartitionByRange(partitions, "week_end_date")


@pytest.fixture
def fitted_rows(monkeypatch):
    """Name and sizes of the partitions of every table stored."""
    sizes = []
    plain = models.Workspace.table

    def table(self, df, name):
        parts = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        sizes.append((name, [r["count"] for r in parts]))
        return plain(self, df, name)

    monkeypatch.setattr(models, "DEAL_ROWS", 50, raising=False)
    monkeypatch.setattr(models.Workspace, "table", table)
    return sizes


def test_comparison_deals_its_rows_evenly(spark, fitted_rows):
    """ml4: train rows of the first weeks lie in some partitions only."""
    train, test = models.time_split(uneven_panel(spark))
    out = models.compare_regressors(train, test, {"Decision Tree": models.regressors()["Decision Tree"]}, ["x", "upc"])
    name, sizes = fitted_rows[0]
    assert name == "train" and sum(sizes) == train.count()
    assert max(sizes) * spark.sparkContext.defaultParallelism <= 1.4 * sum(sizes)
    assert {r.model: r.row_count for r in out.collect()} == dict.fromkeys(["Baseline (UPC Mean)", "Decision Tree"], test.count())


def test_search_deals_its_rows_evenly(spark, fitted_rows):
    """ml9: every fold trains on the first weeks only."""
    space = {"maxIter": (10,), "maxDepth": (2,), "stepSize": (0.1, 0.2), "subsamplingRate": (1.0,)}
    train = uneven_panel(spark)
    out = models.halving_search(train, draws=2, space=space, columns=["x", "upc"], rungs=(0.1, 0.2), parallel=1)
    ((name, sizes),) = fitted_rows
    assert name == "train" and sum(sizes) == train.count()
    assert max(sizes) * spark.sparkContext.defaultParallelism <= 1.4 * sum(sizes)
    assert out.count() == 2


def test_fit_deals_its_rows_evenly(spark, fitted_rows):
    """rc2: the boosted model and the forest are fitted on rows in the order of their weeks."""
    train, test = models.time_split(uneven_panel(spark))
    model = models.fit(train, models.regressors()["Decision Tree"], ["x", "upc"])
    ((name, sizes),) = fitted_rows
    assert name == "train" and sum(sizes) == train.count()
    assert max(sizes) * spark.sparkContext.defaultParallelism <= 1.4 * sum(sizes)
    assert models.predict(model, test).count() == test.count()


def test_small_fits_keep_their_rows_in_place(spark):
    rows = uneven_panel(spark)
    assert models.dealt(rows) is rows and models.dealt(rows, cut=True) is rows


def test_classifiers_score_after_an_observed_query(spark):
    """A fitted classifier is sent to tasks; its summary would hold the session, which can't be."""
    seen = Observation("before the fit")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = uneven_panel(spark).withColumn("high_sales", (F.col("x") > 2).cast("int"))
    train, test = models.time_split(rows)
    chosen = {k: v for k, v in models.classifiers(trees=3).items() if k != "Boosted Trees"}
    out = models.compare_classifiers(train, test, chosen, columns=["x", "upc"])
    assert sorted(r.model for r in out.collect()) == ["Logistic Regression", "Random Forest"]
