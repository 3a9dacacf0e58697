"""Marts: navigation, refresh by week, sketches, the gate, pair statistics and calendar frames."""

import datetime as dt
import itertools
import math
import random
import statistics

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfwise.operators import attribution, forecast, gram, models, sketches, trend
from shelfwise.operators.features import history_features
from shelfwise.operators.navigate import INPUTS, additive_columns, measures_over_mart
from shelfwise.operators.rollup import kpi_rollup
from shelfwise.plans import catalog, views
from shelfwise.plans.context import REGISTRY, Context
from shelfwise.sources import gate
from shelfwise.sources.refresh import WeeklyMart
from shelfwise.sources.workspace import Workspace


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- navigation


@pytest.mark.parametrize("name", ["m2_category_kpis", "m3_segment_kpis", "m4_state_kpis", "m5_manufacturer_kpis", "s1_weekly_trend", "st1_store_ranking"])
def test_reports_from_marts_do_not_read_the_fact(spark, sf_dir, name):
    text = plan(REGISTRY[name](Context(spark, sf_dir)))
    assert "-mart-" in text and "/fact" not in text


def test_navigation_gives_the_rows_of_the_fact(spark, sf_dir):
    cx = Context(spark, sf_dir)
    measures = ["total_revenue", "avg_price", "avg_discount_pct", "promo_rate_pct", "row_count", "min_price", "max_price", "max_spend", "promoted_rows"]
    for by, more, mart in (
        (["category"], ["product_count"], "product"), (["state", "year"], ["store_count"], "store_week"),
        (["seg_value_name", "category"], ["week_count"], "store_week_category"), (["month_name"], [], "week"), (["city"], [], "store"),
        (["category"], ["product_count", "store_count"], None), (["description"], ["price_stddev"], None),
    ):
        asked = [*measures, *more]
        chosen = cx.marts.choose(by, asked)
        assert (chosen.name if chosen else None) == mart, by
        got = cx.marts.rollup(by, asked, {"share": ("revenue", [])}, {"place": ("revenue", [])})
        want = kpi_rollup(cx.sales("product", "store", "calendar"), by, asked, {"share": ("revenue", [])}, {"place": ("revenue", [])})
        assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())), by


# --- refresh


def fact_like(spark, rows):
    return spark.createDataFrame(rows, "date_key int, category string, units long")


def test_refresh_reads_changed_weeks_only(spark, tmp_path):
    rng = random.Random(2)
    rows = [(20200101 + 7 * w, rng.choice("abc"), rng.randrange(9)) for w in range(12) for _ in range(20)]
    sums, merged = [F.sum("units").alias("units"), F.count(F.lit(1)).alias("n")], [F.sum("units").alias("units"), F.sum("n").alias("n")]
    mart = WeeklyMart(spark, f"{tmp_path}/m", ["category"], sums, merged)

    def check(now, weeks):
        spark.createDataFrame(now, "date_key int, category string, units long").repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/f")
        fact = spark.read.parquet(f"{tmp_path}/f")
        assert mart.refresh(fact) == weeks
        want = fact.groupBy("category").agg(*sums)
        assert sorted(map(tuple, mart.read().collect())) == sorted(map(tuple, want.collect()))
        return fact

    check(rows, sorted({r[0] for r in rows}))
    check(rows[::-1], [])  # order is not a change
    changed = [(w, c, u + (w in (20200108, 20200129))) for w, c, u in rows]
    fact = check(changed, [20200108, 20200129])
    text = plan(mart.delta(fact, [20200108, 20200129]))
    assert "PushedFilters: [In(date_key, [20200108,20200129])" in text
    gone = [r for r in changed if r[0] != 20200115] + [(20200500, "d", 1), (20200108, "a", 0)]
    check(gone, [20200108, 20200500])
    check(gone + [gone[0]], [gone[0][0]])  # a repeated row is a change


def test_refreshed_mart_equals_the_full_one(spark, sf_dir):
    cx = Context(spark, sf_dir)
    mart, weeks = views.corrected(cx, "mv3_refreshed")
    dims, by, measures = views.REFRESHED["mv3_refreshed"]
    rows = cx.star.sales(*dims).select("date_key", *by, *INPUTS)
    full = rows.groupBy("date_key", *by).agg(*additive_columns()).groupBy(*by).agg(*measures_over_mart(measures))
    assert len(weeks) == 2 and sorted(map(tuple, mart.read().collect())) == sorted(map(tuple, full.collect()))


# --- sketches


def test_bitmaps_are_exact_and_sketches_near(spark):
    rng = random.Random(3)
    rows = [(rng.randrange(30), rng.randrange(90_000), rng.gauss(50, 9)) for _ in range(60_000)] + [(3, None, None)]
    df = spark.createDataFrame(rows, "week int, item long, price double")
    coded = df.join(sketches.codes(df, "item"), "item", "left")
    mart = sketches.bitmap_mart(coded, ["week"])
    got = {r["half"]: r["n"] for r in sketches.distinct_of_bitmaps(mart.withColumn("half", F.col("week") % 2), ["half"], "n").collect()}
    exact = {h: len({i for w, i, _ in rows if w % 2 == h and i is not None}) for h in (0, 1)}
    assert got == exact and mart.select("bucket").distinct().count() == 2
    sketched = sketches.sketch_mart(df, ["week"], ["item"], ["price"]).withColumn("half", F.col("week") % 2)
    for r in sketches.of_sketches(sketched, ["half"], ["item"], {"price": {"p10": 0.1, "p50": 0.5, "p99": 0.99}}).collect():
        assert abs(r["item_distinct"] - exact[r["half"]]) < 3 * 1.04 / 2 ** (sketches.LG / 2) * exact[r["half"]]
        values = sorted(p for w, _, p in rows if w % 2 == r["half"] and p is not None)
        for name, q in (("p10", 0.1), ("p50", 0.5), ("p99", 0.99)):
            rank = sum(v <= r[name] for v in values) / len(values)
            assert abs(rank - q) < 0.03


# --- gate


def broken_rules():
    return {"negative": F.col("units") < 0, "no price": F.col("price") <= 0}


def test_gate_writes_once_and_keeps_every_row(spark, tmp_path):
    rows = [(i, -1 if i % 50 == 0 else 1, None if i % 3 else (0.0 if i % 99 == 0 else 2.0)) for i in range(4000)]
    spark.createDataFrame(rows, "id int, units int, price double").write.parquet(f"{tmp_path}/in")
    df = spark.read.parquet(f"{tmp_path}/in")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    report = gate.gated_write(df, broken_rules(), f"{tmp_path}/out", stop=None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) - before == 1  # one job, one scan
    bad = {"negative": sum(u < 0 for _, u, _ in rows), "no price": sum(p == 0 for _, _, p in rows)}
    assert report.per_rule == bad and report.rows == 4000 and report.grade.startswith("FAIL")
    sound, broken = (gate.read_part(df, f"{tmp_path}/out", part) for part in (gate.SOUND, gate.BROKEN))
    assert sorted(tuple(r)[:3] for r in sound.union(broken).collect()) == sorted(rows)
    assert {r["id"]: r["broken_rules"] for r in broken.collect()}[0] == ["negative", "no price"]
    assert sound.where(F.size("broken_rules") > 0).count() == 0 and broken.count() == report.broken


def test_gate_stops_on_fail(spark, tmp_path):
    df = spark.createDataFrame([(i, i - 1, 1.0) for i in range(100)], "id int, units int, price double")
    with pytest.raises(gate.GateError) as error:
        gate.gated_write(df, broken_rules(), f"{tmp_path}/out")
    assert error.value.report.per_rule == {"negative": 1, "no price": 0}
    assert gate.read_part(df, f"{tmp_path}/out", gate.SOUND).count() == 0
    assert [r["id"] for r in gate.read_part(df, f"{tmp_path}/out", gate.BROKEN).collect()] == [0]
    fine = gate.gated_write(df.where("id > 0"), broken_rules(), f"{tmp_path}/out")
    assert fine.grade.startswith("PASS") and gate.read_part(df, f"{tmp_path}/out", gate.SOUND).count() == 99
    assert gate.gated_write(df.limit(0), broken_rules(), f"{tmp_path}/none").rows == 0


# --- pairs


@pytest.mark.parametrize("block", [gram.BLOCK, 3])
def test_pair_statistics_against_a_list_of_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(gram, "BLOCK", block)
    monkeypatch.setattr(gram, "CHUNK", 16 if block == 3 else gram.CHUNK)
    rng = random.Random(4)
    cells = {(g, u, m): (rng.randrange(-50, 50), rng.randrange(5)) for g in "pq" for u in range(80) for m in range(10) if rng.random() < 0.4}
    df = spark.createDataFrame([(*k, *v) for k, v in cells.items()], "g string, u int, m long, x long, y long")
    got = {(r["g"], r["a"], r["b"]): r for r in gram.pair_stats(df, ["g"], ["u"], "m", "x", "y").withColumn("r", gram.correlation()).collect()}
    want = {}
    for (g, u, a), (xa, ya) in cells.items():
        for b in range(a + 1, 10):
            if (g, u, b) in cells:
                want.setdefault((g, a, b), []).append((xa, *cells[g, u, b][:1], ya, cells[g, u, b][1]))
    assert set(got) == set(want)
    for key, met in want.items():
        r = got[key]
        assert (r["n"], r["xa"], r["xb"], r["ya"], r["yb"]) == (len(met), *(sum(c) for c in zip(*met, strict=True)))
        assert (r["a_wins"], r["b_wins"]) == (sum(ya > yb for _, _, ya, yb in met), sum(ya < yb for _, _, ya, yb in met))
        gaps, diffs = [xa - xb for xa, xb, _, _ in met], [ya - yb for _, _, ya, yb in met]
        if len(met) > 2 and len(set(gaps)) > 1 and len(set(diffs)) > 1:
            assert r["r"] == pytest.approx(statistics.correlation(gaps, diffs), abs=1e-9)
    every = gram.pair_stats(df.where("g = 'p'"), [], ["u"], "m", "x", "y")
    assert {(r["a"], r["b"]): r["n"] for r in every.collect()} == {k[1:]: len(v) for k, v in want.items() if k[0] == "p"}


# --- calendar frames and smoothing


def test_calendar_frames_over_gaps(spark):
    start = dt.date(2020, 1, 4)
    weeks = [0, 1, 2, 4, 5, 9, 60, 61, 113]
    rows = [(s, start + dt.timedelta(weeks=w), float(w + 1)) for s in "ab" for w in weeks]
    df = spark.createDataFrame(rows, "s string, week_end_date date, y double")
    w = trend.calendar_series("week_end_date", ["s"])
    out = df.select("s", "week_end_date", trend.calendar_lag("y", w, 1).alias("l1"), trend.calendar_lag("y", w, -1).alias("f1"),
                    trend.calendar_lag("y", w, 52).alias("l52"), trend.calendar_mean("y", w, -3, 0, None).alias("m"))
    for r in out.collect():
        at = (r["week_end_date"] - start).days // 7
        has = lambda k: float(k + 1) if k in weeks else None
        assert (r["l1"], r["f1"], r["l52"]) == (has(at - 1), has(at + 1), has(at - 52))
        assert r["m"] == statistics.mean(k + 1 for k in weeks if at - 3 <= k <= at)
    rows = [(1, 2, d, float(i)) for i, (_, d, _) in enumerate(rows[: len(weeks)])]
    panel = spark.createDataFrame(rows, "store_num int, upc long, week_end_date date, units double")
    for r in history_features(panel, fill=False, calendar=True).collect():
        at = (r["week_end_date"] - start).days // 7
        assert r["sales_last_2_week"] == (float(weeks.index(at - 2)) if at - 2 in weeks else None)


def test_smoothing_like_plain_recursion(spark):
    rng = random.Random(5)
    start, season = dt.date(2020, 1, 4), 4
    series = {"a": [rng.uniform(5, 9) + 3 * (i % season) + i * 0.2 for i in range(40)], "b": [float(i % season) for i in range(22)], "c": [1.0] * 15}
    rows = [(k, start + dt.timedelta(weeks=i), y) for k, ys in series.items() for i, y in enumerate(ys)]
    df = spark.createDataFrame(rows, "k string, week_end_date date, y double")
    got = {}
    for r in sorted(forecast.seasonal_smoothing(df, ["k"], "y", season).collect()):
        got.setdefault(r["k"], []).append((r["actual"], r["prediction"]))
    assert set(got) == {"a", "b"}  # the third has too few rows before its holdout
    for k, found in got.items():
        ys, fits = series[k][: -forecast.HOLDOUT], []
        for no, (a, b, c) in enumerate(forecast.SMOOTHING):
            level = sum(ys[:season]) / season
            slope, seasons, sse = 0.0, [y - level for y in ys[:season]], 0.0
            for i in range(season, len(ys)):
                e = ys[i] - (level + slope + seasons[i % season])
                level, slope = level + slope + a * e, slope + a * b * e
                seasons[i % season] += c * (1 - a) * e
                sse += e * e
            fits.append((sse, no, level, slope, seasons))
        _, _, level, slope, seasons = min(fits)
        want = [level + (h + 1) * slope + seasons[(len(ys) + h) % season] for h in range(forecast.HOLDOUT)]
        assert [p for _, p in found] == pytest.approx(want, abs=1e-4) and [x for x, _ in found] == series[k][-forecast.HOLDOUT :]


def test_new_queries_are_registered_with_twins():
    twins = catalog.oracles()
    names = "ar2_basket_itemsets ar3_basket_rules ar2_store_week_itemsets mv1_refreshed mv2_refreshed mv3_refreshed io6_recomputed_weeks".split()
    names += "x12_distinct_by_quarter v12_gate_report v7_quarantined_rows w3_calendar_lags fe5_calendar_lags ct4_zero_week_runs ts13_seasonal_smoothing".split()
    assert all(n in twins for n in names) and list(itertools.islice(twins, 1))


# --- attributions and layout


def plain_contributions(trees, x):
    """Over all subsets of features, with unknown ones followed by both sides."""
    def known(leaves, subset):
        total = 0.0
        for leaf in leaves:
            part = leaf.value
            for f, low, high, share in leaf.conditions:
                part *= float(low < x[f] <= high) if f in subset else share
            total += part
        return total

    n, leaves = len(x), [leaf for tree in trees for leaf in tree]
    out = []
    for j in range(n):
        rest = [k for k in range(n) if k != j]
        out.append(sum(
            math.factorial(len(s)) * math.factorial(n - 1 - len(s)) / math.factorial(n) * (known(leaves, {*s, j}) - known(leaves, set(s)))
            for size in range(n) for s in itertools.combinations(rest, size)
        ))
    return out, known(leaves, set())


def test_contributions_of_fitted_trees(spark, tmp_path):
    rng = random.Random(6)
    rows = [(float(rng.randrange(6)), rng.random(), float(rng.randrange(3)), rng.random()) for _ in range(300)]
    df = spark.createDataFrame([(*r, 3 * r[0] * r[1] + r[2] ** 2 + rng.random()) for r in rows], "a double, b double, c double, d double, units double")
    columns = ["a", "b", "c", "d"]
    model = models.fit(df, GBTRegressor(featuresCol="features", labelCol="units", maxIter=5, maxDepth=3, seed=1), columns)
    model.write().overwrite().save(f"{tmp_path}/m")
    trees = attribution.saved_leaves(spark, model, f"{tmp_path}/m")
    found = attribution.attribute(trees, df.withColumn("p", F.monotonically_increasing_id()), columns, ["p", *columns[:0]]).collect()
    scored = model.transform(df.withColumn("p", F.monotonically_increasing_id())).collect()
    truth = {r["p"]: r for r in scored}
    for r in found:
        assert r["base"] + sum(r[c] for c in columns) == pytest.approx(truth[r["p"]]["prediction"], abs=1e-6)
    for r in found[:12]:
        want, base = plain_contributions(trees, [truth[r["p"]][c] for c in columns])
        assert [r[c] for c in columns] == pytest.approx(want, abs=1e-9) and r["base"] == pytest.approx(base, abs=1e-9)


def test_bucketed_windows_need_no_exchange(spark, sf_dir):
    text = plan(REGISTRY["io8_bucketed_lags"](Context(spark, sf_dir)))
    assert "Window" in text and "Exchange" not in text


def test_halving_keeps_the_better_settings(spark):
    rng = random.Random(7)
    start = dt.date(2020, 1, 4)
    rows = [(start + dt.timedelta(weeks=w), x, y, 5 * x + y) for w in range(12) for x, y in [(float(rng.randrange(9)), rng.random()) for _ in range(25)]]
    df = spark.createDataFrame(rows, "week_end_date date, x double, z double, units double")
    space = {"maxIter": (6, 9), "maxDepth": (1, 3), "stepSize": (0.1,), "subsamplingRate": (1.0,)}
    found = models.halving_search(df, 4, 2, space, ["x", "z"], rungs=(1 / 3, 1.0), keep=0.5, parallel=2).collect()
    assert [r["rung"] for r in found] == [2, 2, 1, 1] and found[0]["mean_mae"] <= found[1]["mean_mae"]
    assert sorted(r["draw"] for r in found) == [1, 2, 3, 4] and all(r["rounds"] == (r["maxIter"] if r["rung"] == 2 else round(r["maxIter"] / 3)) for r in found)
    assert max(r["mean_mae"] for r in found if r["rung"] == 1) >= found[0]["mean_mae"]
