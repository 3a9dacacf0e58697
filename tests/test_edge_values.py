"""Missing attributes, odd keys, short series, large numbers and heavy tails lose and move nothing."""

import datetime
import random

import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up
from shelfwise.operators import features, forecast, models, scale
from shelfwise.sources.crosswalk import upc_of


def test_rounding_keeps_large_numbers_and_near_ties(spark):
    values = [(1e12, 2, 1e12), (7e11, 2, 7e11), (1.005, 2, 1.01), (-1.005, 2, -1.01), (2.675, 2, 2.68), (0.125, 2, 0.13),
              (123456789.125, 2, 123456789.13), (1e300, 2, 1e300), (1.4999, 0, 1.0), (0.1 + 0.2, 6, 0.3)]
    for x, digits, want in values:
        got = spark.range(1).select(half_up(F.lit(x), digits).alias("r")).first()["r"]
        assert got == want, (x, digits, got)
    odd = spark.createDataFrame([(float("nan"),), (None,)], "x double").select(half_up("x", 2).alias("r")).collect()
    assert odd[0]["r"] != odd[0]["r"] and odd[1]["r"] is None


def test_product_codes_tell_null_from_text(spark):
    pairs = [("x", None), (None, "x"), (None, None), ("x", "x"), ("", "x"), ("x|1", "y"), ("x", "1|y"), ("0", None)]
    df = spark.createDataFrame(pairs, "a string, b string").select(upc_of("a", "b").alias("upc"))
    codes = [r["upc"] for r in df.collect()]
    assert None not in codes and len(set(codes)) == len(pairs) and min(codes) > 0


def test_encoding_keeps_rows_without_attributes(spark):
    rows = [(1, "A", "VALUE"), (2, None, "VALUE"), (None, "B", None), (1, "B", "UPSCALE")]
    df = spark.createDataFrame(rows, "store_num int, category string, seg_value_name string")
    out = {(r["store_num"], r["category"]): r for r in features.encode(df).collect()}
    assert len(out) == 4
    assert [out[k]["category_enc"] for k in ((1, "A"), (1, "B"), (2, None))] == [0, 1, 2]
    assert out[(None, "B")]["store_num_enc"] == 2 and out[(None, "B")]["seg_value_name_enc"] == 2


@pytest.mark.parametrize("steps", [12, 20])
def test_every_series_is_forecast(spark, steps):
    rng = random.Random(1)
    first = datetime.date(2020, 1, 4)
    rows = []
    for name, weeks in (("long", 90), ("other", 80), ("short", steps + 3), ("tiny", 10), ("one", 1)):
        start = 90 - weeks
        rows += [(name, first + datetime.timedelta(weeks=start + w), float(rng.randrange(50, 60))) for w in range(weeks)]
    weekly = spark.createDataFrame(rows, "s string, week_end_date date, v double")
    estimator = GBTRegressor(featuresCol="features", labelCol=models.TARGET, maxIter=2, maxDepth=2, seed=1)
    out = forecast.recursive(weekly, ["s"], "v", estimator, steps)
    counts = {r["s"]: (r["n"], r["p"]) for r in out.groupBy("s").agg(F.count("*").alias("n"), F.count("prediction").alias("p")).collect()}
    assert counts == {"long": (steps, steps), "other": (steps, steps), "short": (steps, steps), "tiny": (10, 10), "one": (1, 1)}
    _, table = forecast.fit_boosted(weekly, ["s"], "v", estimator, steps)
    assert table.filter("NOT is_test").agg(F.min("back")).first()[0] == steps + 1


def test_buckets_hold_outliers_and_tails_apart(spark):
    values = [1e9] + [1 / (1 + i) for i in range(5000)] + [float(i) for i in range(200)] + [-3.5, -1e7, 0.0]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "x double, i int")
    sizes = df.select(scale.value_bucket(F.col("x")).alias("b"), "x").groupBy("b").agg(F.count("*").alias("n"), F.min("x").alias("lo"))
    buckets = sizes.orderBy("b").collect()
    assert [r["lo"] for r in buckets] == sorted(r["lo"] for r in buckets) and max(r["n"] for r in buckets) < 120
    placed = scale.with_positions(df, "x", ["i"], descending=False).select("i", "position").collect()
    order = sorted(range(len(values)), key=lambda i: (values[i], i))
    assert {r["i"]: r["position"] for r in placed} == {i: p + 1 for p, i in enumerate(order)}
    got = scale.group_quantiles(df, [], "x", {"q": 0.5}).first()["q"]
    ranked = sorted(values)
    middle = (len(ranked) - 1) / 2
    assert abs(got - (ranked[int(middle)] + ranked[-(-int(2 * middle) // 2)]) / 2) < 1e-4
