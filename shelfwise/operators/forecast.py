"""Weekly forecasts with a holdout of the last weeks, for any series key."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up
from shelfwise.operators import models

WEEK = "week_end_date"
HOLDOUT = 12
LAG_FEATURES = ("lag_1", "lag_2", "lag_4", "lag_8", "rolling_mean_4", "week_num", "month")


def mark_holdout(weekly: DataFrame, keys: Sequence[str], holdout: int = HOLDOUT) -> DataFrame:
    """``back`` counts weeks from the end of each series (1 is the last)."""
    back = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(WEEK)))
    return weekly.withColumn("back", back).withColumn("is_test", F.col("back") <= holdout)


def moving_average(weekly: DataFrame, keys: Sequence[str], value: str, window: int = 4) -> DataFrame:
    """Every holdout week gets the mean of the last train weeks."""
    marked = mark_holdout(weekly, keys)
    first_train = HOLDOUT + 1
    recent = F.when(F.col("back").between(first_train, first_train + window - 1), F.col(value))
    level = F.avg(recent).over(Window.partitionBy(*keys))
    return (
        marked.withColumn("prediction", half_up(level, 4))
        .filter("is_test")
        .select(*keys, WEEK, F.col(value).cast("double").alias("actual"), "prediction")
    )


def seasonal_naive(weekly: DataFrame, keys: Sequence[str], value: str, season: int = 52) -> DataFrame:
    """Every holdout week repeats the row one season earlier."""
    marked = mark_holdout(weekly, keys)
    before = F.lag(value, season).over(Window.partitionBy(*keys).orderBy(WEEK)).cast("double")
    return (
        marked.withColumn("prediction", before)
        .filter("is_test AND prediction IS NOT NULL")
        .select(*keys, WEEK, F.col(value).cast("double").alias("actual"), "prediction")
    )


#: Weights of level, trend and season that the smoothing chooses from, in this order.
SMOOTHING = tuple((a, b, c) for a in (0.1, 0.3, 0.5) for b in (0.0, 0.1) for c in (0.1, 0.3))


def seasonal_smoothing(
    weekly: DataFrame, keys: Sequence[str], value: str, season: int = 52, weights: Sequence[tuple] = SMOOTHING
) -> DataFrame:
    """Level, trend and season that follow each series with its own weights.

    An additive state-space model: after each week its error moves the level
    by a, the trend by a * b and the week's season by c * (1 - a) of it.  The
    first season gives the starting level and seasons; the trend starts at 0.
    The state is folded along an array of the series' train rows, once per
    weights; those with the smallest squared error on the train rows after the
    first season forecast the holdout (the earlier ones of equal errors).
    Series with less than two seasons of train rows are left out.
    """
    marked = mark_holdout(weekly, keys).withColumn("_x", F.col(value).cast("double"))
    point = F.struct(F.col(WEEK), F.col("_x"))
    rows = marked.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.when(~F.col("is_test"), point))), lambda p: p["_x"]).alias("_y"),
        F.sort_array(F.collect_list(F.when(F.col("is_test"), point))).alias("_held"),
    ).where(F.size("_y") >= 2 * season)
    grid = F.array(*[F.struct(F.lit(i).alias("no"), *[F.lit(float(w)).alias(n) for n, w in zip("abc", ws)]) for i, ws in enumerate(weights)])
    first = F.slice("_y", 1, season)
    level = F.aggregate(first, F.lit(0.0), lambda s, y: s + y) / season
    tried = rows.withColumn("_level", level).select(
        *keys, "_y", "_held", "_level", F.transform(first, lambda y: y - F.col("_level")).alias("_season"), F.explode(grid).alias("_w")
    )
    start = F.struct(
        F.col("_level").alias("l"), F.lit(0.0).alias("t"), F.col("_season").alias("s"), F.lit(0.0).alias("sse"), F.lit(0).alias("i")
    )
    w = F.col("_w")

    def step(state, y):
        at = state["i"] % season
        error = y - (state["l"] + state["t"] + F.get(state["s"], at))
        return F.struct(
            (state["l"] + state["t"] + w["a"] * error).alias("l"),
            (state["t"] + w["a"] * w["b"] * error).alias("t"),
            F.transform(state["s"], lambda x, k: F.when(k == at, x + w["c"] * (1 - w["a"]) * error).otherwise(x)).alias("s"),
            (state["sse"] + error * error).alias("sse"),
            (state["i"] + 1).alias("i"),
        )

    rest = F.slice(F.col("_y"), F.lit(season + 1), F.size("_y") - season)
    fitted = tried.withColumn("_f", F.aggregate(rest, start, step))
    best = fitted.groupBy(*keys).agg(F.min_by(F.struct("_f", "_held"), F.struct("_f.sse", "_w.no")).alias("_b"))
    ahead = best.select(*keys, F.col("_b._f").alias("_f"), F.posexplode("_b._held").alias("_h", "_p"))
    prediction = F.col("_f.l") + (F.col("_h") + 1) * F.col("_f.t") + F.get(F.col("_f.s"), (F.col("_f.i") + F.col("_h")) % season)
    return ahead.select(*keys, F.col("_p")[WEEK].alias(WEEK), F.col("_p._x").alias("actual"), half_up(prediction, 4).alias("prediction"))


def fourier_columns(df: DataFrame, origin, harmonics: int = 3, season: float = 365.25 / 7) -> tuple[DataFrame, list[str]]:
    """Trend and sine/cosine pairs of the yearly cycle."""
    step = F.datediff(F.col(WEEK), F.lit(origin)) / 7
    cols = {"trend": step.cast("double")}
    for k in range(1, harmonics + 1):
        angle = step * (2 * math.pi * k / season)
        cols[f"sin_{k}"], cols[f"cos_{k}"] = F.sin(angle), F.cos(angle)
    return df.withColumns(cols), list(cols)


def fourier_regression(weekly: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Linear regression on trend and yearly cycle.  Stands in for seasonal
    statistical models; it is a different method with the same purpose."""
    origin = weekly.agg(F.min(WEEK)).first()[0]
    marked, inputs = fourier_columns(mark_holdout(weekly, keys), origin)
    data = marked.withColumn(models.TARGET, F.col(value).cast("double"))
    line = LinearRegression(featuresCol="features", labelCol=models.TARGET)
    model = models.fit(data.filter("NOT is_test"), line, inputs)
    return models.predict(model, data.filter("is_test")).select(
        *keys, WEEK, F.col(value).cast("double").alias("actual"), "prediction"
    )


def lag_table(weekly: DataFrame, keys: Sequence[str], value: str, holdout: int = HOLDOUT) -> DataFrame:
    """One-step inputs: lags of actuals, mean of the four rows before, season."""
    w = Window.partitionBy(*keys).orderBy(WEEK)
    x = F.col(value).cast("double")
    before = w.rowsBetween(-4, -1)
    out = mark_holdout(weekly, keys, holdout).withColumns(
        {
            **{f"lag_{n}": F.lag(x, n).over(w) for n in (1, 2, 4, 8)},
            "rolling_mean_4": F.when(F.count(x).over(before) == 4, F.avg(x).over(before)),
            "week_num": F.weekofyear(WEEK).cast("double"),
            "month": F.month(WEEK).cast("double"),
        }
    )
    return out.dropna(subset=list(LAG_FEATURES)).withColumn(models.TARGET, x)


def boosted(rounds: int = 300, depth: int = 5, rate: float = 0.05) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol=models.TARGET, maxIter=rounds, maxDepth=depth, stepSize=rate,
        subsamplingRate=0.8, seed=models.SEED,
    )


def fit_boosted(
    weekly: DataFrame, keys: Sequence[str], value: str, estimator=None, holdout: int = HOLDOUT
) -> tuple[Model, DataFrame]:
    """One model over all series, trained before the holdout."""
    table = lag_table(weekly, keys, value, holdout)
    model = models.fit(table.filter("NOT is_test"), estimator or boosted(), LAG_FEATURES)
    return model, table


def one_step(weekly: DataFrame, keys: Sequence[str], value: str, estimator=None, model: Model | None = None) -> DataFrame:
    """Holdout predictions one week ahead, from actual lags; ``model`` if it is fitted already."""
    table = lag_table(weekly, keys, value)
    model = model or fit_boosted(weekly, keys, value, estimator)[0]
    return models.predict(model, table.filter("is_test")).select(
        *keys, WEEK, F.col(models.TARGET).alias("actual"), "prediction"
    )


def recursive(
    weekly: DataFrame, keys: Sequence[str], value: str, estimator=None, steps: int = HOLDOUT, model: Model | None = None
) -> DataFrame:
    """Holdout predictions that feed on themselves: only train weeks are known.

    Each series carries its last eight values as an array; a step reads the
    lags from it, predicts all series in one transform and pushes the result.
    Every series is forecast: one with fewer than eight train weeks has its
    first one repeated before them, one without any starts from the mean of all
    train weeks.
    """
    model = model or fit_boosted(weekly, keys, value, estimator, steps)[0]
    marked = mark_holdout(weekly, keys, steps).withColumn("actual", F.col(value).cast("double"))
    known = F.when(~F.col("is_test") & (F.col("back") <= steps + 8), F.struct(WEEK, "actual"))
    held = F.when(F.col("is_test"), F.struct("back", F.struct(WEEK, "actual").alias("row")))
    state = marked.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(known)), lambda s: s["actual"]).alias("past"),
        F.map_from_entries(F.collect_list(held)).alias("held"),
    )
    level = marked.filter("NOT is_test").agg(F.avg("actual")).scalar()
    first = F.coalesce(F.get("past", F.lit(0)), level, F.lit(0.0))
    state = state.withColumn("past", F.concat(F.array_repeat(first, 8 - F.size("past")), F.col("past")))
    past, out = F.col("past"), None
    for back in range(steps, 0, -1):
        # A series shorter than the holdout has no row yet: it waits with its past as it is.
        ready = state.withColumn("_row", F.try_element_at("held", F.lit(back))).withColumns(
            {
                **{f"lag_{n}": F.element_at(past, -n) for n in (1, 2, 4, 8)},
                "rolling_mean_4": sum((F.element_at(past, -n) for n in range(1, 5)), F.lit(0.0)) / 4,
                "week_num": F.coalesce(F.weekofyear(F.col("_row")[WEEK]), F.lit(1)).cast("double"),
                "month": F.coalesce(F.month(F.col("_row")[WEEK]), F.lit(1)).cast("double"),
            }
        )
        scored = models.predict(model, ready)
        due = F.col("_row").isNotNull()
        pushed = F.when(due, F.concat(F.slice(past, 2, 7), F.array("prediction"))).otherwise(past)
        state = scored.select(*keys, pushed.alias("past"), "held")
        row = scored.filter(due).select(*keys, F.col("_row")[WEEK].alias(WEEK), F.col("_row")["actual"].alias("actual"), "prediction")
        out = row if out is None else out.unionByName(row)
    return out


def compare(forecasts: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """Metrics per forecast with its horizon, best MAE first; the best is told within a horizon."""
    out = None
    for name, (horizon, df) in forecasts.items():
        row = models.regression_metrics(df, (), "actual").select(
            F.lit(name).alias("model"), F.lit(horizon).alias("horizon"), "row_count", "mae", "rmse", "smape_pct", "r2"
        )
        out = row if out is None else out.unionByName(row)
    best = F.col("mae") == F.min("mae").over(Window.partitionBy("horizon"))
    return out.withColumn("is_best", best).orderBy("mae", "model")
