"""Model jobs on ``pyspark.ml``: metrics, time splits, comparison, search,
feature selection, importance."""

from __future__ import annotations

import itertools
import math
import random
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from shelfwise.functions.expr import count_where, dbl, half_up, ratio
from shelfwise.operators.features import FEATURES, TARGET, WEEK
from shelfwise.operators.scale import group_quantiles
from shelfwise.session import shared_dir
from shelfwise.sources.workspace import Workspace

SEED = 42
#: From DEAL_ROWS on, the rows of a fit are dealt anew if a task would hold more than UNEVEN times its even share.
DEAL_ROWS, UNEVEN = 1 << 16, 1.25
#: Rows of a task after that, at most.
TASK_ROWS = 1 << 20


# ---------------------------------------------------------------- metrics


def smape_term(actual: str = TARGET, predicted: str = "prediction") -> Column:
    a, p = dbl(actual), dbl(predicted)
    size = F.abs(a) + F.abs(p)
    return 2 * F.abs(p - a) / F.when(size == 0, F.lit(1.0)).otherwise(size) * 100


def regression_metrics(
    scored: DataFrame, by: Sequence[str] = (), actual: str = TARGET, predicted: str = "prediction", digits: int = 4
) -> DataFrame:
    """MAE, RMSE, SMAPE and R2, overall or per group, as plain aggregates."""
    a, p = dbl(actual), dbl(predicted)
    grouped = scored.groupBy(*by) if by else scored.groupBy()
    sums = grouped.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.avg(F.abs(a - p)).alias("_mae"),
        F.avg((a - p) * (a - p)).alias("_mse"),
        F.avg(smape_term(actual, predicted)).alias("_smape"),
        F.var_pop(a).alias("_var"),
    )
    return sums.select(
        *by,
        "row_count",
        half_up("_mae", digits).alias("mae"),
        half_up(F.sqrt("_mse"), digits).alias("rmse"),
        half_up("_smape", digits).alias("smape_pct"),
        half_up(1 - ratio("_mse", "_var"), digits).alias("r2"),
    )


def classification_metrics(scored: DataFrame, label: str, predicted: str = "prediction", digits: int = 4) -> DataFrame:
    y, p = F.col(label) == 1, F.col(predicted) == 1
    counts = scored.agg(
        F.count(F.lit(1)).alias("n"),
        count_where(y & p).alias("tp"),
        count_where(~y & p).alias("fp"),
        count_where(y & ~p).alias("fn"),
    )
    precision = F.coalesce(ratio("tp", F.col("tp") + F.col("fp")), F.lit(0.0))
    recall = F.coalesce(ratio("tp", F.col("tp") + F.col("fn")), F.lit(0.0))
    return counts.select(
        half_up(ratio(F.col("n") - F.col("fp") - F.col("fn"), "n"), digits).alias("accuracy"),
        half_up(precision, digits).alias("precision"),
        half_up(recall, digits).alias("recall"),
        half_up(F.coalesce(ratio(2 * precision * recall, precision + recall), F.lit(0.0)), digits).alias("f1"),
    )


def roc_points(scored: DataFrame, score: str, label: str, bins: int = 200) -> DataFrame:
    """False and true positive rates over score bins, highest scores first.

    Scores fold into equal-width bins on the map side; the running sums only
    see one row per bin.
    """
    s = dbl(score)
    lo, hi = scored.agg(F.min(s)).scalar(), scored.agg(F.max(s)).scalar()
    at = F.least(F.floor((s - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins), F.lit(bins - 1))
    per_bin = scored.groupBy(F.coalesce(at, F.lit(0)).alias("score_bin")).agg(
        F.sum(F.col(label)).alias("_p"), F.count(F.lit(1)).alias("_n")
    )
    down = Window.orderBy(F.desc("score_bin")).rowsBetween(Window.unboundedPreceding, 0)
    every = Window.partitionBy()
    p, q = F.col("_p"), F.col("_n") - F.col("_p")
    return per_bin.select(
        "score_bin",
        half_up(ratio(F.sum(q).over(down), F.sum(q).over(every)), 6).alias("fpr"),
        half_up(ratio(F.sum(p).over(down), F.sum(p).over(every)), 6).alias("tpr"),
    )


# ---------------------------------------------------------------- time splits


def week_ranks(df: DataFrame, week: str = WEEK) -> DataFrame:
    """Distinct weeks with their position from 0 and their number."""
    return df.select(week).distinct().select(
        week,
        (F.row_number().over(Window.orderBy(week)) - 1).alias("week_pos"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("week_total"),
    )


def split_week(df: DataFrame, fraction: float = 0.8, week: str = WEEK):
    """First week of the test period (one value on the driver)."""
    start = week_ranks(df, week).filter(F.col("week_pos") == F.floor(F.col("week_total") * fraction))
    return start.first()[week]


def time_split(df: DataFrame, fraction: float = 0.8, week: str = WEEK) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the week that ends the first ``fraction`` of weeks."""
    cut = F.lit(split_week(df, fraction, week))
    return df.filter(F.col(week) < cut), df.filter(F.col(week) >= cut)


def fold_bounds(df: DataFrame, folds: int = 5, week: str = WEEK) -> DataFrame:
    """Expanding folds over whole weeks: fold i tests on the i-th of the last
    ``folds`` equal blocks of weeks and trains on every week before it."""
    size = F.floor(F.col("week_total") / (folds + 1))
    block = F.floor((F.col("week_pos") - (F.col("week_total") - folds * size)) / size)
    return week_ranks(df, week).select(
        week, "week_pos", F.when(block >= 0, block + 1).otherwise(0).cast("int").alias("fold")
    )


def fold_starts(df: DataFrame, folds: int = 5, week: str = WEEK) -> list[tuple]:
    """(first, last) test week per fold: ``folds`` rows on the driver."""
    rows = (
        fold_bounds(df, folds, week)
        .filter("fold > 0")
        .groupBy("fold")
        .agg(F.min(week).alias("lo"), F.max(week).alias("hi"))
        .orderBy("fold")
        .collect()
    )
    return [(r["lo"], r["hi"]) for r in rows]


# ---------------------------------------------------------------- baselines


def hierarchical_mean(train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """Product mean, else category mean, else overall mean of the train rows."""
    product = train.groupBy("upc").agg(F.avg(target).alias("_u"))
    category = train.groupBy("category").agg(F.avg(target).alias("_c"))
    overall = train.agg(F.avg(target)).scalar()
    return (
        test.join(product, "upc", "left")
        .join(category, "category", "left")
        .withColumn("prediction", half_up(F.coalesce(F.col("_u"), F.col("_c"), overall), 6))
        .drop("_u", "_c")
    )


def high_sales(df: DataFrame, train: DataFrame, by: str = "category", target: str = TARGET) -> DataFrame:
    """1 where units exceed the category median of the training rows."""
    medians = group_quantiles(train, [by], target, {"_median": 0.5})
    label = (F.col(target) > F.coalesce(F.col("_median"), F.lit(0.0))).cast("int")
    return df.join(medians, by, "left").withColumn("high_sales", label).drop("_median")


# ---------------------------------------------------------------- fitting


def vector(columns: Sequence[str] = FEATURES, out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=out, handleInvalid="error")


def regressors(trees: int = 150, rounds: int = 200, depth: int = 6, rate: float = 0.1) -> dict:
    """Estimators of the regression comparison, with the published sizes."""
    common = {"featuresCol": "features", "labelCol": TARGET}
    return {
        "Linear Regression": LinearRegression(**common),
        "Decision Tree": DecisionTreeRegressor(maxDepth=depth, seed=SEED, **common),
        "Random Forest": RandomForestRegressor(numTrees=trees, maxDepth=10, seed=SEED, **common),
        "Boosted Trees": GBTRegressor(maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED, **common),
    }


def classifiers(label: str = "high_sales", trees: int = 150, rounds: int = 200, depth: int = 6) -> dict:
    common = {"featuresCol": "features", "labelCol": label}
    return {
        "Logistic Regression": LogisticRegression(maxIter=100, **common),
        "Random Forest": RandomForestClassifier(numTrees=trees, maxDepth=10, seed=SEED, **common),
        "Boosted Trees": GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=SEED, **common),
    }


def dealt(rows: DataFrame, cut: bool = False) -> DataFrame:
    """The same rows, dealt evenly over the tasks that run at a time if they lie unevenly.

    A fit walks its partitions once per tree level, so each level lasts as long
    as the largest one.  Tables in the order of their weeks leave whole files
    without a train row; ``cut`` says that weeks are cut off later, which does
    the same to partitions that are even now.
    """
    slots = rows.sparkSession.sparkContext.defaultParallelism
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id().alias("part")).count().collect()]
    total = sum(sizes)
    if total < DEAL_ROWS or (not cut and max(sizes) * slots <= UNEVEN * total):
        return rows
    return rows.repartition(slots * math.ceil(total / (slots * TASK_ROWS)))


def fit(train: DataFrame, estimator, columns: Sequence[str] = FEATURES) -> Model:
    """Fitted pipeline.  Boosting cuts its lineage by checkpoints, which need a folder.

    Rows that have to be dealt anew are stored for the fit, which reads them several times.
    The model keeps no summary of its training: that holds the session, which tasks can't
    be sent once a query of it has been observed.
    """
    spark = train.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    steps = Pipeline(stages=[vector(columns), estimator])
    if (even := dealt(train)) is train:
        return _without_summary(steps.fit(train))
    work = Workspace(spark, "fit")
    model = steps.fit(work.table(even.select(*dict.fromkeys([*columns, estimator.getLabelCol()])), "train"))
    work.drop("train")
    return _without_summary(model)


def _without_summary(model: Model) -> Model:
    for stage in model.stages:
        if getattr(stage, "hasSummary", False):
            stage._java_obj.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return model


def predict(model: Model, df: DataFrame) -> DataFrame:
    """Predictions of a regression, never below 0."""
    return model.transform(df).withColumn("prediction", F.greatest(F.col("prediction"), F.lit(0.0)))


def compare_regressors(
    train: DataFrame, test: DataFrame, estimators: dict, columns: Sequence[str] = FEATURES, parallel: int = 1
) -> DataFrame:
    """One metrics row per model, the hierarchical mean included, best first.

    Train and test rows are stored once; ``parallel`` fits run at a time (each
    holds its trees on the driver) and each model's one metrics row is
    computed once, so the result holds no model.
    """
    spark = train.sparkSession
    work = Workspace(spark, "compare")
    train, test = work.table(dealt(train), "train"), work.table(test, "test")
    jobs = [lambda: regression_metrics(hierarchical_mean(train, test)).withColumn("model", F.lit("Baseline (UPC Mean)"))]
    for name, estimator in estimators.items():
        jobs.append(
            lambda n=name, e=estimator: regression_metrics(predict(fit(train, e, columns), test)).withColumn("model", F.lit(n))
        )
    out = _collected(spark, side_by_side(spark, [lambda j=j: _first(j()) for j in jobs], parallel))
    work.drop("train", "test")
    return out.withColumn("is_best_r2", F.col("r2") == F.max("r2").over(Window.partitionBy())).orderBy("rmse", "model")


def compare_classifiers(
    train: DataFrame,
    test: DataFrame,
    estimators: dict,
    label: str = "high_sales",
    columns: Sequence[str] = FEATURES,
    parallel: int = 1,
) -> DataFrame:
    """One metrics row per classifier, best AUC first; stored inputs, fits as above."""
    spark = train.sparkSession
    work = Workspace(spark, "compare")
    train, test = work.table(dealt(train), "train"), work.table(test, "test")

    def score(name: str, estimator) -> DataFrame:
        scored = fit(train, estimator, columns).transform(test)
        auc = BinaryClassificationEvaluator(labelCol=label, numBins=1000).evaluate(scored)
        return classification_metrics(scored, label).select(F.lit(name).alias("model"), "*", F.lit(round(auc, 4)).alias("auc"))

    jobs = [lambda n=n, e=e: _first(score(n, e)) for n, e in estimators.items()]
    out = _collected(spark, side_by_side(spark, jobs, parallel))
    work.drop("train", "test")
    return out.orderBy(F.desc("auc"), "model")


def _first(df: DataFrame) -> tuple[StructType, list]:
    """Schema and rows of a small frame (one metrics row)."""
    return df.schema, df.collect()


def _collected(spark: SparkSession, parts: list[tuple[StructType, list]]) -> DataFrame:
    """Union of small collected frames by name, in order, with the first one's schema."""
    schema = parts[0][0]
    rows = [tuple(r.asDict()[f.name] for f in schema.fields) for _, part in parts for r in part]
    return spark.createDataFrame(rows, schema)


def cross_validate(
    df: DataFrame,
    score: Callable[[DataFrame, DataFrame], DataFrame],
    folds: int = 5,
    week: str = WEEK,
    parallel: int = 1,
) -> DataFrame:
    """Metrics of every expanding fold.

    ``score(train, test)`` returns the test rows with a prediction.  Folds cut
    between weeks, never inside one.  ``parallel`` folds are fitted at a time.
    """
    day = F.col(week)

    def of_fold(number: int, lo, hi) -> DataFrame:
        train, test = df.filter(day < F.lit(lo)), df.filter(day.between(F.lit(lo), F.lit(hi)))
        return regression_metrics(score(train, test)).withColumn("fold", F.lit(number))

    jobs = [(i, lo, hi) for i, (lo, hi) in enumerate(fold_starts(df, folds, week), start=1)]
    rows = side_by_side(df.sparkSession, [lambda j=j: of_fold(*j) for j in jobs], parallel)
    out = rows[0]
    for row in rows[1:]:
        out = out.unionByName(row)
    return out


def side_by_side(spark: SparkSession, jobs: Sequence[Callable], parallel: int) -> list:
    """Results of the jobs in order, ``parallel`` of them at a time: small fits leave executors idle between their jobs."""
    if parallel <= 1:
        return [job() for job in jobs]
    with ThreadPoolExecutor(parallel) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]


def fold_summary(folds: DataFrame) -> DataFrame:
    """Mean and (population) spread of each metric over the folds."""
    names = ("mae", "rmse", "smape_pct", "r2")
    one = folds.agg(
        *[half_up(F.avg(c), 4).alias(f"{c}_mean") for c in names],
        *[half_up(F.stddev_pop(c), 4).alias(f"{c}_std") for c in names],
    )
    rows = [
        F.struct(F.lit(c).alias("metric"), F.col(f"{c}_mean").alias("mean"), F.col(f"{c}_std").alias("std"))
        for c in names
    ]
    return one.select(F.inline(F.array(*rows)))


# Values the random search draws from.
SEARCH_SPACE = {
    "maxIter": (100, 150, 200, 300),
    "maxDepth": (3, 5, 6, 8),
    "stepSize": (0.01, 0.05, 0.1, 0.2),
    "subsamplingRate": (0.7, 0.85, 1.0),
}


def search_grid(space: dict[str, Sequence] | None = None, draws: int = 15) -> list[dict]:
    """Settings drawn from the whole grid, each at most once."""
    space = space or SEARCH_SPACE
    grid = list(itertools.product(*space.values()))
    return [dict(zip(space, values, strict=True)) for values in random.Random(SEED).sample(grid, min(draws, len(grid)))]


def halving_search(
    train: DataFrame,
    draws: int = 15,
    folds: int = 3,
    space: dict[str, Sequence] | None = None,
    columns: Sequence[str] = FEATURES,
    rungs: Sequence[float] = (1 / 27, 1 / 9, 1 / 3),
    keep: float = 1 / 3,
    parallel: int = 4,
) -> DataFrame:
    """Successive halving over drawn boosted-tree settings, best first.

    On each rung the settings left are scored by their mean fold MAE with a
    share of their rounds; the best ``keep`` of them go on to the next, larger
    share.  Fits read one stored table of assembled features and run side by
    side.  A setting's row tells the rung it reached, its rounds there and its
    MAE; the first row is the winner, whose full rounds are ``maxIter``.
    """
    spark = train.sparkSession
    work = Workspace(spark, "search")
    table = work.table(dealt(vector(columns).transform(train).select(WEEK, TARGET, "features"), cut=True), "train")
    left = list(enumerate(search_grid(space, draws), start=1))
    scored: dict[int, tuple] = {}

    def mean_mae(settings: dict, rounds: int) -> float:
        estimator = GBTRegressor(featuresCol="features", labelCol=TARGET, seed=SEED, **{**settings, "maxIter": rounds})
        maes = cross_validate(table, lambda a, b: predict(estimator.fit(a), b), folds)
        return maes.agg(F.avg("mae")).first()[0]

    for rung, share in enumerate(rungs, start=1):
        rounds = [max(1, round(settings["maxIter"] * share)) for _, settings in left]
        jobs = [lambda s=s, r=r: mean_mae(s, r) for (_, s), r in zip(left, rounds, strict=True)]
        maes = side_by_side(spark, jobs, parallel)
        for (draw, settings), r, mae in zip(left, rounds, maes, strict=True):
            scored[draw] = (rung, r, round(mae, 4), settings)
        order = sorted(left, key=lambda x: (scored[x[0]][2], x[0]))
        left = sorted(order[: max(1, math.ceil(len(left) * keep))]) if rung < len(rungs) else left
    work.drop("train")
    rows = [(draw, rung, r, mae, *[float(v) for v in settings.values()]) for draw, (rung, r, mae, settings) in scored.items()]
    names = list(search_grid(space, 1)[0])
    kind = "draw int, rung int, rounds int, mean_mae double, " + ", ".join(f"{n} double" for n in names)
    return spark.createDataFrame(rows, kind).orderBy(F.desc("rung"), "mean_mae", "draw")


def tuned_vs_default(scores: dict[str, DataFrame]) -> DataFrame:
    """Metrics of several scored frames and the MAE gain over the first."""
    out = None
    for i, (name, scored) in enumerate(scores.items()):
        row = regression_metrics(scored).select(F.lit(i).alias("_i"), F.lit(name).alias("model"), "mae", "rmse", "r2")
        out = row if out is None else out.unionByName(row)
    base = F.max(F.when(F.col("_i") == 0, F.col("mae"))).over(Window.partitionBy())
    gain = half_up(ratio((base - F.col("mae")) * 100, base), 2)
    return out.withColumn("mae_improvement_pct", gain).drop("_i")


# ---------------------------------------------------------------- feature selection


def long_features(df: DataFrame, columns: Sequence[str] = FEATURES, *keep: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("feature_name"), F.col(c).cast("double").alias("v")) for c in columns]
    return df.select(*keep, F.inline(F.array(*pairs)))


def variance_filter(df: DataFrame, columns: Sequence[str] = FEATURES, threshold: float = 0.01) -> DataFrame:
    """Population variance per feature and whether it passes the threshold."""
    return (
        long_features(df, columns)
        .groupBy("feature_name")
        .agg(half_up(F.var_pop("v"), 4).alias("variance"))
        .withColumn("kept", F.col("variance") > threshold)
    )


def mutual_information(
    df: DataFrame, columns: Sequence[str] = FEATURES, target: str = TARGET, bins: int = 10
) -> DataFrame:
    """Mutual information of each feature with the target over quantile bins.

    Both sides are cut at exact quantiles; the information follows from joint
    counts, at most bins x bins per feature.
    """
    cuts = {f"c{i}": i / bins for i in range(1, bins)}

    def bin_of(v: str, at: Callable[[str], Column] = F.col) -> Column:
        return sum(((F.col(v) > at(c)).cast("int") for c in cuts), F.lit(0))

    y_cuts = group_quantiles(df, [], target, cuts).first()
    y_binned = df.select(bin_of(target, lambda c: F.lit(y_cuts[c])).alias("yb"), *columns)
    rows = long_features(y_binned, columns, "yb")
    edges = group_quantiles(rows, ["feature_name"], "v", cuts)
    joint = (
        rows.join(edges, "feature_name")
        .groupBy("feature_name", bin_of("v").alias("xb"), "yb")
        .agg(F.count(F.lit(1)).cast("double").alias("n"))
    )
    total = F.sum("n").over(Window.partitionBy("feature_name"))
    px = F.sum("n").over(Window.partitionBy("feature_name", "xb"))
    py = F.sum("n").over(Window.partitionBy("feature_name", "yb"))
    n = F.col("n")
    terms = joint.select("feature_name", (n / total * F.log(n * total / (px * py))).alias("t"))
    return terms.groupBy("feature_name").agg(half_up(F.sum("t"), 6).alias("mutual_information"))


def importances(model: Model, columns: Sequence[str]) -> list[tuple[str, float]]:
    values = model.stages[-1].featureImportances.toArray()
    return sorted(zip(columns, (float(v) for v in values)), key=lambda kv: (-kv[1], kv[0]))


def importance_table(spark: SparkSession, model: Model, columns: Sequence[str], top: int = 10) -> DataFrame:
    rows = [(i, c, v) for i, (c, v) in enumerate(importances(model, columns)[:top], start=1)]
    return spark.createDataFrame(rows, "position int, feature_name string, importance double")


def eliminate(
    train: DataFrame, estimator, columns: Sequence[str] = FEATURES, keep: int = 8
) -> list[str]:
    """Drop the least important feature and refit until ``keep`` are left."""
    left = list(columns)
    while len(left) > keep:
        weakest = importances(fit(train, estimator, left), left)[-1][0]
        left.remove(weakest)
    return left


def lasso(train: DataFrame, columns: Sequence[str] = FEATURES, alpha: float = 0.5) -> DataFrame:
    """Absolute lasso coefficients on standardised features."""
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    line = LinearRegression(
        featuresCol="features", labelCol=TARGET, regParam=alpha, elasticNetParam=1.0, standardization=False
    )
    model = Pipeline(stages=[vector(columns, "raw"), scaler, line]).fit(train)
    rows = [(c, abs(float(v))) for c, v in zip(columns, model.stages[-1].coefficients.toArray())]
    return train.sparkSession.createDataFrame(rows, "feature_name string, abs_coefficient double")


def selection_summary(
    variance: DataFrame, information: DataFrame, lasso_table: DataFrame, eliminated: Iterable[str]
) -> DataFrame:
    """Votes of the four selection methods side by side."""
    kept = list(eliminated)
    return (
        variance.join(information, "feature_name")
        .join(lasso_table, "feature_name")
        .withColumn("in_elimination", F.col("feature_name").isin(*kept))
        .withColumn(
            "votes",
            F.col("kept").cast("int")
            + F.col("in_elimination").cast("int")
            + (F.col("abs_coefficient") > 0).cast("int")
            + (F.col("mutual_information") > F.lit(0.01)).cast("int"),
        )
    )


# ---------------------------------------------------------------- importance of a fitted model


def permutation_importance(model: Model, test: DataFrame, columns: Sequence[str], repeat_key: Sequence[str]) -> DataFrame:
    """MAE increase when one feature is exchanged between rows.

    The exchange shifts the feature to the next row in a hashed order inside
    buckets of the hash, so no global sort is needed and no row is lost.
    """
    order = F.xxhash64(*repeat_key)
    bucket = F.pmod(order, F.lit(4096))
    ring = Window.partitionBy("_b").orderBy("_o", *repeat_key)
    first = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    marked = test.withColumn("_o", order).withColumn("_b", bucket)
    base = regression_metrics(predict(model, test)).select(F.lit("(none)").alias("feature_name"), "mae")
    out = base
    for c in columns:
        swapped = marked.withColumn(c, F.coalesce(F.lead(c).over(ring), F.first(c).over(first)))
        row = regression_metrics(predict(model, swapped)).select(F.lit(c).alias("feature_name"), "mae")
        out = out.unionByName(row)
    clean = F.max(F.when(F.col("feature_name") == "(none)", F.col("mae"))).over(Window.partitionBy())
    return out.withColumn("mae_increase", half_up(F.col("mae") - clean, 4)).filter("feature_name <> '(none)'")


def partial_dependence(
    model: Model, rows: DataFrame, feature: str, grid: Sequence[float], also: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Mean prediction when one feature is set to each grid value.

    Rows unfold over the grid in place; ``also`` keeps dependent features in
    line with the changed one.
    """
    spread = rows.withColumn(feature, F.explode(F.array(*[F.lit(float(g)) for g in grid])))
    if also is not None:
        spread = also(spread)
    return predict(model, spread).groupBy(feature).agg(half_up(F.avg("prediction"), 4).alias("mean_prediction"))


def response_by_bin(scored: DataFrame, by: str, effect: str, width: float = 5, top: float = 50) -> DataFrame:
    """Mean effect per bin (right-closed, ``width`` wide) and the best bin."""
    at = F.ceil(F.col(by) / width)
    binned = scored.filter((F.col(by) > 0) & (F.col(by) <= top)).groupBy((at * width).cast("double").alias("bin_to")).agg(
        half_up(F.avg(effect), 4).alias("mean_effect"), F.count(F.lit(1)).alias("row_count")
    )
    every = Window.partitionBy()
    return binned.withColumn(
        "is_best", F.col("bin_to") == F.max_by("bin_to", F.struct("mean_effect", (-F.col("bin_to")))).over(every)
    )
