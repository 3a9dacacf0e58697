"""Model queries (ML).

Fits have the published sizes.  The boosted model that several queries use is
fitted once per state of the inputs and stored next to the star; rows are never
sampled.
"""

from __future__ import annotations

from pyspark.ml import Model
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

from shelfwise.functions.expr import half_up
from shelfwise.operators import attribution
from shelfwise.operators import models as ml
from shelfwise.operators.features import FEATURES, TARGET, WEEK
from shelfwise.plans.context import Context, query
from shelfwise.sources.marts import model_path, stored_model, stored_result

# Published sizes.
ROUNDS, TREES, FOLD_ROUNDS = 200, 150, 150
#: Fits that run side by side.
PARALLEL = 4
#: Shares of the rounds on the rungs of the registered search; the winner is fitted with all of them.
RUNGS = (0.01, 0.03, 0.1)


def boosted_model(cx: Context) -> Model:
    """The boosted model of the train weeks."""
    return stored_model(cx.spark, cx.sf_dir, f"boosted-{ROUNDS}", lambda: ml.fit(split(cx)[0], boosted()))


def boosted(rounds: int = ROUNDS) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features", labelCol=TARGET, maxIter=rounds, maxDepth=5, stepSize=0.1, seed=ml.SEED
    )


def split(cx: Context):
    return ml.time_split(cx.features)


def baseline(cx: Context):
    return ml.hierarchical_mean(*split(cx))


def labelled(cx: Context):
    """Rows with the high-sales label; medians come from the weeks the models are trained on."""
    train, _ = split(cx)
    return ml.high_sales(cx.features, train)


@query("ml1_baseline_metrics")
def baseline_metrics(cx: Context):
    return ml.regression_metrics(baseline(cx))


@query("ml1_metrics_by_category")
def metrics_by_category(cx: Context):
    return ml.regression_metrics(baseline(cx), ["category"])


@query("ml2_time_split")
def time_split(cx: Context):
    train, test = split(cx)
    side = lambda df, name: df.agg(
        F.min(WEEK).alias("first_week"), F.max(WEEK).alias("last_week"),
        F.count_distinct(WEEK).alias("weeks"), F.count(F.lit(1)).alias("row_count"),
    ).select(F.lit(name).alias("part"), "*")
    return side(train, "train").unionByName(side(test, "test"))


@query("ml3_hierarchical_mean")
def hierarchical_mean(cx: Context):
    return baseline(cx).select(WEEK, "store_num", "upc", "units", "prediction")


@query("ml4_regression_comparison")
def regression_comparison(cx: Context):
    train, test = split(cx)
    return ml.compare_regressors(train, test, ml.regressors(TREES, ROUNDS))


@query("ml5_high_sales_label")
def high_sales_label(cx: Context):
    return labelled(cx).groupBy("category").agg(
        F.count(F.lit(1)).alias("row_count"), F.sum("high_sales").alias("high_rows")
    )


@query("ml5_labelled_rows")
def labelled_rows(cx: Context):
    return labelled(cx).select(WEEK, "store_num", "upc", "category", TARGET, F.col("high_sales").cast("bigint").alias("high_sales"))


@query("ml6_classification_comparison")
def classification_comparison(cx: Context):
    train, test = ml.time_split(labelled(cx))
    return ml.compare_classifiers(train, test, ml.classifiers(trees=TREES, rounds=ROUNDS))


@query("ml7_roc_points")
def roc_points(cx: Context):
    """ROC of the hierarchical mean as a score for high sales."""
    train, test = ml.time_split(labelled(cx))
    return ml.roc_points(ml.hierarchical_mean(train, test), "prediction", "high_sales")


@query("ml8_fold_sizes")
def fold_sizes(cx: Context):
    bounds = ml.fold_bounds(cx.features)
    return (
        cx.features.join(bounds, WEEK)
        .groupBy("fold")
        .agg(
            F.min(WEEK).alias("first_week"),
            F.max(WEEK).alias("last_week"),
            F.count_distinct(WEEK).alias("weeks"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


@query("ml8_baseline_cross_validation")
def baseline_cross_validation(cx: Context):
    return ml.cross_validate(cx.features, ml.hierarchical_mean)


@query("ml8_boosted_cross_validation")
def boosted_cross_validation(cx: Context):
    score = lambda train, test: ml.predict(ml.fit(train, boosted(FOLD_ROUNDS)), test)
    return ml.fold_summary(ml.cross_validate(cx.features, score, parallel=PARALLEL))


def searched(cx: Context):
    return stored_result(cx.spark, cx.sf_dir, "halving", lambda: ml.halving_search(split(cx)[0], rungs=RUNGS, parallel=PARALLEL))


@query("ml9_random_search")
def random_search(cx: Context):
    """Fifteen settings drawn from the whole grid, by successive halving."""
    return searched(cx)


@query("ml9_tuned_vs_default")
def tuned_vs_default(cx: Context):
    """The winner of the search with all its rounds against the default model."""
    train, test = split(cx)
    best = searched(cx).orderBy(F.desc("rung"), "mean_mae", "draw").first().asDict()
    whole = ("maxIter", "maxDepth")
    settings = {k: int(best[k]) if k in whole else best[k] for k in ml.SEARCH_SPACE}
    winner = GBTRegressor(featuresCol="features", labelCol=TARGET, seed=ml.SEED, **settings)
    name = "tuned-" + "-".join(f"{v:g}" for v in settings.values())
    tuned = stored_model(cx.spark, cx.sf_dir, name, lambda: ml.fit(train, winner))
    return ml.tuned_vs_default({"default": ml.predict(boosted_model(cx), test), "tuned": ml.predict(tuned, test)})


@query("ml10_variance_filter")
def variance_filter(cx: Context):
    return ml.variance_filter(split(cx)[0])


@query("ml11_mutual_information")
def mutual_information(cx: Context):
    return ml.mutual_information(split(cx)[0])


def tree() -> DecisionTreeRegressor:
    return DecisionTreeRegressor(featuresCol="features", labelCol=TARGET, maxDepth=6, seed=ml.SEED)


@query("ml12_recursive_elimination")
def recursive_elimination(cx: Context):
    kept = ml.eliminate(split(cx)[0], tree())
    rows = [(c, c in kept) for c in FEATURES]
    return cx.spark.createDataFrame(rows, "feature_name string, kept boolean")


@query("ml13_lasso")
def lasso(cx: Context):
    return ml.lasso(split(cx)[0]).withColumn("abs_coefficient", half_up("abs_coefficient", 6))


@query("ml14_selection_summary")
def selection_summary(cx: Context):
    train, _ = split(cx)
    return ml.selection_summary(
        ml.variance_filter(train), ml.mutual_information(train), ml.lasso(train), ml.eliminate(train, tree(), keep=8)
    )


@query("ml15_feature_importance")
def feature_importance(cx: Context):
    return ml.importance_table(cx.spark, boosted_model(cx), FEATURES)


@query("ml16_permutation_importance")
def permutation_importance(cx: Context):
    _, test = split(cx)
    return ml.permutation_importance(boosted_model(cx), test, FEATURES, [WEEK, "store_num", "upc"])


def attributed(cx: Context):
    """Contributions of every feature to the boosted prediction of every test row."""
    model = boosted_model(cx)
    trees = attribution.saved_leaves(cx.spark, model, model_path(cx.spark, cx.sf_dir, f"boosted-{ROUNDS}"))
    return attribution.attribute(trees, split(cx)[1], FEATURES, [WEEK, "store_num", "upc"])


@query("ml16_attributions")
def attributions(cx: Context):
    """Mean and mean absolute contribution of each feature over the test rows."""
    return attribution.importance(attributed(cx), FEATURES)


@query("ml16_discount_response")
def discount_response(cx: Context):
    """Mean change in predicted units against no discount, per discount bin."""
    _, test = split(cx)
    model = boosted_model(cx)
    plain = test.withColumns(
        {"discount_pct": F.lit(0.0), "price": F.col("base_price"), "price_ratio": F.lit(1.0)}
    )
    key = [WEEK, "store_num", "upc"]
    before = ml.predict(model, plain).select(*key, F.col("prediction").alias("_plain"))
    effect = ml.predict(model, test).join(before, key).withColumn("_effect", F.col("prediction") - F.col("_plain"))
    return ml.response_by_bin(effect, "discount_pct", "_effect")


@query("ml16_partial_dependence")
def partial_dependence(cx: Context):
    _, test = split(cx)
    model = boosted_model(cx)
    in_line = lambda df: df.withColumns(
        {
            "price": F.col("base_price") * (1 - F.col("discount_pct") / 100),
            "price_ratio": 1 - F.col("discount_pct") / 100,
        }
    )
    return ml.partial_dependence(model, test, "discount_pct", range(0, 55, 5), in_line)
