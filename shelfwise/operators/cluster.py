"""Store clusters: profile, choice of k, clusters, PCA, merge back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.expr import dbl, half_up, mean
from shelfwise.operators.checks import require_many_to_one
from shelfwise.operators.star import Star

CLUSTER_FEATURES = (
    "total_revenue", "total_units", "avg_discount", "avg_promotion", "sales_area_size_num", "parking_space_qty",
)


def store_profile(star: Star) -> DataFrame:
    """Behaviour and size of each store that sold; missing parking takes the
    median over the profiled stores."""
    levers = F.col("feature") + F.col("display") + F.col("tpr_only")
    sold = star.fact.withColumn("_levers", levers).groupBy("store_num").agg(
        F.round(F.sum("spend"), 2).alias("total_revenue"),
        F.sum("units").alias("total_units"),
        half_up(mean("discount_pct"), 6).alias("avg_discount"),
        half_up(mean("_levers"), 6).alias("avg_promotion"),
        half_up(mean("price"), 6).alias("avg_price"),
        F.count_distinct("date_key").alias("n_weeks_active"),
    )
    info = star.store.select(
        "store_num", "seg_value_name", "sales_area_size_num", dbl("parking_space_qty").alias("parking_space_qty")
    )
    joined = sold.join(info, "store_num")
    median = joined.agg(F.median("parking_space_qty")).scalar()
    return joined.withColumn("parking_space_qty", F.coalesce(F.col("parking_space_qty"), median))


def standardise(df: DataFrame, columns: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    """z-scores with the population deviation, assembled into ``features``."""
    x = {c: dbl(c) for c in columns}
    # One row of means and deviations is all that reaches the driver.
    stat = df.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in x.items()], *[F.stddev_pop(v).alias(f"s_{c}") for c, v in x.items()]
    ).first()
    scaled = df.withColumns(
        {f"z_{c}": (v - F.lit(stat[f"m_{c}"])) / F.lit(stat[f"s_{c}"] or 1.0) for c, v in x.items()}
    )
    return VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol="features").transform(scaled)


def best_kmeans(scaled: DataFrame, k: int, seeds: Sequence[int] = (42, 7, 1)):
    """k-means with the lowest cost over several starts."""
    fits = [KMeans(k=k, seed=s, maxIter=50).fit(scaled) for s in seeds]
    return min(fits, key=lambda m: m.summary.trainingCost)


def choose_k(scaled: DataFrame, ks: Sequence[int] = range(2, 9)) -> DataFrame:
    """Inertia and silhouette per k; the best k has the highest silhouette."""
    rows = []
    for k in ks:
        model = best_kmeans(scaled, k)
        score = ClusteringEvaluator().evaluate(model.transform(scaled))
        rows.append((k, round(float(model.summary.trainingCost), 4), round(float(score), 4)))
    best = max(rows, key=lambda r: (r[2], -r[0]))[0]
    return scaled.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in rows], "k int, inertia double, silhouette double, is_best boolean"
    )


def assign(scaled: DataFrame, k: int) -> DataFrame:
    """Store profile rows with their cluster."""
    return best_kmeans(scaled, k).transform(scaled).withColumnRenamed("prediction", "cluster")


def cluster_profile(clustered: DataFrame, columns: Sequence[str] = CLUSTER_FEATURES) -> DataFrame:
    return clustered.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("store_count"), *[half_up(F.avg(dbl(c)), 2).alias(c) for c in columns]
    )


def principal_axes(scaled: DataFrame) -> DataFrame:
    """Two principal coordinates per store and the variance they explain."""
    model = PCA(k=2, inputCol="features", outputCol="pc").fit(scaled)
    first, second = (float(v) for v in model.explainedVariance)
    at = vector_to_array("pc")
    return model.transform(scaled).select(
        "store_num",
        F.round(at[0], 6).alias("pc1"),
        F.round(at[1], 6).alias("pc2"),
        F.lit(round(first, 6)).alias("explained_pc1"),
        F.lit(round(second, 6)).alias("explained_pc2"),
    )


def cluster_by_segment(clustered: DataFrame, segments: Sequence[str] = ("MAINSTREAM", "UPSCALE", "VALUE")) -> DataFrame:
    return clustered.groupBy("cluster").pivot("seg_value_name", list(segments)).count().fillna(0)


def merge_clusters(rows: DataFrame, clustered: DataFrame) -> DataFrame:
    """Cluster of the store on every row; each store must have one cluster."""
    assigned = require_many_to_one(clustered.select("store_num", "cluster"), "store_num")
    return rows.join(assigned, "store_num", "left")
