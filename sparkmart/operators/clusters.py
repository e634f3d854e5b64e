"""K-means product tiers with stable names, and the choice of k."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sparkmart.operators.features import standard_scale
from sparkmart.session import durable
from sparkmart.sources.sinks import append, overwrite
from sparkmart.sources.tables import table_exists

# brand codes have no distance, and review_count repeats what revenue already says
CLUSTER_COLS = ["revenue", "listing_price", "discount", "rating"]
# Tier names from the lowest to the highest mean revenue.
TIERS = ["Low Performer", "Mid Tier", "Premium"]
FITS = 4  # fits at the same time; each holds its points in the executors while it runs
RESULT = "product_id string, cluster_label string, cluster_id bigint, log_revenue double"
RUNS = "run_name string, n_clusters int, silhouette_score double, cost double, model_path string"


def cluster_input(features: DataFrame, columns: Sequence[str] = CLUSTER_COLS) -> DataFrame:
    """Scaled vectors, written once, sorted by id inside hash partitions: every restart reads the
    same rows in the same partitions, which also makes a seed repeatable."""
    scaled = standard_scale(durable(features.select("product_id", *columns), "cluster-features"), columns)
    assembled = VectorAssembler(inputCols=[f"{c}_z" for c in columns], outputCol="scaled").transform(scaled)
    points = assembled.select("product_id", "revenue", "scaled")
    return durable(points.repartition("product_id").sortWithinPartitions("product_id"), "cluster-input")


def _at_once(make: Callable, arguments: Sequence[tuple], spark: SparkSession) -> list:
    """Results of ``make`` in order. A fit is a chain of short jobs, so several chains share the cores."""
    with ThreadPoolExecutor(FITS) as pool:
        return list(pool.map(inheritable_thread_target(spark)(lambda a: make(*a)), arguments))


def best_models(points: DataFrame, ks: Iterable[int], restarts: int = 10, seed: int = 42) -> dict[int, KMeansModel]:
    """For every k the model with the lowest cost of several starts; the earlier start among equals."""

    def fit(k: int, i: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + i, featuresCol="scaled", predictionCol="_raw").fit(points)

    starts = [(k, i) for k in ks for i in range(restarts)]
    best: dict[int, KMeansModel] = {}
    for (k, _), model in zip(starts, _at_once(fit, starts, points.sparkSession)):
        if k not in best or model.summary.trainingCost < best[k].summary.trainingCost:
            best[k] = model
    return best


def fit_kmeans(points: DataFrame, k: int, restarts: int = 10, seed: int = 42) -> KMeansModel:
    """The model with the lowest cost of several starts."""
    return best_models(points, [k], restarts, seed)[k]


def stable_labels(assigned: DataFrame, raw: str = "_raw", tiers: Sequence[str] = TIERS) -> DataFrame:
    """Number clusters by ascending mean log revenue and name them, whatever ids the fit drew.

    One row per cluster, so numbering them in one task and broadcasting them is bounded by k.
    """
    means = assigned.groupBy(raw).agg(F.avg("revenue").alias("_mean"))
    position = F.row_number().over(Window.orderBy("_mean", raw)) - 1
    named = means.select(raw, position.cast("bigint").alias("cluster_id")).withColumn(
        "cluster_label",
        F.coalesce(
            F.try_element_at(F.array(*(F.lit(t) for t in tiers)), (F.col("cluster_id") + 1).cast("int")),
            F.concat(F.lit("Cluster "), F.col("cluster_id").cast("string")),
        ),
    )
    return assigned.join(F.broadcast(named), raw).select(
        "product_id", "cluster_label", "cluster_id", F.col("revenue").alias("log_revenue")
    )


def product_clusters(features: DataFrame, k: int = 3, restarts: int = 10, seed: int = 42) -> DataFrame:
    """product_id, cluster_label, cluster_id, log_revenue; no rows for no features."""
    if features.isEmpty():
        return features.sparkSession.createDataFrame([], RESULT)
    points = cluster_input(features)
    return stable_labels(fit_kmeans(points, k, restarts, seed).transform(points))


def build_clusters(features: DataFrame, path: str, **options) -> DataFrame:
    """Write the cluster table; an empty feature table writes nothing."""
    result = product_clusters(features, **options)
    if features.isEmpty():
        return result
    return overwrite(result, path)


def cluster_counts(clusters: DataFrame) -> DataFrame:
    return clusters.groupBy("cluster_label").agg(F.count(F.lit(1)).alias("product_count")).orderBy("cluster_label")


def cluster_features(clusters: DataFrame, features: DataFrame) -> DataFrame:
    """Clusters with list price, joined on the id alone: log revenue is a double and no key."""
    return clusters.join(features.select("product_id", "listing_price"), "product_id")


# --- choosing k --------------------------------------------------------------------------


def elbow(features: DataFrame, ks: Iterable[int] = range(2, 11), restarts: int = 10, seed: int = 42) -> DataFrame:
    """(k, inertia) for a range of k."""
    points = cluster_input(features)
    rows = [(k, float(m.summary.trainingCost)) for k, m in best_models(points, ks, restarts, seed).items()]
    return features.sparkSession.createDataFrame(rows, "k int, inertia double")


def tune_k(
    features: DataFrame, ks: Iterable[int] = range(2, 9), restarts: int = 10, seed: int = 42, model_folder: str | None = None
) -> DataFrame:
    """One run per k with its silhouette (squared Euclidean, which Spark evaluates without pairs;
    its values are not comparable with a Euclidean silhouette). Models are kept when a folder is given."""
    points = cluster_input(features)
    evaluator = ClusteringEvaluator(featuresCol="scaled", predictionCol="_raw")
    models = best_models(points, ks, restarts, seed)
    scores = _at_once(lambda m: evaluator.evaluate(m.transform(points)), [(m,) for m in models.values()], points.sparkSession)
    rows = []
    for (k, model), score in zip(models.items(), scores):
        path = os.path.join(model_folder, f"k{k}") if model_folder else None
        if path:
            model.write().overwrite().save(path)
        rows.append((f"kmeans-k{k}", k, float(score), float(model.summary.trainingCost), path))
    return features.sparkSession.createDataFrame(rows, RUNS)


def compare_runs(runs: DataFrame) -> DataFrame:
    """Runs, best silhouette first."""
    return runs.orderBy(F.desc("silhouette_score"), "run_name")


def best_run(runs: DataFrame):
    """The best run as a row; an error when there is none."""
    best = compare_runs(runs).first()
    if best is None:
        raise ValueError("no runs to compare")
    return best


REGISTRY = "version int, run_name string, n_clusters int, silhouette_score double, path string, stage string, seq bigint"


def save_best_model(runs: DataFrame, folder: str) -> dict:
    """Copy the best model to a new version and mark it as the production version."""
    spark = runs.sparkSession
    best = best_run(runs)
    log = os.path.join(folder, "registry")
    last = 0
    if table_exists(spark, log):
        last = spark.read.schema(REGISTRY).parquet(log).agg(F.max("version")).first()[0] or 0
    version = last + 1
    path = os.path.join(folder, f"v{version}")
    KMeansModel.load(best["model_path"]).write().overwrite().save(path)
    row = (version, best["run_name"], best["n_clusters"], best["silhouette_score"], path, "production", version)
    append(spark.createDataFrame([row], REGISTRY), log)
    return {"version": version, "path": path, "n_clusters": best["n_clusters"]}


def production_model(spark, folder: str) -> KMeansModel:
    log = os.path.join(folder, "registry")
    if not table_exists(spark, log):
        raise FileNotFoundError(f"no registered model below {folder}")
    newest = spark.read.schema(REGISTRY).parquet(log).orderBy(F.desc("seq")).first()
    return KMeansModel.load(newest["path"])
