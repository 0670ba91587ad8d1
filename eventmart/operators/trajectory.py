"""Yearly commit vectors per repository, K-Means clusters and their labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.functions.columns import mean_fixed
from eventmart.session import durable


def yearly_vectors(
    activity: DataFrame, years: Sequence[int], min_years: int = 2
) -> DataFrame:
    """One row per repository with a column of summed commits for each listed year.

    Summed to (repository, year) first, then pivoted; both steps are partitioned by the
    repository, and the years observed come out of the second one. Events of repositories
    without a key are no repository and are left out.
    """
    yearly = (
        activity.filter(F.col("repo_key").isNotNull())
        .groupBy("repo_key", "year")
        .agg(F.sum("total_commits").alias("commits"))
    )
    cells = [
        F.coalesce(F.sum(F.when(F.col("year") == y, F.col("commits"))), F.lit(0)).alias(str(y))
        for y in years
    ]
    return (
        yearly.groupBy("repo_key")
        .agg(*cells, F.count("year").alias("years_observed"))
        .filter(F.col("years_observed") >= min_years)
    )


def _average(years: Sequence[int]) -> Column:
    total = sum((F.col(str(y)) for y in years), F.lit(0))
    return total.cast("double") / float(len(years))


def with_growth(vectors: DataFrame, years: Sequence[int], early_to: int) -> DataFrame:
    """Average commits of the early and the recent years and their smoothed ratio."""
    early = [y for y in years if y <= early_to]
    recent = [y for y in years if y > early_to]
    return vectors.withColumns(
        {"avg_commits_early": _average(early), "avg_commits_recent": _average(recent)}
    ).withColumn(
        "growth_ratio", F.col("avg_commits_recent") / (F.col("avg_commits_early") + 1.0)
    )


def cluster_labels(clustered: DataFrame, names: Sequence[str] = V.CLUSTER_LABELS) -> DataFrame:
    """Name the clusters by rank of mean growth, fastest first.

    The ranking window sees one row per cluster. Clusters beyond the last name share it, with
    a number: "name 2", "name 3". The lookup that is broadcast has one row per cluster.
    """
    mean = mean_fixed(F.col("growth_ratio"))
    order = Window.orderBy(F.desc("mean_growth_ratio"), "cluster_id")
    named = (
        clustered.groupBy("cluster_id")
        .agg(mean.alias("mean_growth_ratio"))
        .withColumn("rank", F.row_number().over(order))
        .select(
            "cluster_id",
            F.coalesce(
                F.get(F.array(*map(F.lit, names)), F.col("rank") - 1),
                F.concat_ws(" ", F.lit(names[-1]), F.col("rank") - len(names) + 1),
            ).alias("trajectory_label"),
        )
    )
    return clustered.join(F.broadcast(named), "cluster_id", "left")


def trajectory_table(labelled: DataFrame, computed_at: str | None = None) -> DataFrame:
    at = F.lit(computed_at).cast("timestamp") if computed_at else F.current_timestamp()
    return labelled.select(
        "repo_key",
        "cluster_id",
        "trajectory_label",
        F.round("growth_ratio", 3).alias("growth_ratio"),
        F.round("avg_commits_early", 1).alias("avg_commits_early"),
        F.round("avg_commits_recent", 1).alias("avg_commits_recent"),
        "years_observed",
        at.alias("computed_at"),
    )


def cluster(
    vectors: DataFrame,
    years: Sequence[int],
    max_k: int = 6,
    max_iter: int = 50,
    seed: int = 42,
    min_repos: int = 4,
) -> DataFrame:
    """K-Means on min-max scaled vectors with k chosen by silhouette.

    Returns the vectors with a cluster_id, or no rows for fewer than `min_repos` vectors. The
    vectors are written out, so neither the fits nor a lost executor go back to the event
    data; the scaled form is cached for the candidate fits. The best fit is used as it is
    instead of being fitted again.
    """
    prepare = Pipeline(
        stages=[
            VectorAssembler(
                inputCols=[str(y) for y in years],
                outputCol="features_raw",
                handleInvalid="keep",
            ),
            MinMaxScaler(inputCol="features_raw", outputCol="features"),
        ]
    )
    vectors = durable(vectors)
    rows = vectors.count()
    if rows < min_repos:
        return vectors.withColumn("cluster_id", F.lit(0)).limit(0)
    scaled = (
        prepare.fit(vectors)
        .transform(vectors)
        .drop("features_raw")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    silhouette = ClusteringEvaluator(featuresCol="features", predictionCol="cluster_id")
    best, best_score = None, float("-inf")
    for k in range(2, min(max_k, rows - 1) + 1):
        model = KMeans(
            k=k, seed=seed, maxIter=max_iter, featuresCol="features", predictionCol="cluster_id"
        ).fit(scaled)
        score = silhouette.evaluate(model.transform(scaled))
        if score > best_score:
            best, best_score = model, score
    result = best.transform(scaled).drop("features")
    scaled.unpersist()
    return result
