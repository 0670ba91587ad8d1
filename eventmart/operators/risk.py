"""Abandonment labels, class weights, temporal split, risk tiers and outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.functions.columns import ladder


def _column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def risk_tier(probability: str | Column, age: str = "repo_age_days") -> Column:
    """Tier of a probability; age is looked at only below the risk thresholds."""
    p = _column(probability)
    return (
        F.when(p >= 0.70, V.HIGH_RISK)
        .when(p >= 0.40, V.MODERATE_RISK)
        .when(F.col(age) < V.MIN_AGE_DAYS, V.TOO_YOUNG)
        .otherwise(V.LOW_RISK)
    )


def momentum_label(momentum: str | Column) -> Column:
    return ladder(_column(momentum), V.MOMENTUM_LABELS, V.MOMENTUM_BELOW, "ge")


def labelled_repositories(
    repositories: DataFrame, activity: DataFrame, as_of_year: int
) -> DataFrame:
    """Repositories with label 1 (abandoned) or 0, young ones without a verdict left out.

    Archived means abandoned; so does being two years old with no activity in the last
    two years.
    """
    last = (
        activity.filter(F.col("repo_key").isNotNull())
        .groupBy("repo_key")
        .agg(F.max("year").alias("last_active_year"))
    )
    age = F.col("repo_age_days")
    silent = (age >= V.MIN_AGE_DAYS) & (F.col("last_active_year") < as_of_year - 2)
    label = (
        F.when(F.col("is_archived"), 1)
        .when(silent, 1)
        .when(age < V.MIN_AGE_DAYS, F.lit(None))
        .otherwise(0)
    )
    return (
        repositories.filter(F.col("created_at").isNotNull() & age.isNotNull())
        .join(last, "repo_key", "left")
        .select(
            "repo_key",
            "language",
            "license",
            "is_ai_ml_repo",
            "has_readme",
            "has_ci",
            "created_year",
            "repo_age_days",
            F.to_date("created_at").alias("repo_created_date"),
            label.cast("int").alias("label"),
        )
        .filter(F.col("label").isNotNull())
    )


def class_balance(labelled: DataFrame) -> DataFrame:
    """Counts per class and the weight of a positive row, in one row."""
    positive, negative = F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)
    weight = negative.cast("double") / F.greatest(positive, F.lit(1)).cast("double")
    return labelled.agg(
        positive.alias("positives"), negative.alias("negatives"), weight.alias("weight_ratio")
    )


def with_class_weight(features: DataFrame, balance: DataFrame) -> DataFrame:
    """Weight positives by the class ratio, read from `balance` as a scalar subquery."""
    ratio = balance.select("weight_ratio").scalar()
    return features.withColumn(
        "class_weight", F.when(F.col("label") == 1, ratio).otherwise(F.lit(1.0))
    )


def temporal_split(rows: DataFrame, as_of_year: int) -> tuple[DataFrame, DataFrame]:
    """Train on repositories created up to Y-4, test on those from (Y-4, Y-2]."""
    created, cutoff = F.col("created_year"), as_of_year - 4
    return (
        rows.filter(created <= cutoff),
        rows.filter((created > cutoff) & (created <= as_of_year - 2)),
    )


def outcome(label: str = "label", prediction: str = "prediction") -> Column:
    """Confusion cell of a prediction."""
    truth, guess = F.col(label), F.col(prediction)
    return (
        F.when((truth == 1) & (guess == 1), "True Positive")
        .when((truth == 0) & (guess == 0), "True Negative")
        .when((truth == 0) & (guess == 1), "False Positive")
        .when((truth == 1) & (guess == 0), "False Negative")
    )
