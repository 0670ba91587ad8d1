"""Feature frame for the abandonment model.

Everything read from the hourly activity is one aggregation, and so is everything read
from the pushes and from the pull requests. The single-purpose functions reuse the same
expression lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.functions.columns import hour_key_date, mean_int


def _early() -> Column:
    """Within the early window; activity dated before the creation day counts as early."""
    return F.col("obs_date") <= F.date_add("repo_created_date", V.EARLY_WINDOW_DAYS)


def _with_dates(rows: DataFrame, repositories: DataFrame) -> DataFrame:
    """Rows of the given repositories with the day of the event and the creation day."""
    dates = repositories.select("repo_key", "repo_created_date")
    day = hour_key_date("date_key")
    if "obs_date" in rows.columns:
        day = F.coalesce("obs_date", day)
    return rows.withColumn("obs_date", day).join(dates, "repo_key")


_EARLY_SUMS = {
    "early_commits": "total_commits",
    "early_pushes": "total_pushes",
    "early_stars": "total_stars",
    "early_forks": "total_forks",
    "early_prs_opened": "total_prs_opened",
    "early_prs_merged": "total_prs_merged",
    "early_issues": "total_issues_opened",
}


def _early_aggregates(inside: Column) -> list[Column]:
    sums = [F.sum(F.when(inside, F.col(c))).alias(name) for name, c in _EARLY_SUMS.items()]
    return [
        *sums,
        mean_int(F.when(inside, F.col("unique_contributors"))).alias("avg_daily_contributors"),
        # NULL, not 0, for a repository without early activity, as from an outer join
        F.nullif(F.count(F.when(inside, F.col("date_key"))), F.lit(0)).alias(
            "active_days_in_90"
        ),
    ]


def _era_aggregates(boundary: int) -> list[Column]:
    commits = F.col("total_commits")
    return [
        mean_int(F.when(F.col("year") <= boundary, commits)).alias("avg_commits_early"),
        mean_int(F.when(F.col("year") > boundary, commits)).alias("avg_commits_recent"),
    ]


def _momentum() -> Column:
    early = F.coalesce("avg_commits_early", F.lit(0.0))
    return F.coalesce("avg_commits_recent", F.lit(0.0)) / (early + 1.0)


def _lifetime_aggregates() -> list[Column]:
    return [
        F.count_distinct("date_key").alias("total_active_days"),
        F.count_distinct("year").alias("years_observed"),
    ]


def early_activity(activity: DataFrame, repositories: DataFrame) -> DataFrame:
    """Sums over the first 90 days of each repository."""
    inside = _with_dates(activity, repositories).filter(_early())
    return inside.groupBy("repo_key").agg(*_early_aggregates(F.lit(True)))


def momentum(activity: DataFrame, boundary: int) -> DataFrame:
    """Average hourly commits before and after the boundary year, and their ratio."""
    return (
        activity.filter(F.col("repo_key").isNotNull())
        .groupBy("repo_key")
        .agg(*_era_aggregates(boundary))
        .withColumn("commit_momentum", _momentum())
    )


def lifetime(activity: DataFrame) -> DataFrame:
    """Distinct active hours (the day columns of the source are hours) and years."""
    known = activity.filter(F.col("repo_key").isNotNull())
    return known.groupBy("repo_key").agg(*_lifetime_aggregates())


def activity_features(activity: DataFrame, repositories: DataFrame, boundary: int) -> DataFrame:
    """Early window, momentum and lifetime in one pass over the activity.

    First to (repository, year): hours belong to one year, so distinct hours and years can
    be added up from there and no row is multiplied for a second distinct count. A hot
    repository has at most one row per hour here and one per year afterwards.
    """
    inside = _early()
    commits = F.col("total_commits")
    parts = {name: F.when(inside, F.col(c)) for name, c in _EARLY_SUMS.items()}
    yearly = (
        _with_dates(activity, repositories)
        .groupBy("repo_key", "year")
        .agg(
            *(F.sum(value).alias(name) for name, value in parts.items()),
            F.sum(F.when(inside, F.col("unique_contributors"))).alias("people"),
            F.count(F.when(inside, F.col("date_key"))).alias("early_hours"),
            F.sum(commits).alias("commits"),
            F.count(commits).alias("hours"),
            F.count_distinct("date_key").alias("active_hours"),
        )
    )

    def era_mean(condition: Column) -> Column:
        total = F.sum(F.when(condition, F.col("commits"))).cast("double")
        return total / F.nullif(F.sum(F.when(condition, F.col("hours"))), F.lit(0))

    early_hours = F.nullif(F.sum("early_hours"), F.lit(0))
    return (
        yearly.groupBy("repo_key")
        .agg(
            *(F.sum(name).alias(name) for name in _EARLY_SUMS),
            (F.sum("people").cast("double") / early_hours).alias("avg_daily_contributors"),
            early_hours.alias("active_days_in_90"),
            era_mean(F.col("year") <= boundary).alias("avg_commits_early"),
            era_mean(F.col("year") > boundary).alias("avg_commits_recent"),
            F.sum("active_hours").alias("total_active_days"),
            F.count("year").alias("years_observed"),
        )
        .withColumn("commit_momentum", _momentum())
    )


def push_features(pushes: DataFrame, repositories: DataFrame) -> DataFrame:
    """Distinct branches and share of pushes to the default branch in the early window."""
    early = _with_dates(pushes, repositories).filter(_early())
    return early.groupBy("repo_key").agg(
        F.count_distinct("branch_ref").alias("unique_branches"),
        mean_int(F.col("is_default_branch")).alias("default_branch_push_ratio"),
    )


def pr_features(prs: DataFrame, repositories: DataFrame) -> DataFrame:
    early = _with_dates(prs, repositories).filter(_early())
    return early.groupBy("repo_key").agg(
        mean_int(F.col("additions")).alias("avg_pr_additions"),
        mean_int(F.col("review_comments")).alias("avg_review_comments"),
        F.sum(F.col("is_merged").cast("bigint")).alias("early_merged_prs"),
    )


def contributor_features(
    pushes: DataFrame, contributors: DataFrame, repositories: DataFrame
) -> DataFrame:
    """Distinct people, bots left out, who pushed in the early window.

    The pairs are made distinct before the join with the contributors, so that join sees
    each (repository, contributor) once however often it pushed.
    """
    people = contributors.filter(~F.col("is_bot")).select("contributor_key")
    pairs = (
        _with_dates(pushes, repositories)
        .filter(_early())
        .select("repo_key", "contributor_key")
        .distinct()
    )
    return (
        pairs.join(people, "contributor_key", "left_semi")
        .groupBy("repo_key")
        .agg(F.count("contributor_key").alias("total_unique_contributors"))
    )


def push_side_features(
    pushes: DataFrame, contributors: DataFrame, repositories: DataFrame
) -> DataFrame:
    """Push and contributor features together, from one join with the creation days.

    The early pushes are counted at (repository, branch, contributor) grain first. The
    contributor join and the two distinct counts then work on that smaller frame.
    """
    people = contributors.filter(~F.col("is_bot")).select(
        "contributor_key", F.col("contributor_key").alias("person")
    )
    grain = (
        _with_dates(pushes, repositories)
        .filter(_early())
        .groupBy("repo_key", "branch_ref", "is_default_branch", "contributor_key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    on_default = F.sum(F.col("is_default_branch").cast("bigint") * F.col("n"))
    with_branch = F.sum(F.when(F.col("is_default_branch").isNotNull(), F.col("n")))
    return (
        grain.join(people, "contributor_key", "left")
        .groupBy("repo_key")
        .agg(
            F.count_distinct("branch_ref").alias("unique_branches"),
            (on_default.cast("double") / with_branch).alias("default_branch_push_ratio"),
            F.nullif(F.count_distinct("person"), F.lit(0)).alias("total_unique_contributors"),
        )
    )


def build_features(
    repositories: DataFrame,
    activity: DataFrame,
    pushes: DataFrame,
    prs: DataFrame,
    contributors: DataFrame,
    boundary: int,
) -> DataFrame:
    """All features of the given repositories.

    `repositories` needs repo_key and repo_created_date; its other columns are kept. The
    joins are all on repo_key, which every feature frame is already partitioned by.
    """

    def smoothed(part: str, whole: str) -> Column:
        top = F.coalesce(F.col(part), F.lit(0)).cast("double")
        return top / (F.coalesce(F.col(whole), F.lit(0)) + 1).cast("double")

    parts = (
        activity_features(activity, repositories, boundary),
        push_side_features(pushes, contributors, repositories),
        pr_features(prs, repositories),
    )
    out = repositories.drop("repo_created_date")
    for part in parts:
        out = out.join(part, "repo_key", "left")
    return out.withColumns(
        {
            "pr_merge_rate": smoothed("early_merged_prs", "early_prs_opened"),
            "fork_to_star_ratio": smoothed("early_forks", "early_stars"),
            "commits_per_active_day": smoothed("early_commits", "active_days_in_90"),
        }
    )
