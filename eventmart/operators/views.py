"""Analysis views over the star schema."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.functions.columns import (
    day_name,
    flag_count,
    hour_key_date,
    hour_key_day,
    hour_key_hour,
    hour_key_year,
    hour_keys_of_years,
    ladder,
    mean_2dp,
    mean_fixed,
    mean_int,
    percent,
    ratio,
)


def _sums(**names: str) -> list:
    return [F.sum(source).alias(name) for name, source in names.items()]


def _bitmap(dates: DataFrame, flag: str | None) -> Column:
    """The hours of the dimension, and those with the flag, as the one row of a scalar subquery.

    Element 0 is the first day (yyyyMMdd) above 24 empty bits; a long per day number from then on
    holds 24 bits for its hours and 24 for those flagged. It takes 80 KB a year, whatever the rows
    that look hours up.
    """
    bit = F.expr("shiftleft(1L, CAST(date_key % 100 AS INT))")
    flagged = F.when(F.col(flag), F.expr("shiftleft(1L, CAST(24 + date_key % 100 AS INT))")) if flag else F.lit(None)
    days = dates.groupBy(hour_key_day("date_key").alias("day")).agg(
        F.bit_or(bit).bitwiseOR(F.coalesce(F.bit_or(flagged.cast("long")), F.lit(0))).alias("bits")
    )
    listed = days.agg(F.array_sort(F.collect_list(F.struct("day", "bits"))).alias("days"))

    def with_gap(x: Column, i: Column) -> Column:
        gap = F.get("days", i + 1)["day"] - x["day"] - 1
        return F.concat(F.array(x["bits"]), F.array_repeat(F.lit(0).cast("long"), F.coalesce(gap, F.lit(0))))

    first = F.array(F.shiftleft(F.get("days", F.lit(0))["day"].cast("long"), 24))
    return listed.select(F.concat(first, F.flatten(F.transform("days", with_gap)))).scalar()


# calendar columns that an hour key tells by itself
_FROM_KEY = {
    "year": lambda: hour_key_year("date_key"),
    "hour": lambda: hour_key_hour("date_key"),
    "day_of_week": lambda: F.dayofweek(hour_key_date("date_key")).cast("tinyint"),
    "is_weekend": lambda: F.dayofweek(hour_key_date("date_key")).isin(1, 7),
}


def _dated(activity: DataFrame, dates: DataFrame, *columns: str) -> DataFrame:
    """Activity with columns of its hour; hours outside the dimension drop out.

    Nothing is joined: calendar columns are read off the key, and the hours of the dimension and
    at most one other flag of it are looked up in a bitmap.
    """
    flags = [c for c in columns if c not in _FROM_KEY]
    if len(flags) > 1:
        raise ValueError(f"one flag at a time, not {flags}")
    bitmap = _bitmap(dates, flags[0] if flags else None)
    # a day before the first has a place below 1: none, or one without hours
    day = hour_key_day("date_key") - F.shiftright(F.get(bitmap, F.lit(0)), 24).cast("int") + 1
    bits, hour = F.get(bitmap, day), (F.col("date_key") % 100).cast("int")
    kept = activity.filter(F.getbit(bits, hour) == 1)
    told = {c: _FROM_KEY[c]() if c in _FROM_KEY else F.getbit(bits, hour + 24) == 1 for c in columns}
    return kept.withColumns(told)


def language_evolution(
    yearly: DataFrame, languages: DataFrame, years: tuple[int, int] = (2016, 2026)
) -> DataFrame:
    named = languages.select("language_key", "language_name").filter(
        F.col("language_name") != V.UNKNOWN_LANGUAGE
    )
    return (
        yearly.filter(F.col("year").between(*years))
        .join(named, "language_key")
        .select(
            "language_name",
            "year",
            "total_push_events",
            "total_commits",
            "unique_repos",
            "unique_contributors",
            "market_share_pct",
            "yoy_push_growth_pct",
        )
    )


def ai_boom(activity: DataFrame, dates: DataFrame, repositories: DataFrame) -> DataFrame:
    """Yearly activity of repositories with and without the topic flag.

    Hours are summed to (year, repository) before the repository join, which shrinks what
    that join has to shuffle and turns a hot repository into one row per year.
    """
    per_repo = (
        _dated(activity.filter(F.col("repo_key").isNotNull()), dates, "year")
        .groupBy("year", "repo_key")
        .agg(
            *_sums(
                total_pushes="total_pushes",
                total_stars="total_stars",
                total_forks="total_forks",
                total_prs="total_prs_opened",
            )
        )
    )
    grouped = (
        per_repo.join(repositories.select("repo_key", "is_ai_ml_repo"), "repo_key")
        .groupBy("year", "is_ai_ml_repo")
        .agg(
            F.count_distinct("repo_key").alias("unique_repos"),
            *_sums(
                total_pushes="total_pushes",
                total_stars="total_stars",
                total_forks="total_forks",
                total_prs="total_prs",
            ),
        )
    )
    of_year = F.sum("total_pushes").over(Window.partitionBy("year"))
    return grouped.withColumn(
        "ai_activity_share_pct", percent(F.col("total_pushes"), of_year, 2)
    )


def covid_impact(
    activity: DataFrame,
    dates: DataFrame,
    years: Sequence[int] = V.COVID_YEARS,
    flag: str = V.COVID_PERIOD[0],
) -> DataFrame:
    wanted = activity.filter(hour_keys_of_years("date_key", years))
    return (
        _dated(wanted, dates, "year", "hour", flag, "is_weekend")
        .groupBy("year", "hour", flag, "is_weekend")
        .agg(
            *_sums(
                total_pushes="total_pushes",
                total_prs="total_prs_opened",
                total_issues="total_issues_opened",
            ),
            F.count_distinct("repo_key").alias("unique_repos"),
        )
    )


def repo_health(activity: DataFrame, repositories: DataFrame) -> DataFrame:
    """Health score: merge speed, close speed, merge rate and reach, 25 points each."""
    metrics = (
        activity.filter(F.col("repo_key").isNotNull())
        .groupBy("repo_key")
        .agg(
            mean_fixed(F.col("avg_pr_merge_hours")).alias("avg_pr_merge_hrs"),
            mean_fixed(F.col("avg_issue_close_hours")).alias("avg_issue_close_hrs"),
            F.sum("total_stars").alias("total_stars"),
            F.sum("total_forks").alias("total_forks"),
            ratio(F.sum("total_prs_merged"), F.sum("total_prs_opened")).alias("merge_rate"),
        )
    )

    def speed(hours: str, limit: float):
        used = F.coalesce(F.col(hours), F.lit(limit)) / limit
        return 25 * (1 - F.least(F.lit(1.0), used))

    reach = F.ln(1 + F.col("total_stars") + F.col("total_forks")) / 15.0
    points = (
        speed("avg_pr_merge_hrs", 168.0)
        + speed("avg_issue_close_hrs", 720.0)
        + 25 * F.coalesce("merge_rate", F.lit(0.0))
        + 25 * F.least(F.lit(1.0), reach)
    )
    score = F.round(F.least(F.lit(100.0), F.greatest(F.lit(0.0), points)), 2)
    labels = repositories.select("repo_key", "repo_name", "language", "is_ai_ml_repo")
    return metrics.join(labels, "repo_key").select(
        "repo_name",
        "language",
        "is_ai_ml_repo",
        "avg_pr_merge_hrs",
        "avg_issue_close_hrs",
        "total_stars",
        "total_forks",
        "merge_rate",
        score.alias("health_score"),
    )


def pr_lifecycle(prs: DataFrame, dates: DataFrame, languages: DataFrame) -> DataFrame:
    """Closed pull requests by year, language and size.

    Aggregated on keys first; names are joined to the few result rows.
    """
    events = F.count("event_id")
    merged = F.sum(F.col("is_merged").cast("bigint"))
    per_key = (
        _dated(prs.filter(F.col("action") == "closed"), dates, "year")
        .groupBy("year", "language_key", "pr_size_bucket")
        .agg(
            events.alias("total_pr_events"),
            merged.alias("merged_count"),
            percent(merged, events, 2).alias("merge_rate_pct"),
            F.round(mean_2dp(F.col("time_to_merge_hours")), 1).alias("avg_merge_hrs"),
            F.round(mean_int(F.col("review_comments")), 2).alias("avg_review_comments"),
            F.round(mean_int(F.col("additions") + F.col("deletions")), 0).alias(
                "avg_lines_changed"
            ),
        )
    )
    named = languages.select("language_key", "language_name")
    return per_key.join(named, "language_key").drop("language_key")


def _same_name(left: DataFrame, right: DataFrame):
    return left.repo_name.eqNullSafe(right.repo_name) & left.language.eqNullSafe(right.language)


def bus_factor(
    pushes: DataFrame, repositories: DataFrame, min_contributors: int = 3
) -> DataFrame:
    """Share of the pushes of a repository made by its top 1, 3 and 5 contributors.

    Ranks are computed on a histogram, (repository, push count) -> number of contributors,
    and not on the contributors. A repository with P pushes has at most sqrt(2P) different
    push counts, so even the largest one is a small window partition. All contributors with
    the same count share a rank, and the rank is one plus the number of contributors above.

    Repositories that share name and language are reported as one row. Their contributors
    have to be counted once across all of them; only those names need the distinct count.
    """
    names = repositories.select("repo_key", "repo_name", "language")
    sharing = (
        names.groupBy("repo_name", "language")
        .agg(F.count(F.lit(1)).alias("keys"))
        .filter(F.col("keys") > 1)
    )
    pairs = (
        pushes.filter(F.col("repo_key").isNotNull())
        .groupBy("repo_key", "contributor_key")
        .agg(F.count("event_id").alias("push_count"))
    )
    histogram = pairs.groupBy("repo_key", "push_count").agg(
        F.count(F.lit(1)).alias("people"), F.count("contributor_key").alias("named_people")
    )
    repo = Window.partitionBy("repo_key")
    above = F.sum("people").over(
        repo.orderBy(F.desc("push_count")).rowsBetween(Window.unboundedPreceding, -1)
    )
    made = F.col("push_count") * F.col("people")

    def share_of_top(k: int):
        return F.sum(F.when(F.col("rnk") <= k, made).otherwise(0)).alias(f"top{k}")

    per_repo = (
        histogram.withColumn("rnk", F.coalesce(above, F.lit(0)) + 1)
        .groupBy("repo_key")
        .agg(
            F.sum(made).alias("repo_total"),
            F.sum("named_people").alias("contributors"),
            *(share_of_top(k) for k in (1, 3, 5)),
        )
        .join(names, "repo_key")
    )
    shared_keys = names.join(sharing, _same_name(names, sharing), "left_semi")
    shared = (
        pairs.join(shared_keys, "repo_key")
        .groupBy("repo_name", "language")
        .agg(F.count_distinct("contributor_key").alias("shared_contributors"))
    )
    top = [
        percent(F.sum(f"top{k}"), F.max("repo_total"), 2).alias(f"top{k}_pct") for k in (1, 3, 5)
    ]
    by_name = per_repo.groupBy("repo_name", "language").agg(
        F.sum("contributors").alias("contributors"), *top
    )
    total = F.coalesce(shared.shared_contributors, by_name.contributors)
    return (
        by_name.join(shared, _same_name(by_name, shared), "left")
        .select(
            by_name.repo_name,
            by_name.language,
            total.alias("total_contributors"),
            "top1_pct",
            "top3_pct",
            "top5_pct",
        )
        .filter(F.col("total_contributors") >= min_contributors)
    )


def ecosystem_growth(activity: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        _dated(activity, dates, "year")
        .groupBy("year")
        .agg(
            F.count_distinct("repo_key").alias("unique_repos"),
            *_sums(
                total_contributors="unique_contributors",
                total_pushes="total_pushes",
                total_prs="total_prs_opened",
                total_issues="total_issues_opened",
                total_stars="total_stars",
                total_forks="total_forks",
            ),
        )
        .withColumn(
            "pr_to_push_ratio", F.round(ratio(F.col("total_prs"), F.col("total_pushes")), 4)
        )
    )


def hourly_heatmap(activity: DataFrame, dates: DataFrame) -> DataFrame:
    slots = ("year", "hour", "day_of_week")
    return (
        _dated(activity, dates, *slots)
        .groupBy(*slots)
        .agg(
            *_sums(total_pushes="total_pushes", total_prs="total_prs_opened"),
            F.count_distinct("repo_key").alias("active_repos"),
        )
        .withColumn("day_name", day_name("day_of_week"))
    )


# ---- views over the model tables ---------------------------------------------------------


def ml_predictions(scores: DataFrame, repositories: DataFrame) -> DataFrame:
    about = repositories.select(
        "repo_key", "repo_name", "language", "is_ai_ml_repo", "created_year"
    )
    tier = ladder(
        F.col("abandonment_probability"), V.CONFIDENCE_TIERS, V.CONFIDENCE_BELOW, "ge"
    )
    return (
        scores.drop("created_year")
        .join(about, "repo_key")
        .select(
            "repo_name",
            "language",
            "is_ai_ml_repo",
            "created_year",
            "abandonment_probability",
            "risk_tier",
            "trajectory_label",
            "model_version",
            "scored_at",
            "is_archived",
            tier.alias("confidence_tier"),
        )
    )


def _risk_counts() -> list:
    def in_tier(label: str):
        return flag_count(F.col("risk_tier") == label)

    return [
        F.count(F.lit(1)).alias("total_repos"),
        in_tier(V.HIGH_RISK).alias("high_risk_count"),
        in_tier(V.MODERATE_RISK).alias("moderate_risk_count"),
        in_tier(V.LOW_RISK).alias("low_risk_count"),
        percent(in_tier(V.HIGH_RISK), F.count(F.lit(1)), 1).alias("high_risk_pct"),
    ]


def _scored_languages(scores: DataFrame, repositories: DataFrame) -> DataFrame:
    spoken = repositories.select("repo_key", "language").filter(F.col("language").isNotNull())
    return scores.join(spoken, "repo_key").groupBy("language")


def ml_by_language(
    scores: DataFrame, repositories: DataFrame, min_repos: int = 10
) -> DataFrame:
    mean = mean_fixed(F.col("abandonment_probability"), 6)
    return (
        _scored_languages(scores, repositories)
        .agg(*_risk_counts(), F.round(mean * 100, 2).alias("avg_abandonment_prob_pct"))
        .filter(F.col("total_repos") >= min_repos)
    )


def ml_feature_importance(importance: DataFrame) -> DataFrame:
    version = Window.partitionBy("model_version")
    share = percent(F.col("importance"), F.sum("importance").over(version), 2)
    rank = F.rank().over(version.orderBy(F.desc("importance")))
    return importance.select(
        "feature_name",
        "importance",
        "model_version",
        share.alias("importance_pct"),
        rank.cast("bigint").alias("importance_rank"),
    )


def latest_scores(scores: DataFrame) -> DataFrame:
    """Scores of the newest model version; the version is a one-row scalar subquery."""
    newest = scores.agg(F.max("model_version")).scalar()
    return scores.filter(F.col("model_version") == newest)


def abandonment_risk_current(scores: DataFrame, repositories: DataFrame) -> DataFrame:
    about = repositories.select(
        "repo_key",
        "repo_name",
        "owner_login",
        "language",
        "license",
        "is_ai_ml_repo",
        "has_readme",
        "has_ci",
        "created_year",
        "repo_age_days",
    )
    score = latest_scores(scores).select(
        "repo_key",
        "abandonment_probability",
        "risk_tier",
        "trajectory_label",
        "is_archived",
        "model_version",
        "scored_at",
    )
    return score.join(about, "repo_key").select(*about.columns[1:], *score.columns[1:])


def abandonment_by_language(scores: DataFrame, repositories: DataFrame) -> DataFrame:
    mean = mean_fixed(F.col("abandonment_probability"), 6)
    return _scored_languages(latest_scores(scores), repositories).agg(
        *_risk_counts(), F.round(mean, 4).alias("avg_abandonment_probability")
    )


def abandonment_trend(scores: DataFrame) -> DataFrame:
    tiers = scores.groupBy("model_version", "risk_tier").agg(
        F.count(F.lit(1)).alias("repo_count"),
        F.round(mean_fixed(F.col("abandonment_probability"), 6), 4).alias("avg_probability"),
    )
    of_version = F.sum("repo_count").over(Window.partitionBy("model_version"))
    return tiers.withColumn(
        "pct_of_scored_repos", percent(F.col("repo_count"), of_version, 1)
    )


def repo_trajectories(trajectories: DataFrame, repositories: DataFrame) -> DataFrame:
    about = repositories.select(
        "repo_key", "repo_name", "language", "is_ai_ml_repo", "created_year"
    )
    return trajectories.join(about, "repo_key").select(
        *about.columns[1:],
        "trajectory_label",
        "growth_ratio",
        "avg_commits_early",
        "avg_commits_recent",
        "years_observed",
        "computed_at",
    )


def language_forecast(forecasts: DataFrame, languages: DataFrame) -> DataFrame:
    about = languages.select("language_key", "paradigm", "type_system", "first_appeared")
    shares = [c for c in forecasts.columns if c.startswith("forecast_")]
    return (
        forecasts.filter(F.col("language_name").isNotNull())
        .join(about, "language_key", "left")
        .select(
            "language_name",
            "slope_pct_per_year",
            "r_squared",
            *shares,
            "trend_label",
            "computed_at",
            "paradigm",
            "type_system",
            "first_appeared",
        )
    )


def contributor_dynamics(pushes: DataFrame, dates: DataFrame) -> DataFrame:
    """New, returning and retained contributors per year.

    One window over the distinct (contributor, year) pairs replaces a self-join: a
    contributor has one row per active year, so no window partition can grow large.
    The retention rate is the share of this year's contributors active the year before.
    """
    yearly = (
        _dated(pushes.filter(F.col("contributor_key").isNotNull()), dates, "year")
        .groupBy("contributor_key", "year")
        .agg(F.count("event_id").alias("push_count"))
    )
    before = F.lag("year").over(Window.partitionBy("contributor_key").orderBy("year"))
    everyone = F.count(F.lit(1))
    new = flag_count(F.col("before").isNull())
    retained = flag_count(F.col("before") == F.col("year") - 1)
    return (
        yearly.withColumn("before", before)
        .groupBy("year")
        .agg(
            everyone.alias("total_contributors"),
            new.alias("new_contributors"),
            (everyone - new).alias("returning_contributors"),
            percent(new, everyone, 2).alias("new_contributor_pct"),
            retained.alias("retained_from_prior"),
            percent(retained, everyone, 2).alias("retention_rate_pct"),
            F.sum("push_count").alias("total_pushes"),
        )
        .orderBy("year")
    )


# View name -> (function, the tables it reads in order of its parameters)
VIEWS: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "analysis_language_evolution": (
        language_evolution,
        ("fact_language_yearly", "dim_language"),
    ),
    "analysis_ai_boom": (
        ai_boom,
        ("fact_repo_activity_daily", "dim_date", "dim_repository"),
    ),
    "analysis_covid_impact": (covid_impact, ("fact_repo_activity_daily", "dim_date")),
    "analysis_repo_health": (repo_health, ("fact_repo_activity_daily", "dim_repository")),
    "analysis_pr_lifecycle": (pr_lifecycle, ("fact_pr_events", "dim_date", "dim_language")),
    "analysis_bus_factor": (bus_factor, ("fact_push_events", "dim_repository")),
    "analysis_ecosystem_growth": (ecosystem_growth, ("fact_repo_activity_daily", "dim_date")),
    "analysis_hourly_heatmap": (hourly_heatmap, ("fact_repo_activity_daily", "dim_date")),
    "analysis_ml_predictions": (ml_predictions, ("ml_abandonment_risk", "dim_repository")),
    "analysis_ml_by_language": (ml_by_language, ("ml_abandonment_risk", "dim_repository")),
    "analysis_ml_feature_importance": (ml_feature_importance, ("ml_feature_importance",)),
    "analysis_abandonment_risk_current": (
        abandonment_risk_current,
        ("ml_abandonment_risk", "dim_repository"),
    ),
    "analysis_abandonment_by_language": (
        abandonment_by_language,
        ("ml_abandonment_risk", "dim_repository"),
    ),
    "analysis_abandonment_trend": (abandonment_trend, ("ml_abandonment_risk",)),
    "analysis_repo_trajectories": (
        repo_trajectories,
        ("ml_repo_trajectories", "dim_repository"),
    ),
    "analysis_language_forecast": (
        language_forecast,
        ("ml_language_trend_forecasts", "dim_language"),
    ),
    "analysis_contributor_dynamics": (contributor_dynamics, ("fact_push_events", "dim_date")),
}
