"""Dimensions of the star schema and the surrogate keys of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.functions.columns import hour_key
from eventmart.operators.conform import first_per_key

DATED_TYPES = ("PushEvent", "PullRequestEvent", "IssuesEvent", "WatchEvent", "ForkEvent")


def dim_date(
    timestamps: DataFrame,
    column: str = "created_at",
    period: tuple[str, str, str] = V.COVID_PERIOD,
) -> DataFrame:
    """One row per hour that occurs.

    Truncating before the distinct lets the map side collapse each partition to its hours,
    so what is shuffled is hours, not events.
    """
    return describe_hours(
        timestamps.select(F.date_trunc("hour", column).alias("h")).distinct(), period
    )


def describe_hours(hours: DataFrame, period: tuple[str, str, str] = V.COVID_PERIOD) -> DataFrame:
    """Calendar columns of distinct hours `h`; `period` is (flag name, first, last day)."""
    flag, first_day, last_day = period
    return hours.selectExpr(
        "CAST(year(h) * 1000000 + month(h) * 10000 + day(h) * 100 + hour(h) AS INT) AS date_key",
        "to_date(h) AS full_date",
        "CAST(year(h) AS SMALLINT) AS year",
        "CAST(quarter(h) AS TINYINT) AS quarter",
        "CAST(month(h) AS TINYINT) AS month",
        "date_format(h, 'MMMM') AS month_name",
        "CAST(dayofweek(h) AS TINYINT) AS day_of_week",
        "date_format(h, 'EEEE') AS day_name",
        "CAST(hour(h) AS TINYINT) AS hour",
        "dayofweek(h) IN (1, 7) AS is_weekend",
        f"to_date(h) BETWEEN DATE'{first_day}' AND DATE'{last_day}' AS {flag}",
    )


def dim_repository(
    repositories: DataFrame,
    as_of: str | None = None,
    topic_pattern: str = V.AI_TOPIC_PATTERN,
    word_boundary: bool = False,
) -> DataFrame:
    """Repository dimension with defaults, owner, topic flag and age in days.

    The topic pattern matches anywhere in the text; `word_boundary` confines it to words.
    """
    pattern = rf"\b(?:{topic_pattern})\b" if word_boundary else topic_pattern
    today = F.lit(as_of).cast("date") if as_of else F.current_date()
    order = [F.col("created_at").desc_nulls_last()] + [
        c for c in repositories.columns if c not in ("repo_id", "created_at")
    ]
    unique = first_per_key(repositories, ["repo_id"], order)
    topics = F.coalesce("topics", F.lit(""))
    return unique.select(
        F.col("repo_id").cast("bigint").alias("repo_key"),
        "repo_id",
        "repo_name",
        F.substring_index("repo_name", "/", 1).alias("owner_login"),
        F.coalesce("language", F.lit(V.UNKNOWN_LANGUAGE)).alias("language"),
        "license",
        topics.alias("topics"),
        "stars_at_extract",
        "forks_at_extract",
        (F.lower(topics).rlike(pattern) | F.lower("repo_name").rlike(pattern)).alias(
            "is_ai_ml_repo"
        ),
        "is_archived",
        F.year("created_at").cast("smallint").alias("created_year"),
        "description",
        "has_readme",
        "has_ci",
        F.datediff(today, F.to_date("created_at")).alias("repo_age_days"),
        "created_at",
    )


def dim_contributor(contributors: DataFrame) -> DataFrame:
    return contributors.select(
        F.col("actor_id").cast("bigint").alias("contributor_key"),
        "actor_id",
        "login",
        F.coalesce(F.lower("login").rlike(V.BOT_PATTERN), F.lit(False)).alias("is_bot"),
        "account_type",
    )


def _known_languages(spark: SparkSession) -> DataFrame:
    """The attribute table as an inline relation, so its tiny size is known to the planner."""

    def literal(value) -> str:
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    rows = ", ".join(f"({', '.join(map(literal, row))})" for row in V.KNOWN_LANGUAGES)
    return spark.sql(
        f"SELECT language_name, paradigm, type_system, CAST(first AS BIGINT) AS first_appeared,"
        f" is_emerging FROM VALUES {rows}"
        f" AS known(language_name, paradigm, type_system, first, is_emerging)"
    )


def dim_language(repositories: DataFrame) -> DataFrame:
    """Languages found in the data and the known ones, keyed by alphabetical position.

    The ranking window sees distinct language names only, a vocabulary and not the data:
    the distinct below it runs partially on the map side.
    """
    known = _known_languages(repositories.sparkSession)
    found = repositories.select(
        F.coalesce("language", F.lit(V.UNKNOWN_LANGUAGE)).alias("language_name")
    )
    names = found.union(known.select("language_name")).distinct()
    return names.join(known, "language_name", "left").select(
        F.row_number().over(Window.orderBy("language_name")).cast("bigint").alias("language_key"),
        "language_name",
        F.coalesce("paradigm", F.lit("unknown")).alias("paradigm"),
        F.coalesce("type_system", F.lit("unknown")).alias("type_system"),
        "first_appeared",
        F.coalesce("is_emerging", F.lit(False)).alias("is_emerging"),
    )


def unknown_language_key(languages: DataFrame):
    """Key of the default language as a scalar subquery; -1 if the dimension lacks it."""
    return (
        languages.filter(F.col("language_name") == V.UNKNOWN_LANGUAGE)
        .agg(F.coalesce(F.min("language_key"), F.lit(-1).cast("bigint")))
        .scalar()
    )


def repo_lookup(repositories: DataFrame, languages: DataFrame) -> DataFrame:
    """repo_id -> (repo_key, language_key), one row per row of the repository dimension.

    The language is an attribute of the repository, so it is resolved here, on the
    dimension, and the event stream needs no join of its own for it.
    """
    by_name = languages.groupBy(F.lower("language_name").alias("name")).agg(
        F.min("language_key").alias("language_key")
    )
    repos = repositories.select("repo_id", "repo_key", F.lower("language").alias("name"))
    return repos.join(by_name, "name", "left").select("repo_id", "repo_key", "language_key")


def attach_keys(
    events: DataFrame,
    repositories: DataFrame,
    contributors: DataFrame,
    languages: DataFrame,
    ts_column: str = "created_at",
    lookup: DataFrame | None = None,
) -> DataFrame:
    """Add date_key, repo_key, contributor_key and language_key to an event stream.

    `lookup` is `repo_lookup` made before: bucketed by repo_id as the events are, it joins in place.
    Unknown repositories and contributors keep a NULL key and the default language. The
    date key is computed, not looked up: a lookup could not change it. Both dimensions are
    unique on their natural key by construction, so the joins never multiply events.
    """
    people = contributors.select("actor_id", "contributor_key")
    keyed = (
        events.withColumn("date_key", hour_key(ts_column))
        .join(repo_lookup(repositories, languages) if lookup is None else lookup, "repo_id", "left")
        .join(people, "actor_id", "left")
    )
    return keyed.withColumn(
        "language_key", F.coalesce("language_key", unknown_language_key(languages))
    )
