"""Ranking of repositories, enrichment work list, metadata responses and contributors."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.operators.conform import first_per_key


def repo_event_counts(events: DataFrame, year: int) -> DataFrame:
    """Events per repository in one year, over the union of all event tables."""
    return (
        events.filter(F.col("year") == year)
        .groupBy("repo_id")
        .agg(F.count("event_id").alias("n"))
    )


def _latest(events: DataFrame, key: str, value: str) -> DataFrame:
    """Latest non-null value per key.

    First to (key, value) with a fixed-width maximum, which hashes on the map side and
    leaves a row or two per key; only those reach the string comparison.
    """
    return (
        events.filter(F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.max("created_at").alias("seen"))
        .groupBy(key)
        .agg(F.max_by(value, F.struct("seen", value)).alias(value))
    )


def repo_names(events: DataFrame) -> DataFrame:
    """Latest name of each repository."""
    return _latest(events, "repo_id", "repo_name")


_RANGE = 1 << 20  # consecutive whole numbers that one sort holds at most


def _numbered(rows: DataFrame, key: str, name: str, within: str | None = None) -> DataFrame:
    """Adds `name`: the place (from 1) of each row in the order of `key`, per value of `within`.

    `key` holds distinct whole numbers. Rows are sorted in ranges of the key, which bounds every sort
    whatever the number of rows; only one count per range meets in a window.
    """
    same = [within] if within else []
    ranged = rows.withColumn("_range", F.floor(F.col(key) / _RANGE))
    counts = ranged.groupBy(*same, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*same).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*same, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(*same, "_range").orderBy(key))
    return (
        ranged.withColumn("_row", place)
        .join(starts, [*same, "_range"])
        .withColumn(name, F.col("_row") + F.col("_start"))
        .drop("_range", "_row", "_start")
    )


def top_repos(
    events: DataFrame,
    year: int | None = None,
    percent: float | None = None,
    top_n: int | None = None,
) -> DataFrame:
    """The busiest repositories of a year, or of all years without one.

    Keeps the busiest `percent` of them, at least one, and no more than `top_n` if that is
    given. The cut is found on a histogram of the counts; only the rows above it are ranked.
    """
    if year is not None:
        events = events.filter(F.col("year") == year)
    grain = events.groupBy("repo_id", "repo_name").agg(
        F.count("event_id").alias("n"), F.max("created_at").alias("seen")
    )
    named = F.when(F.col("repo_name").isNotNull(), F.struct("seen", "repo_name"))
    per_repo = grain.groupBy("repo_id").agg(
        F.max_by("repo_name", named).alias("repo_name"), F.sum("n").alias("n")
    )
    # one row per different count: at most the root of twice the number of events
    histogram = per_repo.groupBy("n").agg(F.count(F.lit(1)).alias("_repos"))
    busier = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.desc("n")).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    share = F.lit(100.0 if percent is None else float(percent))
    keep = F.greatest(F.lit(1), F.floor(F.sum("_repos").over(whole) * share / 100))
    if top_n is not None:
        keep = F.least(keep, F.lit(top_n))
    cut = histogram.select(
        "n", F.coalesce(F.sum("_repos").over(busier), F.lit(0)).alias("_above"), keep.alias("_keep")
    ).filter(F.col("_above") < F.col("_keep"))
    ranked = _numbered(per_repo.join(cut, "n"), "repo_id", "_place", within="n")
    rank = (F.col("_above") + F.col("_place")).cast("bigint")
    return ranked.filter(rank <= F.col("_keep")).select(
        rank.alias("rank"), "repo_id", "repo_name", "n"
    )


def repos_to_fetch(top: DataFrame, enriched: DataFrame) -> DataFrame:
    """Ranked repositories without a metadata row yet."""
    return top.join(enriched.select("repo_id"), "repo_id", "left_anti")


def shard_worklist(worklist: DataFrame, shards: int) -> DataFrame:
    """Deal the ranked work list to shards in turn."""
    dealt = _numbered(worklist, "rank", "_turn")
    shard = F.pmod(F.col("_turn") - 1, F.lit(shards)).cast("int")
    return dealt.withColumn("shard", shard).select(*worklist.columns, "shard")


def conform_metadata(
    responses: DataFrame, detect_ci: bool = False, max_description: int | None = None
) -> DataFrame:
    """Landed metadata responses -> one row per repository.

    The response does not say whether there is a readme or a CI set-up; `detect_ci` looks
    for a workflow folder in the contents address, as the local collector does.
    """
    text = F.coalesce("description", F.lit(""))
    if max_description is not None:
        text = F.substring(text, 1, max_description)
    ci = F.coalesce(F.col("contents_url").contains(".github/workflows"), F.lit(False))
    rows = responses.filter(F.col("id").isNotNull()).select(
        F.col("id").alias("repo_id"),
        F.col("full_name").alias("repo_name"),
        "language",
        F.col("license.spdx_id").alias("license"),
        F.concat_ws(",", "topics").alias("topics"),
        F.col("stargazers_count").alias("stars_at_extract"),
        F.col("forks_count").alias("forks_at_extract"),
        text.alias("description"),
        F.col("archived").alias("is_archived"),
        F.col("has_readme"),
        (ci if detect_ci else F.lit(None).cast("boolean")).alias("has_ci"),
        F.try_to_timestamp("created_at").alias("created_at"),
    )
    return unique_repositories(rows)


def unique_repositories(rows: DataFrame) -> DataFrame:
    """One row per repo_id, the first in column order."""
    return first_per_key(rows, ["repo_id"], [c for c in rows.columns if c != "repo_id"])


def merge_shards(shards: DataFrame) -> DataFrame:
    """Rows of all shards with a parsed timestamp, one per repository."""
    parsed = shards.drop("shard")
    if dict(parsed.dtypes)["created_at"] == "string":
        parsed = parsed.withColumn("created_at", F.try_to_timestamp("created_at"))
    return unique_repositories(parsed)


def contributors(events: DataFrame, account_type: str = "User") -> DataFrame:
    """Every actor once, with the latest login seen, if any was."""
    actors = events.filter(F.col("actor_id").isNotNull())
    seen = actors.groupBy("actor_id", F.col("actor_login").alias("login")).agg(
        F.max("created_at").alias("seen")
    )
    # rows without a login keep the actor; max_by passes over a NULL ordering
    order = F.when(F.col("login").isNotNull(), F.struct("seen", "login"))
    return seen.groupBy("actor_id").agg(
        F.max_by("login", order).alias("login"), F.lit(account_type).alias("account_type")
    )
