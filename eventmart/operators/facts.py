"""Event facts and the common activity stream the aggregates are computed from."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart import schemas as S
from eventmart.functions import vocab as V
from eventmart.functions.columns import hours_between, ladder
from eventmart.operators.conform import first_per_key
from eventmart.session import durable

KEYS = ("event_id", "date_key", "repo_key", "contributor_key", "language_key", "year")


def _fact(keyed: DataFrame, columns: list[str], unique: bool) -> DataFrame:
    """Select the fact columns; deduplicate only input that is not unique already."""
    fact = keyed.select(*KEYS, *columns)
    if unique:
        return fact
    return first_per_key(fact, ["event_id"], [c for c in fact.columns if c != "event_id"])


def default_branch(ref: str = "branch_ref") -> Column:
    return F.col(ref).rlike(V.DEFAULT_BRANCH_PATTERN)


def size_bucket(lines: Column) -> Column:
    return ladder(lines, V.PR_SIZES, V.PR_SIZE_ABOVE, "le")


def merge_hours() -> Column:
    return F.when(F.col("is_merged"), hours_between("merged_at", "pr_created_at"))


def close_hours() -> Column:
    return F.when(F.col("state") == "closed", hours_between("closed_at", "issue_created_at"))


def fact_push(keyed: DataFrame, unique: bool = False) -> DataFrame:
    out = keyed.withColumn("is_default_branch", default_branch())
    return _fact(out, ["commit_count", "branch_ref", "is_default_branch"], unique)


def fact_pr(keyed: DataFrame, unique: bool = False) -> DataFrame:
    out = keyed.withColumns(
        {
            "pr_size_bucket": size_bucket(F.col("additions") + F.col("deletions")),
            "time_to_merge_hours": merge_hours(),
        }
    )
    columns = [
        "action",
        "pr_id",
        "is_merged",
        "additions",
        "deletions",
        "changed_files",
        "review_comments",
        "time_to_merge_hours",
        "pr_size_bucket",
    ]
    return _fact(out, columns, unique)


def fact_issues(keyed: DataFrame, unique: bool = False) -> DataFrame:
    out = keyed.withColumn("time_to_close_hours", close_hours())
    columns = ["action", "issue_id", "label_list", "comments_count", "time_to_close_hours"]
    return _fact(out, columns, unique)


def fact_release(keyed: DataFrame, unique: bool = False) -> DataFrame:
    columns = [
        "action",
        "release_id",
        "tag_name",
        "release_name",
        "is_prerelease",
        "is_draft",
        "release_created_at",
        "published_at",
    ]
    return _fact(keyed, columns, unique)


# ---- activity stream ---------------------------------------------------------------------
# One narrow frame for all types: keys plus the few measures the aggregates read. Columns
# that do not apply to a type are NULL. Every aggregate below is then a single conditional
# aggregation over one stream instead of one aggregation and one join per event type.

_STREAM_KEYS = ("date_key", "repo_key", "contributor_key", "language_key", "year")


def _stream(
    rows: DataFrame,
    type_name: Column,
    commits: Column | None = None,
    action: Column | None = None,
    merged: Column | None = None,
    hours: Column | None = None,
) -> DataFrame:
    def typed(column: Column | None, kind: str, name: str) -> Column:
        return (F.lit(None) if column is None else column).cast(kind).alias(name)

    return rows.select(
        type_name.alias("type"),
        F.col("event_id").isNotNull().alias("has_id"),
        *_STREAM_KEYS,
        typed(commits, "int", "commit_count"),
        typed(action, "string", "action"),
        typed(merged, "boolean", "is_merged"),
        typed(hours, "double", "hours"),
    )


def stream_from_facts(
    push: DataFrame,
    pr: DataFrame,
    issues: DataFrame,
    watch: DataFrame,
    fork: DataFrame,
    release: DataFrame,
) -> DataFrame:
    """Activity stream from the stored facts and the keyed watch and fork events."""
    parts = [
        _stream(push, F.lit(S.PUSH), commits=F.col("commit_count")),
        _stream(
            pr,
            F.lit(S.PULL_REQUEST),
            action=F.col("action"),
            merged=F.col("is_merged"),
            hours=F.col("time_to_merge_hours"),
        ),
        _stream(
            issues,
            F.lit(S.ISSUES),
            action=F.col("action"),
            hours=F.col("time_to_close_hours"),
        ),
        _stream(watch, F.lit(S.WATCH)),
        _stream(fork, F.lit(S.FORK)),
        _stream(release, F.lit(S.RELEASE)),
    ]
    return reduce(DataFrame.unionAll, parts)


STREAM_TYPES = (S.PUSH, S.PULL_REQUEST, S.ISSUES, S.WATCH, S.FORK, S.RELEASE)


# what facts, activity and features read of keyed events
_STAGED = (
    *KEYS,
    "commit_count",
    "branch_ref",
    "action",
    "state",
    "is_merged",
    "additions",
    "deletions",
    "changed_files",
    "pr_id",
    "review_comments",
    "pr_created_at",
    "merged_at",
    "issue_created_at",
    "closed_at",
    "type",
)


def stage_keyed(keyed: DataFrame) -> DataFrame:
    """Keyed events written once, a folder per type, for all aggregates that start from them.

    Reading, deduplicating and keying the events is then one pass, however many feature sides follow;
    each reads the folders and columns it needs.
    """
    return durable(keyed.select(*_STAGED), "keyed", by=["type"])


def stream_from_keyed(keyed: DataFrame) -> DataFrame:
    """Activity stream from one keyed frame that holds all stream types: a single pass.

    Types that are no activity (create events) must have been left out.
    """
    kind = F.col("type")
    return _stream(
        keyed,
        kind,
        commits=F.when(kind == S.PUSH, F.col("commit_count")),
        action=F.when(kind.isin(S.PULL_REQUEST, S.ISSUES), F.col("action")),
        merged=F.when(kind == S.PULL_REQUEST, F.col("is_merged")),
        hours=F.when(kind == S.PULL_REQUEST, merge_hours()).when(kind == S.ISSUES, close_hours()),
    )
