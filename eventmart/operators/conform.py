"""Raw envelope -> conformed, typed event tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart import schemas as S
from eventmart.functions import vocab as V

SHARED_COLUMNS = (
    "event_id",
    "repo_id",
    "repo_name",
    "actor_id",
    "actor_login",
    "created_at",
    "year",
)


def of_types(events: DataFrame, types: Sequence[str] = S.EVENT_TYPES) -> DataFrame:
    """Keep the listed event types."""
    return events.filter(F.col("type").isin(list(types)))


def not_in_future(as_of: str | None) -> Column:
    """Up to now, a point in time, or the end of a day if `as_of` is a date."""
    if not as_of:
        return F.col("created_at") <= F.current_timestamp()
    bound = F.lit(as_of).cast("timestamp")
    if len(as_of) > len("2000-01-01"):
        return F.col("created_at") <= bound
    return F.col("created_at") < bound + F.expr("INTERVAL 1 DAY")


def valid_events(
    events: DataFrame,
    earliest: str = V.EARLIEST_EVENT,
    as_of: str | None = None,
    types: Sequence[str] = S.EVENT_TYPES,
) -> DataFrame:
    """Known type; id, actor and repo present; timestamp between `earliest` and `as_of` (now)."""
    return of_types(events, types).filter(
        F.col("id").isNotNull()
        & F.col("actor.id").isNotNull()
        & F.col("repo.id").isNotNull()
        & (F.col("created_at") >= F.lit(earliest).cast("timestamp"))
        & not_in_future(as_of)
    )


def flatten(events: DataFrame) -> DataFrame:
    """Envelope structs to plain columns, plus the year used for partitioning."""
    source = F.col("source_file") if "source_file" in events.columns else F.lit(None)
    return events.select(
        F.col("id").alias("event_id"),
        "type",
        "created_at",
        F.year("created_at").cast("smallint").alias("year"),
        F.col("actor.id").alias("actor_id"),
        F.col("actor.login").alias("actor_login"),
        F.col("repo.id").alias("repo_id"),
        F.col("repo.name").alias("repo_name"),
        "payload",
        source.cast("string").alias("source_file"),
    )


def first_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the first under `order`, which should be a total order.

    Spark turns the `= 1` filter into a group limit below the exchange, so each map task
    sends at most one row per key however many copies it holds.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per event id; the survivor does not depend on the order of arrival."""
    rest = [c for c in events.columns if c != "event_id"]
    lead = [c for c in ("created_at", "source_file") if c in rest]
    return first_per_key(events, ["event_id"], lead + [c for c in rest if c not in lead])


def conform(
    raw: DataFrame,
    earliest: str = V.EARLIEST_EVENT,
    as_of: str | None = None,
    types: Sequence[str] = S.EVENT_TYPES,
    payload: bool = True,
) -> DataFrame:
    """Filter, flatten and deduplicate a raw envelope.

    Without its `payload`, if the caller reads none: as the last column of the order it decides only
    between copies that agree in all others, and need not be shuffled.
    """
    flat = flatten(valid_events(raw, earliest, as_of, types))
    return dedup_events(flat if payload else flat.drop("payload"))


# ---- typed projections -------------------------------------------------------------------


def _or_zero(field: str) -> Column:
    return F.coalesce(F.col(field), F.lit(0))


def _or_false(field: str) -> Column:
    return F.coalesce(F.col(field), F.lit(False))


def _typed(events: DataFrame, event_type: str, columns: Sequence[Column]) -> DataFrame:
    """Rows of one type with the payload parsed into `p` and projected."""
    parsed = events.filter(F.col("type") == event_type).withColumn(
        "p", F.from_json("payload", S.PAYLOADS[event_type])
    )
    return parsed.select(*SHARED_COLUMNS, *columns, "source_file")


def push_events(events: DataFrame) -> DataFrame:
    return _typed(
        events,
        S.PUSH,
        [
            _or_zero("p.size").alias("commit_count"),
            F.coalesce("p.ref", F.lit("unknown")).alias("branch_ref"),
        ],
    )


def pr_events(events: DataFrame) -> DataFrame:
    pr = "p.pull_request."
    counts = ("additions", "deletions", "changed_files", "review_comments")
    return _typed(
        events,
        S.PULL_REQUEST,
        [
            F.col("p.action").alias("action"),
            F.col(pr + "id").alias("pr_id"),
            F.col(pr + "title").alias("title"),
            F.col(pr + "state").alias("state"),
            _or_false(pr + "merged").alias("is_merged"),
            *(_or_zero(pr + c).alias(c) for c in counts),
            F.col(pr + "created_at").alias("pr_created_at"),
            F.col(pr + "merged_at").alias("merged_at"),
            F.col(pr + "closed_at").alias("closed_at"),
        ],
    )


def label_csv(labels: str | Column) -> Column:
    """Label names joined by commas; empty for no labels, missing names are skipped."""
    names = F.transform(labels, lambda label: label["name"])
    return F.concat_ws(",", names)


def issues_events(events: DataFrame) -> DataFrame:
    issue = "p.issue."
    return _typed(
        events,
        S.ISSUES,
        [
            F.col("p.action").alias("action"),
            F.col(issue + "id").alias("issue_id"),
            F.col(issue + "title").alias("title"),
            F.col(issue + "state").alias("state"),
            _or_zero(issue + "comments").alias("comments_count"),
            label_csv(issue + "labels").alias("label_list"),
            F.col(issue + "created_at").alias("issue_created_at"),
            F.col(issue + "closed_at").alias("closed_at"),
        ],
    )


def watch_events(events: DataFrame) -> DataFrame:
    started = events.filter(
        (F.col("type") == S.WATCH)
        & (F.from_json("payload", S.PAYLOADS[S.WATCH])["action"] == "started")
    )
    return started.select(*SHARED_COLUMNS, "source_file")


def fork_events(events: DataFrame) -> DataFrame:
    return _typed(
        events,
        S.FORK,
        [
            F.col("p.forkee.id").alias("fork_id"),
            F.col("p.forkee.full_name").alias("fork_name"),
        ],
    )


def create_events(events: DataFrame) -> DataFrame:
    return _typed(
        events,
        S.CREATE,
        [F.col("p.ref_type").alias("ref_type"), F.col("p.description").alias("description")],
    )


def release_events(events: DataFrame) -> DataFrame:
    release = "p.release."
    return _typed(
        events,
        S.RELEASE,
        [
            F.col("p.action").alias("action"),
            F.col(release + "id").alias("release_id"),
            F.col(release + "tag_name").alias("tag_name"),
            F.col(release + "name").alias("release_name"),
            _or_false(release + "prerelease").alias("is_prerelease"),
            _or_false(release + "draft").alias("is_draft"),
            F.col(release + "created_at").alias("release_created_at"),
            F.col(release + "published_at").alias("published_at"),
        ],
    )


PROJECTORS: dict[str, Callable[[DataFrame], DataFrame]] = {
    S.PUSH: push_events,
    S.PULL_REQUEST: pr_events,
    S.ISSUES: issues_events,
    S.WATCH: watch_events,
    S.FORK: fork_events,
    S.CREATE: create_events,
    S.RELEASE: release_events,
}


def route(events: DataFrame) -> dict[str, DataFrame]:
    """Conformed events -> {table name: typed frame}. Persist the input before writing all."""
    return {S.EVENT_TABLES[t]: project(events) for t, project in PROJECTORS.items()}
