from __future__ import annotations

from datetime import datetime

import pytest
from conftest import as_dict, as_set
from pyspark.sql import functions as F

from eventmart import schemas as S
from eventmart.functions import vocab as V
from eventmart.operators import activity, dims, facts


def ts(text):
    return datetime.fromisoformat(text)


def test_dim_date_hours_and_flags(spark, rows):
    frame = rows(
        "created_at timestamp",
        (ts("2020-02-29T23:10:00"),),
        (ts("2020-02-29T23:59:59"),),
        (ts("2020-03-01T00:00:00"),),
        (ts("2021-06-30T23:00:00"),),
        (ts("2021-07-01T00:00:00"),),
    )
    got = as_dict(dims.dim_date(frame), "date_key")
    assert set(got) == {2020022923, 2020030100, 2021063023, 2021070100}
    saturday = got[2020022923]
    assert saturday["is_weekend"] and saturday["day_of_week"] == 7
    assert (saturday["month_name"], saturday["day_name"]) == ("February", "Saturday")
    assert [got[k]["is_covid_period"] for k in sorted(got)] == [False, True, True, False]


def repositories(spark, *values):
    columns = "repo_id bigint, repo_name string, language string, topics string"
    frame = spark.createDataFrame(list(values), columns)
    return frame.selectExpr(
        "repo_id",
        "repo_name",
        "language",
        "'MIT' AS license",
        "topics",
        "1 AS stars_at_extract",
        "1 AS forks_at_extract",
        "'' AS description",
        "false AS is_archived",
        "CAST(NULL AS BOOLEAN) AS has_readme",
        "CAST(NULL AS BOOLEAN) AS has_ci",
        "timestamp'2020-01-01' AS created_at",
    )


def test_dim_repository_defaults_and_pattern(spark):
    repos = repositories(
        spark,
        (1, "me/mailer", None, None),
        (2, "me/tool", "Go", "AI,web"),
        (3, "me/tool", "Go", "web"),
        (3, "me/tool", "Go", "web"),
        (4, None, "Go", ""),
    )
    got = as_dict(dims.dim_repository(repos, "2020-01-31"), "repo_id")
    assert len(got) == 4
    assert got[1]["language"] == "Unknown" and got[1]["topics"] == ""
    assert got[1]["owner_login"] == "me" and got[1]["repo_age_days"] == 30
    # the pattern is unanchored: "mailer" contains "ai"
    assert [got[i]["is_ai_ml_repo"] for i in (1, 2, 3, 4)] == [True, True, False, None]
    strict = as_dict(dims.dim_repository(repos, "2020-01-31", word_boundary=True), "repo_id")
    assert [strict[i]["is_ai_ml_repo"] for i in (1, 2, 3)] == [False, True, False]


@pytest.mark.parametrize(
    "login, bot",
    [
        ("dependabot[bot]", True),
        ("Robot", True),
        ("bottle", False),
        ("github-actions-x", True),
        (None, False),
    ],
)
def test_bot_pattern(rows, login, bot):
    frame = rows("actor_id bigint, login string, account_type string", (1, login, "User"))
    assert dims.dim_contributor(frame).first().is_bot is bot


def test_dim_language_is_alphabetical_over_found_and_known(spark):
    repos = repositories(spark, (1, "a/b", "Zig", ""), (2, "a/c", None, ""), (3, "a/d", "Rust", ""))
    got = as_dict(dims.dim_language(repos), "language_name")
    assert len(got) == len(V.KNOWN_LANGUAGES) + 1
    assert [got[n]["language_key"] for n in sorted(got)] == list(range(1, len(got) + 1))
    assert got["Rust"]["is_emerging"] and got["Rust"]["first_appeared"] == 2015
    assert got["Zig"]["paradigm"] == "unknown" and got["Zig"]["first_appeared"] is None


def test_attach_keys_defaults(spark, rows):
    repos = dims.dim_repository(
        repositories(spark, (1, "a/b", "rust", ""), (2, "a/c", None, "")), "2020-02-01"
    )
    languages = dims.dim_language(repos)
    people = rows("actor_id bigint, contributor_key bigint", (5, 5))
    events = rows(
        "event_id string, repo_id bigint, actor_id bigint, created_at timestamp",
        ("e1", 1, 5, ts("2020-01-02T03:00:00")),
        ("e2", 2, 6, ts("2020-01-02T03:00:00")),
        ("e3", 3, 5, ts("2020-01-02T03:00:00")),
    )
    keys = {r.language_name: r.language_key for r in languages.collect()}
    got = as_dict(dims.attach_keys(events, repos, people, languages), "event_id")
    # "Rust" and "rust" are the same language; the smaller key stands for both
    assert got["e1"]["language_key"] == min(keys["Rust"], keys["rust"])
    assert got["e2"]["language_key"] == got["e3"]["language_key"] == keys["Unknown"]
    assert (got["e2"]["contributor_key"], got["e3"]["repo_key"]) == (None, None)
    assert got["e1"]["date_key"] == 2020010203


@pytest.mark.parametrize(
    "lines, bucket",
    [
        (0, "XS"),
        (10, "XS"),
        (11, "S"),
        (50, "S"),
        (51, "M"),
        (250, "M"),
        (251, "L"),
        (1000, "L"),
        (1001, "XL"),
    ],
)
def test_size_buckets(spark, lines, bucket):
    got = spark.range(1).select(facts.size_bucket(F.lit(lines)).alias("b")).first().b
    assert got == bucket


def test_merge_and_close_hours(rows):
    schema = (
        "is_merged boolean, merged_at timestamp, pr_created_at timestamp, state string,"
        "closed_at timestamp, issue_created_at timestamp"
    )
    start, same, later = ts("2020-01-01"), ts("2020-01-01"), ts("2020-01-01T01:20:00")
    frame = rows(
        schema,
        (True, later, start, "closed", later, start),
        (True, same, start, "closed", same, start),
        (False, later, start, "open", later, start),
        (True, None, start, None, None, start),
    )
    got = frame.select(facts.merge_hours().alias("m"), facts.close_hours().alias("c")).collect()
    assert [r.m for r in got] == [1.33, None, None, None]
    assert [r.c for r in got] == [1.33, None, None, None]


def test_default_branch_pattern(rows):
    refs = ["refs/heads/main", "refs/heads/master", "refs/heads/main2", "x/refs/heads/main", None]
    frame = rows("branch_ref string", *[(r,) for r in refs])
    got = [r.d for r in frame.select(facts.default_branch().alias("d")).collect()]
    assert got == [True, True, False, True, None]


STREAM = (
    "type string, has_id boolean, date_key int, repo_key bigint, contributor_key bigint,"
    "language_key bigint, year smallint, commit_count int, action string, is_merged boolean,"
    "hours double"
)


def item(type, hour=1, repo=1, who=1, lang=3, year=2020, commits=None, action=None, merged=None, hours=None):
    return (type, True, 2020010100 + hour, repo, who, lang, year, commits, action, merged, hours)


def test_activity_metrics_and_unknown_repository(rows):
    stream = rows(
        STREAM,
        item(S.PUSH, commits=2, who=1),
        item(S.PUSH, commits=3, who=1),
        item(S.PUSH, commits=1, who=None),
        item(S.PULL_REQUEST, action="opened", merged=False),
        item(S.PULL_REQUEST, action="closed", merged=True, hours=2.5),
        item(S.PULL_REQUEST, action="closed", merged=True, hours=3.0),
        item(S.ISSUES, hour=2, action="closed", hours=4.0),
        item(S.WATCH, hour=2),
        item(S.PUSH, hour=2, repo=None, commits=50, lang=9),
        item(S.FORK, hour=2, repo=None, lang=9),
    )
    got = {(r.date_key, r.repo_key): r for r in activity.repo_activity(stream).collect()}
    assert len(got) == 3
    first = got[2020010101, 1]
    assert (first.total_pushes, first.total_commits, first.unique_contributors) == (3, 6, 1)
    assert (first.total_prs_opened, first.total_prs_merged) == (1, 2)
    assert first.avg_pr_merge_hours == 2.75 and first.avg_issue_close_hours is None
    second = got[2020010102, 1]
    assert (second.total_issues_closed, second.total_stars, second.total_pushes) == (1, 1, 0)
    # the row of unknown repositories exists, but carries no metrics
    unknown = got[2020010102, None]
    assert (unknown.total_pushes, unknown.total_commits, unknown.total_forks) == (0, 0, 0)
    assert unknown.language_key == 9 and str(unknown.obs_date) == "2020-01-01"


def test_stream_from_facts_equals_single_pass(spark, rows):
    base = "event_id string, date_key int, repo_key bigint, contributor_key bigint, language_key bigint, year smallint"
    key = (2020010101, 1, 1, 3, 2020)
    push = rows(f"{base}, commit_count int", ("a", *key, 4))
    pr = rows(
        f"{base}, action string, is_merged boolean, time_to_merge_hours double",
        ("b", *key, "opened", True, 1.5),
    )
    issue = rows(f"{base}, action string, time_to_close_hours double", ("c", *key, "closed", 2.0))
    plain = rows(base, ("d", *key))
    stream = facts.stream_from_facts(push, pr, issue, plain, plain, plain)
    direct = rows(
        STREAM,
        item(S.PUSH, commits=4),
        item(S.PULL_REQUEST, action="opened", merged=True, hours=1.5),
        item(S.ISSUES, action="closed", hours=2.0),
        item(S.WATCH),
        item(S.FORK),
        item(S.RELEASE),
    )
    assert as_set(activity.repo_activity(stream)) == as_set(activity.repo_activity(direct))


def test_activity_has_one_wide_aggregate_not_a_join_per_type(rows):
    plan = activity.repo_activity(rows(STREAM, item(S.PUSH)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text
    # the exchange on (hour, repository, contributor) spreads a hot repository out first
    assert text.count("Exchange hashpartitioning") == 2


def test_language_growth_compares_observed_years(rows):
    base = rows(
        "language_key bigint, year smallint, total_push_events bigint",
        (1, 2018, 10),
        (1, 2020, 15),
        (2, 2018, 0),
        (2, 2020, 5),
        (3, 2021, 0),
    )
    got = {(r.language_key, r.year): r for r in activity.language_yearly(base).collect()}
    assert got[1, 2018].yoy_push_growth_pct is None
    assert got[1, 2020].yoy_push_growth_pct == 50.0  # across the gap year
    assert got[2, 2020].yoy_push_growth_pct is None  # growth from zero
    assert got[3, 2021].market_share_pct is None  # a year without pushes
    for year in (2018, 2020):
        share = sum(r.market_share_pct for (_, y), r in got.items() if y == year)
        assert share == pytest.approx(100, abs=0.01)
