"""Declared schemas as DDL: raw envelope, payloads per event type, conformed tables."""

from __future__ import annotations

# ---- fixed values: event type names and the table each one lands in -----------------
EVENT_TABLES = {
    "PushEvent": "push_events",
    "PullRequestEvent": "pr_events",
    "IssuesEvent": "issues_events",
    "WatchEvent": "watch_events",
    "ForkEvent": "fork_events",
    "CreateEvent": "create_events",
    "ReleaseEvent": "release_events",
}
EVENT_TYPES = tuple(EVENT_TABLES)

PUSH, PULL_REQUEST, ISSUES, WATCH, FORK, CREATE, RELEASE = EVENT_TYPES

# ---- raw envelope ---------------------------------------------------------------------
ENVELOPE_COLUMNS = ("id", "type", "created_at", "actor", "repo", "payload")
ENVELOPE = (
    "id string, type string, created_at timestamp,"
    "actor struct<id: bigint, login: string>,"
    "repo struct<id: bigint, name: string>,"
    "payload string"
)

# ---- payload per type -----------------------------------------------------------------
PAYLOADS = {
    PUSH: "ref string, size int",
    PULL_REQUEST: (
        "action string, pull_request struct<id: bigint, title: string, state: string,"
        "merged: boolean, additions: int, deletions: int, changed_files: int,"
        "review_comments: int, created_at: timestamp, merged_at: timestamp,"
        "closed_at: timestamp>"
    ),
    ISSUES: (
        "action string, issue struct<id: bigint, title: string, state: string,"
        "comments: int, created_at: timestamp, closed_at: timestamp,"
        "labels: array<struct<name: string>>>"
    ),
    WATCH: "action string",
    FORK: "forkee struct<id: bigint, full_name: string>",
    CREATE: "ref_type string, description string",
    RELEASE: (
        "action string, release struct<id: bigint, tag_name: string, name: string,"
        "prerelease: boolean, draft: boolean, created_at: timestamp,"
        "published_at: timestamp>"
    ),
}

# ---- conformed (silver) tables ---------------------------------------------------------
_COMMON = (
    "event_id string, repo_id bigint, repo_name string, actor_id bigint,"
    "actor_login string, created_at timestamp, year smallint"
)
SILVER = {
    PUSH: f"{_COMMON}, commit_count int, branch_ref string, source_file string",
    PULL_REQUEST: (
        f"{_COMMON}, action string, pr_id bigint, title string, state string,"
        "is_merged boolean, additions int, deletions int, changed_files int,"
        "review_comments int, pr_created_at timestamp, merged_at timestamp,"
        "closed_at timestamp, source_file string"
    ),
    ISSUES: (
        f"{_COMMON}, action string, issue_id bigint, title string, state string,"
        "comments_count int, label_list string, issue_created_at timestamp,"
        "closed_at timestamp, source_file string"
    ),
    WATCH: f"{_COMMON}, source_file string",
    FORK: f"{_COMMON}, fork_id bigint, fork_name string, source_file string",
    CREATE: f"{_COMMON}, ref_type string, description string, source_file string",
    RELEASE: (
        f"{_COMMON}, action string, release_id bigint, tag_name string,"
        "release_name string, is_prerelease boolean, is_draft boolean,"
        "release_created_at timestamp, published_at timestamp, source_file string"
    ),
}

REPOSITORIES = (
    "repo_id bigint, repo_name string, language string, license string, topics string,"
    "stars_at_extract int, forks_at_extract int, description string,"
    "is_archived boolean, has_readme boolean, has_ci boolean, created_at timestamp"
)
CONTRIBUTORS = "actor_id bigint, login string, account_type string"
DQ_AUDIT = (
    "event_type string, raw_count bigint, accepted_count bigint, run_mode string,"
    "audited_at timestamp"
)

# One landed metadata response per line, as the enrichment client stores it.
METADATA_RESPONSE = (
    "id bigint, full_name string, language string, license struct<spdx_id: string>,"
    "topics array<string>, stargazers_count int, forks_count int, description string,"
    "archived boolean, created_at string, contents_url string, has_readme boolean"
)
