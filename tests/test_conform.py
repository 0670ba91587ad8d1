from __future__ import annotations

import gzip
import json

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from eventmart import schemas as S
from eventmart.operators import conform, quality
from eventmart.sources.events import read_events, slim_events, write_events


def event(id="1", type="PushEvent", at="2020-01-02T03:04:05Z", actor=7, repo=9, payload=None):
    return {
        "id": id,
        "type": type,
        "created_at": at,
        "actor": {"id": actor, "login": f"user{actor}"},
        "repo": {"id": repo, "name": f"own/repo{repo}"},
        "payload": payload or {},
    }


@pytest.fixture
def files(tmp_path):
    def write(*lines, name="2020/2020-01-02-3.json.gz"):
        path = tmp_path / "raw" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        text = "\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines) + "\n"
        with gzip.open(path, "wt") as out:
            out.write(text)
        return str(tmp_path / "raw")

    return write


def test_reads_gzip_lines_and_drops_what_is_invalid(spark, files):
    path = files(
        event("1", payload={"ref": "refs/heads/main", "size": 3}),
        event("2", type="GollumEvent"),
        event("3", actor=None),
        event("4", repo=None),
        event("5", at="2007-12-31T23:59:59Z"),
        event("6", at="2008-01-01T00:00:00Z"),
        event("7", at="2999-01-01T00:00:00Z"),
        '{"id": "8", "type": ',
        {**event("9"), "created_at": None},
        event("10", at="2021-06-30T00:00:00Z"),
    )
    out = as_dict(conform.conform(read_events(spark, path, "*.gz"), as_of="2021-06-30"), "event_id")
    assert set(out) == {"1", "6", "10"}
    assert out["1"]["year"] == 2020
    assert out["1"]["source_file"].endswith("2020/2020-01-02-3.json.gz")
    assert json.loads(out["1"]["payload"])["size"] == 3


def test_single_file_and_other_suffix(spark, files):
    root = files(event("1"))
    files(event("2"), name="2020/notes.txt.bz")
    one = read_events(spark, f"{root}/2020/2020-01-02-3.json.gz")
    assert [r.id for r in one.collect()] == ["1"]
    assert read_events(spark, root, "*.gz").count() == 1


def test_reasons_for_rejection(spark, files):
    path = files(
        event("1"),
        event("2", type="GollumEvent"),
        event("3", actor=None),
        event("4", repo=None),
        event("5", at="2007-01-01T00:00:00Z"),
        event("6", at="2999-01-01T00:00:00Z"),
        {**event("7"), "created_at": None},
        event("8", at="2021-01-01T23:00:00Z"),
        event(None),
        "not json",
    )
    raw = read_events(spark, path, keep_corrupt=True).cache()
    got = raw.select("id", quality.rejection_reason(as_of="2021-01-01").alias("why")).collect()
    assert {r.id: r.why for r in got if r.id} == {
        "1": None,
        "2": "other_type",
        "3": "missing_actor",
        "4": "missing_repo",
        "5": "too_early",
        "6": "in_future",
        "7": "missing_timestamp",
        "8": None,  # on the day itself
    }
    assert sorted(r.why for r in got if r.id is None) == ["malformed", "missing_id"]
    kept = conform.valid_events(raw, as_of="2021-01-01").select("id").collect()
    assert sorted(r.id for r in kept) == ["1", "8"]


def test_dedup_keeps_one_row_whatever_the_order(spark, rows):
    schema = "event_id string, created_at timestamp, payload string"
    base = spark.sql("SELECT timestamp'2020-01-01' AS t").first().t
    values = [("a", base, "x"), ("a", base, "b"), ("b", base, "z"), (None, base, "n"), (None, base, "m")]
    first = {tuple(r) for r in conform.dedup_events(rows(schema, *values)).collect()}
    again = {tuple(r) for r in conform.dedup_events(rows(schema, *values[::-1])).collect()}
    assert first == again == {("a", base, "b"), ("b", base, "z"), (None, base, "m")}


def flat(spark, files, *events):
    return conform.flatten(read_events(spark, files(*events)))


def test_push_defaults(spark, files):
    frame = flat(spark, files, event("1"), event("2", payload={"ref": "r", "size": 4}))
    got = as_dict(conform.push_events(frame), "event_id")
    assert (got["1"]["commit_count"], got["1"]["branch_ref"]) == (0, "unknown")
    assert (got["2"]["commit_count"], got["2"]["branch_ref"]) == (4, "r")


def test_pull_request_defaults_and_string_payload(spark, files):
    pr = {"action": "closed", "pull_request": {"id": 5, "merged": True, "additions": 2}}
    frame = flat(
        spark,
        files,
        event("1", type=S.PULL_REQUEST, payload=pr),
        {**event("2", type=S.PULL_REQUEST), "payload": json.dumps(pr)},
        event("3", type=S.PULL_REQUEST, payload={"action": "opened"}),
    )
    got = as_dict(conform.pr_events(frame), "event_id")
    for id in ("1", "2"):
        assert got[id]["is_merged"] and got[id]["additions"] == 2 and got[id]["deletions"] == 0
        assert got[id]["pr_id"] == 5
    assert got["3"]["is_merged"] is False and got["3"]["changed_files"] == 0


def test_issue_labels(spark, files):
    def issue(labels):
        return {"action": "opened", "issue": {"id": 1, "labels": labels}}

    frame = flat(
        spark,
        files,
        event("1", type=S.ISSUES, payload=issue([{"name": "bug"}, {"name": None}, {"name": "ui"}])),
        event("2", type=S.ISSUES, payload=issue([])),
        event("3", type=S.ISSUES, payload={"action": "opened"}),
    )
    got = as_dict(conform.issues_events(frame), "event_id")
    assert [got[i]["label_list"] for i in "123"] == ["bug,ui", "", ""]


def test_watch_fork_create_release(spark, files):
    release = {"action": "published", "release": {"id": 3, "tag_name": "v1", "prerelease": True}}
    frame = flat(
        spark,
        files,
        event("1", type=S.WATCH, payload={"action": "started"}),
        event("2", type=S.WATCH, payload={"action": "deleted"}),
        event("3", type=S.FORK, payload={"forkee": {"id": 8, "full_name": "me/fork"}}),
        event("4", type=S.CREATE, payload={"ref_type": "branch", "description": "d"}),
        event("5", type=S.RELEASE, payload=release),
    )
    tables = conform.route(frame)
    assert [r.event_id for r in tables["watch_events"].collect()] == ["1"]
    fork = tables["fork_events"].first()
    assert (fork.fork_id, fork.fork_name) == (8, "me/fork")
    create = tables["create_events"].first()
    assert (create.ref_type, create.description) == ("branch", "d")
    got = tables["release_events"].first()
    assert (got.tag_name, got.is_prerelease, got.is_draft) == ("v1", True, False)
    for kind, name in S.EVENT_TABLES.items():
        declared = spark.createDataFrame([], S.SILVER[kind])
        assert tables[name].dtypes == declared.dtypes


def test_audit_counts_every_type(spark, files):
    frame = flat(
        spark,
        files,
        event("1"),
        event("2", type=S.WATCH, payload={"action": "started"}),
        event("3", type=S.WATCH, payload={"action": "deleted"}),
    )
    accepted = {kind: project(frame) for kind, project in conform.PROJECTORS.items()}
    got = as_dict(quality.dq_audit(frame, quality.tagged(accepted), "full_refresh"), "event_type")
    assert len(got) == 7
    assert (got[S.WATCH]["raw_count"], got[S.WATCH]["accepted_count"]) == (2, 1)
    assert (got[S.FORK]["raw_count"], got[S.FORK]["accepted_count"]) == (0, 0)


def test_slimming_round_trip(spark, files, tmp_path):
    pr = {"action": "opened", "pull_request": {"id": 1, "title": "t", "body": "long"}, "n": 1}
    path = files(
        event("1", payload={"ref": "r", "size": 2, "commits": ["c"]}),
        event("2", type=S.PULL_REQUEST, payload=pr),
        event("3", type=S.RELEASE),
        "broken",
    )
    out = str(tmp_path / "slim")
    write_events(slim_events(read_events(spark, path)), out)
    lines = as_dict(read_events(spark, out, "*.gz"), "id")
    assert set(lines) == {"1", "2"}
    assert json.loads(lines["1"]["payload"]) == {"ref": "r", "size": 2, "distinct_size": 0}
    slim = json.loads(lines["2"]["payload"])
    assert slim["pull_request"]["merged"] is False and slim["pull_request"]["additions"] is None
    assert "body" not in slim["pull_request"] and "n" not in slim


def test_profile_shares_and_batch_year(spark, rows):
    frame = rows(
        "source_file string, type string, repo_name string",
        *[("a/2020-01-02-3.json.gz", "PushEvent", f"r{i % 2}") for i in range(3)],
        ("a/2020-01-02-3.json.gz", "WatchEvent", "r9"),
        ("b/none.gz", "WatchEvent", "r1"),
    )
    got = {(r.source_file, r.type): r for r in quality.event_profile(frame).collect()}
    push = got["a/2020-01-02-3.json.gz", "PushEvent"]
    assert (push.event_count, push.pct_of_file, push.distinct_repos) == (3, 75.0, 3)
    assert push.batch_year == 2020
    assert got["b/none.gz", "WatchEvent"].batch_year is None


def test_payload_of_hot_key_is_limited_before_the_exchange(spark):
    """A third of all rows under one id: each map task passes one of them on."""
    frame = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("payload"),
    )
    out = conform.dedup_events(frame)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert plan.rindex("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")
    assert out.count() == 20_001
