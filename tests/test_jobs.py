"""Whole jobs on raw files: batch pipeline, streams, model tables, registered queries."""

from __future__ import annotations

import gzip
import json
import random
import threading
from datetime import datetime, timedelta

import pytest
from conftest import as_set
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from eventmart import schemas as S
from eventmart.functions import vocab as V
from eventmart.operators import model
from eventmart.plans.pipeline import FULL, GOLD_TABLES, INCREMENTAL, MODEL_TABLES, Mart
from eventmart.sources import idfilter
from eventmart.sources.events import read_events
from eventmart.sources.snapshots import Table, mirror
from eventmart.streaming import activity as streaming
from eventmart.streaming import ingest as ingestion
from eventmart.streaming.ingest import event_stream, ingest

REPOS = 40


def make_events(seed, n, first_id=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        repo = rng.choice([1, rng.randrange(REPOS)])
        at = datetime(2015, 1, 1) + timedelta(hours=rng.randrange(24 * 365 * 5))
        if repo % 3 == 0:
            at = min(at, datetime(2016, 12, 31))
        kind = rng.choice([S.PUSH, S.PUSH, S.PULL_REQUEST, S.ISSUES, S.WATCH, S.FORK, S.CREATE])
        stamp = at.isoformat() + "Z"
        later = (at + timedelta(hours=rng.randrange(1, 99))).isoformat() + "Z"
        payload = {
            S.PUSH: {"ref": rng.choice(["refs/heads/main", "refs/heads/x"]), "size": rng.randrange(5)},
            S.PULL_REQUEST: {
                "action": rng.choice(["opened", "closed"]),
                "pull_request": {"id": i, "merged": rng.random() < 0.5, "additions": rng.randrange(99),
                                 "created_at": stamp, "merged_at": later, "review_comments": 1},
            },
            S.ISSUES: {
                "action": "closed",
                "issue": {"id": i, "state": "closed", "created_at": stamp, "closed_at": later},
            },
            S.WATCH: {"action": "started"},
            S.FORK: {"forkee": {"id": i, "full_name": "f/f"}},
            S.CREATE: {"ref_type": "tag"},
        }[kind]
        actor = rng.randrange(30)
        out.append(
            {
                "id": str(first_id + i),
                "type": kind,
                "created_at": stamp,
                "actor": {"id": actor, "login": f"u{actor}" + ("[bot]" if actor == 0 else "")},
                "repo": {"id": repo, "name": f"own/repo{repo}"},
                "payload": payload,
            }
        )
    return out


def write_file(folder, name, events, *extra):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join([*map(json.dumps, events), *extra]) + "\n")
    return str(path)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """A mart built from two files, the second one added incrementally and twice."""
    base = tmp_path_factory.mktemp("jobs")
    raw, root = base / "raw", str(base / "mart")
    first = make_events(1, 1500)
    second = [*first[1000:], *make_events(2, 200, first_id=1500)]
    write_file(raw, "2015-01-01-0.json.gz", first, "broken")
    mart = Mart(spark, root, "2020-01-01")
    mart.build_silver(str(raw), FULL, "*.gz")
    late = write_file(base / "late", "2016-01-01-0.json.gz", second)
    added = [mart.build_silver(late) for _ in range(2)]
    responses = base / "responses.json"
    responses.write_text(
        "\n".join(
            json.dumps(
                {
                    "id": k,
                    "full_name": f"own/repo{k}",
                    "language": ["Go", "Rust", None][k % 3],
                    "license": {"spdx_id": "MIT"},
                    "topics": ["ai"] if k % 4 == 0 else [],
                    "archived": k % 7 == 0,
                    "created_at": f"{2012 + k % 7}-03-01T00:00:00Z",
                }
            )
            for k in range(1, REPOS)
        )
    )
    mart.load_metadata(str(responses))
    mart.load_contributors()
    mart.build_gold()
    return mart, first, second, added


def test_incremental_inserts_each_event_once(built):
    mart, first, second, added = built
    known = {e["id"] for e in first}
    fresh = [e for e in second if e["id"] not in known]
    assert sum(added[0].values()) == len(fresh) and sum(added[1].values()) == 0
    for kind, name in S.EVENT_TABLES.items():
        want = {e["id"] for e in [*first, *fresh] if e["type"] == kind}
        got = [r.event_id for r in mart.silver(kind).select("event_id").collect()]
        assert sorted(got) == sorted(want), name


def test_audit_table(built):
    mart, first, *_ = built
    audit = {r.event_type: (r.raw_count, r.accepted_count) for r in mart.read("dq_audit").collect()}
    for kind in S.EVENT_TYPES:
        n = sum(e["type"] == kind for e in first)
        assert audit[kind] == (n, n)


def test_gold_tables(built):
    mart, first, second, _ = built
    events = {e["id"]: e for e in second} | {e["id"]: e for e in first}
    pushes = [e for e in events.values() if e["type"] == S.PUSH]
    activity = mart.read("fact_repo_activity_daily")
    total = activity.selectExpr("sum(total_pushes) AS p", "sum(total_commits) AS c").first()
    known = [e for e in pushes if e["repo"]["id"] != 0]
    assert (total.p, total.c) == (len(known), sum(e["payload"]["size"] for e in known))
    assert mart.read("fact_push_events").count() == len(pushes)
    assert mart.read("fact_release_events").isEmpty()
    yearly = mart.read("fact_language_yearly")
    assert yearly.selectExpr("sum(total_push_events) AS p").first().p == len(pushes)


def test_views_register(built, spark):
    mart, *_ = built
    names = mart.register_views()
    assert "analysis_bus_factor" in names and "analysis_ml_predictions" not in names
    top = spark.sql("SELECT max(top1_pct) AS t FROM analysis_bus_factor").first().t
    assert 0 < top <= 100


def test_worklist_excludes_known_repositories(built):
    mart, *_ = built
    got = mart.worklist(2015, 100, shards=3).collect()
    assert [r.repo_id for r in got] == [0]


def test_train_score_trajectories_trends(built):
    mart, *_ = built
    assert mart.score() == 0  # no model yet
    info = mart.train(boundary=2016, trees=(5,), depths=(3,), version="202001")
    assert info["train_rows"] > 0 and info["test_rows"] > 0 and 0 <= info["auc_roc"] <= 1
    scored = mart.score()
    assert scored == REPOS - 1 == mart.score()
    risk = mart.read("ml_abandonment_risk")
    assert risk.count() == REPOS - 1
    assert risk.filter("abandonment_probability NOT BETWEEN 0 AND 1").isEmpty()
    importance = mart.read("ml_feature_importance")
    assert importance.count() == len(model.VECTOR_NAMES) + len(V.CATEGORY_FEATURES)
    assert abs(importance.agg({"importance": "sum"}).first()[0] - 1) < 1e-9
    assert mart.read("ml_test_predictions").count() == info["test_rows"]
    assert mart.read("ml_model_current").first().model_version == "202001"
    years = list(range(2015, 2020))
    assert mart.trajectories(years, 2017) == mart.read("ml_repo_trajectories").count() > 0
    assert mart.language_trends((2020, 2021)) > 0
    assert len(mart.register_views()) == 17


def test_mirror_and_views_for_other_readers(built, spark, tmp_path):
    mart, *_ = built
    copies = str(tmp_path / "copies")
    done = mirror(spark, mart.root, copies, (*GOLD_TABLES, *MODEL_TABLES))
    assert set(done) == {*GOLD_TABLES, *MODEL_TABLES}  # after the test that trains
    written = mart.write_views(str(tmp_path / "views"))
    assert len(written) == 17 and len(set(written.values())) == 1
    got = spark.read.parquet(str(tmp_path / "views" / "analysis_bus_factor"))
    assert {r._pipeline_run_id for r in got.collect()} == set(written.values())
    mart.register_views()
    assert as_set(got.drop("_pipeline_run_id", "_loaded_at")) == as_set(spark.table("analysis_bus_factor"))


def _files_of(mart, name, year):
    paths = mart.read(name).filter(F.col("year") == year).inputFiles()
    return {p for p in paths if f"year={year}/" in p}


def test_incremental_gold_equals_a_full_build(spark, tmp_path):
    mart = Mart(spark, str(tmp_path / "mart"), "2020-01-01")
    mart.build_silver(write_file(tmp_path, "a.json.gz", make_events(7, 600)), FULL)
    responses = tmp_path / "r"

    def enrich(number, *repos):
        lines = [
            json.dumps({"id": k, "full_name": f"own/repo{k}", "language": language, "created_at": "2012-03-01T00:00:00Z"})
            for k, language in repos
        ]
        (responses / str(number)).mkdir(parents=True)
        (responses / str(number) / "part.json").write_text("\n".join(lines))
        mart.load_metadata(str(responses / str(number)))

    def rows():
        return {name: as_set(mart.read(name)) for name in GOLD_TABLES}

    def incremental_equals_full():
        years = mart.build_gold(mode=INCREMENTAL)
        got = rows()
        mart.build_gold()
        assert got == rows()
        return years

    enrich(0, *[(k, ["Go", "Rust"][k % 2]) for k in range(1, 30)])
    mart.load_contributors()
    assert mart.build_gold(mode=INCREMENTAL) is None  # nothing stored yet
    assert incremental_equals_full() == []
    # one new event: one year, the files of the others stay
    event = make_events(8, 1, first_id=9000)[0] | {"created_at": "2016-05-05T05:05:05Z", "type": S.WATCH, "payload": {"action": "started"}}
    mart.build_silver(write_file(tmp_path, "b.json.gz", [event]))
    kept, hit = _files_of(mart, "fact_push_events", 2015), _files_of(mart, "fact_push_events", 2016)
    assert mart.build_gold(mode=INCREMENTAL) == [2016]
    assert _files_of(mart, "fact_push_events", 2015) == kept and hit
    assert not _files_of(mart, "fact_push_events", 2016) & hit
    assert incremental_equals_full() == []
    # a repository enriched later, with events in several years
    enrich(1, (30, "Go"))
    assert len(incremental_equals_full()) > 1
    # a language that moves the keys of others, and a full refresh: all years
    enrich(2, (31, "Ada 2022"))
    assert incremental_equals_full() is None
    mart.build_silver(write_file(tmp_path, "c.json.gz", make_events(9, 50)), FULL)
    assert incremental_equals_full() is None


def test_batch_quarantine_keeps_what_is_rejected(spark, tmp_path):
    bad = json.dumps({"id": "x", "type": "Other"})
    path = write_file(tmp_path, "a.json.gz", make_events(4, 20), bad, "broken")
    rejected = str(tmp_path / "rejected")
    for mode in (FULL, INCREMENTAL):  # the same input replaces its folder
        mart = Mart(spark, str(tmp_path / mode), "2020-01-01")
        assert sum(mart.build_silver(path, mode, quarantine=rejected).values()) == 20
        found = spark.read.parquet(rejected).collect()
        assert sorted(r.reason for r in found) == ["malformed", "other_type"]
        assert {r._corrupt_record for r in found if r.reason == "malformed"} == {"broken"}


def test_command_line_profile_and_worklist(built, spark, tmp_path, monkeypatch):
    from eventmart import __main__ as command

    mart, *_ = built
    path = write_file(tmp_path, "2015-01-01-0.json.gz", make_events(4, 20))

    def run(*arguments):
        monkeypatch.setattr("sys.argv", ["eventmart", "--root", mart.root, *arguments])
        command.main()

    run("profile", "--input", path, "--output", str(tmp_path / "profile"))
    profile = spark.read.parquet(str(tmp_path / "profile")).collect()
    assert sum(r.event_count for r in profile) == 20 and {r.batch_year for r in profile} == {2015}
    run("worklist", "--output", str(tmp_path / "list"), "--top-n", "50")
    assert [r.repo_id for r in spark.read.parquet(str(tmp_path / "list")).collect()] == [0]
    run("views", "--output", str(tmp_path / "views"))
    assert (tmp_path / "views" / "analysis_bus_factor").exists()


def test_stream_equals_batch_and_quarantines(spark, tmp_path):
    raw, root = tmp_path / "raw", str(tmp_path / "mart")
    bad = json.dumps({"id": "x", "type": "Other"})
    events = make_events(4, 400)
    write_file(raw, "a.json.gz", events[:250], bad, "broken")
    write_file(raw, "b.json.gz", events[200:])
    progress, rejected = str(tmp_path / "progress"), str(tmp_path / "rejected")

    def drain():
        stream = event_stream(spark, str(raw), max_files=1)
        ingest(stream, root, progress, as_of="2020-01-01", quarantine=rejected).start().awaitTermination()

    drain()
    before = set(Table(spark, root, "push_events").read().inputFiles())
    drain()  # nothing new: no batch
    assert set(Table(spark, root, "push_events").read().inputFiles()) == before
    other = str(tmp_path / "batch")
    Mart(spark, other, "2020-01-01").build_silver(str(raw), FULL)
    for name in S.EVENT_TABLES.values():
        batch = Table(spark, other, name).read().drop("source_file")
        if batch.isEmpty():
            continue
        assert as_set(Table(spark, root, name).read().drop("source_file")) == as_set(batch)
    reasons = [r.reason for r in spark.read.parquet(rejected).collect()]
    assert sorted(reasons) == ["malformed", "other_type"]


@pytest.mark.parametrize("filtered", [False, True])
def test_batch_that_failed_after_the_write_is_played_again(spark, tmp_path, monkeypatch, filtered):
    raw, root, progress = tmp_path / "raw", str(tmp_path / "mart"), str(tmp_path / "progress")
    events = make_events(4, 300)
    for i in range(3):
        write_file(raw, f"{i}.json.gz", events[i * 100 : i * 100 + 110])
    merge, played = ingestion.merge_batch, []

    def stops_once(*arguments):
        added = merge(*arguments)
        played.append(sum(added.values()))
        if len(played) == 2:
            raise RuntimeError("lost after the write")
        return added

    monkeypatch.setattr(ingestion, "merge_batch", stops_once)

    def drain():
        stream = event_stream(spark, str(raw), max_files=1)
        ingest(stream, root, progress, as_of="2020-01-01", filtered=filtered).start().awaitTermination()

    with pytest.raises(StreamingQueryException, match="lost after the write"):
        drain()
    drain()
    assert len(played) == 4 and played[1] > 0 and played[2] == 0 and played[3] > 0
    other = str(tmp_path / "batch")
    Mart(spark, other, "2020-01-01").build_silver(str(raw), FULL)
    for name in S.EVENT_TABLES.values():
        batch = Table(spark, other, name).read().drop("source_file")
        if not batch.isEmpty():
            got = Table(spark, root, name).read().drop("source_file")
            assert got.count() == batch.count() and as_set(got) == as_set(batch)


def test_a_batch_is_merged_with_one_search(spark, tmp_path, monkeypatch):
    """The ids that the seven tables hold are found by one join; nothing is cached, and only new rows are added."""
    raw, root = tmp_path / "raw", str(tmp_path / "mart")
    events = make_events(4, 300)
    write_file(raw, "a.json.gz", events[:200], "broken")
    write_file(raw, "b.json.gz", events[150:])
    searches, found = [], ingestion._held_ids

    def search(*arguments):
        searches.append(1)
        return found(*arguments)

    monkeypatch.setattr(ingestion, "_held_ids", search)
    monkeypatch.setattr(Table, "insert_only", lambda *_, **__: pytest.fail("a search for one table"))
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *_: pytest.fail("a cached frame"))
    stream = event_stream(spark, str(raw), max_files=1)
    ingest(stream, root, str(tmp_path / "progress"), as_of="2020-01-01").start().awaitTermination()
    assert len(searches) == 2
    monkeypatch.undo()
    other = str(tmp_path / "batch")
    Mart(spark, other, "2020-01-01").build_silver(str(raw), FULL)
    for name in S.EVENT_TABLES.values():
        want = Table(spark, other, name).read().drop("source_file")
        got = Table(spark, root, name).read().drop("source_file")
        assert got.count() == want.count() and as_set(got) == as_set(want)


def test_tables_of_a_batch_are_appended_at_once(spark, tmp_path, monkeypatch):
    raw, root = tmp_path / "raw", str(tmp_path / "mart")
    write_file(raw, "a.json.gz", make_events(4, 200))
    gate, add = threading.Barrier(len(S.EVENT_TABLES)), Table.add_copied

    def together(*arguments):
        gate.wait(30)  # one after the other they never meet
        return add(*arguments)

    monkeypatch.setattr(Table, "add_copied", together)
    added = ingestion.merge_batch(read_events(spark, str(raw), keep_corrupt=True), root, as_of="2020-01-01")
    assert list(added) == list(S.EVENT_TABLES.values()) and added["push_events"] > 0
    assert added == {name: Table(spark, root, name).read().count() for name in added}


def test_ids_in_no_batch_are_dropped_before_the_shuffle(spark):
    def named(start, end):
        return spark.range(start, end).selectExpr("'a' AS type", "CAST(id AS STRING) AS event_id")

    held, batch = named(0, 20000), named(19990, 20010)
    left = idfilter.possible(held, batch, ["type", "event_id"])
    assert as_set(left.join(batch, ["type", "event_id"])) == as_set(named(19990, 20000))
    assert left.columns == held.columns and left.count() < 100
    assert "hashpartitioning(type" not in left._jdf.queryExecution().executedPlan().toString()


def test_an_id_is_searched_in_its_own_table_only(spark, tmp_path):
    schema = S.ENVELOPE
    row = ("7", "PushEvent", datetime(2015, 5, 1), (1, "x"), (2, "a/b"), "{}")
    names = spark.createDataFrame([], schema).columns

    def batch(*types):
        frames = [spark.createDataFrame([(row[0], t, *row[2:])], "id string, type string, created_at timestamp, actor struct<id:long,login:string>, repo struct<id:long,name:string>, payload string") for t in types]
        out = frames[0]
        for frame in frames[1:]:
            out = out.unionAll(frame)
        return out.select(*names)

    def added(*types):
        done = ingestion.merge_batch(batch(*types), str(tmp_path), as_of="2020-01-01")
        return sorted(name for name, n in done.items() if n)

    assert added("PushEvent") == ["push_events"]
    assert added("ForkEvent") == ["fork_events"]
    assert added("PushEvent") == added("ForkEvent") == []


def test_hourly_stream_stops_and_resumes_from_its_state(spark, tmp_path, monkeypatch):
    folder, root, progress = str(tmp_path / "in"), str(tmp_path / "mart"), tmp_path / "p"
    frame = spark.range(600).selectExpr(
        "CAST(id AS STRING) AS event_id",
        "timestampadd(MINUTE, CAST(id % 300 AS INT), timestamp'2020-01-01') AS created_at",
        "if(id % 3 = 0, 'a', 'b') AS type",
        "id % 4 AS repo_id",
    )
    frame.repartition(4, "event_id").write.parquet(folder)  # every hour lies in every file
    upsert, calls = Table.upsert, []

    def stops_once(*arguments, **named):
        calls.append(upsert(*arguments, **named))
        if len(calls) == 2:
            raise RuntimeError("lost after the write")
        return calls[-1]

    monkeypatch.setattr(Table, "upsert", stops_once)

    def drain():
        source = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        unique = streaming.dedup_stream(source, "30 days")
        counts = unique.groupBy(F.window("created_at", "1 hour").alias("w"), "repo_id").count()
        counts = counts.select(F.to_date("w.start").alias("window_day"), F.col("w.start").alias("window_start"), "repo_id", "count")
        streaming.upsert_stream(counts, root, "hourly", str(progress)).start().awaitTermination()

    with pytest.raises(StreamingQueryException, match="lost after the write"):
        drain()
    drain()
    assert len(calls) == 5  # four files and one that was played again
    hour = F.date_trunc("hour", "created_at")
    want = frame.groupBy(F.to_date(hour), hour.alias("hour"), "repo_id").count()
    got = Table(spark, root, "hourly").read().select("window_day", "window_start", "repo_id", "count")
    assert as_set(got) == as_set(want)
    assert list((progress / "state").rglob("*.changelog"))  # the state lies outside the heap


def test_hourly_stream_equals_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    frame = spark.range(900).selectExpr(
        "CAST(id AS STRING) AS event_id",
        "timestampadd(MINUTE, CAST(id * 7 AS INT), timestamp'2020-01-01') AS created_at",
        "if(id % 3 = 0, 'a', 'b') AS type",
        "id % 4 AS repo_id",
    )
    frame.repartition(5).write.parquet(folder)
    source = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    counts = streaming.hourly_counts(source, ["a", "b"], "30 days")
    root = str(tmp_path / "mart")
    streaming.upsert_stream(counts, root, "hourly", str(tmp_path / "p")).start().awaitTermination()
    want = as_set(streaming.hourly_counts(frame, ["a", "b"]))
    assert as_set(Table(spark, root, "hourly").read().select(*"window_day window_start repo_id n_events n_a n_b".split())) == want


CHECKED = (
    "silver_pr",
    "dq_audit",
    "top_repos",
    "repo_activity",
    "language_yearly",
    "vw_bus_factor",
    "vw_contributor_dynamics",
    "features_all",
    "language_trend",
    "mirror_audit",
    "trajectory_clusters",
    "conform_metadata",
    "conform_metadata_short",
    "attach_keys_bucketed",
    "evaluation",
    "vw_ai_boom",
    "vw_covid_impact",
    "vw_pr_lifecycle",
    "vw_ecosystem_growth",
    "vw_hourly_heatmap",
)


@pytest.mark.parametrize("name", CHECKED)
def test_registered_query_matches_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    import check_oracle

    sf = "/root/testdata/sf0.001"
    from eventmart.plans.queries import ORACLE, QUERIES

    con = check_oracle.connect(duckdb, sf)
    got, want = check_oracle.both(spark, con, sf, QUERIES[name], ORACLE[name])
    assert check_oracle.normal(got).equals(check_oracle.normal(want))


def test_every_query_has_sql():
    from eventmart.plans.queries import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)


EAGER = {
    "attach_keys_bucketed",
    "table_insert_only",
    "table_upsert",
    "mirror_audit",
    "merge_shards",
    "read_events",
    "route_events",
    "dq_audit",
    "stream_ingest",
    "stream_dedup",
    "stream_activity",
    "features_all",
    "model_training",
    "feature_importance",
    "score_repos",
    "trajectory_clusters",
}


def test_plans_hold_without_broadcasts(spark):
    """With every side too big to broadcast, no query needs a cross or nested-loop join."""
    from eventmart.plans.queries import QUERIES

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in sorted(set(QUERIES) - EAGER):
            frame = QUERIES[name](spark, "/root/testdata/sf0.001")
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
            # the one broadcast asked for is the lookup of at most six cluster names
            allowed = name in {"cluster_labels", "vw_repo_trajectories"}
            assert allowed or "BroadcastExchange" not in plan, name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bucketed_tables_join_in_place(spark):
    """No exchange on the bucketing key, neither for the join nor for an aggregate on it."""
    from eventmart.sources.buckets import write_bucketed

    events = write_bucketed(spark.range(1000).selectExpr("id % 90 AS repo_id", "id AS event_id"), ["repo_id"], 4)
    lookup = write_bucketed(spark.range(80).selectExpr("id AS repo_id", "id * 2 AS repo_key"), ["repo_id"], 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = events.join(lookup, "repo_id", "left").groupBy("repo_id").agg({"repo_key": "sum", "*": "count"})
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 90
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_feature_sides_read_one_staged_pass(spark):
    """The raw table is not read again: each side scans the folders of its type and the columns it needs."""
    from eventmart.operators import facts
    from eventmart.plans import queries

    staged = queries._staged(spark, "/root/testdata/sf0.001")
    pushes = facts.fact_push(staged.filter("type = 'PushEvent'"), unique=True).select("repo_key", "branch_ref")
    plan = pushes._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(type" in plan and "PushEvent" in plan
    assert "ReadSchema: struct<repo_key:bigint,branch_ref:string>" in plan
    built = queries.features_all(spark, "/root/testdata/sf0.001")
    assert not any("lineitem" in f for f in built.inputFiles())


def test_scans_read_only_the_columns_and_rows_they_need(spark):
    from eventmart.plans.queries import QUERIES

    frame = QUERIES["dim_contributor"](spark, "/root/testdata/sf0.001")
    plan = frame.select("contributor_key")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<c_custkey:bigint>" in plan
    frame = QUERIES["merge_upsert"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "o_orderpriority" not in plan and "o_custkey" not in plan


def test_runtime_settings_can_be_set_on_a_live_session(spark):
    from eventmart.session import RUNTIME_CONF

    assert all(spark.conf.isModifiable(key) for key in RUNTIME_CONF)


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns == [
        "repo_name",
        "language",
        "total_contributors",
        "top1_pct",
        "top3_pct",
        "top5_pct",
    ]
    assert set(entry.oracle_sql()) <= set(entry.queries())
