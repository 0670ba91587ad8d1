from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from conftest import as_dict
from pyspark.sql import functions as F

from eventmart.functions import columns
from eventmart.operators import views
from eventmart.plans.queries import QUERIES

PUSH = "event_id string, repo_key bigint, contributor_key bigint, date_key int"
REPO = "repo_key bigint, repo_name string, language string"


def pushes_of(spark, counts, date_key=2020010100):
    """counts: {(repo, contributor): pushes}"""
    values = [
        (f"{repo}-{who}-{i}", repo, who, date_key)
        for (repo, who), n in counts.items()
        for i in range(n)
    ]
    return spark.createDataFrame(values, PUSH)


def brute_bus_factor(counts, names, least=3):
    """Rank contributors per repository by hand, then group by name and language."""
    per_repo = defaultdict(dict)
    for (repo, who), n in counts.items():
        if repo in names:
            per_repo[repo][who] = n
    groups = defaultdict(lambda: {"who": set(), "total": 0, 1: 0, 3: 0, 5: 0})
    for repo, people in per_repo.items():
        group = groups[names[repo]]
        group["who"] |= {w for w in people if w is not None}
        group["total"] = max(group["total"], sum(people.values()))
        for n in people.values():
            rank = 1 + sum(m > n for m in people.values())
            for k in (1, 3, 5):
                group[k] += n if rank <= k else 0
    return {
        name: (len(g["who"]), *(round(100 * g[k] / g["total"] + 1e-9, 2) for k in (1, 3, 5)))
        for name, g in groups.items()
        if len(g["who"]) >= least
    }


def run_bus_factor(spark, counts, names):
    repos = spark.createDataFrame([(k, *v) for k, v in names.items()], REPO)
    frame = views.bus_factor(pushes_of(spark, counts), repos)
    return {(r[0], r[1]): tuple(r)[2:] for r in frame.collect()}


def test_bus_factor_ties_share_a_rank(spark):
    counts = {(1, 1): 4, (1, 2): 4, (1, 3): 1, (1, 4): 1, (1, 5): 1, (2, 1): 3, (2, 2): 1}
    got = run_bus_factor(spark, counts, {1: ("a", "Go"), 2: ("b", "Go")})
    assert got == {("a", "Go"): (5, 72.73, 100.0, 100.0)}


def test_bus_factor_names_shared_by_repositories(spark):
    # the same three people in two repositories of one name: counted once, shares add up
    counts = {(r, w): n for r in (1, 2) for w, n in ((1, 5), (2, 3), (3, 2))}
    got = run_bus_factor(spark, counts, {1: ("a", "Go"), 2: ("a", "Go")})
    assert got == {("a", "Go"): (3, 100.0, 200.0, 200.0)}


def test_bus_factor_against_brute_force(spark):
    rng = random.Random(5)
    names = {r: (f"n{r % 9}", rng.choice(["Go", "C"])) for r in range(12)}
    counts = {}
    for repo in [*range(14), None]:
        for who in [*range(rng.randint(1, 12)), None]:
            counts[repo, who] = rng.choice([1, 1, 2, 3, 8])
    assert run_bus_factor(spark, counts, names) == brute_bus_factor(counts, names)


def test_bus_factor_histogram_is_small_for_a_hot_repository(spark):
    """One repository with a third of all rows: the ranking window sees push counts only."""
    counts = {(1, w): 1 + w % 3 for w in range(3000)} | {(r, 1): 3 for r in range(2, 2000)}
    names = {1: ("hot", "Go"), 2: ("cold", "Go")}
    got = run_bus_factor(spark, counts, names)
    assert got == brute_bus_factor(counts, names)


def test_contributor_dynamics_against_brute_force(spark):
    rng = random.Random(3)
    active = {w: sorted(rng.sample(range(2015, 2022), rng.randint(1, 5))) for w in range(40)}
    values = [
        (f"{w}-{y}-{i}", 1, w, y * 1_000_000 + 10100)
        for w, years in active.items()
        for y in years
        for i in range(rng.randint(1, 3))
    ]
    values.append(("anonymous", 1, None, 2016010100))
    pushes = spark.createDataFrame(values, PUSH)
    dates = pushes.select(
        "date_key", (F.col("date_key") / 1_000_000).cast("smallint").alias("year")
    ).distinct()
    got = as_dict(views.contributor_dynamics(pushes, dates), "year")
    total = Counter(k // 1_000_000 for *_, who, k in values if who is not None)
    for year, row in got.items():
        here = {w for w, years in active.items() if year in years}
        new = {w for w in here if active[w][0] == year}
        kept = {w for w in here if year - 1 in active[w]}
        assert row["total_contributors"] == len(here)
        assert (row["new_contributors"], row["returning_contributors"]) == (
            len(new),
            len(here) - len(new),
        )
        assert row["retained_from_prior"] == len(kept)
        assert row["retention_rate_pct"] == pytest.approx(100 * len(kept) / len(here), abs=0.006)
        assert row["total_pushes"] == total[year]


ACTIVITY = (
    "date_key int, repo_key bigint, year smallint, total_pushes bigint, total_commits bigint,"
    "unique_contributors bigint, total_prs_opened bigint, total_prs_merged bigint,"
    "avg_pr_merge_hours double, total_issues_opened bigint, total_issues_closed bigint,"
    "avg_issue_close_hours double, total_stars bigint, total_forks bigint, total_releases bigint"
)


def hour(key, repo, **metrics):
    names = [c.split()[0] for c in ACTIVITY.split(",")]
    base = dict.fromkeys(names, 0) | {"avg_pr_merge_hours": None, "avg_issue_close_hours": None}
    base |= {"date_key": key, "repo_key": repo, "year": key // 1_000_000} | metrics
    return tuple(base[n] for n in names)


def test_repo_health_scores(spark):
    values = [
        hour(2020010100, 1, avg_pr_merge_hours=84.0, total_prs_opened=4, total_prs_merged=2),
        hour(2020010101, 1, avg_issue_close_hours=1000.0),
        hour(2020010100, 2),
        hour(2020010100, 3, total_prs_opened=1, total_prs_merged=9, total_stars=10**7),
    ]
    repos = spark.createDataFrame(
        [(k, f"r{k}", "Go", False) for k in (1, 2, 3)], REPO + ", is_ai_ml_repo boolean"
    )
    frame = views.repo_health(spark.createDataFrame(values, ACTIVITY), repos)
    got = as_dict(frame, "repo_name")
    assert got["r1"]["health_score"] == 25.0  # half of the speed and of the merge points
    assert got["r2"]["health_score"] == 0.0 and got["r2"]["merge_rate"] is None
    assert got["r3"]["health_score"] == 100.0  # capped


def test_ai_boom_shares_sum_to_hundred_and_drop_unknown_repositories(spark):
    values = [
        hour(2020010100, 1, total_pushes=1),
        hour(2020010101, 1, total_pushes=2),
        hour(2020010100, 2, total_pushes=5),
        hour(2020010100, None, total_pushes=0),
        hour(2021010100, 2, total_pushes=0),
    ]
    dates = spark.createDataFrame(
        [(2020010100, 2020), (2020010101, 2020), (2021010100, 2021)], "date_key int, year smallint"
    )
    repos = spark.createDataFrame([(1, True), (2, False)], "repo_key bigint, is_ai_ml_repo boolean")
    frame = views.ai_boom(spark.createDataFrame(values, ACTIVITY), dates, repos)
    got = {(r.year, r.is_ai_ml_repo): r for r in frame.collect()}
    assert got[2020, True].ai_activity_share_pct == 37.5 and got[2020, True].unique_repos == 1
    assert got[2020, False].ai_activity_share_pct == 62.5
    assert got[2021, False].ai_activity_share_pct is None


def test_hours_missing_from_the_dimension_drop_out(spark):
    values = [hour(2020010100, 1, total_pushes=1), hour(2020010101, 1, total_releases=1)]
    dates = spark.createDataFrame([(2020010100, 2020)], "date_key int, year smallint")
    got = views.ecosystem_growth(spark.createDataFrame(values, ACTIVITY), dates).collect()
    assert [(r.year, r.unique_repos, r.total_pushes, r.pr_to_push_ratio) for r in got] == [
        (2020, 1, 1, 0.0)
    ]


SCORE = (
    "repo_key bigint, model_version string, abandonment_probability double, risk_tier string,"
    "created_year smallint, scored_at timestamp, is_archived boolean, trajectory_label string"
)


def test_score_views(spark):
    from datetime import datetime

    now = datetime(2020, 1, 1)
    probabilities = [0.8, 0.7999, 0.6, 0.4, 0.2, 0.1999]
    values = [
        (i, v, p, "High Risk" if p >= 0.7 else "Low Risk", 2019, now, False, "Stable")
        for v in ("202001", "202002")
        for i, p in enumerate(probabilities)
    ]
    scores = spark.createDataFrame(values, SCORE)
    repos = spark.createDataFrame(
        [(i, f"r{i}", "o", "Go", "MIT", True, None, None, 2019, 9) for i in range(6)],
        "repo_key bigint, repo_name string, owner_login string, language string, license string,"
        "is_ai_ml_repo boolean, has_readme boolean, has_ci boolean, created_year smallint,"
        "repo_age_days int",
    )
    tiers = {
        r.repo_name: r.confidence_tier for r in views.ml_predictions(scores, repos).collect()
    }
    assert [tiers[f"r{i}"].split(" (")[0] for i in range(6)] == [
        "Very High Risk",
        "High Risk",
        "High Risk",
        "Moderate Risk",
        "Low Risk",
        "Very Low Risk",
    ]
    current = views.abandonment_risk_current(scores, repos).collect()
    assert len(current) == 6 and {r.model_version for r in current} == {"202002"}
    assert views.ml_by_language(scores, repos, 13).count() == 0
    by_language = views.ml_by_language(scores, repos, 12).first()
    assert (by_language.total_repos, by_language.high_risk_pct) == (12, 33.3)
    trend = views.abandonment_trend(scores).collect()
    assert sum(r.pct_of_scored_repos for r in trend if r.model_version == "202001") == 100.0


def test_feature_importance_ties(spark):
    frame = spark.createDataFrame(
        [("a", 0.5, "v"), ("b", 0.5, "v"), ("c", 0.25, "v")],
        "feature_name string, importance double, model_version string",
    )
    got = as_dict(views.ml_feature_importance(frame), "feature_name")
    assert [got[n]["importance_rank"] for n in "abc"] == [1, 1, 3]
    assert got["a"]["importance_pct"] == 40.0


def test_hours_are_looked_up_and_not_joined(spark):
    """Days before, between and after those of the dimension, hours apart, and a flag."""
    held = [2020010305, 2020010306, 2020022923, 2021123100]
    dates = spark.createDataFrame([(k, k == 2020010306) for k in held], "date_key int, odd boolean")
    keys = [*held, 2020010304, 2020010205, 2020010406, 2020030100, 2020022900, 2022010100, 1999123123, 2020010205]
    activity = spark.createDataFrame([(k, 1) for k in keys] + [(None, 1)], "date_key int, n int")
    got = views._dated(activity, dates, "year", "hour", "day_of_week", "is_weekend", "odd").collect()
    assert sorted((r.date_key, r.year, r.hour, r.day_of_week, r.is_weekend, r.odd) for r in got) == [
        (2020010305, 2020, 5, 6, False, False),
        (2020010306, 2020, 6, 6, False, True),
        (2020022923, 2020, 23, 7, True, False),
        (2021123100, 2021, 0, 6, False, False),
    ]
    assert views._dated(activity, dates.limit(0), "year").count() == 0
    with pytest.raises(ValueError, match="one flag"):
        views._dated(activity, dates.withColumn("even", F.lit(True)), "odd", "even")


def test_year_ranges_of_hour_keys(spark):
    keys = spark.createDataFrame([(y * 1_000_000 + 123123,) for y in range(2015, 2025)], "k int")
    for years in ((2017, 2018, 2019, 2021), (2016,), ()):
        got = keys.filter(columns.hour_keys_of_years("k", years)).collect()
        assert sorted(r.k // 1_000_000 for r in got) == sorted(years)


@pytest.mark.parametrize(
    "name",
    ["vw_ai_boom", "vw_covid_impact", "vw_pr_lifecycle", "vw_ecosystem_growth", "vw_hourly_heatmap", "vw_contributor_dynamics"],
)
def test_views_need_no_exchange_on_the_hour(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"hashpartitioning\(date_key#\d+, \d+\)", plan)
    assert "date_key" in plan
