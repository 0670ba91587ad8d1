from __future__ import annotations

import random

import pytest
from conftest import as_dict, as_set
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from eventmart.functions import vocab as V
from eventmart.operators import evaluation, features, risk, trajectory, trends


@pytest.mark.parametrize(
    "p, age, tier",
    [
        (0.70, 10, "High Risk"),
        (0.6999, 10, "Moderate Risk"),
        (0.40, 10, "Moderate Risk"),
        (0.3999, 729, "Too Young"),
        (0.3999, 730, "Low Risk"),
    ],
)
def test_risk_tier(rows, p, age, tier):
    frame = rows("p double, repo_age_days int", (p, age))
    assert frame.select(risk.risk_tier("p").alias("t")).first().t == tier


def test_momentum_labels(rows):
    frame = rows("m double", (1.5,), (1.49,), (0.5,), (0.1,), (0.09,), (None,))
    got = [r.t for r in frame.select(risk.momentum_label("m").alias("t")).collect()]
    assert got == ["Accelerating", "Stable", "Stable", "Declining", "Stalled", "Stalled"]


def test_labels(spark, rows):
    repos = spark.sql(
        """SELECT k AS repo_key, 'Go' AS language, 'MIT' AS license, false AS is_ai_ml_repo,
                  CAST(NULL AS BOOLEAN) AS has_readme, CAST(NULL AS BOOLEAN) AS has_ci,
                  CAST(2018 AS SMALLINT) AS created_year, age AS repo_age_days,
                  archived AS is_archived, at AS created_at
           FROM VALUES (1L, 100, true, timestamp'2018-01-01'), (2L, 730, false, timestamp'2018-01-01'),
                (3L, 729, false, timestamp'2018-01-01'), (4L, 900, false, timestamp'2018-01-01'),
                (5L, 900, false, timestamp'2018-01-01'), (6L, 900, NULL, CAST(NULL AS TIMESTAMP))
                AS t(k, age, archived, at)"""
    )
    activity = rows("repo_key bigint, year smallint", (2, 2017), (4, 2018), (None, 2020), (2, 2016))
    got = {r.repo_key: r.label for r in risk.labelled_repositories(repos, activity, 2020).collect()}
    # 1 archived, 2 silent since 2017, 3 too young, 4 active in 2018, 5 never active, 6 undated
    assert got == {1: 1, 2: 1, 4: 0, 5: 0}


def test_class_weight_and_split(rows):
    frame = rows("label int, created_year smallint", *[(0, 2016)] * 6, (1, 2017), (1, 2018), (0, 2019))
    weighted = risk.with_class_weight(frame, risk.class_balance(frame))
    assert {(r.label, r.class_weight) for r in weighted.collect()} == {(0, 1.0), (1, 3.5)}
    train, test = risk.temporal_split(frame, 2020)
    assert (train.count(), test.count()) == (6, 2)
    none = frame.filter("label = 0")
    assert risk.class_balance(none).first().weight_ratio == 7.0


def test_outcomes(rows):
    frame = rows("label int, prediction double", (1, 1.0), (0, 0.0), (0, 1.0), (1, 0.0), (None, 1.0))
    got = [r.o for r in frame.select(risk.outcome().alias("o")).collect()]
    assert got == ["True Positive", "True Negative", "False Positive", "False Negative", None]


YEARLY = "language_key bigint, year smallint, market_share_pct double"
LANGUAGE = "language_key bigint, language_name string"


def test_trend_against_least_squares(spark):
    import numpy as np

    rng = random.Random(1)
    shares = {k: [(y, rng.uniform(0, 9)) for y in range(2015, 2022)] for k in range(1, 6)}
    shares[6] = [(2015, 9.0), (2016, 5.0), (2017, 0.5)]
    values = [(k, y, s) for k, points in shares.items() for y, s in points]
    languages = spark.createDataFrame([(k, f"l{k}") for k in range(1, 7)], LANGUAGE)
    frame = trends.language_trend(spark.createDataFrame(values, YEARLY), languages)
    got = as_dict(frame, "language_key")
    for k, points in shares.items():
        x, y = np.array(points).T
        slope, base = np.polyfit(x - 2018, y, 1)
        r2 = np.corrcoef(x, y)[0, 1] ** 2
        assert got[k]["slope_pct_per_year"] == pytest.approx(slope, abs=1e-4)
        assert got[k]["r_squared"] == pytest.approx(r2, abs=1e-4)
        for year in (2026, 2027):
            want = max(0.0, base + slope * (year - 2018))
            assert got[k][f"forecast_{year}_share"] == pytest.approx(want, abs=1e-4)
    assert got[6]["forecast_2026_share"] == 0.0


def test_trend_leaves_out_constant_and_short_series(spark):
    values = [(1, y, 5.0) for y in range(2015, 2020)] + [(2, 2019, 1.0), (2, 2020, 2.0)]
    values += [(3, 2018 + i, s) for i, s in enumerate((1.0, 1.1, 1.21))]
    languages = spark.createDataFrame([(k, f"l{k}") for k in (1, 2, 3)], LANGUAGE)
    frame = trends.language_trend(spark.createDataFrame(values, YEARLY), languages)
    assert [(r.language_key, r.trend_label) for r in frame.collect()] == [(3, "Growing")]


@pytest.mark.parametrize(
    "step, label",
    [
        (0.51, "Strongly Growing"),
        (0.5, "Growing"),
        (0.1, "Stable"),
        (0.05, "Stable"),
        (-0.05, "Stable"),
        (-0.3, "Declining"),
        (-0.6, "Strongly Declining"),
    ],
)
def test_trend_labels(spark, step, label):
    values = [(1, 2018 + i, 50 + step * i) for i in range(4)]
    languages = spark.createDataFrame([(1, "l")], LANGUAGE)
    frame = trends.language_trend(spark.createDataFrame(values, YEARLY), languages)
    assert frame.first().trend_label == label


ACTIVITY = "repo_key bigint, year smallint, total_commits bigint"


def test_vectors_and_growth(rows):
    frame = rows(ACTIVITY, (1, 2019, 2), (1, 2019, 3), (1, 2021, 8), (2, 2021, 4), (None, 2019, 9), (None, 2020, 9))
    vectors = trajectory.yearly_vectors(frame, [2019, 2020, 2021])
    got = trajectory.with_growth(vectors, [2019, 2020, 2021], 2020).collect()
    assert len(got) == 1
    row = got[0].asDict()
    assert (row["2019"], row["2020"], row["2021"], row["years_observed"]) == (5, 0, 8, 2)
    assert (row["avg_commits_early"], row["avg_commits_recent"]) == (2.5, 8.0)
    assert row["growth_ratio"] == 8.0 / 3.5


def test_cluster_names_follow_growth(rows):
    frame = rows(
        "repo_key bigint, cluster_id int, growth_ratio double",
        *[(k, k % 3, {0: 0.1, 1: 9.0, 2: 2.0}[k % 3]) for k in range(9)],
    )
    got = {(r.cluster_id, r.trajectory_label) for r in trajectory.cluster_labels(frame).collect()}
    assert got == {(1, "Viral"), (2, "Established"), (0, "Stable")}


def test_clusters_found_and_too_few_repositories(spark, rows):
    years = [2019, 2020]
    low = [(k, 0, k % 2, 2) for k in range(10)]
    high = [(k, 100, 90 + k % 2, 2) for k in range(10, 20)]
    schema = "repo_key bigint, `2019` bigint, `2020` bigint, years_observed bigint"
    got = trajectory.cluster(rows(schema, *low, *high), years, max_k=2)
    groups = {}
    for r in got.collect():
        groups.setdefault(r.cluster_id, set()).add(r.repo_key)
    assert sorted(map(sorted, groups.values())) == [list(range(10)), list(range(10, 20))]
    few = trajectory.cluster(rows(schema, *low[:3]), years)
    assert few.isEmpty() and few.dtypes == got.dtypes


def test_every_cluster_gets_a_name(spark, rows):
    schema = "repo_key bigint, cluster_id int, growth_ratio double"
    named = trajectory.cluster_labels(rows(schema, *[(k, k, float(9 - k)) for k in range(9)]))
    labels = [r.trajectory_label for r in named.orderBy("cluster_id").collect()]
    assert None not in labels and len(set(labels)) == 9
    assert labels[6:] == [f"{labels[5]} {n}" for n in (2, 3, 4)]


def brute_features(values, born, bots, pushes):
    from datetime import date, timedelta

    out = {}
    for repo, day in born.items():
        limit = day + timedelta(days=90)
        mine = [v for v in values if v["repo_key"] == repo]
        early = [v for v in mine if v["obs_date"] <= limit]
        early_pushes = [p for p in pushes if p[0] == repo and _day(p[2]) <= limit]
        out[repo] = (
            sum(v["total_commits"] for v in early) if early else None,
            len(early) or None,
            len({v["date_key"] for v in mine}) or None,
            len({v["year"] for v in mine}) or None,
            len({p[1] for p in early_pushes if p[1] is not None and p[1] not in bots}) or None,
            len({p[3] for p in early_pushes}) or None,
        )
    assert isinstance(next(iter(born.values())), date)
    return out


def _day(key):
    from datetime import date

    return date(key // 1_000_000, key // 10_000 % 100, key // 100 % 100)


def test_features_against_brute_force(spark):
    from datetime import date

    rng = random.Random(11)
    born = {r: date(2018, rng.randint(1, 12), 3) for r in range(8)}
    sums = list(features._EARLY_SUMS.values())
    values, pushes = [], []
    for repo in [*range(7), 99, None]:
        for _ in range(rng.randint(0, 12)):
            key = rng.randint(2017, 2019) * 1_000_000 + rng.randint(1, 12) * 10_000 + 1500
            if any(v["repo_key"] == repo and v["date_key"] == key for v in values):
                continue
            row = {"repo_key": repo, "date_key": key, "year": key // 1_000_000, "obs_date": _day(key)}
            row |= {c: rng.randint(0, 9) for c in sums} | {"unique_contributors": 2}
            values.append(row)
        for _ in range(rng.randint(0, 12)):
            key = rng.randint(2017, 2019) * 1_000_000 + rng.randint(1, 12) * 10_000 + 1500
            pushes.append((repo, rng.choice([1, 2, 3, 4, None]), key, rng.choice("abc"), True))
    schema = "repo_key bigint, date_key int, year smallint, obs_date date," + ",".join(
        f"{c} bigint" for c in [*sums, "unique_contributors"]
    )
    columns = [c.split()[0] for c in schema.split(",")]
    activity = spark.createDataFrame([tuple(v[c] for c in columns) for v in values], schema)
    push = spark.createDataFrame(
        pushes,
        "repo_key bigint, contributor_key bigint, date_key int, branch_ref string,"
        "is_default_branch boolean",
    )
    prs = spark.createDataFrame(
        [(0, 2018011500, 4, 2, True)],
        "repo_key bigint, date_key int, additions int, review_comments int, is_merged boolean",
    )
    repos = spark.createDataFrame(list(born.items()), "repo_key bigint, repo_created_date date")
    people = spark.createDataFrame(
        [(1, False), (2, True), (3, False)], "contributor_key bigint, is_bot boolean"
    )
    got = features.build_features(repos, activity, push, prs, people, 2018)
    names = (
        "early_commits active_days_in_90 total_active_days years_observed "
        "total_unique_contributors unique_branches"
    ).split()
    # 4 is no known contributor: like a bot, it does not count
    want = brute_features(values, born, {2, 4}, pushes)
    assert {r.repo_key: tuple(r[n] for n in names) for r in got.collect()} == want
    assert as_set(got.select("repo_key", "commit_momentum")) == as_set(
        repos.select("repo_key")
        .join(features.momentum(activity, 2018), "repo_key", "left")
        .select("repo_key", "commit_momentum")
    )
    assert set(V.NUMERIC_FEATURES) - {"repo_age_days", "created_year"} <= set(got.columns)


def test_feature_join_splits_a_hot_repository(spark):
    """With a third of all pushes in one repository the join partition is split at run time."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        push = spark.range(0, 60_000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).alias("repo_key"),
            F.lit(2018011500).alias("date_key"),
            (F.col("id") % 997).alias("contributor_key"),
            F.concat(F.lit("b"), F.col("id") % 300).alias("branch_ref"),
            F.lit(True).alias("is_default_branch"),
        )
        repos = spark.range(5000).select(
            F.col("id").alias("repo_key"), F.lit("2018-01-01").cast("date").alias("repo_created_date")
        )
        out = features.push_features(push, repos)
        hot = {r.repo_key: r.unique_branches for r in out.collect()}
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
        want = push.filter("repo_key = 1").select("branch_ref").distinct().count()
        assert hot[1] == want and len(hot) == 5000
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_evaluation_equals_the_library(spark):
    """Area with ties, f1 and accuracy against MLlib's evaluators."""
    rng = random.Random(4)
    rows = []
    for _ in range(700):
        label = int(rng.random() < 0.3)
        score = min(1.0, max(0.0, round(rng.gauss(0.4 + 0.2 * label, 0.25), 2)))
        rows.append((float(label), score, float(score >= 0.5)))
    frame = spark.createDataFrame(rows, "label double, score double, prediction double").repartition(5)
    got = evaluation.evaluate(frame, "score", predicted="prediction").first()
    area = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label").evaluate(frame)
    assert abs(got.area_under_roc - area) < 1e-9
    for name in ("f1", "accuracy"):
        known = MulticlassClassificationEvaluator(labelCol="label", metricName=name).evaluate(frame)
        assert abs(got[name] - known) < 1e-9
    assert got.true_positives + got.false_negatives == sum(r[0] for r in rows)
    one_class = evaluation.evaluate(frame.filter("label = 1"), "score", predicted="prediction").first()
    assert one_class.area_under_roc is None and one_class.false_positives == 0
    nothing = evaluation.evaluate(frame.limit(0), "score", predicted="prediction").first()
    assert nothing.area_under_roc is None and nothing.accuracy is None
