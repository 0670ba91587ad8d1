"""Independent SQL for the registered queries.

Named building blocks, each a plain SQL formulation of one table (separate aggregates and
joins where the Spark side fuses them), put together into one statement per query.
"""

from __future__ import annotations

import re


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding on the decimal text of the double, as Spark rounds."""
    text = f"CAST(CAST({expr} AS DOUBLE) AS VARCHAR)"
    return f"CAST(ROUND(CAST({text} AS DECIMAL(38,18)), {digits}) AS DOUBLE)"


def mean2(expr: str) -> str:
    return f"(CAST(SUM(CAST(ROUND(({expr}) * 100) AS BIGINT)) AS DOUBLE) / 100.0 / COUNT({expr}))"


def mean_int(expr: str) -> str:
    return f"(CAST(SUM(CAST({expr} AS BIGINT)) AS DOUBLE) / COUNT({expr}))"


def mean_fixed(expr: str, scale: int = 9) -> str:
    return f"(CAST(SUM(CAST({expr} AS DECIMAL(28,{scale}))) AS DOUBLE) / COUNT({expr}))"


def pct(part: str, whole: str, digits: int) -> str:
    whole_ = f"NULLIF(CAST({whole} AS DOUBLE), 0)"
    return rnd(f"(100.0::DOUBLE * CAST({part} AS DOUBLE) / {whole_})", digits)


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def hours(later: str, earlier: str) -> str:
    seconds = f"(epoch({later}) - epoch({earlier}))"
    return f"CASE WHEN {later} > {earlier} THEN {rnd(seconds + ' / 3600.0', 2)} END"


_LINE_ORDER = (
    "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus, l_shipdate"
)

_EVENT_COLUMNS = """
    l_orderkey, l_linenumber,
    CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS event_id,
    CASE WHEN l_linenumber <= 2 THEN 'PushEvent' WHEN l_linenumber = 3 THEN 'PullRequestEvent'
         WHEN l_linenumber = 4 THEN 'IssuesEvent' WHEN l_linenumber = 5 THEN 'WatchEvent'
         WHEN l_linenumber = 6 THEN 'ForkEvent' ELSE 'ReleaseEvent' END AS type,
    l_shipdate + INTERVAL 1 HOUR * (l_suppkey % 24) AS created_at,
    CAST(year(l_shipdate) AS SMALLINT) AS year,
    l_partkey AS repo_id,
    'repo/' || l_partkey || '-' || year(l_shipdate) AS repo_name,
    o_custkey AS actor_id,
    CASE WHEN l_quantity >= 2 THEN 'user-' || o_custkey
         || CASE WHEN o_custkey % 20 = 0 THEN '[bot]' ELSE '' END END AS actor_login,
    CAST(trunc(l_quantity) AS INTEGER) AS commit_count,
    CASE l_returnflag WHEN 'A' THEN 'refs/heads/main' WHEN 'N' THEN 'refs/heads/master'
         ELSE 'refs/heads/dev' END AS branch_ref,
    CASE o_orderstatus WHEN 'O' THEN 'opened' WHEN 'F' THEN 'closed' ELSE 'reopened' END AS action,
    CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE 'open' END AS state,
    l_orderkey * 10 + l_linenumber AS object_id,
    'Item ' || l_orderkey AS title,
    l_linestatus = 'F' AS is_merged,
    CAST(floor(l_quantity * l_quantity / 2) AS INTEGER) AS additions,
    CAST(round(l_discount * 100) AS INTEGER) AS deletions,
    CAST(l_partkey % 7 AS INTEGER) AS changed_files,
    CAST(l_suppkey % 10 AS INTEGER) AS remarks,
    o_orderdate AS opened_at,
    l_shipdate AS ended_at,
    l_returnflag || ',' || l_linestatus AS label_list,
    CASE WHEN o_orderstatus = 'F' THEN 'started' ELSE 'deleted' END AS watch_action,
    'v' || l_suppkey AS tag_name,
    l_returnflag = 'R' AS is_prerelease
"""

_SUM_OPENED = "SUM(CASE WHEN action = 'opened' THEN 1 ELSE 0 END)"
_SUM_CLOSED = "SUM(CASE WHEN action = 'closed' THEN 1 ELSE 0 END)"
_SUM_MERGED = "SUM(CASE WHEN is_merged THEN 1 ELSE 0 END)"

_KNOWN = """
    ('Python', 'multi-paradigm', 'dynamic', 1991, false),
    ('JavaScript', 'multi-paradigm', 'dynamic', 1995, false),
    ('TypeScript', 'multi-paradigm', 'static', 2012, false),
    ('Java', 'OOP', 'static', 1995, false),
    ('Go', 'procedural', 'static', 2009, false),
    ('Rust', 'systems', 'static', 2015, true),
    ('C++', 'multi-paradigm', 'static', 1985, false),
    ('C', 'procedural', 'static', 1972, false),
    ('Ruby', 'OOP', 'dynamic', 1995, false),
    ('PHP', 'multi-paradigm', 'dynamic', 1994, false),
    ('Swift', 'multi-paradigm', 'static', 2014, false),
    ('Kotlin', 'multi-paradigm', 'static', 2011, false),
    ('Scala', 'functional', 'static', 2004, false),
    ('Shell', 'scripting', 'dynamic', 1989, false),
    ('Jupyter Notebook', 'scripting', 'dynamic', 2014, false),
    ('Unknown', 'unknown', 'unknown', NULL, false)
"""

_EARLY = "obs_date <= repo_created_date + 90"

# Name -> SQL. A block may use any block above it and the test tables.
BLOCKS: dict[str, str] = {
    "line1": f"""
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (
                PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS rn
            FROM lineitem) WHERE rn = 1""",
    "ev0": f"SELECT {_EVENT_COLUMNS} FROM lineitem JOIN orders ON l_orderkey = o_orderkey",
    "ev": f"SELECT {_EVENT_COLUMNS} FROM line1 JOIN orders ON l_orderkey = o_orderkey",
    "conf": "SELECT * FROM ev WHERE type <> 'WatchEvent' OR watch_action = 'started'",
    "repos": """
        SELECT p_partkey AS repo_id,
               p_brand || '/' || replace(p_name, ' ', '-') || '-' || p_partkey AS repo_name,
               CASE WHEN p_size > 3 THEN p_type END AS language,
               p_brand AS license, lower(p_name) AS topics, p_size AS stars_at_extract,
               CAST(NULL AS INTEGER) AS forks_at_extract, CAST(NULL AS VARCHAR) AS description,
               p_size >= 45 AS is_archived, CAST(NULL AS BOOLEAN) AS has_readme,
               CAST(NULL AS BOOLEAN) AS has_ci,
               CAST(DATE '1994-01-01' + CAST((p_partkey * 37) % 2900 AS INTEGER) AS TIMESTAMP)
                   AS created_at
        FROM part WHERE p_brand NOT LIKE 'Brand#2%'""",
    "drepo": """
        SELECT repo_id AS repo_key, repo_id, repo_name,
               split_part(repo_name, '/', 1) AS owner_login,
               coalesce(language, 'Unknown') AS language, license,
               coalesce(topics, '') AS topics, stars_at_extract, forks_at_extract,
               (regexp_matches(lower(coalesce(topics, '')), 'ring|small')
                OR regexp_matches(lower(repo_name), 'ring|small')) AS is_ai_ml_repo,
               is_archived, CAST(year(created_at) AS SMALLINT) AS created_year, description,
               has_readme, has_ci,
               CAST(DATE '2001-12-31' - CAST(created_at AS DATE) AS INTEGER) AS repo_age_days,
               created_at
        FROM repos""",
    "people": """
        SELECT c_custkey AS actor_id,
               c_name || CASE WHEN c_custkey % 20 = 0 THEN '[bot]' ELSE '' END AS login,
               'User' AS account_type
        FROM customer""",
    "dcontrib": r"""
        SELECT actor_id AS contributor_key, actor_id, login,
               coalesce(regexp_matches(lower(login), '\[bot\]|bot$|github.actions'), false)
                   AS is_bot,
               account_type
        FROM people""",
    "known": f"""
        SELECT * FROM (VALUES {_KNOWN})
            AS k(language_name, paradigm, type_system, first_appeared, is_emerging)""",
    "dlang": """
        SELECT row_number() OVER (ORDER BY n.language_name) AS language_key, n.language_name,
               coalesce(k.paradigm, 'unknown') AS paradigm,
               coalesce(k.type_system, 'unknown') AS type_system,
               CAST(k.first_appeared AS BIGINT) AS first_appeared,
               coalesce(k.is_emerging, false) AS is_emerging
        FROM (SELECT coalesce(language, 'Unknown') AS language_name FROM repos
              UNION SELECT language_name FROM known) n
        LEFT JOIN known k ON n.language_name = k.language_name""",
    "ddate": """
        SELECT DISTINCT
               CAST(strftime(created_at, '%Y%m%d%H') AS INTEGER) AS date_key,
               CAST(created_at AS DATE) AS full_date,
               CAST(year(created_at) AS SMALLINT) AS year,
               CAST(quarter(created_at) AS TINYINT) AS quarter,
               CAST(month(created_at) AS TINYINT) AS month,
               strftime(created_at, '%B') AS month_name,
               CAST(dayofweek(created_at) + 1 AS TINYINT) AS day_of_week,
               strftime(created_at, '%A') AS day_name,
               CAST(hour(created_at) AS TINYINT) AS hour,
               dayofweek(created_at) IN (0, 6) AS is_weekend,
               CAST(created_at AS DATE) BETWEEN DATE '1998-03-01' AND DATE '1999-06-30'
                   AS is_covid_period
        FROM conf WHERE type <> 'ReleaseEvent'""",
    "keyed": """
        SELECT c.*, CAST(strftime(c.created_at, '%Y%m%d%H') AS INTEGER) AS date_key,
               r.repo_key, p.contributor_key,
               coalesce(l.language_key,
                        (SELECT language_key FROM dlang WHERE language_name = 'Unknown'))
                   AS language_key
        FROM conf c
        LEFT JOIN drepo r ON c.repo_id = r.repo_id
        LEFT JOIN dcontrib p ON c.actor_id = p.actor_id
        LEFT JOIN (SELECT lower(language_name) AS name, min(language_key) AS language_key
                   FROM dlang GROUP BY 1) l ON lower(r.language) = l.name""",
    "fpush": r"""
        SELECT event_id, date_key, repo_key, contributor_key, language_key, year,
               commit_count, branch_ref,
               regexp_matches(branch_ref, 'refs/heads/(main|master)$') AS is_default_branch
        FROM keyed WHERE type = 'PushEvent'""",
    "fpr": f"""
        SELECT event_id, date_key, repo_key, contributor_key, language_key, year, action,
               object_id AS pr_id, is_merged, additions, deletions, changed_files,
               remarks AS review_comments,
               CASE WHEN is_merged THEN {hours('ended_at', 'opened_at')} END
                   AS time_to_merge_hours,
               CASE WHEN additions + deletions <= 10 THEN 'XS'
                    WHEN additions + deletions <= 50 THEN 'S'
                    WHEN additions + deletions <= 250 THEN 'M'
                    WHEN additions + deletions <= 1000 THEN 'L' ELSE 'XL' END AS pr_size_bucket
        FROM keyed WHERE type = 'PullRequestEvent'""",
    "fissue": f"""
        SELECT event_id, date_key, repo_key, contributor_key, language_key, year, action,
               object_id AS issue_id, label_list, remarks AS comments_count,
               CASE WHEN state = 'closed' THEN {hours('ended_at', 'opened_at')} END
                   AS time_to_close_hours
        FROM keyed WHERE type = 'IssuesEvent'""",
    "spine": """
        SELECT date_key, repo_key, min(language_key) AS language_key, min(year) AS year,
               CAST(strptime(CAST(date_key // 100 AS VARCHAR), '%Y%m%d') AS DATE) AS obs_date
        FROM keyed GROUP BY date_key, repo_key""",
    "activity": f"""
        SELECT s.date_key, s.repo_key, s.language_key, s.year, s.obs_date,
               {big('coalesce(total_pushes, 0)')} AS total_pushes,
               {big('coalesce(total_commits, 0)')} AS total_commits,
               {big('coalesce(unique_contributors, 0)')} AS unique_contributors,
               {big('coalesce(total_prs_opened, 0)')} AS total_prs_opened,
               {big('coalesce(total_prs_merged, 0)')} AS total_prs_merged,
               avg_pr_merge_hours,
               {big('coalesce(total_issues_opened, 0)')} AS total_issues_opened,
               {big('coalesce(total_issues_closed, 0)')} AS total_issues_closed,
               avg_issue_close_hours,
               {big('coalesce(total_stars, 0)')} AS total_stars,
               {big('coalesce(total_forks, 0)')} AS total_forks,
               {big('coalesce(total_releases, 0)')} AS total_releases
        FROM spine s
        LEFT JOIN (SELECT date_key, repo_key, COUNT(event_id) AS total_pushes,
                          SUM(commit_count) AS total_commits,
                          COUNT(DISTINCT contributor_key) AS unique_contributors
                   FROM fpush GROUP BY 1, 2) a
               ON s.date_key = a.date_key AND s.repo_key = a.repo_key
        LEFT JOIN (SELECT date_key, repo_key, {_SUM_OPENED} AS total_prs_opened,
                          {_SUM_MERGED} AS total_prs_merged,
                          {mean2('time_to_merge_hours')} AS avg_pr_merge_hours
                   FROM fpr GROUP BY 1, 2) b
               ON s.date_key = b.date_key AND s.repo_key = b.repo_key
        LEFT JOIN (SELECT date_key, repo_key, {_SUM_OPENED} AS total_issues_opened,
                          {_SUM_CLOSED} AS total_issues_closed,
                          {mean2('time_to_close_hours')} AS avg_issue_close_hours
                   FROM fissue GROUP BY 1, 2) c
               ON s.date_key = c.date_key AND s.repo_key = c.repo_key
        LEFT JOIN (SELECT date_key, repo_key, COUNT(event_id) AS total_stars
                   FROM keyed WHERE type = 'WatchEvent' GROUP BY 1, 2) d
               ON s.date_key = d.date_key AND s.repo_key = d.repo_key
        LEFT JOIN (SELECT date_key, repo_key, COUNT(event_id) AS total_forks
                   FROM keyed WHERE type = 'ForkEvent' GROUP BY 1, 2) e
               ON s.date_key = e.date_key AND s.repo_key = e.repo_key
        LEFT JOIN (SELECT date_key, repo_key, COUNT(event_id) AS total_releases
                   FROM keyed WHERE type = 'ReleaseEvent' GROUP BY 1, 2) f
               ON s.date_key = f.date_key AND s.repo_key = f.repo_key""",
    "langbase": f"""
        SELECT language_key, year,
               {big('coalesce(total_push_events, 0)')} AS total_push_events,
               {big('coalesce(total_commits, 0)')} AS total_commits,
               {big('coalesce(total_pr_events, 0)')} AS total_pr_events,
               {big('coalesce(total_prs_merged, 0)')} AS total_prs_merged,
               avg_pr_merge_hours,
               {big('coalesce(total_issue_events, 0)')} AS total_issue_events,
               {big('coalesce(total_issues_opened, 0)')} AS total_issues_opened,
               {big('coalesce(total_issues_closed, 0)')} AS total_issues_closed,
               {big('coalesce(total_stars, 0)')} AS total_stars,
               {big('coalesce(total_forks, 0)')} AS total_forks,
               {big('coalesce(unique_repos, 0)')} AS unique_repos,
               {big('coalesce(unique_contributors, 0)')} AS unique_contributors
        FROM (SELECT language_key, year, COUNT(event_id) AS total_push_events,
                     SUM(commit_count) AS total_commits,
                     COUNT(DISTINCT repo_key) AS unique_repos,
                     COUNT(DISTINCT contributor_key) AS unique_contributors
              FROM fpush GROUP BY 1, 2)
        FULL JOIN (SELECT language_key, year, COUNT(event_id) AS total_pr_events,
                          {_SUM_MERGED} AS total_prs_merged,
                          {mean2('time_to_merge_hours')} AS avg_pr_merge_hours
                   FROM fpr GROUP BY 1, 2) USING (language_key, year)
        FULL JOIN (SELECT language_key, year, COUNT(event_id) AS total_issue_events,
                          {_SUM_OPENED} AS total_issues_opened,
                          {_SUM_CLOSED} AS total_issues_closed
                   FROM fissue GROUP BY 1, 2) USING (language_key, year)
        FULL JOIN (SELECT language_key, year, COUNT(event_id) AS total_stars
                   FROM keyed WHERE type = 'WatchEvent' GROUP BY 1, 2)
             USING (language_key, year)
        FULL JOIN (SELECT language_key, year, COUNT(event_id) AS total_forks
                   FROM keyed WHERE type = 'ForkEvent' GROUP BY 1, 2)
             USING (language_key, year)""",
    "langyear": f"""
        SELECT *,
               {rnd('''(CAST(total_push_events AS DOUBLE) / NULLIF(CAST(lag(total_push_events)
                   OVER (PARTITION BY language_key ORDER BY year) AS DOUBLE), 0) - 1) * 100''', 2)}
                   AS yoy_push_growth_pct,
               {rnd('''CAST(total_push_events AS DOUBLE) / NULLIF(CAST(SUM(total_push_events)
                   OVER (PARTITION BY year) AS DOUBLE), 0) * 100''', 3)}
                   AS market_share_pct
        FROM langbase""",
    "scores": """
        SELECT repo_key, model_version, abandonment_probability,
               CASE WHEN abandonment_probability >= 0.70 THEN 'High Risk'
                    WHEN abandonment_probability >= 0.40 THEN 'Moderate Risk'
                    WHEN repo_age_days < 730 THEN 'Too Young' ELSE 'Low Risk' END AS risk_tier,
               created_year, TIMESTAMP '2001-12-31 06:00:00' AS scored_at, is_archived,
               CASE WHEN m >= 1.5 THEN 'Accelerating' WHEN m >= 0.5 THEN 'Stable'
                    WHEN m >= 0.1 THEN 'Declining' ELSE 'Stalled' END AS trajectory_label
        FROM (SELECT d.*, v.model_version,
                     ((repo_key * v.f) % 1000) / 1000.0::DOUBLE AS abandonment_probability,
                     ((repo_key * 13) % 200) / 100.0::DOUBLE AS m
              FROM drepo d CROSS JOIN (VALUES ('200111', 37), ('200112', 41)) v(model_version, f))
        """,
    "newest": """
        SELECT * FROM scores WHERE model_version = (SELECT MAX(model_version) FROM scores)""",
    "labelled": """
        SELECT * FROM (
            SELECT d.repo_key, d.language, d.license, d.is_ai_ml_repo, d.has_readme, d.has_ci,
                   d.created_year, d.repo_age_days,
                   CAST(d.created_at AS DATE) AS repo_created_date,
                   CAST(CASE WHEN d.is_archived THEN 1
                        WHEN d.repo_age_days >= 730 AND a.last_year < 1999 THEN 1
                        WHEN d.repo_age_days < 730 THEN NULL ELSE 0 END AS INTEGER) AS label
            FROM drepo d
            LEFT JOIN (SELECT repo_key, MAX(year) AS last_year FROM activity GROUP BY 1) a
                   ON d.repo_key = a.repo_key
            WHERE d.created_at IS NOT NULL AND d.repo_age_days IS NOT NULL)
        WHERE label IS NOT NULL""",
    "born": "SELECT *, CAST(created_at AS DATE) AS repo_created_date FROM drepo",
    "early": f"""
        SELECT a.repo_key,
               {big('SUM(total_commits)')} AS early_commits,
               {big('SUM(total_pushes)')} AS early_pushes,
               {big('SUM(total_stars)')} AS early_stars,
               {big('SUM(total_forks)')} AS early_forks,
               {big('SUM(total_prs_opened)')} AS early_prs_opened,
               {big('SUM(total_prs_merged)')} AS early_prs_merged,
               {big('SUM(total_issues_opened)')} AS early_issues,
               {mean_int('unique_contributors')} AS avg_daily_contributors,
               COUNT(date_key) AS active_days_in_90
        FROM activity a JOIN born b ON a.repo_key = b.repo_key
        WHERE {_EARLY} GROUP BY a.repo_key""",
    "pushday": """
        SELECT f.*, CAST(strptime(CAST(date_key // 100 AS VARCHAR), '%Y%m%d') AS DATE)
                   AS obs_date, b.repo_created_date
        FROM fpush f JOIN born b ON f.repo_key = b.repo_key""",
    "featpush": f"""
        SELECT repo_key, COUNT(DISTINCT branch_ref) AS unique_branches,
               {mean_int('is_default_branch')} AS default_branch_push_ratio
        FROM pushday WHERE {_EARLY} GROUP BY repo_key""",
    "featpr": f"""
        SELECT f.repo_key, {mean_int('additions')} AS avg_pr_additions,
               {mean_int('review_comments')} AS avg_review_comments,
               {big('SUM(CAST(is_merged AS INTEGER))')} AS early_merged_prs
        FROM (SELECT *, CAST(strptime(CAST(date_key // 100 AS VARCHAR), '%Y%m%d') AS DATE)
                     AS obs_date FROM fpr) f
        JOIN born b ON f.repo_key = b.repo_key WHERE {_EARLY} GROUP BY f.repo_key""",
    "featcontrib": f"""
        SELECT repo_key, COUNT(DISTINCT p.contributor_key) AS total_unique_contributors
        FROM pushday p LEFT JOIN dcontrib c ON p.contributor_key = c.contributor_key
        WHERE {_EARLY} AND c.is_bot = false GROUP BY repo_key""",
    "featera": f"""
        SELECT repo_key, avg_commits_early, avg_commits_recent,
               coalesce(avg_commits_recent, 0.0) / (coalesce(avg_commits_early, 0.0) + 1.0)
                   AS commit_momentum
        FROM (SELECT repo_key, {mean_int('total_commits')} AS avg_commits_early
              FROM activity WHERE year <= 1998 AND repo_key IS NOT NULL GROUP BY 1)
        FULL JOIN (SELECT repo_key, {mean_int('total_commits')} AS avg_commits_recent
              FROM activity WHERE year > 1998 AND repo_key IS NOT NULL GROUP BY 1)
             USING (repo_key)""",
    "featlife": """
        SELECT repo_key, COUNT(DISTINCT date_key) AS total_active_days,
               COUNT(DISTINCT year) AS years_observed
        FROM activity WHERE repo_key IS NOT NULL GROUP BY 1""",
    "feat": """
        SELECT l.* EXCLUDE (repo_created_date), e.* EXCLUDE (repo_key),
               p.* EXCLUDE (repo_key), r.* EXCLUDE (repo_key), c.total_unique_contributors,
               t.* EXCLUDE (repo_key), f.* EXCLUDE (repo_key),
               CAST(coalesce(early_merged_prs, 0) AS DOUBLE)
                   / (coalesce(early_prs_opened, 0) + 1) AS pr_merge_rate,
               CAST(coalesce(early_forks, 0) AS DOUBLE)
                   / (coalesce(early_stars, 0) + 1) AS fork_to_star_ratio,
               CAST(coalesce(early_commits, 0) AS DOUBLE)
                   / (coalesce(active_days_in_90, 0) + 1) AS commits_per_active_day
        FROM labelled l
        LEFT JOIN early e ON l.repo_key = e.repo_key
        LEFT JOIN featpush p ON l.repo_key = p.repo_key
        LEFT JOIN featpr r ON l.repo_key = r.repo_key
        LEFT JOIN featcontrib c ON l.repo_key = c.repo_key
        LEFT JOIN featera t ON l.repo_key = t.repo_key
        LEFT JOIN featlife f ON l.repo_key = f.repo_key""",
    "pivoted": """
        SELECT repo_key,
               """
    + ",\n               ".join(
        f'CAST(coalesce(SUM(CASE WHEN year = {y} THEN total_commits END), 0) AS BIGINT) AS "{y}"'
        for y in range(1995, 2002)
    )
    + """,
               COUNT(DISTINCT year) AS years_observed
        FROM activity WHERE repo_key IS NOT NULL GROUP BY repo_key
        HAVING COUNT(DISTINCT year) >= 2""",
    "growth": """
        SELECT *, avg_commits_recent / (avg_commits_early + 1.0) AS growth_ratio
        FROM (SELECT *,
                     CAST("1995" + "1996" + "1997" AS DOUBLE) / 3.0 AS avg_commits_early,
                     CAST("1998" + "1999" + "2000" + "2001" AS DOUBLE) / 4.0
                         AS avg_commits_recent
              FROM pivoted)""",
    "named": f"""
        SELECT cluster_id,
               CASE row_number() OVER (ORDER BY m DESC, cluster_id)
                    WHEN 1 THEN 'Viral' WHEN 2 THEN 'Established' WHEN 3 THEN 'Stable'
                    WHEN 4 THEN 'Declining' WHEN 5 THEN 'Dormant' WHEN 6 THEN 'Inactive' END
                   AS trajectory_label
        FROM (SELECT CAST(repo_key % 6 AS INTEGER) AS cluster_id,
                     {mean_fixed('growth_ratio')} AS m
              FROM growth GROUP BY 1)""",
    "traj": f"""
        SELECT g.repo_key, n.cluster_id, n.trajectory_label,
               {rnd('growth_ratio', 3)} AS growth_ratio,
               {rnd('avg_commits_early', 1)} AS avg_commits_early,
               {rnd('avg_commits_recent', 1)} AS avg_commits_recent,
               years_observed, TIMESTAMP '2001-12-31 00:00:00' AS computed_at
        FROM growth g JOIN named n ON g.repo_key % 6 = n.cluster_id""",
    "trend": f"""
        SELECT t.language_key, {rnd('slope', 4)} AS slope_pct_per_year,
               {rnd('r2', 4)} AS r_squared,
               {rnd(f"greatest(0.0, {rnd('base + slope * 2002', 10)})", 4)} AS forecast_2002_share,
               {rnd(f"greatest(0.0, {rnd('base + slope * 2003', 10)})", 4)} AS forecast_2003_share,
               CASE WHEN slope > 0.5 THEN 'Strongly Growing' WHEN slope > 0.1 THEN 'Growing'
                    WHEN slope > -0.1 THEN 'Stable' WHEN slope > -0.5 THEN 'Declining'
                    ELSE 'Strongly Declining' END AS trend_label,
               l.language_name, TIMESTAMP '2001-12-31 00:00:00' AS computed_at
        FROM (SELECT language_key, {rnd('regr_slope(market_share_pct, year)', 10)} AS slope,
                     avg(market_share_pct) - regr_slope(market_share_pct, year) * avg(year)
                         AS base,
                     {rnd('regr_r2(market_share_pct, year)', 10)} AS r2
              FROM langyear GROUP BY language_key
              HAVING COUNT(*) >= 3 AND MIN(market_share_pct) < MAX(market_share_pct)) t
        LEFT JOIN dlang l ON t.language_key = l.language_key""",
}


def sql(body: str) -> str:
    """Prefix a statement with the blocks it needs, directly or through other blocks."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in BLOCKS:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN)\s+{name}\b", text):
                needed.add(name)
                visit(BLOCKS[name])

    visit(body)
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in BLOCKS if name in needed)
    if body.lstrip().upper().startswith("WITH"):
        body = f"SELECT * FROM ({body})"
    return f"WITH {ctes}\n{body}" if ctes else body
