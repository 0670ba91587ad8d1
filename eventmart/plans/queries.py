"""Registered queries: one per operator, over the test tables, with its SQL counterpart."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventmart import schemas as S
from eventmart.functions import vocab as V
from eventmart.operators import (
    activity,
    conform,
    dims,
    enrich,
    facts,
    features,
    merge,
    model,
    quality,
    risk,
    trajectory,
    trends,
    views,
)
from eventmart.operators.evaluation import evaluate
from eventmart.plans import fixtures as X
from eventmart.plans import oracle as O
from eventmart.session import configure, drop_work, durable, work_path
from eventmart.sources.buckets import write_bucketed
from eventmart.sources.events import (
    CORRUPT,
    read_events,
    read_shards,
    slim_events,
    stage_by_type,
    write_events,
)
from eventmart.sources.snapshots import Table, mirror
from eventmart.streaming import activity as streaming
from eventmart.streaming.ingest import event_stream, ingest, reject

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; `sql` is the statement over the oracle blocks."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLE[name] = O.sql(sql)
        return build

    return register


# ---- shared inputs -----------------------------------------------------------------------


def _stream(spark, d):
    return facts.stream_from_keyed(X.keyed(spark, d))


def _activity(spark, d):
    return activity.repo_activity(_stream(spark, d))


def _staged(spark, d):
    keyed = X.keyed(spark, d).withColumns({"pr_id": F.col("object_id"), "review_comments": F.col("remarks")})
    return facts.stage_keyed(keyed)


def _yearly(spark, d):
    return activity.language_yearly(activity.language_yearly_base(_stream(spark, d)))


def _fact_push(spark, d):
    return facts.fact_push(X.keyed(spark, d, S.PUSH), unique=True)


def _fact_pr(spark, d):
    return facts.fact_pr(X.keyed(spark, d, S.PULL_REQUEST), unique=True)


def _born(spark, d):
    return X.dim_repository(spark, d).withColumn("repo_created_date", F.to_date("created_at"))


def _labelled(spark, d, hourly=None):
    if hourly is None:
        hourly = _activity(spark, d)
    return risk.labelled_repositories(X.dim_repository(spark, d), hourly, X.AS_OF_YEAR)


# ---- filters, projections, dedup ---------------------------------------------------------

_FLAT_COLUMNS = "event_id, type, created_at, year, actor_id, actor_login, repo_id, repo_name"


@query(
    "event_type_filter",
    f"SELECT {_FLAT_COLUMNS} FROM ev0 WHERE type IN ('PushEvent', 'ReleaseEvent')",
)
def event_type_filter(spark, d):
    kept = conform.of_types(X.all_events(spark, d), [S.PUSH, S.RELEASE])
    return kept.select(*_FLAT_COLUMNS.split(", "))


# A line without actor, repository or with a date out of range is made by nulling columns.
_BROKEN = """
    SELECT CASE WHEN l_linenumber <> 6 OR actor_id % 5 <> 1 THEN event_id END AS event_id,
           type, created_at, year,
           CASE WHEN l_linenumber <> 2 OR actor_id % 5 <> 0 THEN actor_id END AS actor_id,
           actor_login,
           CASE WHEN l_linenumber <> 4 OR repo_id % 7 <> 0 THEN repo_id END AS repo_id,
           repo_name FROM ev0"""


def _broken(spark, d) -> DataFrame:
    """Envelope in which some events lack their id, actor or repository."""
    events = X.all_events(spark, d)
    line = F.col("l_linenumber")
    return X.envelope(
        events.withColumns(
            {
                "event_id": F.when((line != 6) | (F.col("actor_id") % 5 != 1), F.col("event_id")),
                "actor_id": F.when((line != 2) | (F.col("actor_id") % 5 != 0), F.col("actor_id")),
                "repo_id": F.when((line != 4) | (F.col("repo_id") % 7 != 0), F.col("repo_id")),
            }
        )
    )


@query(
    "valid_events",
    f"""SELECT event_id AS id, type, created_at, actor_id, repo_id FROM ({_BROKEN})
        WHERE event_id IS NOT NULL AND actor_id IS NOT NULL AND repo_id IS NOT NULL
          AND created_at >= TIMESTAMP '1996-01-01' AND created_at < TIMESTAMP '2000-07-01'""",
)
def valid_events(spark, d):
    valid = conform.valid_events(_broken(spark, d), "1996-01-01", "2000-06-30")
    return valid.select(
        "id",
        "type",
        "created_at",
        F.col("actor.id").alias("actor_id"),
        F.col("repo.id").alias("repo_id"),
    )


@query(
    "rejected_events",
    f"""SELECT reason, event_id AS id, type, created_at FROM (
            SELECT *, CASE WHEN event_id IS NULL THEN 'missing_id'
                           WHEN actor_id IS NULL THEN 'missing_actor'
                           WHEN repo_id IS NULL THEN 'missing_repo'
                           WHEN created_at < TIMESTAMP '1996-01-01' THEN 'too_early'
                           WHEN created_at >= TIMESTAMP '2000-07-01' THEN 'in_future' END AS reason
            FROM ({_BROKEN})) WHERE reason IS NOT NULL""",
)
def rejected_events(spark, d):
    """Quarantined rows of an envelope with invalid events, and why each was rejected."""
    raw = _broken(spark, d).withColumns(
        {name: F.lit(None).cast("string") for name in (CORRUPT, "source_file")}
    )
    rejected = reject(raw, "1996-01-01", "2000-06-30")
    return rejected.select("reason", "id", "type", "created_at")


@query("flatten_envelope", f"SELECT {_FLAT_COLUMNS} FROM ({_BROKEN})")
def flatten_envelope(spark, d):
    return conform.flatten(_broken(spark, d)).drop("payload", "source_file")


@query(
    "dedup_events",
    f"""SELECT {_FLAT_COLUMNS}, commit_count, branch_ref, action, is_merged, deletions,
               opened_at, ended_at FROM ev""",
)
def dedup_events(spark, d):
    columns = f"{_FLAT_COLUMNS}, commit_count, branch_ref, action, is_merged, deletions"
    return X.unique_events(spark, d).select(*columns.split(", "), "opened_at", "ended_at")


_SILVER = (
    "event_id, repo_id, repo_name, actor_id, actor_login, created_at, year, {} "
    "strftime(created_at, '%Y/%Y-%m-%d-') || hour(created_at) || '.json.gz' AS source_file"
)


def _silver_sql(kind: str, columns: str = "", where: str = "") -> str:
    return f"SELECT {_SILVER.format(columns)} FROM ev WHERE type = '{kind}'{where}"


@query("silver_push", _silver_sql(S.PUSH, "commit_count, branch_ref,"))
def silver_push(spark, d):
    return conform.push_events(X.flat_events(spark, d, S.PUSH))


@query(
    "silver_pr",
    _silver_sql(
        S.PULL_REQUEST,
        """action, object_id AS pr_id, title, state, is_merged, additions, deletions,
        changed_files, remarks AS review_comments, opened_at AS pr_created_at,
        ended_at AS merged_at, ended_at AS closed_at,""",
    ),
)
def silver_pr(spark, d):
    return conform.pr_events(X.flat_events(spark, d, S.PULL_REQUEST))


@query(
    "silver_issues",
    _silver_sql(
        S.ISSUES,
        """action, object_id AS issue_id, title, state, remarks AS comments_count,
        label_list, opened_at AS issue_created_at, ended_at AS closed_at,""",
    ),
)
def silver_issues(spark, d):
    return conform.issues_events(X.flat_events(spark, d, S.ISSUES))


@query("silver_watch", _silver_sql(S.WATCH, where=" AND watch_action = 'started'"))
def silver_watch(spark, d):
    return conform.watch_events(X.flat_events(spark, d, S.WATCH))


@query(
    "silver_fork",
    _silver_sql(S.FORK, "l_orderkey AS fork_id, 'fork/' || repo_id AS fork_name,"),
)
def silver_fork(spark, d):
    return conform.fork_events(X.flat_events(spark, d, S.FORK))


@query(
    "silver_create",
    _silver_sql(S.FORK, "branch_ref AS ref_type, title AS description,"),
)
def silver_create(spark, d):
    """The test events have no create type; the fork lines are re-labelled for it."""
    payload = "to_json(struct(branch_ref AS ref_type, title AS description))"
    forks = X.flat_events(spark, d, S.FORK, payload)
    return conform.create_events(forks.withColumn("type", F.lit(S.CREATE)))


@query(
    "silver_release",
    _silver_sql(
        S.RELEASE,
        """'published' AS action, object_id AS release_id, tag_name,
        'Release ' || tag_name AS release_name, is_prerelease, false AS is_draft,
        opened_at AS release_created_at, ended_at AS published_at,""",
    ),
)
def silver_release(spark, d):
    return conform.release_events(X.flat_events(spark, d, S.RELEASE))


_TABLE_OF = "CASE type " + " ".join(
    f"WHEN '{kind}' THEN '{table}'" for kind, table in S.EVENT_TABLES.items()
) + " END"


@query(
    "route_events",
    f"""SELECT {_TABLE_OF} AS table_name, year, COUNT(*) AS n_rows,
               MIN(event_id) AS first_id, MAX(event_id) AS last_id
        FROM conf GROUP BY 1, 2""",
)
def route_events(spark, d):
    """Rows per table and year after routing one envelope to all typed tables."""
    staged = stage_by_type(X.flat_events(spark, d), work_path(spark, "events"))
    parts = [
        frame.select(F.lit(name).alias("table_name"), "year", "event_id")
        for name, frame in conform.route(staged).items()
    ]
    routed = parts[0]
    for part in parts[1:]:
        routed = routed.unionAll(part)
    return routed.groupBy("table_name", "year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


@query(
    "dq_audit",
    f"""SELECT k.event_type, coalesce(r.n, 0) AS raw_count, coalesce(a.n, 0) AS accepted_count,
               'full_refresh' AS run_mode, TIMESTAMP '2001-12-31' AS audited_at
        FROM (VALUES {', '.join(f"('{t}')" for t in S.EVENT_TYPES)}) k(event_type)
        LEFT JOIN (SELECT type, COUNT(*) AS n FROM ev GROUP BY 1) r ON k.event_type = r.type
        LEFT JOIN (SELECT type, COUNT(*) AS n FROM conf GROUP BY 1) a
               ON k.event_type = a.type""",
)
def dq_audit(spark, d):
    staged = stage_by_type(X.flat_events(spark, d), work_path(spark, "events"))
    accepted = {kind: project(staged) for kind, project in conform.PROJECTORS.items()}
    return quality.dq_audit(staged, quality.tagged(accepted), "full_refresh", X.AS_OF)


@query(
    "event_profile",
    f"""SELECT source_file,
               CAST(regexp_extract(source_file, '(\\d{{4}})-\\d{{2}}-\\d{{2}}', 1) AS SMALLINT)
                   AS batch_year,
               type, event_count, {O.pct('event_count', 'SUM(event_count) OVER w', 1)}
                   AS pct_of_file,
               distinct_repos
        FROM (SELECT source_file, type, COUNT(*) AS event_count FROM src GROUP BY 1, 2)
        JOIN (SELECT source_file, COUNT(DISTINCT repo_name) AS distinct_repos
              FROM src GROUP BY 1) USING (source_file)
        WINDOW w AS (PARTITION BY source_file)""".replace(
        "src",
        "(SELECT *, strftime(created_at, '%Y/%Y-%m-%d-') || hour(created_at) || '.json.gz'"
        " AS source_file FROM ev)",
    ),
)
def event_profile(spark, d):
    return quality.event_profile(X.flat_events(spark, d))


# ---- ranking, enrichment, contributors ---------------------------------------------------

_YEAR = 1998
_COUNTS = "SELECT repo_id, COUNT(event_id) AS n FROM conf WHERE year = 1998 GROUP BY 1"
_NAMES = """SELECT repo_id, arg_max(repo_name, (created_at, repo_name)) AS repo_name
            FROM conf {} GROUP BY 1"""
_TOP = f"""
    SELECT row_number() OVER (ORDER BY c.n DESC, c.repo_id) AS rank, c.repo_id, m.repo_name, c.n
    FROM ({_COUNTS}) c JOIN ({_NAMES.format('WHERE year = 1998')}) m USING (repo_id)
    QUALIFY rank <= greatest(1,
        CAST(floor((SELECT COUNT(*) FROM ({_COUNTS})) * 40 / 100.0) AS BIGINT))"""


@query("repo_event_counts", _COUNTS)
def repo_event_counts(spark, d):
    return enrich.repo_event_counts(X.conformed(spark, d), _YEAR)


@query("repo_names", _NAMES.format(""))
def repo_names(spark, d):
    return enrich.repo_names(X.conformed(spark, d))


def _top(spark, d):
    return enrich.top_repos(X.conformed(spark, d), _YEAR, X.TOP_PERCENT)


@query("top_repos", _TOP)
def top_repos(spark, d):
    return _top(spark, d)


@query(
    "top_repos_all",
    f"""SELECT row_number() OVER (ORDER BY c.n DESC, c.repo_id) AS rank, c.repo_id, m.repo_name, c.n
        FROM (SELECT repo_id, COUNT(event_id) AS n FROM conf GROUP BY 1) c
        JOIN ({_NAMES.format('')}) m USING (repo_id) QUALIFY rank <= 100""",
)
def top_repos_all(spark, d):
    """The hundred busiest repositories over all years."""
    return enrich.top_repos(X.conformed(spark, d), top_n=100)


@query("repos_to_fetch", f"SELECT * FROM ({_TOP}) WHERE repo_id NOT IN (SELECT repo_id FROM repos)")
def repos_to_fetch(spark, d):
    return enrich.repos_to_fetch(_top(spark, d), X.repositories(spark, d))


@query(
    "shard_worklist",
    f"""SELECT *, CAST((row_number() OVER (ORDER BY rank) - 1) % 4 AS INTEGER) AS shard
        FROM (SELECT * FROM ({_TOP}) WHERE repo_id NOT IN (SELECT repo_id FROM repos))""",
)
def shard_worklist(spark, d):
    return enrich.shard_worklist(repos_to_fetch(spark, d), 4)


@query(
    "contributors",
    """SELECT actor_id, arg_max(actor_login, (created_at, actor_login))
                  FILTER (WHERE actor_login IS NOT NULL) AS login, 'User' AS account_type
       FROM conf GROUP BY actor_id""",
)
def contributors(spark, d):
    return enrich.contributors(X.conformed(spark, d))


# ---- merges --------------------------------------------------------------------------------
# The target holds the orders up to 1999 with their original price; the batch brings those
# from 1999 on, with another price and one more column.

_MERGE_COLUMNS = "o_orderkey, CAST(year(o_orderdate) AS SMALLINT) AS year"
_TARGET = f"SELECT {_MERGE_COLUMNS}, o_totalprice AS price FROM orders WHERE year(o_orderdate) <= 1999"
_BATCH = f"""SELECT {_MERGE_COLUMNS}, o_totalprice + 1 AS price, o_orderstatus AS status
             FROM orders WHERE year(o_orderdate) >= 1999"""


def _merge_sides(spark, d):
    orders = X.table(spark, d, "orders").select(
        "o_orderkey",
        F.year("o_orderdate").cast("smallint").alias("year"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderstatus").alias("status"),
    )
    target = orders.filter(F.col("year") <= 1999).drop("status")
    batch = orders.filter(F.col("year") >= 1999).withColumn("price", F.col("price") + 1)
    return target, batch


@query(
    "merge_insert_only",
    f"""SELECT *, CAST(NULL AS VARCHAR) AS status FROM ({_TARGET}) UNION ALL
        SELECT * FROM ({_BATCH}) b
        WHERE NOT EXISTS (SELECT 1 FROM ({_TARGET}) t WHERE t.o_orderkey = b.o_orderkey)""",
)
def merge_insert_only(spark, d):
    target, batch = _merge_sides(spark, d)
    return merge.insert_only(target, batch, ["o_orderkey"])


@query(
    "merge_upsert",
    f"""SELECT * FROM ({_BATCH}) UNION ALL
        SELECT *, CAST(NULL AS VARCHAR) AS status FROM ({_TARGET}) t
        WHERE NOT EXISTS (SELECT 1 FROM ({_BATCH}) b
                          WHERE b.o_orderkey = t.o_orderkey AND b.year = t.year)""",
)
def merge_upsert(spark, d):
    target, batch = _merge_sides(spark, d)
    return merge.upsert(target, batch, ["o_orderkey", "year"])


# ---- dimensions and facts ------------------------------------------------------------------


@query("dim_date", "SELECT * FROM ddate")
def dim_date(spark, d):
    return X.dim_date(spark, d)


@query("dim_repository", "SELECT * FROM drepo")
def dim_repository(spark, d):
    return X.dim_repository(spark, d)


@query("dim_contributor", "SELECT * FROM dcontrib")
def dim_contributor(spark, d):
    return X.dim_contributor(spark, d)


@query("dim_language", "SELECT * FROM dlang")
def dim_language(spark, d):
    return X.dim_language(spark, d)


@query(
    "attach_keys",
    """SELECT event_id, type, created_at, date_key, repo_id, repo_key, actor_id,
              contributor_key, language_key FROM keyed""",
)
def attach_keys(spark, d):
    return X.keyed(spark, d).select(
        "event_id",
        "type",
        "created_at",
        "date_key",
        "repo_id",
        "repo_key",
        "actor_id",
        "contributor_key",
        "language_key",
    )


@query(
    "attach_keys_bucketed",
    """SELECT event_id, type, created_at, date_key, repo_id, repo_key, actor_id,
              contributor_key, language_key FROM keyed""",
)
def attach_keys_bucketed(spark, d):
    """Events and the repository lookup bucketed alike: the key join reads both in place."""
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    repositories, languages = X.dim_repository(spark, d), X.dim_language(spark, d)
    names = ("event_id", "type", "created_at", "repo_id", "actor_id")
    events = write_bucketed(X.conformed(spark, d).select(*names), ["repo_id"], buckets, "events")
    lookup = write_bucketed(dims.repo_lookup(repositories, languages), ["repo_id"], buckets, "lookup")
    return dims.attach_keys(events, repositories, X.dim_contributor(spark, d), languages, lookup=lookup)


@query("fact_push", "SELECT * FROM fpush")
def fact_push(spark, d):
    return _fact_push(spark, d)


@query("fact_pr", "SELECT * FROM fpr")
def fact_pr(spark, d):
    return _fact_pr(spark, d)


@query("fact_issues", "SELECT * FROM fissue")
def fact_issues(spark, d):
    return facts.fact_issues(X.keyed(spark, d, S.ISSUES), unique=True)


@query(
    "fact_release",
    """SELECT event_id, date_key, repo_key, contributor_key, language_key, year, action,
              object_id AS release_id, tag_name, 'Release ' || tag_name AS release_name,
              is_prerelease, false AS is_draft, opened_at AS release_created_at,
              ended_at AS published_at
       FROM keyed WHERE type = 'ReleaseEvent'""",
)
def fact_release(spark, d):
    return facts.fact_release(X.keyed(spark, d, S.RELEASE), unique=True)


@query("activity_spine", "SELECT * FROM spine")
def activity_spine(spark, d):
    return activity.activity_spine(_stream(spark, d))


@query("repo_activity", "SELECT * FROM activity")
def repo_activity(spark, d):
    return _activity(spark, d)


@query("language_yearly_base", "SELECT * FROM langbase")
def language_yearly_base(spark, d):
    return activity.language_yearly_base(_stream(spark, d))


@query("language_yearly", "SELECT * FROM langyear")
def language_yearly(spark, d):
    return _yearly(spark, d)


# ---- analysis views --------------------------------------------------------------------------


@query(
    "vw_language_evolution",
    """SELECT l.language_name, f.year, total_push_events, total_commits, unique_repos,
              unique_contributors, market_share_pct, yoy_push_growth_pct
       FROM langyear f JOIN dlang l ON f.language_key = l.language_key
       WHERE l.language_name <> 'Unknown' AND f.year BETWEEN 1995 AND 2001""",
)
def vw_language_evolution(spark, d):
    return views.language_evolution(_yearly(spark, d), X.dim_language(spark, d), (1995, 2001))


_ACT_DATE = "FROM activity f JOIN ddate d ON f.date_key = d.date_key"


@query(
    "vw_ai_boom",
    f"""SELECT *, {O.pct('total_pushes', 'SUM(total_pushes) OVER (PARTITION BY year)', 2)}
                  AS ai_activity_share_pct
        FROM (SELECT d.year, r.is_ai_ml_repo, COUNT(DISTINCT f.repo_key) AS unique_repos,
                     {O.big('SUM(total_pushes)')} AS total_pushes,
                     {O.big('SUM(total_stars)')} AS total_stars,
                     {O.big('SUM(total_forks)')} AS total_forks,
                     {O.big('SUM(total_prs_opened)')} AS total_prs
              {_ACT_DATE} JOIN drepo r ON f.repo_key = r.repo_key
              GROUP BY d.year, r.is_ai_ml_repo)""",
)
def vw_ai_boom(spark, d):
    return views.ai_boom(_activity(spark, d), X.dim_date(spark, d), X.dim_repository(spark, d))


@query(
    "vw_covid_impact",
    f"""SELECT d.year, d.hour, d.is_covid_period, d.is_weekend,
               {O.big('SUM(total_pushes)')} AS total_pushes,
               {O.big('SUM(total_prs_opened)')} AS total_prs,
               {O.big('SUM(total_issues_opened)')} AS total_issues,
               COUNT(DISTINCT f.repo_key) AS unique_repos
        {_ACT_DATE} WHERE d.year IN (1997, 1998, 1999)
        GROUP BY d.year, d.hour, d.is_covid_period, d.is_weekend""",
)
def vw_covid_impact(spark, d):
    return views.covid_impact(_activity(spark, d), X.dim_date(spark, d), X.PERIOD_YEARS)


@query(
    "vw_repo_health",
    f"""SELECT r.repo_name, r.language, r.is_ai_ml_repo, avg_pr_merge_hrs, avg_issue_close_hrs,
               total_stars, total_forks, merge_rate,
               {O.rnd('''least(100.0, greatest(0.0,
                   25 * (1 - least(1.0, coalesce(avg_pr_merge_hrs, 168) / 168.0::DOUBLE)) +
                   25 * (1 - least(1.0, coalesce(avg_issue_close_hrs, 720) / 720.0::DOUBLE)) +
                   25 * coalesce(merge_rate, 0) +
                   25 * least(1.0, ln(1 + total_stars + total_forks) / 15.0::DOUBLE)))''', 2)}
                   AS health_score
        FROM (SELECT repo_key, {O.mean_fixed('avg_pr_merge_hours')} AS avg_pr_merge_hrs,
                     {O.mean_fixed('avg_issue_close_hours')} AS avg_issue_close_hrs,
                     {O.big('SUM(total_stars)')} AS total_stars,
                     {O.big('SUM(total_forks)')} AS total_forks,
                     CAST(SUM(total_prs_merged) AS DOUBLE)
                         / NULLIF(SUM(total_prs_opened), 0) AS merge_rate
              FROM activity GROUP BY repo_key) m
        JOIN drepo r ON m.repo_key = r.repo_key""",
)
def vw_repo_health(spark, d):
    return views.repo_health(_activity(spark, d), X.dim_repository(spark, d))


@query(
    "vw_pr_lifecycle",
    f"""SELECT d.year, l.language_name, f.pr_size_bucket,
               COUNT(f.event_id) AS total_pr_events,
               {O.big('SUM(CAST(f.is_merged AS INTEGER))')} AS merged_count,
               {O.pct('SUM(CAST(f.is_merged AS INTEGER))', 'COUNT(f.event_id)', 2)}
                   AS merge_rate_pct,
               {O.rnd(O.mean2('f.time_to_merge_hours'), 1)} AS avg_merge_hrs,
               {O.rnd(O.mean_int('f.review_comments'), 2)} AS avg_review_comments,
               {O.rnd(O.mean_int('(f.additions + f.deletions)'), 0)} AS avg_lines_changed
        FROM fpr f JOIN ddate d ON f.date_key = d.date_key
        JOIN dlang l ON f.language_key = l.language_key
        WHERE f.action = 'closed' GROUP BY d.year, l.language_name, f.pr_size_bucket""",
)
def vw_pr_lifecycle(spark, d):
    return views.pr_lifecycle(_fact_pr(spark, d), X.dim_date(spark, d), X.dim_language(spark, d))


@query(
    "vw_bus_factor",
    f"""WITH ranked AS (
            SELECT repo_key, contributor_key, COUNT(event_id) AS push_count,
                   RANK() OVER (PARTITION BY repo_key ORDER BY COUNT(event_id) DESC) AS rnk,
                   SUM(COUNT(event_id)) OVER (PARTITION BY repo_key) AS repo_total
            FROM fpush GROUP BY repo_key, contributor_key)
        SELECT r.repo_name, r.language,
               COUNT(DISTINCT k.contributor_key) AS total_contributors,
               {', '.join(
                   O.pct(f'SUM(CASE WHEN rnk <= {n} THEN push_count ELSE 0 END)',
                         'MAX(repo_total)', 2) + f' AS top{n}_pct' for n in (1, 3, 5))}
        FROM ranked k JOIN drepo r ON k.repo_key = r.repo_key
        GROUP BY r.repo_name, r.language HAVING COUNT(DISTINCT k.contributor_key) >= 3""",
)
def vw_bus_factor(spark, d):
    return views.bus_factor(_fact_push(spark, d), X.dim_repository(spark, d))


@query(
    "vw_ecosystem_growth",
    f"""SELECT d.year, COUNT(DISTINCT f.repo_key) AS unique_repos,
               {O.big('SUM(f.unique_contributors)')} AS total_contributors,
               {O.big('SUM(f.total_pushes)')} AS total_pushes,
               {O.big('SUM(f.total_prs_opened)')} AS total_prs,
               {O.big('SUM(f.total_issues_opened)')} AS total_issues,
               {O.big('SUM(f.total_stars)')} AS total_stars,
               {O.big('SUM(f.total_forks)')} AS total_forks,
               {O.rnd('''CAST(SUM(f.total_prs_opened) AS DOUBLE)
                   / NULLIF(SUM(f.total_pushes), 0)''', 4)} AS pr_to_push_ratio
        {_ACT_DATE} GROUP BY d.year""",
)
def vw_ecosystem_growth(spark, d):
    return views.ecosystem_growth(_activity(spark, d), X.dim_date(spark, d))


@query(
    "vw_hourly_heatmap",
    f"""SELECT d.year, d.hour, d.day_of_week, d.day_name,
               {O.big('SUM(f.total_pushes)')} AS total_pushes,
               {O.big('SUM(f.total_prs_opened)')} AS total_prs,
               COUNT(DISTINCT f.repo_key) AS active_repos
        {_ACT_DATE} GROUP BY d.year, d.hour, d.day_of_week, d.day_name""",
)
def vw_hourly_heatmap(spark, d):
    return views.hourly_heatmap(_activity(spark, d), X.dim_date(spark, d))


@query(
    "vw_ml_predictions",
    """SELECT r.repo_name, r.language, r.is_ai_ml_repo, r.created_year,
              p.abandonment_probability, p.risk_tier, p.trajectory_label, p.model_version,
              p.scored_at, p.is_archived,
              CASE WHEN p.abandonment_probability >= 0.80 THEN 'Very High Risk (80%+)'
                   WHEN p.abandonment_probability >= 0.60 THEN 'High Risk (60-80%)'
                   WHEN p.abandonment_probability >= 0.40 THEN 'Moderate Risk (40-60%)'
                   WHEN p.abandonment_probability >= 0.20 THEN 'Low Risk (20-40%)'
                   ELSE 'Very Low Risk (<20%)' END AS confidence_tier
       FROM scores p JOIN drepo r ON p.repo_key = r.repo_key""",
)
def vw_ml_predictions(spark, d):
    return views.ml_predictions(X.scores(spark, d), X.dim_repository(spark, d))


def _risk_sql(alias: str) -> str:
    tiers = {"high_risk_count": V.HIGH_RISK, "moderate_risk_count": V.MODERATE_RISK}
    tiers["low_risk_count"] = V.LOW_RISK
    counts = ", ".join(
        O.big(f"SUM(CASE WHEN {alias}.risk_tier = '{t}' THEN 1 ELSE 0 END)") + f" AS {name}"
        for name, t in tiers.items()
    )
    high = f"SUM(CASE WHEN {alias}.risk_tier = 'High Risk' THEN 1 ELSE 0 END)"
    return f"COUNT(*) AS total_repos, {counts}, {O.pct(high, 'COUNT(*)', 1)} AS high_risk_pct"


_MEAN_P = O.mean_fixed("p.abandonment_probability", 6)


@query(
    "vw_ml_by_language",
    f"""SELECT r.language, {_risk_sql('p')},
               {O.rnd(_MEAN_P + ' * 100', 2)} AS avg_abandonment_prob_pct
        FROM scores p JOIN drepo r ON p.repo_key = r.repo_key
        WHERE r.language IS NOT NULL GROUP BY r.language HAVING COUNT(*) >= 10""",
)
def vw_ml_by_language(spark, d):
    return views.ml_by_language(X.scores(spark, d), X.dim_repository(spark, d))


@query(
    "vw_ml_feature_importance",
    f"""SELECT feature_name, importance, model_version,
               {O.pct('importance', 'SUM(importance) OVER (PARTITION BY model_version)', 2)}
                   AS importance_pct,
               RANK() OVER (PARTITION BY model_version ORDER BY importance DESC)
                   AS importance_rank
        FROM (SELECT p_brand AS feature_name,
                     CASE WHEN p_size % 2 = 0 THEN '200111' ELSE '200112' END AS model_version,
                     CAST(SUM(p_size) AS DOUBLE) AS importance
              FROM part GROUP BY 1, 2)""",
)
def vw_ml_feature_importance(spark, d):
    version = F.when(F.col("p_size") % 2 == 0, "200111").otherwise("200112")
    importance = (
        X.table(spark, d, "part")
        .groupBy(F.col("p_brand").alias("feature_name"), version.alias("model_version"))
        .agg(F.sum("p_size").cast("double").alias("importance"))
    )
    return views.ml_feature_importance(importance)


@query(
    "vw_abandonment_risk_current",
    """SELECT r.repo_name, r.owner_login, r.language, r.license, r.is_ai_ml_repo, r.has_readme,
              r.has_ci, r.created_year, r.repo_age_days, p.abandonment_probability, p.risk_tier,
              p.trajectory_label, p.is_archived, p.model_version, p.scored_at
       FROM newest p JOIN drepo r ON p.repo_key = r.repo_key""",
)
def vw_abandonment_risk_current(spark, d):
    return views.abandonment_risk_current(X.scores(spark, d), X.dim_repository(spark, d))


@query(
    "vw_abandonment_by_language",
    f"""SELECT r.language, {_risk_sql('p')}, {O.rnd(_MEAN_P, 4)} AS avg_abandonment_probability
        FROM newest p JOIN drepo r ON p.repo_key = r.repo_key
        WHERE r.language IS NOT NULL GROUP BY r.language""",
)
def vw_abandonment_by_language(spark, d):
    return views.abandonment_by_language(X.scores(spark, d), X.dim_repository(spark, d))


@query(
    "vw_abandonment_trend",
    f"""SELECT model_version, risk_tier, repo_count, avg_probability,
               {O.pct('repo_count', 'SUM(repo_count) OVER (PARTITION BY model_version)', 1)}
                   AS pct_of_scored_repos
        FROM (SELECT model_version, risk_tier, COUNT(*) AS repo_count,
                     {O.rnd(_MEAN_P, 4)} AS avg_probability
              FROM scores p GROUP BY 1, 2)""",
)
def vw_abandonment_trend(spark, d):
    return views.abandonment_trend(X.scores(spark, d))


def _growth(spark, d):
    vectors = trajectory.yearly_vectors(_activity(spark, d), X.YEARS)
    return trajectory.with_growth(vectors, X.YEARS, X.EARLY_YEARS_TO)


def _trajectories(spark, d):
    """Trajectory table with the cluster taken from the key instead of a fitted model."""
    cluster_id = F.pmod("repo_key", F.lit(6)).cast("int")
    labelled = trajectory.cluster_labels(_growth(spark, d).withColumn("cluster_id", cluster_id))
    return trajectory.trajectory_table(labelled, X.AS_OF)


@query(
    "vw_repo_trajectories",
    """SELECT r.repo_name, r.language, r.is_ai_ml_repo, r.created_year, t.trajectory_label,
              t.growth_ratio, t.avg_commits_early, t.avg_commits_recent, t.years_observed,
              TIMESTAMP '2001-12-31 00:00:00' AS computed_at
       FROM traj t JOIN drepo r ON t.repo_key = r.repo_key""",
)
def vw_repo_trajectories(spark, d):
    return views.repo_trajectories(_trajectories(spark, d), X.dim_repository(spark, d))


def _trend(spark, d):
    return trends.language_trend(
        _yearly(spark, d), X.dim_language(spark, d), X.FORECAST_YEARS, computed_at=X.AS_OF
    )


@query(
    "vw_language_forecast",
    """SELECT t.language_name, slope_pct_per_year, r_squared, forecast_2002_share,
              forecast_2003_share, trend_label, computed_at, l.paradigm, l.type_system,
              l.first_appeared
       FROM trend t LEFT JOIN dlang l ON t.language_key = l.language_key
       WHERE t.language_name IS NOT NULL""",
)
def vw_language_forecast(spark, d):
    return views.language_forecast(_trend(spark, d), X.dim_language(spark, d))


@query(
    "vw_contributor_dynamics",
    f"""WITH yc AS (
            SELECT d.year, p.contributor_key, COUNT(p.event_id) AS push_count
            FROM fpush p JOIN ddate d ON p.date_key = d.date_key GROUP BY 1, 2),
        fy AS (SELECT contributor_key, MIN(year) AS first_year FROM yc GROUP BY 1),
        retained AS (
            SELECT a.year, COUNT(DISTINCT a.contributor_key) AS active,
                   COUNT(DISTINCT b.contributor_key) AS retained_from_prior
            FROM yc a LEFT JOIN yc b
              ON a.contributor_key = b.contributor_key AND b.year = a.year - 1
            GROUP BY 1)
        SELECT yc.year, COUNT(DISTINCT yc.contributor_key) AS total_contributors,
               COUNT(DISTINCT CASE WHEN yc.year = first_year THEN yc.contributor_key END)
                   AS new_contributors,
               COUNT(DISTINCT CASE WHEN yc.year <> first_year THEN yc.contributor_key END)
                   AS returning_contributors,
               {O.pct('COUNT(DISTINCT CASE WHEN yc.year = first_year THEN yc.contributor_key END)',
                      'COUNT(DISTINCT yc.contributor_key)', 2)} AS new_contributor_pct,
               MAX(retained_from_prior) AS retained_from_prior,
               {O.pct('MAX(retained_from_prior)', 'MAX(active)', 2)} AS retention_rate_pct,
               {O.big('SUM(push_count)')} AS total_pushes
        FROM yc JOIN fy ON yc.contributor_key = fy.contributor_key
        JOIN retained r ON yc.year = r.year GROUP BY yc.year""",
)
def vw_contributor_dynamics(spark, d):
    return views.contributor_dynamics(_fact_push(spark, d), X.dim_date(spark, d))


# ---- model inputs and outputs ----------------------------------------------------------------


@query("features_early", "SELECT * FROM early")
def features_early(spark, d):
    return features.early_activity(_activity(spark, d), _born(spark, d))


@query("features_push", "SELECT * FROM featpush")
def features_push(spark, d):
    return features.push_features(_fact_push(spark, d), _born(spark, d))


@query("features_pr", "SELECT * FROM featpr")
def features_pr(spark, d):
    return features.pr_features(_fact_pr(spark, d), _born(spark, d))


@query("features_contrib", "SELECT * FROM featcontrib")
def features_contrib(spark, d):
    return features.contributor_features(
        _fact_push(spark, d), X.dim_contributor(spark, d), _born(spark, d)
    )


@query("features_momentum", "SELECT * FROM featera")
def features_momentum(spark, d):
    return features.momentum(_activity(spark, d), X.BOUNDARY_YEAR)


@query("features_lifetime", "SELECT * FROM featlife")
def features_lifetime(spark, d):
    return features.lifetime(_activity(spark, d))


def _hourly_of(staged):
    return durable(activity.repo_activity(facts.stream_from_keyed(staged)), "hourly")


def _features(spark, d, repositories, hourly, staged):
    return features.build_features(
        repositories,
        hourly,
        facts.fact_push(staged.filter(F.col("type") == S.PUSH), unique=True),
        facts.fact_pr(staged.filter(F.col("type") == S.PULL_REQUEST), unique=True),
        X.dim_contributor(spark, d),
        X.BOUNDARY_YEAR,
    )


@query("features_all", "SELECT * FROM feat")
def features_all(spark, d):
    """All sides from one pass over the events: keyed and staged by type, then read by each."""
    staged = _staged(spark, d)
    hourly = _hourly_of(staged)
    return _features(spark, d, _labelled(spark, d, hourly), hourly, staged)


@query("abandonment_labels", "SELECT * FROM labelled")
def abandonment_labels(spark, d):
    return _labelled(spark, d)


_BALANCE = """SELECT SUM(label) AS positives, COUNT(*) - SUM(label) AS negatives,
                     CAST(COUNT(*) - SUM(label) AS DOUBLE) / greatest(SUM(label), 1)
                         AS weight_ratio FROM labelled"""


@query(
    "class_weights",
    f"""SELECT repo_key, label,
               CASE WHEN label = 1 THEN (SELECT weight_ratio FROM ({_BALANCE})) ELSE 1.0::DOUBLE
                   END AS class_weight FROM labelled""",
)
def class_weights(spark, d):
    labelled = _labelled(spark, d)
    weighted = risk.with_class_weight(labelled, risk.class_balance(labelled))
    return weighted.select("repo_key", "label", "class_weight")


_SCORED = """
    SELECT label, (repo_key * 37 % 1000) / 1000.0::DOUBLE AS score,
           CASE WHEN repo_key * 37 % 1000 >= 500 THEN 1 ELSE 0 END AS said FROM labelled"""


@query(
    "evaluation",
    f"""WITH s AS ({_SCORED}),
        ranked AS (SELECT *, rank() OVER (ORDER BY score)
                             + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS place FROM s),
        n AS (SELECT SUM(label) AS p, COUNT(*) - SUM(label) AS n,
                     SUM(label * said) AS tp, SUM((1 - label) * said) AS fp,
                     SUM((1 - label) * (1 - said)) AS tn, SUM(label * (1 - said)) AS fn FROM s)
        SELECT {O.rnd("(SELECT SUM(place) FROM ranked WHERE label = 1) / (p * n)::DOUBLE - (p + 1) / (2.0 * n)::DOUBLE", 9)} AS area_under_roc,
               {O.rnd("(p * 2 * tp / (2 * tp + fp + fn)::DOUBLE + n * 2 * tn / (2 * tn + fp + fn)::DOUBLE) / (p + n)", 9)} AS f1,
               {O.rnd("(tp + tn) / (p + n)::DOUBLE", 9)} AS accuracy,
               {O.big("tp")} AS true_positives, {O.big("fp")} AS false_positives,
               {O.big("tn")} AS true_negatives, {O.big("fn")} AS false_negatives FROM n""",
)
def evaluation(spark, d):
    """Area, f1 and accuracy of made-up scores of all labelled repositories, ties included."""
    points = F.pmod(F.col("repo_key") * 37, F.lit(1000))
    rows = _labelled(spark, d).select("label", (points / 1000.0).alias("score"), (points >= 500).cast("int").alias("said"))
    found = evaluate(rows, "score", predicted="said")
    figures = ("area_under_roc", "f1", "accuracy")
    return found.select(*[F.round(c, 9).alias(c) for c in figures], *[c for c in found.columns if c not in figures])


@query(
    "temporal_split",
    """SELECT repo_key, created_year, CASE WHEN created_year <= 1997 THEN 'train' ELSE 'test' END
                  AS part FROM labelled WHERE created_year <= 1999""",
)
def temporal_split(spark, d):
    # both parts read one copy of the labelled repositories, which come from all events
    train, test = risk.temporal_split(durable(_labelled(spark, d), "labelled"), X.AS_OF_YEAR)
    columns = ("repo_key", "created_year")
    return train.select(*columns, F.lit("train").alias("part")).unionAll(
        test.select(*columns, F.lit("test").alias("part"))
    )


@query(
    "confusion",
    """SELECT outcome, COUNT(*) AS n FROM (
           SELECT CASE WHEN label = 1 AND guess = 1 THEN 'True Positive'
                       WHEN label = 0 AND guess = 0 THEN 'True Negative'
                       WHEN label = 0 AND guess = 1 THEN 'False Positive'
                       WHEN label = 1 AND guess = 0 THEN 'False Negative' END AS outcome
           FROM (SELECT label, CASE WHEN (repo_key * 37) % 1000 >= 500 THEN 1 ELSE 0 END AS guess
                 FROM labelled)) GROUP BY 1""",
)
def confusion(spark, d):
    guess = F.when(F.pmod(F.col("repo_key") * 37, F.lit(1000)) >= 500, 1).otherwise(0)
    rows = _labelled(spark, d).withColumn("prediction", guess)
    return rows.groupBy(risk.outcome().alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "risk_tier",
    """SELECT repo_key, model_version, abandonment_probability, risk_tier FROM scores""",
)
def risk_tier(spark, d):
    return X.scores(spark, d).select(
        "repo_key", "model_version", "abandonment_probability", "risk_tier"
    )


@query(
    "momentum_label",
    """SELECT repo_key, commit_momentum,
              CASE WHEN commit_momentum >= 1.5 THEN 'Accelerating'
                   WHEN commit_momentum >= 0.5 THEN 'Stable'
                   WHEN commit_momentum >= 0.1 THEN 'Declining' ELSE 'Stalled' END
                  AS trajectory_label FROM featera""",
)
def momentum_label(spark, d):
    return features.momentum(_activity(spark, d), X.BOUNDARY_YEAR).select(
        "repo_key",
        "commit_momentum",
        risk.momentum_label("commit_momentum").alias("trajectory_label"),
    )


@query("trajectory_pivot", "SELECT * FROM pivoted")
def trajectory_pivot(spark, d):
    return trajectory.yearly_vectors(_activity(spark, d), X.YEARS)


@query(
    "growth_ratio",
    "SELECT repo_key, avg_commits_early, avg_commits_recent, growth_ratio FROM growth",
)
def growth_ratio(spark, d):
    return _growth(spark, d).select(
        "repo_key", "avg_commits_early", "avg_commits_recent", "growth_ratio"
    )


@query("cluster_labels", "SELECT * FROM traj")
def cluster_labels(spark, d):
    return _trajectories(spark, d)


@query("language_trend", "SELECT * FROM trend")
def language_trend(spark, d):
    return _trend(spark, d)


# ---- sources, tables and streams: written to the shared folder and read back ------------------


def _raw_files(spark, d, events: DataFrame) -> str:
    """The envelope of the events as gzip JSON lines, a folder per year."""
    path = work_path(spark, "raw")
    write_events(X.envelope(events), path)
    return path


_ALWAYS = "2100-01-01"
_ROUTED = f"""SELECT {_TABLE_OF} AS table_name, year, COUNT(*) AS n_rows,
                     MIN(event_id) AS first_id, MAX(event_id) AS last_id
              FROM conf GROUP BY 1, 2"""


@query("read_events", f"SELECT {_FLAT_COLUMNS} FROM ev")
def read_events_query(spark, d):
    """Events written as JSON lines, read back and conformed."""
    raw = read_events(spark, _raw_files(spark, d, X.unique_events(spark, d)), "*.gz")
    return conform.conform(raw, X.EARLIEST, _ALWAYS, payload=False).drop("source_file")


@query("source_files", "SELECT year AS folder_year, COUNT(*) AS n_events, 0 AS n_elsewhere FROM ev GROUP BY 1")
def source_files(spark, d):
    """Conformed events by the year in the name of their source file, and those of another year there."""
    raw = read_events(spark, _raw_files(spark, d, X.unique_events(spark, d)), "*.gz")
    rows = conform.conform(raw, X.EARLIEST, _ALWAYS, payload=False)
    folder = F.regexp_extract("source_file", r"/year=(\d+)/", 1).cast("smallint")
    return rows.groupBy(folder.alias("folder_year")).agg(
        F.count("*").alias("n_events"), F.count_if(F.col("year") != folder).cast("int").alias("n_elsewhere")
    )


@query(
    "slim_events",
    """SELECT event_id AS id, type, false AS has_extra,
              CASE WHEN type = 'PushEvent' THEN commit_count END AS size,
              CASE WHEN type = 'PushEvent' THEN branch_ref END AS ref
       FROM ev WHERE type <> 'ReleaseEvent'""",
)
def slim_events_query(spark, d):
    """Payloads with fields nobody reads, slimmed."""
    raw = X.envelope(X.unique_events(spark, d))
    heavy = F.concat(F.lit('{"extra": {"diff": "@@"}, '), F.expr("substring(payload, 2)"))
    slim = slim_events(raw.withColumn("payload", heavy))
    slim = slim.withColumn("push", F.from_json(F.when(F.col("type") == S.PUSH, F.col("payload")), S.PAYLOADS[S.PUSH]))
    return slim.select(
        "id",
        "type",
        F.col("payload").contains("extra").alias("has_extra"),
        F.col("push.size").alias("size"),
        F.col("push.ref").alias("ref"),
    )


_METADATA = """
    SELECT p_partkey AS repo_id, p_brand || '/' || p_name AS repo_name, p_type AS language,
           p_brand AS license, replace(p_name, ' ', ',') AS topics, p_size AS stars_at_extract,
           p_size * 2 AS forks_at_extract, {description} AS description,
           p_size >= 45 AS is_archived, CAST(NULL AS BOOLEAN) AS has_readme,
           CAST(NULL AS BOOLEAN) AS has_ci, TIMESTAMP '1998-05-06 07:08:09' AS created_at
    FROM part"""


def _responses(spark, d) -> DataFrame:
    """Metadata responses made from the parts, through their JSON form."""
    text = F.expr(
        """to_json(struct(p_partkey AS id, concat(p_brand, '/', p_name) AS full_name,
             p_type AS language, struct(p_brand AS spdx_id) AS license,
             split(p_name, ' ') AS topics, p_size AS stargazers_count,
             p_size * 2 AS forks_count,
             if(p_size > 10, repeat(p_name, 60), NULL) AS description,
             p_size >= 45 AS archived, '1998-05-06T07:08:09Z' AS created_at))"""
    )
    response = F.from_json(text, S.METADATA_RESPONSE)
    return X.table(spark, d, "part").select(response.alias("r")).select("r.*")


@query(
    "conform_metadata",
    _METADATA.format(description="CASE WHEN p_size > 10 THEN repeat(p_name, 60) ELSE '' END"),
)
def conform_metadata(spark, d):
    return enrich.conform_metadata(_responses(spark, d))


@query(
    "conform_metadata_short",
    _METADATA.format(
        description="CASE WHEN p_size > 10 THEN substr(repeat(p_name, 60), 1, 500) ELSE '' END"
    ),
)
def conform_metadata_short(spark, d):
    """With the limit on descriptions that the option sets."""
    return enrich.conform_metadata(_responses(spark, d), max_description=500)


@query(
    "merge_shards",
    "SELECT repo_id, repo_name, language, stars_at_extract, created_at FROM repos",
)
def merge_shards(spark, d):
    """Shards written as year=Y/shard=I with every row in two shards, read back and merged."""
    rows = X.repositories(spark, d).withColumns(
        {
            "created_at": F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"),
            "year": F.lit(_YEAR),
            "shard": F.explode(F.array(F.lit(0), F.lit(1))),
        }
    )
    path = work_path(spark, "shards")
    rows.write.partitionBy("year", "shard").parquet(path)
    merged = enrich.merge_shards(read_shards(spark, path, _YEAR))
    return merged.select("repo_id", "repo_name", "language", "stars_at_extract", "created_at")


def _written_target(spark, d) -> tuple[Table, DataFrame]:
    target, batch = _merge_sides(spark, d)
    table = Table(spark, work_path(spark, "tables"), "orders")
    table.overwrite(target, partition="year")
    return table, batch


@query(
    "table_insert_only",
    f"""SELECT *, CAST(NULL AS VARCHAR) AS status FROM ({_TARGET}) UNION ALL
        SELECT * FROM ({_BATCH}) b
        WHERE NOT EXISTS (SELECT 1 FROM ({_TARGET}) t WHERE t.o_orderkey = b.o_orderkey)""",
)
def table_insert_only(spark, d):
    """The same batch inserted twice into a stored table: the second time adds nothing."""
    table, batch = _written_target(spark, d)
    table.insert_only(batch, ["o_orderkey"])
    table.insert_only(batch, ["o_orderkey"])
    return table.read()


@query(
    "table_insert_filtered",
    f"""SELECT *, CAST(NULL AS VARCHAR) AS status FROM ({_TARGET}) UNION ALL
        SELECT * FROM ({_BATCH}) b
        WHERE NOT EXISTS (SELECT 1 FROM ({_TARGET}) t WHERE t.o_orderkey = b.o_orderkey)""",
)
def table_insert_filtered(spark, d):
    """The batch inserted twice behind a filter of ids so small that it has false hits."""
    table, batch = _written_target(spark, d)
    for _ in range(2):
        table.insert_only(batch, ["o_orderkey"], fixed=True, filtered=True, blocks=1)
    return table.read()


@query("table_history", f"SELECT *, 1 AS run FROM ({_TARGET}) UNION ALL SELECT *, 2 AS run FROM ({_TARGET})")
def table_history(spark, d):
    """Two runs appended to a history that reads as empty while it is missing."""
    target, _ = _merge_sides(spark, d)
    table = Table(spark, work_path(spark, "tables"), "history")
    missing = table.read_or_empty("o_orderkey bigint, year smallint, price double, run int")
    for run in (1, 2):
        table.append(target.withColumn("run", F.lit(run)))
    return missing.unionByName(table.read())


@query(
    "table_upsert",
    f"""SELECT * FROM ({_BATCH}) UNION ALL
        SELECT *, CAST(NULL AS VARCHAR) AS status FROM ({_TARGET}) t
        WHERE NOT EXISTS (SELECT 1 FROM ({_BATCH}) b
                          WHERE b.o_orderkey = t.o_orderkey AND b.year = t.year)""",
)
def table_upsert(spark, d):
    """A batch upserted twice into a stored table, which is then compacted."""
    table, batch = _written_target(spark, d)
    table.upsert(batch, ["o_orderkey", "year"])
    table.upsert(batch, ["o_orderkey", "year"])
    table.compact()
    return table.read()


@query("mirror_audit", "SELECT *, true AS has_run_id, true AS has_load_time FROM dcontrib")
def mirror_audit(spark, d):
    """A stored dimension mirrored with run id and load time; the missing table is skipped.

    Both differ from run to run, so whether they are right is compared instead.
    """
    root, copies = work_path(spark, "tables"), work_path(spark, "mirror")
    Table(spark, root, "dim_contributor").overwrite(X.dim_contributor(spark, d))
    done = mirror(spark, root, copies, ["dim_contributor", "dim_language"])
    copied = spark.read.parquet(*(f"{copies}/{name}" for name in done))
    return copied.withColumns(
        {
            "has_run_id": F.col("_pipeline_run_id").eqNullSafe(F.lit(done["dim_contributor"])),
            "has_load_time": F.col("_loaded_at").isNotNull(),
        }
    ).drop("_pipeline_run_id", "_loaded_at")


def _play_last_again(spark, checkpoint: str) -> None:
    """Leaves a stream as if it had stopped after a batch was written and before it was noted."""
    notes = spark.read.format("binaryFile").option("pathGlobFilter", "[0-9]*").load(f"{checkpoint}/commits").select("path")
    last = notes.orderBy(F.desc(F.regexp_extract("path", r"(\d+)$", 1).cast("long"))).first()
    if last:  # without events there was no batch
        drop_work(spark, last.path)


@query("stream_ingest", _ROUTED)
def stream_ingest(spark, d):
    """Files drained in several batches, of which the last is played again and changes nothing."""
    root, raw = work_path(spark, "tables"), _raw_files(spark, d, X.unique_events(spark, d))
    checkpoint = work_path(spark, "progress")
    for run in range(2):
        if run:
            _play_last_again(spark, checkpoint)
        stream = event_stream(spark, raw, max_files=2)
        ingest(stream, root, checkpoint, X.EARLIEST, _ALWAYS).start().awaitTermination()
    parts = [
        Table(spark, root, name).read().select(
            F.lit(name).alias("table_name"), "year", "event_id"
        )
        for name in S.EVENT_TABLES.values()
        if Table(spark, root, name).exists()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    return rows.groupBy("table_name", "year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


_CLICK_TYPES = ("signup", "error", "click", "view", "purchase")


def _clicks(frame: DataFrame) -> DataFrame:
    return frame.select(
        "event_id",
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_type").alias("type"),
        F.get_json_object("props", "$.k").cast("bigint").alias("repo_id"),
        F.col("user_id").alias("actor_id"),
    )


def _click_stream(spark, d, copies: int) -> DataFrame:
    """The events table as a file stream of several micro-batches, each row `copies` times."""
    path = work_path(spark, "clicks")
    rows = _clicks(X.table(spark, d, "events"))
    many = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    many.repartition(4, "event_id", "copy").drop("copy").write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


@query(
    "stream_dedup",
    """SELECT event_id, ts AS created_at, event_type AS type, user_id AS actor_id
       FROM events""",
)
def stream_dedup(spark, d):
    """Every event delivered three times over several micro-batches, kept once."""
    unique = streaming.dedup_stream(_click_stream(spark, d, 3), "400 days")
    sink, progress = work_path(spark, "unique"), work_path(spark, "progress")
    (
        unique.writeStream.option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start(sink, format="parquet", outputMode="append")
        .awaitTermination()
    )
    return spark.read.parquet(sink).select("event_id", "created_at", "type", "actor_id")


@query(
    "stream_activity",
    f"""SELECT CAST(ts AS DATE) AS window_day, date_trunc('hour', ts) AS window_start,
               CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS repo_id,
               COUNT(*) AS n_events,
               {', '.join(
                   f"COUNT(*) FILTER (WHERE event_type = '{t}') AS n_{t}" for t in _CLICK_TYPES)}
        FROM events GROUP BY 1, 2, 3""",
)
def stream_activity(spark, d):
    """Hourly counts kept up to date by the stream; they must equal the batch result."""
    counts = streaming.hourly_counts(_click_stream(spark, d, 1), _CLICK_TYPES, "400 days")
    root, progress = work_path(spark, "tables"), work_path(spark, "progress")
    streaming.upsert_stream(counts, root, "hourly", progress).start().awaitTermination()
    return Table(spark, root, "hourly").read()


# ---- fitted models: what does not depend on the fit is compared, and that the rest fits to it ---


def _model_rows(spark, d) -> tuple[DataFrame, DataFrame]:
    staged = _staged(spark, d)
    return _rows_of(spark, d, staged, _hourly_of(staged))


def _rows_of(spark, d, staged, hourly) -> tuple[DataFrame, DataFrame]:
    labelled = _labelled(spark, d, hourly)
    rows = model.training_rows(_features(spark, d, labelled, hourly, staged))
    return risk.temporal_split(rows, X.AS_OF_YEAR)


def _trained(spark, d, trees=(20,), depths=(5,)) -> model.Training:
    return model.train(*_model_rows(spark, d), trees=trees, depths=depths, folds=2)


@query(
    "model_training",
    """SELECT repo_key, '200112' AS model_version, label, '2001-12-31' AS trained_at,
              true AS in_range, true AS prediction_fits, true AS outcome_fits
       FROM labelled WHERE created_year > 1997 AND created_year <= 1999""",
)
def model_training(spark, d):
    """Outcomes of the test rows under the forest chosen by cross-validation."""
    result = _trained(spark, d, trees=(10, 20))
    found = model.test_predictions(result.predictions, "200112", X.AS_OF)
    p, guess = F.col("abandonment_probability"), F.col("predicted_label")
    kind = F.concat_ws(
        " ",
        F.when(guess == F.col("label"), "True").otherwise("False"),
        F.when(guess == 1, "Positive").otherwise("Negative"),
    )
    return found.select(
        "repo_key",
        "model_version",
        "label",
        "trained_at",
        p.between(0, 1).alias("in_range"),
        # rounding moves a probability onto a threshold, never across it
        F.when(guess == 1, p >= 0.5).otherwise(p <= 0.5).alias("prediction_fits"),
        (F.col("outcome") == kind).alias("outcome_fits"),
    )


_INPUTS = (*model.VECTOR_NAMES, *V.CATEGORY_FEATURES)


@query(
    "feature_importance",
    f"""SELECT unnest({list(_INPUTS)}) AS feature_name, '200112' AS model_version,
               true AS in_range, 1.0::DOUBLE AS total WHERE EXISTS (SELECT 1 FROM labelled)""",
)
def feature_importance(spark, d):
    """Every input of the model once; the importances are shares of one."""
    train_rows, test_rows = _model_rows(spark, d)
    fitted = model.train(train_rows, test_rows, trees=(20,), depths=(5,))
    found = model.feature_importance(fitted.model, train_rows, "200112")
    total = F.round(F.sum("importance").over(Window.partitionBy("model_version")), 9)
    return found.select(
        "feature_name",
        "model_version",
        F.col("importance").between(0, 1).alias("in_range"),
        total.alias("total"),
    )


@query(
    "score_repos",
    """SELECT b.repo_key, '200112' AS model_version, created_year,
              TIMESTAMP '2001-12-31 00:00:00' AS scored_at, is_archived,
              CASE WHEN commit_momentum >= 1.5 THEN 'Accelerating'
                   WHEN commit_momentum >= 0.5 THEN 'Stable'
                   WHEN commit_momentum >= 0.1 THEN 'Declining' ELSE 'Stalled' END
                  AS trajectory_label,
              true AS in_range, true AS tier_fits
       FROM born b LEFT JOIN featera m ON b.repo_key = m.repo_key
       WHERE repo_age_days IS NOT NULL""",
)
def score_repos(spark, d):
    """Every repository with an age, scored; the tier has to fit its probability and age."""
    staged = _staged(spark, d)
    hourly = _hourly_of(staged)
    fitted = model.train(*_rows_of(spark, d, staged, hourly), trees=(20,), depths=(5,), folds=2)
    ready = durable(_features(spark, d, _born(spark, d), hourly, staged))
    repositories = X.dim_repository(spark, d)
    scored = model.score(fitted.model, ready, repositories, "200112", X.AS_OF)
    p, young = F.col("abandonment_probability"), F.col("repo_age_days") < V.MIN_AGE_DAYS
    fits = (
        F.when(F.col("risk_tier") == V.HIGH_RISK, p >= 0.7)
        .when(F.col("risk_tier") == V.MODERATE_RISK, (p >= 0.4) & (p <= 0.7))
        .when(F.col("risk_tier") == V.TOO_YOUNG, (p <= 0.4) & young)
        .otherwise((F.col("risk_tier") == V.LOW_RISK) & (p <= 0.4) & ~young)
    )
    return scored.join(repositories.select("repo_key", "repo_age_days"), "repo_key").select(
        "repo_key",
        "model_version",
        "created_year",
        "scored_at",
        "is_archived",
        "trajectory_label",
        p.between(0, 1).alias("in_range"),
        fits.alias("tier_fits"),
    )


@query(
    "trajectory_clusters",
    f"""SELECT repo_key, {O.rnd('growth_ratio', 3)} AS growth_ratio,
               {O.rnd('avg_commits_early', 1)} AS avg_commits_early,
               {O.rnd('avg_commits_recent', 1)} AS avg_commits_recent,
               years_observed, TIMESTAMP '2001-12-31 00:00:00' AS computed_at,
               true AS cluster_fits
        FROM growth""",
)
def trajectory_clusters(spark, d):
    """Clustered repositories; each has one of at most six clusters, and that one its label."""
    vectors = trajectory.yearly_vectors(_activity(spark, d), X.YEARS)
    clustered = trajectory.cluster(vectors, X.YEARS, max_iter=20)
    grown = trajectory.with_growth(clustered, X.YEARS, X.EARLY_YEARS_TO)
    found = trajectory.trajectory_table(trajectory.cluster_labels(grown), X.AS_OF)
    known = F.col("cluster_id").between(0, 5) & F.col("trajectory_label").isNotNull()
    return found.withColumn("cluster_fits", known).drop("cluster_id", "trajectory_label")
