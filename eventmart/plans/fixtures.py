"""Adapters from the TPC-H-like test tables to the event model.

Order lines play the events, parts the repositories, customers the contributors. All
frames are lazy; each query composes the ones it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart import schemas as S
from eventmart.operators import dims
from eventmart.operators.conform import first_per_key, label_csv

AS_OF = "2001-12-31"
AS_OF_YEAR = 2001
EARLIEST = "1990-01-01"
YEARS = tuple(range(1995, 2002))
EARLY_YEARS_TO = 1997
BOUNDARY_YEAR = 1998
PERIOD = ("is_covid_period", "1998-03-01", "1999-06-30")
PERIOD_YEARS = (1997, 1998, 1999)
TOPIC_PATTERN = "ring|small"
FORECAST_YEARS = (2002, 2003)
TOP_PERCENT = 40

LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_REST = (
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
)


_schemas: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once and then declared."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as delivered, with repeated (order, line number) keys."""
    return table(spark, sf_dir, "lineitem").select(*LINE_KEY, *LINE_REST)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One line per (order, line number), deduplicated before any join.

    Dealt by the order: the ranking and the join with the orders then share one exchange.
    """
    return first_per_key(all_lines(spark, sf_dir).repartition("l_orderkey"), LINE_KEY, LINE_REST)


EVENT_COLUMNS = (
    "l_orderkey",
    "l_linenumber",
    "CAST(number AS STRING) AS event_id",
    """CASE WHEN l_linenumber <= 2 THEN 'PushEvent' WHEN l_linenumber = 3 THEN 'PullRequestEvent'
            WHEN l_linenumber = 4 THEN 'IssuesEvent' WHEN l_linenumber = 5 THEN 'WatchEvent'
            WHEN l_linenumber = 6 THEN 'ForkEvent' ELSE 'ReleaseEvent' END AS type""",
    "created_at",
    "CAST(year(created_at) AS SMALLINT) AS year",
    "l_partkey AS repo_id",
    "concat('repo/', l_partkey, '-', year(created_at)) AS repo_name",
    "actor_id",
    """CASE WHEN l_quantity >= 2 THEN
            concat('user-', actor_id, if(actor_id % 20 = 0, '[bot]', '')) END AS actor_login""",
    # push
    "CAST(l_quantity AS INT) AS commit_count",
    """CASE l_returnflag WHEN 'A' THEN 'refs/heads/main' WHEN 'N' THEN 'refs/heads/master'
            ELSE 'refs/heads/dev' END AS branch_ref""",
    # pull request and issue
    """CASE o_orderstatus WHEN 'O' THEN 'opened' WHEN 'F' THEN 'closed'
            ELSE 'reopened' END AS action""",
    "if(o_orderstatus = 'F', 'closed', 'open') AS state",
    "number AS object_id",
    "concat('Item ', l_orderkey) AS title",
    "l_linestatus = 'F' AS is_merged",
    "CAST(floor(l_quantity * l_quantity / 2) AS INT) AS additions",
    "CAST(round(l_discount * 100) AS INT) AS deletions",
    "CAST(pmod(l_partkey, 7) AS INT) AS changed_files",
    "CAST(pmod(l_suppkey, 10) AS INT) AS remarks",
    "opened_at",
    "shipped_at AS ended_at",
    "array(struct(l_returnflag AS name), struct(l_linestatus AS name)) AS labels",
    # watch
    "if(o_orderstatus = 'F', 'started', 'deleted') AS watch_action",
    # release
    "concat('v', l_suppkey) AS tag_name",
    "l_returnflag = 'R' AS is_prerelease",
)


def with_event_columns(order_lines: DataFrame, orders: DataFrame) -> DataFrame:
    """Envelope and typed columns of each line, all from one join."""
    order = orders.selectExpr(
        "o_orderkey AS l_orderkey",
        "o_custkey AS actor_id",
        "o_orderstatus",
        "CAST(o_orderdate AS TIMESTAMP) AS opened_at",
    )
    joined = order_lines.join(order, "l_orderkey").selectExpr(
        "*",
        "CAST(l_shipdate AS TIMESTAMP) AS shipped_at",
        "timestampadd(HOUR, pmod(l_suppkey, 24), CAST(l_shipdate AS TIMESTAMP)) AS created_at",
        "l_orderkey * 10 + l_linenumber AS number",
    )
    return joined.selectExpr(*EVENT_COLUMNS)


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event columns of every delivered line, repeated event ids included."""
    return with_event_columns(all_lines(spark, sf_dir), table(spark, sf_dir, "orders"))


def unique_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_event_columns(lines(spark, sf_dir), table(spark, sf_dir, "orders"))


def conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the typed event tables hold together: unique events, only started watches."""
    events = unique_events(spark, sf_dir)
    return events.filter((F.col("type") != S.WATCH) | (F.col("watch_action") == "started"))


# Payload text per type, in the shape the raw feed delivers. The draft flag of a release is
# left out so that its default is exercised.
_PAYLOAD = """
    CASE type
    WHEN 'PushEvent' THEN to_json(struct(branch_ref AS ref, commit_count AS size))
    WHEN 'PullRequestEvent' THEN to_json(struct(action, struct(
        object_id AS id, title, state, is_merged AS merged, additions, deletions, changed_files,
        remarks AS review_comments, opened_at AS created_at, ended_at AS merged_at,
        ended_at AS closed_at) AS pull_request))
    WHEN 'IssuesEvent' THEN to_json(struct(action, struct(
        object_id AS id, title, state, remarks AS comments, opened_at AS created_at,
        ended_at AS closed_at, labels) AS issue))
    WHEN 'WatchEvent' THEN to_json(struct(watch_action AS action))
    WHEN 'ForkEvent' THEN to_json(struct(struct(
        l_orderkey AS id, concat('fork/', repo_id) AS full_name) AS forkee))
    ELSE to_json(struct('published' AS action, struct(
        object_id AS id, tag_name, concat('Release ', tag_name) AS name,
        is_prerelease AS prerelease, opened_at AS created_at, ended_at AS published_at)
        AS release))
    END"""


def envelope(events: DataFrame) -> DataFrame:
    """Raw envelope of the events, as read from the archive files."""
    return events.select(
        F.col("event_id").alias("id"),
        "type",
        "created_at",
        F.struct(F.col("actor_id").alias("id"), F.col("actor_login").alias("login")).alias(
            "actor"
        ),
        F.struct(F.col("repo_id").alias("id"), F.col("repo_name").alias("name")).alias("repo"),
        F.expr(_PAYLOAD).alias("payload"),
    )


def flat_events(
    spark: SparkSession, sf_dir: str, kind: str | None = None, payload: str = _PAYLOAD
) -> DataFrame:
    """Flattened unique events (of one type) with their payload text."""
    events = unique_events(spark, sf_dir)
    if kind:
        events = events.filter(F.col("type") == kind)
    return events.select(
        "event_id",
        "type",
        "created_at",
        "year",
        "actor_id",
        "actor_login",
        "repo_id",
        "repo_name",
        F.expr(payload).alias("payload"),
        F.concat(
            F.date_format("created_at", "yyyy/yyyy-MM-dd"),
            F.lit("-"),
            F.hour("created_at"),
            F.lit(".json.gz"),
        ).alias("source_file"),
    )


def typed_payload(kind: str) -> list[Column]:
    """Silver columns of one type, taken straight from the event columns."""
    return {
        S.PULL_REQUEST: [
            F.col("object_id").alias("pr_id"),
            F.col("remarks").alias("review_comments"),
            F.col("opened_at").alias("pr_created_at"),
            F.col("ended_at").alias("merged_at"),
        ],
        S.ISSUES: [
            F.col("object_id").alias("issue_id"),
            F.col("remarks").alias("comments_count"),
            F.col("opened_at").alias("issue_created_at"),
            F.col("ended_at").alias("closed_at"),
            label_csv("labels").alias("label_list"),
        ],
        S.RELEASE: [
            F.col("object_id").alias("release_id"),
            F.concat(F.lit("Release "), "tag_name").alias("release_name"),
            F.lit(False).alias("is_draft"),
            F.col("opened_at").alias("release_created_at"),
            F.col("ended_at").alias("published_at"),
        ],
    }.get(kind, [])


def repositories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the enriched repositories; parts of some brands were never enriched."""
    return (
        table(spark, sf_dir, "part")
        .filter("p_brand NOT LIKE 'Brand#2%'")
        .selectExpr(
            "p_partkey AS repo_id",
            "concat(p_brand, '/', replace(p_name, ' ', '-'), '-', p_partkey) AS repo_name",
            "CASE WHEN p_size > 3 THEN p_type END AS language",
            "p_brand AS license",
            "lower(p_name) AS topics",
            "p_size AS stars_at_extract",
            "CAST(NULL AS INT) AS forks_at_extract",
            "CAST(NULL AS STRING) AS description",
            "p_size >= 45 AS is_archived",
            "CAST(NULL AS BOOLEAN) AS has_readme",
            "CAST(NULL AS BOOLEAN) AS has_ci",
            """CAST(date_add(DATE'1994-01-01', CAST(pmod(p_partkey * 37, 2900) AS INT))
                    AS TIMESTAMP) AS created_at""",
        )
    )


def contributors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS actor_id",
        "concat(c_name, if(c_custkey % 20 = 0, '[bot]', '')) AS login",
        "'User' AS account_type",
    )


def dim_repository(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_repository(repositories(spark, sf_dir), AS_OF, TOPIC_PATTERN)


def dim_contributor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_contributor(contributors(spark, sf_dir))


def dim_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.dim_language(repositories(spark, sf_dir))


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours of the dated event types.

    The type is tested after grouping, not filtered before: then this branch reads the same
    deduplicated lines as the activity it is joined with, and Spark reuses that exchange.
    """
    dated = F.col("type").isin(list(dims.DATED_TYPES))
    hours = (
        conformed(spark, sf_dir)
        .groupBy(F.date_trunc("hour", "created_at").alias("h"))
        .agg(F.bool_or(dated).alias("dated"))
        .filter("dated")
    )
    return dims.describe_hours(hours, PERIOD)


def keyed(spark: SparkSession, sf_dir: str, kind: str | None = None) -> DataFrame:
    """Conformed events with surrogate keys; of one type with that type's own columns."""
    events = conformed(spark, sf_dir)
    if kind:
        events = events.filter(F.col("type") == kind)
    else:
        events = events.withColumns(
            {
                "pr_created_at": F.col("opened_at"),
                "merged_at": F.col("ended_at"),
                "issue_created_at": F.col("opened_at"),
                "closed_at": F.col("ended_at"),
            }
        )
    extra = typed_payload(kind) if kind else []
    return dims.attach_keys(
        events.select("*", *extra),
        dim_repository(spark, sf_dir),
        dim_contributor(spark, sf_dir),
        dim_language(spark, sf_dir),
    )


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic synthetic scores, two model versions per repository."""
    from eventmart.operators.risk import momentum_label, risk_tier

    repos = dim_repository(spark, sf_dir)
    key = F.col("repo_key")
    version = F.explode(F.array(F.lit("200111"), F.lit("200112")))
    probability = F.pmod(
        key * F.when(F.col("model_version") == "200111", 37).otherwise(41), F.lit(1000)
    )
    return (
        repos.withColumn("model_version", version)
        .withColumn("abandonment_probability", probability / 1000.0)
        .select(
            "repo_key",
            "model_version",
            "abandonment_probability",
            risk_tier("abandonment_probability").alias("risk_tier"),
            "created_year",
            F.lit("2001-12-31 06:00:00").cast("timestamp").alias("scored_at"),
            "is_archived",
            momentum_label(F.pmod(key * 13, F.lit(200)) / 100.0).alias("trajectory_label"),
        )
    )
