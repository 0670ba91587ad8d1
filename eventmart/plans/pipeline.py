"""Whole jobs: raw files to conformed tables, star schema, views and model tables.

Every job reads and writes named tables below one root. Jobs are safe to run again.
"""

from __future__ import annotations

import hashlib
import posixpath
import uuid
from collections.abc import Iterator, Sequence
from datetime import UTC, date, datetime

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
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
    model,
    quality,
    risk,
    trajectory,
    trends,
    views,
)
from eventmart.session import configure, drop_work, path_exists, staged, work_path
from eventmart.sources.events import CORRUPT, read_events, read_metadata, read_shards, stage_by_type
from eventmart.sources.snapshots import Table, with_audit
from eventmart.streaming.ingest import merge_batch, reject

FULL, INCREMENTAL = "full_refresh", "incremental"
GOLD_TABLES = (
    "dim_date",
    "dim_repository",
    "dim_contributor",
    "dim_language",
    "fact_push_events",
    "fact_pr_events",
    "fact_issues_events",
    "fact_release_events",
    "fact_repo_activity_daily",
    "fact_language_yearly",
)
MODEL_TABLES = (
    "ml_feature_importance",
    "ml_model_metadata",
    "ml_abandonment_risk",
    "ml_repo_trajectories",
    "ml_language_trend_forecasts",
)
# rows per event type and year that the star schema was last built from
_BUILT = "gold_state"
_BUILT_SCHEMA = "type string, year smallint, n bigint"


class Mart:
    """The tables of one root and the jobs over them."""

    def __init__(self, spark: SparkSession, root: str, as_of: str | None = None):
        self.spark, self.root = configure(spark), root
        self.as_of = as_of

    def table(self, name: str) -> Table:
        return Table(self.spark, self.root, name)

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()

    @property
    def year(self) -> int:
        return int(self.as_of[:4]) if self.as_of else date.today().year

    # ---- conformed tables ---------------------------------------------------------------

    def build_silver(
        self,
        paths: str | Sequence[str],
        mode: str = INCREMENTAL,
        pattern: str | None = None,
        earliest: str = V.EARLIEST_EVENT,
        keep_audits: bool = False,
        quarantine: str | None = None,
    ) -> dict[str, int]:
        """Raw files into the typed tables; a full refresh replaces them and audits.

        The audit replaces the one before it, unless `keep_audits` appends to a history.
        Rows that are not conformed go to `quarantine` with the reason, one folder per input:
        reading the same input again replaces its folder.
        """
        raw = read_events(self.spark, paths, pattern, keep_corrupt=quarantine is not None)
        if quarantine:
            given = [paths] if isinstance(paths, str) else sorted(paths)
            run = hashlib.sha256("\n".join([*given, pattern or ""]).encode()).hexdigest()[:16]
            rejected = reject(raw, earliest, self.as_of)
            rejected.write.mode("overwrite").parquet(posixpath.join(quarantine, f"run={run}"))
            raw = raw.drop(CORRUPT)
        if mode == INCREMENTAL:
            return merge_batch(raw, self.root, earliest, self.as_of)
        self._forget_built()
        staged = work_path(self.spark, "events")
        events = stage_by_type(conform.conform(raw, earliest, self.as_of), staged)
        added = {
            name: self.table(name).overwrite(rows, partition="year")
            for name, rows in conform.route(events).items()
        }
        accepted = quality.tagged({kind: self.silver(kind) for kind in S.EVENT_TYPES})
        audit = quality.dq_audit(events, accepted, mode, self.as_of)
        history = self.table("dq_audit")
        history.append(audit) if keep_audits else history.overwrite(audit)
        drop_work(self.spark, staged)
        return added

    def silver(self, kind: str) -> DataFrame:
        return self.table(S.EVENT_TABLES[kind]).read_or_empty(S.SILVER[kind])

    def _all_events(self) -> DataFrame:
        """Shared columns of all typed tables as one stream."""
        columns = ("event_id", "repo_id", "repo_name", "actor_id", "actor_login", "created_at")
        first, *rest = (self.silver(kind).select(*columns, "year") for kind in S.EVENT_TYPES)
        for part in rest:
            first = first.unionByName(part)
        return first

    # ---- enrichment -----------------------------------------------------------------------

    def worklist(
        self,
        year: int | None,
        percent: float | None,
        shards: int = 1,
        top_n: int | None = None,
    ) -> DataFrame:
        """Busiest repositories of a year (None: all) without metadata yet, dealt to shards."""
        top = enrich.top_repos(self._all_events(), year, percent, top_n)
        known = self.table("repositories").read_or_empty(S.REPOSITORIES)
        return enrich.shard_worklist(enrich.repos_to_fetch(top, known), shards)

    def load_metadata(self, path: str) -> int:
        """Landed metadata responses into the repository table; newer rows win."""
        rows = enrich.conform_metadata(read_metadata(self.spark, path))
        return self.table("repositories").upsert(rows, ["repo_id"])

    def load_shards(self, base: str, year: int | None = None) -> int:
        rows = enrich.merge_shards(read_shards(self.spark, base, year))
        return self.table("repositories").upsert(rows, ["repo_id"])

    def load_contributors(self) -> int:
        """Actors of all events; an actor already known keeps its row."""
        rows = enrich.contributors(self._all_events())
        return self.table("contributors").insert_only(rows, ["actor_id"])

    # ---- star schema ----------------------------------------------------------------------

    def build_gold(
        self,
        period: tuple[str, str, str] = V.COVID_PERIOD,
        topic_pattern: str = V.AI_TOPIC_PATTERN,
        mode: str = FULL,
    ) -> list[int] | None:
        """Dimensions, facts and aggregates; returns the years that were built, None for all.

        Both modes leave the same rows. An incremental build replaces the dimensions, and of
        the facts only the years that gained events or hold events whose keys changed.
        """
        repositories = self.table("repositories").read_or_empty(S.REPOSITORIES)
        contributors = self.table("contributors").read_or_empty(S.CONTRIBUTORS)
        fresh = {
            "dim_repository": dims.dim_repository(repositories, self.as_of, topic_pattern),
            "dim_contributor": dims.dim_contributor(contributors),
            "dim_language": dims.dim_language(repositories),
        }
        counts = self._event_counts()
        years = self._changed_years(fresh, counts) if mode == INCREMENTAL else None
        # a build that fails half-way is followed by one of all years
        self._forget_built()
        self._build_dates(years, period)
        for name, rows in fresh.items():
            self.table(name).overwrite(rows)
        if years != []:
            self._build_facts(years)
        state = [(kind, year, n) for (kind, year), n in counts.items()]
        self.table(_BUILT).overwrite(self.spark.createDataFrame(state, _BUILT_SCHEMA))
        return years

    def _event_counts(self) -> dict[tuple[str, int], int]:
        """Rows per event type and year, from the folders and file footers."""
        tables = [
            self.silver(kind).select(F.lit(kind).alias("type"), "year") for kind in facts.STREAM_TYPES
        ]
        for part in tables[1:]:
            tables[0] = tables[0].unionAll(part)
        counted = tables[0].groupBy("type", "year").agg(F.count(F.lit(1)).alias("n"))
        return {(r["type"], r["year"]): r["n"] for r in counted.collect()}

    def _forget_built(self) -> None:
        self.table(_BUILT).overwrite(self.spark.createDataFrame([], _BUILT_SCHEMA))

    def _changed_years(
        self, fresh: dict[str, DataFrame], counts: dict[tuple[str, int], int]
    ) -> list[int] | None:
        """Years whose facts can differ from the stored ones; None if all have to be built."""
        if not all(self.table(name).exists() for name in (*GOLD_TABLES, _BUILT)):
            return None
        built = {(r["type"], r["year"]): r["n"] for r in self.read(_BUILT).collect()}
        if not built or any(counts.get(key, 0) < n for key, n in built.items()):
            return None

        def changed(name: str, *columns: str) -> DataFrame:
            """Rows of the columns that only the stored or only the fresh dimension holds."""
            old, new = self.read(name).select(*columns), fresh[name].select(*columns)
            return old.subtract(new).unionAll(new.subtract(old))

        # languages are numbered in alphabetical order: a new one moves those behind it
        if not changed("dim_language", "language_key", "language_name").isEmpty():
            return None
        repos = changed("dim_repository", "repo_id", "language").select("repo_id").distinct()
        people = changed("dim_contributor", "actor_id").distinct()
        events = self._all_events().select("repo_id", "actor_id", "year")
        moved = (
            events.join(repos, "repo_id", "left_semi")
            .select("year")
            .unionAll(events.join(people, "actor_id", "left_semi").select("year"))
            .distinct()
        )
        grown = {year for (kind, year), n in counts.items() if built.get((kind, year)) != n}
        return sorted(grown | {r["year"] for r in moved.collect()})

    def _build_dates(self, years: list[int] | None, period: tuple[str, str, str]) -> None:
        """Hours that occur; outside of `years` those of the stored dimension."""
        stamps = [_of_years(self.silver(kind), years).select("created_at") for kind in dims.DATED_TYPES]
        for part in stamps[1:]:
            stamps[0] = stamps[0].unionAll(part)
        dates = dims.dim_date(stamps[0], period=period)
        if years is None:
            self.table("dim_date").overwrite(dates)
            return
        others = self.read("dim_date").filter(~F.col("year").isin(years))
        hour = F.expr("CAST(full_date AS TIMESTAMP) + make_interval(0, 0, 0, 0, CAST(hour AS INT))")
        kept = dims.describe_hours(others.select(hour.alias("h")), period)
        with staged(kept.unionByName(dates), "dates") as rows:
            self.table("dim_date").overwrite(rows)

    def _build_facts(self, years: list[int] | None) -> None:
        def keyed(kind: str) -> DataFrame:
            return dims.attach_keys(
                _of_years(self.silver(kind), years),
                self.read("dim_repository"),
                self.read("dim_contributor"),
                self.read("dim_language"),
            )

        def store(name: str, rows: DataFrame) -> None:
            if years is None:
                self.table(name).overwrite(rows, partition="year")
            else:
                self.table(name).replace_partitions(rows)

        def stored(name: str) -> DataFrame:
            return _of_years(self.read(name), years)

        # the typed tables hold each event id once, so the facts need no second dedup
        store("fact_push_events", facts.fact_push(keyed(S.PUSH), unique=True))
        store("fact_pr_events", facts.fact_pr(keyed(S.PULL_REQUEST), unique=True))
        store("fact_issues_events", facts.fact_issues(keyed(S.ISSUES), unique=True))
        store("fact_release_events", facts.fact_release(keyed(S.RELEASE), unique=True))
        # the aggregates read the stored facts back: nothing is keyed twice
        stream = facts.stream_from_facts(
            stored("fact_push_events"),
            stored("fact_pr_events"),
            stored("fact_issues_events"),
            keyed(S.WATCH),
            keyed(S.FORK),
            stored("fact_release_events"),
        )
        store("fact_repo_activity_daily", activity.repo_activity(stream))
        base = activity.language_yearly_base(stream)
        yearly = self.table("fact_language_yearly")
        if years is not None:
            others = yearly.read().filter(~F.col("year").isin(years)).select(*base.columns)
            base = others.unionByName(base)
        # a few rows per language and year; growth looks back over the years
        with staged(activity.language_yearly(base), "yearly") as rows:
            yearly.overwrite(rows)

    def compact(self, names: Sequence[str] = GOLD_TABLES) -> None:
        for name in names:
            if self.table(name).exists():
                self.table(name).compact()

    def _views(self) -> Iterator[tuple[str, DataFrame]]:
        """Name and rows of each analysis view whose tables exist."""
        for name, (build, inputs) in views.VIEWS.items():
            if all(self.table(table).exists() for table in inputs):
                yield name, build(*(self.read(table) for table in inputs))

    def register_views(self) -> list[str]:
        """Tables and analysis views as temporary views; views lacking a table are skipped."""
        done = []
        for name, rows in self._views():
            for table in views.VIEWS[name][1]:
                self.read(table).createOrReplaceTempView(table)
            rows.createOrReplaceTempView(name)
            done.append(name)
        return done

    def write_views(self, target: str) -> dict[str, str]:
        """Analysis views as Parquet folders with audit columns, for readers outside the session.

        Returns {view: run id}; views lacking a table are skipped.
        """
        run_id, done = str(uuid.uuid4()), {}
        for name, rows in self._views():
            with_audit(rows, run_id).write.mode("overwrite").parquet(posixpath.join(target, name))
            done[name] = run_id
        return done

    # ---- model tables ---------------------------------------------------------------------

    def _features(self, repositories: DataFrame, boundary: int) -> DataFrame:
        return features.build_features(
            repositories,
            self.read("fact_repo_activity_daily"),
            self.read("fact_push_events"),
            self.read("fact_pr_events"),
            self.read("dim_contributor"),
            boundary,
        )

    def train(
        self,
        boundary: int = 2020,
        trees: Sequence[int] = model.TREE_GRID,
        depths: Sequence[int] = model.DEPTH_GRID,
        version: str | None = None,
    ) -> dict:
        """Label, build features, tune, evaluate, save the model and point to it."""
        now = datetime.now(UTC)
        version = version or now.strftime("%Y%m")
        labelled = risk.labelled_repositories(
            self.read("dim_repository"), self.read("fact_repo_activity_daily"), self.year
        )
        rows = model.training_rows(self._features(labelled, boundary))
        train_rows, test_rows = risk.temporal_split(rows, self.year)
        result = model.train(train_rows, test_rows, trees, depths)
        path = posixpath.join(self.root, "models", "abandonment_risk", version)
        result.model.write().overwrite().save(path)
        trained_at, run_id = now.isoformat(), str(uuid.uuid4())
        pointer = {
            "model_version": version,
            "model_path": path,
            "model_type": "abandonment_risk",
            "run_id": run_id,
            "trained_at": trained_at,
            "boundary": boundary,
        }
        metadata = {
            **pointer,
            "auc_roc": float(result.auc_roc),
            "f1": float(result.f1),
            "accuracy": float(result.accuracy),
            "num_trees": int(result.forest.getNumTrees),
            "max_depth": int(result.forest.getMaxDepth()),
            "train_cutoff": self.year - 4,
            "test_max": self.year - 2,
            "train_rows": train_rows.count(),
            "test_rows": test_rows.count(),
        }
        recorded = {
            "ml_test_predictions": model.test_predictions(result.predictions, version, trained_at),
            "ml_feature_importance": model.feature_importance(result.model, rows, version),
            "ml_model_metadata": self.spark.createDataFrame([metadata]),
        }
        for name, found in recorded.items():
            self._record(name, found, version)
        # last, so that the pointer never names a half-recorded model
        self.table("ml_model_current").overwrite(self.spark.createDataFrame([pointer]))
        return metadata

    def _record(self, name: str, rows: DataFrame, version: str) -> None:
        """Results of one model version; training it again replaces them."""
        table = self.table(name)
        if table.exists():
            others = table.read().filter(F.col("model_version") != version)
            with staged(others.unionByName(rows, allowMissingColumns=True), name) as kept:
                table.overwrite(kept)
        else:
            table.overwrite(rows)

    def score(self) -> int:
        """Score all repositories with the current model; 0 if there is none to load."""
        current = self.table("ml_model_current")
        if not current.exists():
            return 0
        pointer = current.read().first()
        if not path_exists(self.spark, pointer["model_path"]):
            return 0
        repositories = self.read("dim_repository")
        dated = repositories.withColumn("repo_created_date", F.to_date("created_at"))
        dated = dated.filter(F.col("repo_created_date").isNotNull()).select(
            "repo_key",
            "language",
            "license",
            "is_ai_ml_repo",
            "has_readme",
            "has_ci",
            "created_year",
            "repo_age_days",
            "repo_created_date",
        )
        with staged(self._features(dated, pointer["boundary"]), "features") as ready:
            scored = model.score(
                PipelineModel.load(pointer["model_path"]),
                ready,
                repositories,
                pointer["model_version"],
                self.as_of,
            )
            return self.table("ml_abandonment_risk").upsert(
                scored, ["repo_key", "model_version"], partition="created_year"
            )

    def trajectories(self, years: Sequence[int], early_to: int) -> int:
        """Cluster the yearly commit vectors; an empty table if there are too few repositories."""
        vectors = trajectory.yearly_vectors(self.read("fact_repo_activity_daily"), years)
        clustered = trajectory.cluster(vectors, years)
        labelled = trajectory.cluster_labels(trajectory.with_growth(clustered, years, early_to))
        return self.table("ml_repo_trajectories").overwrite(
            trajectory.trajectory_table(labelled, self.as_of)
        )

    def language_trends(self, forecast_years: Sequence[int]) -> int:
        fitted = trends.language_trend(
            self.read("fact_language_yearly"),
            self.read("dim_language"),
            forecast_years,
            computed_at=self.as_of,
        )
        return self.table("ml_language_trend_forecasts").overwrite(fitted)


def _of_years(rows: DataFrame, years: list[int] | None) -> DataFrame:
    return rows if years is None else rows.filter(F.col("year").isin(years))
