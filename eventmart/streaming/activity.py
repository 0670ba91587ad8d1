"""Bounded-state deduplication and incremental hourly counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from eventmart.sources.snapshots import Table

WINDOW_KEYS = ("window_start", "repo_id")
WINDOW_DAY = "window_day"


def dedup_stream(
    events: DataFrame, delay: str, keys: Sequence[str] = ("event_id",), ts: str = "created_at"
) -> DataFrame:
    """Drop copies that arrive within `delay` of each other; state older than that goes."""
    return events.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def hourly_counts(
    events: DataFrame, types: Sequence[str], delay: str | None = None, ts: str = "created_at"
) -> DataFrame:
    """Events per tumbling hour and repository, in all and per type.

    Works on a stream (give `delay`) and on a batch frame alike.
    """
    source = events.withWatermark(ts, delay) if delay else events
    per_type = [F.count_if(F.col("type") == t).alias(f"n_{t}") for t in types]
    counts = source.groupBy(F.window(ts, "1 hour").alias("w"), "repo_id").agg(
        F.count(F.lit(1)).alias("n_events"), *per_type
    )
    return counts.select(
        F.to_date("w.start").alias(WINDOW_DAY),
        F.col("w.start").alias("window_start"),
        "repo_id",
        "n_events",
        *(f"n_{t}" for t in types),
    )


def upsert_stream(
    counts: DataFrame, root: str, name: str, checkpoint: str, keys: Sequence[str] = WINDOW_KEYS
) -> DataStreamWriter:
    """Keep a table of the latest counts per window.

    Update mode hands over every window that changed; a replayed batch writes the same
    values again. Append mode would hold a window back until the watermark passes it. The
    table is partitioned by day, so a batch rewrites the days it touches and no others.
    """

    def write(batch: DataFrame, _batch_id: int) -> None:
        table = Table(batch.sparkSession, root, name)
        table.upsert(batch, list(keys), partition=WINDOW_DAY)

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(write)
    )
