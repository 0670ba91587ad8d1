"""Session settings and the shared scratch folder."""

from __future__ import annotations

import posixpath
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. All of them are plain Spark options that can be
# changed on a live session, so they are applied to whatever session the caller brings.
RUNTIME_CONF = {
    # hour keys, dates and ages are defined in UTC
    "spark.sql.session.timeZone": "UTC",
    # re-plan from real sizes: coalesce small partitions, switch to broadcast when a side
    # turns out small, and split the partitions of a hot join key
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot repository may carry a third of all rows: split it even where that costs the
    # aggregate above the join one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # a job of many steps must not hold the shuffle files of those that are done
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # texts can be long: bound what a Python worker holds by bytes, not only by rows
    "spark.sql.execution.arrow.maxBytesPerBatch": "1m",
    # stream state outside the executor's heap; a stream that was started with another store keeps it
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Options that Spark looks up by name without listing them; they too can be set on a live session.
UNLISTED_CONF = {
    # stream state is saved as the changes of each batch
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# What one task reads at most, of files and of coalesced shuffle partitions: narrow rows compress so
# well that the usual 128 and 64 MB are millions of them in one task's sorts and hash maps. A
# session that has less keeps it.
MOST = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_FILE_BYTES = "spark.eventmart.fileBytes"  # the session's own advisory size

# Settings that a session can only be created with.
START_CONF = {
    # no Python stack capture per column expression while plans are built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in {**RUNTIME_CONF, **UNLISTED_CONF}.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, most in MOST.items():
        held = spark.conf.get(key)
        if _bytes(spark, held) > _bytes(spark, most):
            if key == _ADVISORY:
                spark.conf.set(_FILE_BYTES, held)
            spark.conf.set(key, most)
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


@contextmanager
def file_sized(spark: SparkSession) -> Iterator[None]:
    """Within the block rebalancing yields files of the session's own advisory size, not partitions of MOST."""
    small, own = spark.conf.get(_ADVISORY), spark.conf.get(_FILE_BYTES, None)
    if own is None or _bytes(spark, own) < _bytes(spark, small) or small != MOST[_ADVISORY]:
        yield
        return
    spark.conf.set(_ADVISORY, own)
    try:
        yield
    finally:
        spark.conf.set(_ADVISORY, small)


def build_session(app: str = "eventmart", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; on a cluster leave `master` unset so that spark-submit decides."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**START_CONF, **RUNTIME_CONF, **UNLISTED_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors can reach, taken from `spark.checkpoint.dir`.

    Only a session that names none (a local test) gets a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    local = tempfile.mkdtemp(prefix="eventmart-")
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run below the shared folder."""
    return posixpath.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def path_exists(spark: SparkSession, path: str) -> bool:
    files, where = _file_system(spark, path)
    return files.exists(where)


def drop_work(spark: SparkSession, path: str) -> None:
    """Remove a folder made with `work_path`."""
    files, where = _file_system(spark, path)
    files.delete(where, True)


# paths of the durable copies made below the innermost `settled`
_made: ContextVar[list[str] | None] = ContextVar("_made", default=None)


def durable(frame: DataFrame, name: str = "frame", by: Sequence[str] = ()) -> DataFrame:
    """Cut the lineage of a frame: write it to the shared folder and read it back.

    Compared with an RDD checkpoint the copy is columnar: later reads prune columns, and
    the planner knows its size. With `by` (the last columns) their values have folders of their own.
    """
    path = work_path(frame.sparkSession, name)
    made = _made.get()
    if made is not None:
        made.append(path)
    frame.write.partitionBy(*by).parquet(path)
    copy = frame.sparkSession.read.schema(frame.schema).parquet(path)
    copy._durable_path = path
    return copy


def release(*copies: DataFrame) -> None:
    """Drop durable copies whose last reader is done."""
    for copy in copies:
        drop_work(copy.sparkSession, copy._durable_path)


def settled(make: Callable[[], DataFrame], name: str = "frame") -> DataFrame:
    """A durable copy of make(), without the durable copies that were made on the way."""
    made: list[str] = []
    outer = _made.set(made)
    try:
        try:
            frame = make()
        finally:
            _made.reset(outer)
        return durable(frame, name)
    finally:
        for old in made:
            drop_work(SparkSession.active(), old)


@contextmanager
def staged(frame: DataFrame, name: str = "staged") -> Iterator[DataFrame]:
    """A durable copy that is dropped at the end of the block."""
    path = work_path(frame.sparkSession, name)
    try:
        frame.write.parquet(path)
        yield frame.sparkSession.read.schema(frame.schema).parquet(path)
    finally:
        drop_work(frame.sparkSession, path)
