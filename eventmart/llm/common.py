"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.session import configure, durable

_PART_BITS = 33  # monotonically_increasing_id(): partition above, row within it below
FILTER_BITS = 24  # size of a broadcast bitmap of keys: a fixed 2**18 words


T = TypeVar("T")


def thrifty(batches: Iterable[T]) -> Iterator[T]:
    """The batches of a task. What Arrow holds for later use goes back to the system after each of them.

    A Python worker outlives its task, so all that it keeps adds up with what other workers and the JVM hold.
    """
    for batch in batches:
        yield batch
        del batch
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh(frame: DataFrame, name: str) -> str:
    """A column name that the frame does not use in any letter case."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_rows(frame: DataFrame) -> tuple[DataFrame, str]:
    """A durable copy in which every row, repeated ones too, has a number of its own.

    The number is stored with the row: a lost executor cannot change it afterwards.
    """
    row = fresh(frame, "_row")
    return durable(frame.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def with_positions(frame: DataFrame, keys: Sequence[str], name: str = "position") -> DataFrame:
    """Number the rows 0..n-1 in the order of `keys`, which must tell all rows apart.

    A range shuffle and a sort inside each partition; the only thing that reaches the driver
    is one count per partition. The ordered copy is durable, so the numbers stay as they are.
    """
    order = [F.asc_nulls_last(col(k)) for k in keys]
    at = fresh(frame, "_at")
    ordered = frame.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered = durable(ordered.withColumn(at, F.monotonically_increasing_id()), "positions")
    sizes = ordered.groupBy(F.shiftright(at, _PART_BITS).alias("part")).count().collect()
    starts, total = [], 0
    for part, n in sorted((r["part"], r["count"]) for r in sizes):
        starts.append((part, total))
        total += n
    part, start = fresh(frame, "_part"), fresh(frame, "_start")
    offsets = frame.sparkSession.createDataFrame(starts, f"`{part}` long, `{start}` long")
    within = col(at).bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return (
        ordered.withColumn(part, F.shiftright(at, _PART_BITS))
        # one row per partition of the shuffle above, whatever the data
        .join(F.broadcast(offsets), part)
        .withColumn(name, col(start) + within)
        .drop(part, start, at)
    )


def told_apart(frame: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may stand in the only column of `keys`, with all that do, and the other rows.

    A bitmap of hashes, of fixed size, is broadcast, so neither part is shuffled. No key is null.
    """
    word, bit, bits, of = (fresh(frame, f"_{x}") for x in ("word", "bit", "bits", "of"))

    def place(name: str) -> list[Column]:
        spot = F.pmod(F.xxhash64(col(name)), F.lit(1 << FILTER_BITS))
        return [F.shiftright(spot, 6).alias(word), spot.bitwiseAND(F.lit(63)).cast("int").alias(bit)]

    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col(bit))
    bitmap = keys.select(*place(keys.columns[0])).groupBy(F.col(word).alias(of)).agg(F.bit_or(one).alias(bits))
    marked = frame.select("*", *place(key)).join(F.broadcast(bitmap), F.col(word) == F.col(of), "left")
    held = F.coalesce(F.col(bits), F.lit(0)).bitwiseAND(one) != 0
    columns = list(map(col, frame.columns))
    return marked.where(held).select(*columns), marked.where(~held).select(*columns)


def without(frame: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """The rows whose key is not in the only column of `keys`, which has that name; few of the others are shuffled."""
    maybe, other = told_apart(frame, key, keys)
    return other.union(maybe.join(keys, key, "left_anti").select(*map(col, frame.columns)))
