"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows of input partition p go to shard s is drawn exactly, row by row of the matrix,
from the multivariate hypergeometric law. Each partition permutes its rows and deals them out by
its row of the matrix, the rows are exchanged, and each shard is permuted again. Every
assignment of rows to (shard, slot) is equally likely, and shard sizes differ by one at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import _PART_BITS, fresh, with_rows

BUCKET = 1024  # rows that one sort of the second permutation holds on average


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """Draws `n` of good + bad items and counts the good ones; populations of any size.

    Inversion over the probabilities within 12 standard deviations of the mode, which hold all
    but 1e-30 of the mass; numpy's own sampler ends at 10**9 items.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mode = min(high, max(low, (n + 1) * (good + 1) // (total + 2)))
    share = good / total
    spread = int(12 * math.sqrt(max(n * share * (1 - share), 0.0))) + 40
    first, last = max(low, mode - spread), min(high, mode + spread)
    k = np.arange(first, last, dtype=np.float64)
    steps = np.log((good - k) * (n - k)) - np.log((k + 1) * (bad - n + k + 1))
    logs = np.concatenate([[0.0], np.cumsum(steps)])
    mass = np.cumsum(np.exp(logs - logs.max()))
    return first + int(np.searchsorted(mass, rng.random() * mass[-1], side="right"))


def communication_matrix(sizes: list[int], shards: int, seed: int) -> np.ndarray:
    """Rows: partitions, columns: shards; row sums are `sizes`, column sums differ by one at most."""
    rng = np.random.default_rng(seed)
    total = sum(sizes)
    room = [total // shards + (s < total % shards) for s in range(shards)]
    matrix = np.zeros((len(sizes), shards), np.int64)
    for p, size in enumerate(sizes):
        left, open_room = size, sum(room)
        for s in range(shards):
            drawn = hypergeometric(rng, room[s], open_room - room[s], left)
            matrix[p, s] = drawn
            open_room -= room[s]
            room[s] -= drawn
            left -= drawn
    return matrix


def deal_out(ends: np.ndarray, seed: int, part: int) -> np.ndarray:
    """The shard of each row of a partition; `ends` are the running sums of its row of the matrix."""
    place = np.random.default_rng([seed, 1, part]).permutation(int(ends[-1]))
    return np.searchsorted(ends, place, side="right").astype(np.int32)


def shuffle_into_shards(frame: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """Adds `shard` (0..shards-1) and `slot` (gapless from 0 in each shard) to all rows.

    Every column of `frame` is carried along (columns named shard or slot are replaced); pass a
    narrow frame to shard by reference. Nulls, ties and repeated rows are rows like any other;
    an empty frame gives an empty result. The result depends on the seed and on how the input
    is partitioned. The driver holds (input partitions x shards) counts.
    """
    spark = frame.sparkSession
    frame = frame.select([c for c in frame.columns if c.lower() not in ("shard", "slot")])
    rows, row = with_rows(frame)
    part = F.shiftright(row, _PART_BITS)
    counted = rows.groupBy(part.alias("part")).count().collect()
    sizes = dict(sorted((r["part"], r["count"]) for r in counted))
    matrix = communication_matrix(list(sizes.values()), shards, seed)
    part_name, cuts = fresh(frame, "_part"), fresh(frame, "_cuts")
    deal = spark.createDataFrame(
        [(p, m.cumsum().tolist()) for p, m in zip(sizes, matrix, strict=True)],
        f"`{part_name}` long, `{cuts}` array<long>",
    )

    @F.pandas_udf("int")
    def shard_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        # rows of one input partition follow one another: each is permuted once, not once a batch
        held, dealt_to = -1, np.zeros(0, np.int32)
        for at, ends in batches:
            out = np.empty(len(at), np.int32)
            parts = at.to_numpy() >> _PART_BITS
            within = at.to_numpy() & ((1 << _PART_BITS) - 1)
            for p in np.unique(parts):
                own = np.flatnonzero(parts == p)
                if p != held:
                    held, dealt_to = p, deal_out(np.asarray(ends.iloc[own[0]]), seed, int(p))
                out[own] = dealt_to[within[own]]
            yield pd.Series(out)

    # one row per input partition; the join leaves broadcasting to Spark's size check
    dealt = rows.withColumn(part_name, part).join(deal, part_name)
    dealt = dealt.withColumn("shard", shard_of(F.col(f"`{row}`"), F.col(f"`{cuts}`")))
    # second permutation: by a random key, in ranges of the key that one task can sort
    total = sum(sizes.values())
    ranges = max(1, total // shards // BUCKET)
    key, bucket, offset = (fresh(frame, n) for n in ("_key", "_bucket", "_offset"))
    keyed = dealt.drop(part_name, cuts).withColumn(key, F.xxhash64(F.lit(seed), F.lit("slot"), row))
    keyed = keyed.withColumn(bucket, F.pmod(F.shiftright(key, 16), F.lit(ranges)))
    counts = keyed.groupBy("shard", bucket).count()
    before = Window.partitionBy("shard").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", bucket, F.coalesce(F.sum("count").over(before), F.lit(0)).alias(offset))
    order = Window.partitionBy("shard", bucket).orderBy(key, row)
    slots = keyed.withColumn("slot", F.row_number().over(order).cast("long") - 1)
    joined = slots.join(starts, ["shard", bucket]).withColumn("slot", F.col("slot") + F.col(f"`{offset}`"))
    return joined.select(*[f"`{c}`" for c in frame.columns], "shard", "slot")
