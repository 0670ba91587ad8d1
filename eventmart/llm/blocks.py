"""Vectors in packed blocks: the unit that searches move between tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import col

PACKED = "block long, ids binary, positions binary, vectors binary"


def whole_vectors(frame: DataFrame, key: str, vector: str) -> DataFrame:
    """(id long, vector array<double>) of the rows whose vector takes part in a search.

    Vectors that are null or hold null, NaN or infinite components do not; neither do empty
    ones and rows without an id. Searches refuse vectors of several lengths (`one_length`).
    """
    rows = frame.select(col(key).cast("long").alias("id"), col(vector).cast("array<double>").alias("vector"))
    inf = float("inf")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)

    return rows.where(F.col("id").isNotNull() & (F.size("vector") > 0)).where(F.forall("vector", finite))


def one_length(least: int, most: int) -> None:
    """No inner product is defined between vectors of different lengths."""
    if least != most:
        raise ValueError(f"vectors of {least} to {most} components: all must have the same length")


def pack_blocks(frame: DataFrame, block: Column, dtype: str) -> DataFrame:
    """One row per block of (id, position, vector) rows; `block` must bound the rows of a block."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        flat = table["vector"].combine_chunks().flatten().to_numpy()
        return pa.table(
            {
                "block": table["block"].slice(0, 1).cast(pa.int64()),
                "ids": pa.array([table["id"].to_numpy().tobytes()], pa.binary()),
                "positions": pa.array([table["position"].to_numpy().tobytes()], pa.binary()),
                "vectors": pa.array([flat.astype(dtype).tobytes()], pa.binary()),
            }
        )

    return frame.select(block.cast("long").alias("block"), "id", "position", "vector").groupBy("block").applyInArrow(run, PACKED)


@dataclass
class Block:
    ids: np.ndarray
    positions: np.ndarray
    vectors: np.ndarray


def unpack(table: pa.Table, dtype: str) -> list[Block]:
    out = []
    for ids, positions, vectors in zip(*(table[c].to_pylist() for c in ("ids", "positions", "vectors")), strict=True):
        own = np.frombuffer(ids, np.int64)
        flat = np.frombuffer(vectors, dtype).astype(np.float64).reshape(len(own), -1)
        out.append(Block(own, np.frombuffer(positions, np.int64), flat))
    return out


def best_per_query(found: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest scores, ties to the smaller vec_id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
