"""Exact top-k search over integer vectors by block-at-a-time pruning.

Each component is a term with an integer weight. Documents are laid out in ranges (blocks) of an
order that puts those near the same pivot together, pivots being a sample of the rows; the order
decides what can be skipped and never what is found. A block's forward index holds its rows, and
its largest and smallest weight per term bound every score in it.

A query first scores the block that it lies in itself; its k-th score there is a floor of the answer.
Only the extremes of the blocks then meet the queries, and a block moves to a group of queries if it
can reach the floor of one of them. There a query takes the blocks by falling bound and stops when
the bound is below its k-th score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.blocks import best_per_query, one_length, pack_blocks, unpack, whole_vectors
from eventmart.llm.common import with_positions
from eventmart.session import durable

ROWS = 64  # documents of a block
SPAN = 256  # blocks that one task searches
STEP = 16  # blocks that are scored between two looks at the bounds
PIVOTS = 1024  # rows sampled for the order
QUERIES = 4096  # queries that one task answers
WIDE = 512  # blocks whose extremes one task compares with the floors of its queries
FOUND = "query_id long, vec_id long, score long"


def integer_vectors(frame: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, vector) with floor(scale * x) for each component x, x as double."""
    rows = whole_vectors(frame, key, vector)

    def floored(x: Column) -> Column:
        scaled = x * F.lit(float(scale))
        # doubles from 2**53 on are whole, and the longs that floor gives would end at 2**63
        return F.when(F.abs(scaled) < 2.0**53, F.floor(scaled).cast("double")).otherwise(scaled)

    return rows.select("id", F.transform("vector", floored).alias("vector"))


def _laid_out(vectors: DataFrame) -> DataFrame:
    """Adds `pivot`, the most similar one of a bounded sample, and `away`, falling with the similarity."""
    sample = vectors.orderBy(F.xxhash64("id"), "id", "vector").limit(PIVOTS).select("vector").collect()
    pivots = _chained(_directions(np.array([r.vector for r in sample])))

    @F.pandas_udf("pivot int, away double")
    def near(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                alike = _directions(np.stack(batch.to_list())) @ pivots.T
                yield pd.DataFrame({"pivot": alike.argmax(axis=1), "away": -alike.max(axis=1)})
            else:
                yield pd.DataFrame({"pivot": [], "away": []})

    return vectors.select("id", "vector", near("vector").alias("near")).select("id", "vector", "near.*")


def _directions(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; rows of zeros stay."""
    largest = np.abs(rows).max(axis=1, keepdims=True)
    rows = rows / np.where(largest > 0, largest, 1)
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def _chained(pivots: np.ndarray) -> np.ndarray:
    """Each pivot is followed by the most similar one that is left."""
    left, order = np.ones(len(pivots), bool), [0]
    for _ in range(1, len(pivots)):
        left[order[-1]] = False
        order.append(int(np.argmax(np.where(left, pivots @ pivots[order[-1]], -np.inf))))
    return pivots[order]


def _scores(vectors: np.ndarray, query: np.ndarray, exact: bool) -> np.ndarray:
    if exact:  # all sums stay below 2**53
        return (vectors @ query).astype(np.int64)
    whole = [int(x) for x in query]
    return np.array([sum(int(a) * b for a, b in zip(v, whole, strict=True)) for v in vectors.tolist()], np.int64)


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray, exact: bool) -> np.ndarray:
    """What the rows of each block (column) can score at most for each query (row)."""
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    # a rounded bound must not fall below the true one
    return bounds if exact else bounds + np.abs(bounds) * 1e-9 + 1


def _floors(k: int, dtype: str, exact: bool):
    """Each query's k-th score in its own block; none where the block has fewer candidates."""

    def run(queries: pa.Table, documents: pa.Table) -> pa.Table:
        ids, floors = [], []
        for block in unpack(documents, dtype):
            for group in unpack(queries, dtype):
                for own, query in zip(group.ids, group.vectors, strict=True):
                    got = _scores(block.vectors, query, exact)[block.ids != own]
                    if len(got) >= k:
                        ids.append(own)
                        floors.append(np.partition(got, len(got) - k)[len(got) - k])
        return pa.table({"id": np.array(ids, np.int64), "floor": np.array(floors, np.int64)})

    return run


def _extremes(dtype: str):
    """The smallest and the largest weight per term of each block, and its number of rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low, high = [], []
            for block in unpack(pa.Table.from_batches([batch]), dtype):
                low.append(block.vectors.min(axis=0).astype(dtype).tobytes())
                high.append(block.vectors.max(axis=0).astype(dtype).tobytes())
            columns = {"block": batch["block"], "low": pa.array(low, pa.binary()), "high": pa.array(high, pa.binary())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _unpack_queries(table: pa.Table, dtype: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, vectors and floors (packed where blocks have positions) of the rows of one group."""
    groups = unpack(table, dtype)
    return tuple(np.concatenate([getattr(g, c) for g in groups]) for c in ("ids", "vectors", "positions"))


def _reachable(dtype: str, exact: bool):
    """The blocks of a span that can reach the floor of a query of the group."""

    def run(queries: pa.Table, extremes: pa.Table) -> pa.Table:
        part, block = [], []
        if queries.num_rows and extremes.num_rows:
            _, vectors, floors = _unpack_queries(queries, dtype)
            low, high = (np.stack([np.frombuffer(x, dtype) for x in extremes[c].to_pylist()]).astype(np.float64) for c in ("low", "high"))
            some = (_bounds(vectors, low, high, exact) >= floors[:, None]).any(axis=0)
            block = extremes["block"].to_numpy()[some]
            part = np.full(len(block), queries["part"][0].as_py())
        return pa.table({"part": np.array(part, np.int64), "block": np.array(block, np.int64)})

    return run


def _search(k: int, dtype: str, exact: bool):
    def run(queries: pa.Table, documents: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if queries.num_rows and documents.num_rows:
            blocks = unpack(documents, dtype)
            high = np.array([b.vectors.max(axis=0) for b in blocks])
            low = np.array([b.vectors.min(axis=0) for b in blocks])
            ids, vectors, floors = _unpack_queries(queries, dtype)
            for own, query, least, bound in zip(ids, vectors, floors, _bounds(vectors, low, high, exact), strict=True):
                near, got = np.zeros(0, np.int64), np.zeros(0, np.int64)
                order = np.argsort(-bound, kind="stable")
                for at in range(0, len(order), STEP):
                    some = [blocks[b] for b in order[at : at + STEP] if bound[b] >= least]
                    if not some:
                        break
                    new = _scores(np.concatenate([b.vectors for b in some]), query, exact)
                    named = np.concatenate([b.ids for b in some])
                    take = (new >= least) & (named != own)
                    if take.any():
                        near, got = np.concatenate([near, named[take]]), np.concatenate([got, new[take]])
                        best = np.lexsort((near, -got))[:k]
                        near, got = near[best], got[best]
                        if len(got) == k:
                            least = max(least, got[-1])
                out.append((np.full(len(near), own), near, got))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return run


def exact_top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the k largest inner products of each query, exactly.

    `vectors` has (id long, vector array<double> of whole numbers); `is_query` is over id. Rows
    with the query's own id are no candidates; other repeated rows each count. Of several query
    rows with one id the smallest vector is used. Fewer candidates than k are all returned; no
    queries or no rows give an empty result. Scores beyond 64 bits and vectors of several lengths
    are errors.
    """
    spark = vectors.sparkSession
    largest = F.max(F.array_max(F.transform("vector", F.abs)))
    largest, total, least, width = vectors.agg(largest, F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    one_length(least, width)
    ordered = with_positions(durable(_laid_out(vectors), "laid_out"), ["pivot", "away", "id"])
    dtype = "<i1" if largest < 2**7 else "<i2" if largest < 2**15 else "<i4" if largest < 2**31 else "<f8"
    exact = largest * largest * width < 2**53
    blocks = durable(pack_blocks(ordered, F.floor(F.col("position") / ROWS), dtype), "blocks")
    asked = ordered.where(is_query).groupBy("id").agg(F.min(F.struct("vector", "position")).alias("row"))
    asked = durable(asked.select("id", "row.*"), "asked")
    groups = _query_groups(asked, blocks, k, dtype, exact)
    cells = _cells(groups, blocks, dtype, exact)
    span = F.floor(F.col("block") / SPAN).alias("span")
    documents = blocks.join(cells, "block").withColumn("span", span)
    queries = groups.join(cells.select("part", span).distinct(), "part")
    found = queries.groupBy("part", "span").cogroup(documents.groupBy("part", "span")).applyInArrow(_search(k, dtype, exact), FOUND)
    return best_per_query(found, k)


def _query_groups(asked: DataFrame, blocks: DataFrame, k: int, dtype: str, exact: bool) -> DataFrame:
    """Queries packed by part: ids, vectors and, as positions, floors.

    Queries are numbered in the order of the documents, so those of a part are alike and look for
    the same blocks.
    """
    home = pack_blocks(asked, F.floor(F.col("position") / ROWS), dtype)
    floors = home.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_floors(k, dtype, exact), "id long, floor long")
    floor = F.coalesce("floor", F.lit(-(2**63)))
    placed = with_positions(asked.join(floors, "id", "left").withColumn("floor", floor), ["position"], "place")
    placed = placed.drop("position").withColumnRenamed("floor", "position")
    packed = pack_blocks(placed, F.floor(F.col("place") / QUERIES), dtype)
    return durable(packed.withColumnRenamed("block", "part"), "queries")


def _cells(groups: DataFrame, blocks: DataFrame, dtype: str, exact: bool) -> DataFrame:
    """(part, block): the blocks that a part of the queries has to read.

    Two rows for a block, its extremes, go to every part, instead of its `ROWS` rows.
    """
    extremes = blocks.mapInArrow(_extremes(dtype), "block long, low binary, high binary")
    parts = groups.agg(F.max("part")).first()[0]
    spans = blocks.agg(F.max("block")).first()[0] // WIDE
    extremes = extremes.withColumn("wide", F.floor(F.col("block") / WIDE))
    extremes = extremes.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(-1 if parts is None else parts).cast("long"))))
    queries = groups.withColumn("wide", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spans).cast("long"))))
    met = queries.groupBy("part", "wide").cogroup(extremes.groupBy("part", "wide"))
    return durable(met.applyInArrow(_reachable(dtype, exact), "part long, block long"), "cells")
