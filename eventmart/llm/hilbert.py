"""Nearest neighbours by several shifted Hilbert orderings of projected vectors.

Each ordering projects the vectors onto a few random directions, shifts the grid and sorts by
the Hilbert key: a range shuffle in Spark. A query scores the rows in a window around its place
in every ordering; the windows' best are merged and ranked on the original vectors.

Equal vectors are searched once: a class of copies is one point that carries its k + 1 smallest
ids, which is all that a list of k can show.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.blocks import best_per_query, one_length, pack_blocks, unpack, whole_vectors
from eventmart.llm.common import with_positions
from eventmart.session import durable, settled

ROWS = 8192  # places of a block
QUERY_ROWS = 1 << 16  # places whose queries meet a block together
TILE = 64  # queries multiplied at a time
FOUND = "query_id long, vec_id long, score double"


def hilbert_keys(grid: np.ndarray, bits: int) -> np.ndarray:
    """Index along the Hilbert curve of points (n x dims, `bits` bits each; dims * bits <= 62)."""
    x = grid.T.astype(np.int64).copy()
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the rotations and reflections of each level
        for i in range(len(x)):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(flip, q - 1, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    return _interleave(_gray(x, top), bits)


def _gray(x: np.ndarray, top: int) -> np.ndarray:
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    return x ^ turn


def _interleave(x: np.ndarray, bits: int) -> np.ndarray:
    key = np.zeros(x.shape[1], np.int64)
    for bit in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | ((axis >> bit) & 1)
    return key


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: id (the smallest), members (its k + 1 smallest ids)."""
    first = Window.partitionBy("vector").orderBy("id")
    few = rows.distinct().withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k + 1)
    return few.groupBy("vector").agg(F.min("id").alias("id"), F.sort_array(F.collect_list("id")).alias("members"))


def _projections(seed: int, ordering: int, width: int, dims: int) -> np.ndarray:
    drawn = np.random.default_rng([seed, ordering]).normal(size=(width, min(dims, width)))
    return np.linalg.qr(drawn)[0]


def _keys(points: DataFrame, width: int, orderings: int, dims: int, bits: int, seed: int) -> DataFrame:
    """Adds `keys`: the Hilbert key of each vector in every ordering."""
    matrices = [_projections(seed, s, width, dims) for s in range(orderings)]
    matrix = np.hstack(matrices)

    @F.pandas_udf("array<double>")
    def project(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(list(np.stack(batch.to_list()) @ matrix) if len(batch) else [])

    flat = durable(points.withColumn("flat", project("vector")), "projected")
    stats = flat.agg(
        *[F.avg(F.col("flat")[i]) for i in range(matrix.shape[1])],
        *[F.stddev_pop(F.col("flat")[i]) for i in range(matrix.shape[1])],
    ).first()
    mean, spread = np.array(stats[: matrix.shape[1]]), np.array(stats[matrix.shape[1] :])

    @F.pandas_udf("array<long>")
    def key(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            unit = (np.stack(batch.to_list()) - mean) / np.where(spread > 0, spread, 1)
            unit = np.clip((unit + 4) / 8, 0, 1)
            out, at = [], 0
            for s, m in enumerate(matrices):
                shift = np.random.default_rng([seed, s, 1]).random(m.shape[1])
                grid = ((unit[:, at : at + m.shape[1]] + shift) / 2 * (2**bits - 1)).astype(np.int64)
                out.append(hilbert_keys(grid, bits))
                at += m.shape[1]
            yield pd.Series(list(np.stack(out, axis=1)))

    return durable(flat.withColumn("keys", key("flat")).drop("flat"), "keys")


def _search(k: int, window: int):
    def run(queries: pa.Table, documents: pa.Table) -> pa.Table:
        out = []
        for block in unpack(documents, "<f8"):
            first = int(block.positions[0])
            norm = np.abs(block.vectors).sum(axis=1).max()
            for group in unpack(queries, "<f8"):
                for at in range(0, len(group.ids), TILE):
                    places = group.positions[at : at + TILE]
                    asked = group.vectors[at : at + TILE]
                    low = np.clip(places - window - first, 0, len(block.ids))
                    high = np.clip(places + window + 1 - first, 0, len(block.ids))
                    base = int(low.min())
                    rough = asked @ block.vectors[base : int(high.max())].T
                    for own, query, row, a, b in zip(group.ids[at : at + TILE], asked, rough, low - base, high - base, strict=True):
                        if a >= b:
                            continue
                        near = row[a:b]
                        # the multiplication rounds by position: keep a margin, then sum each row alike
                        margin = 1e-12 * norm * np.abs(query).max()
                        floor = np.partition(near, len(near) - k)[len(near) - k] - margin if len(near) > k else -np.inf
                        some = np.flatnonzero(near >= floor) + base + a
                        score = (block.vectors[some] * query).sum(axis=1)
                        best = np.lexsort((block.ids[some], -score))[:k]
                        out.append((np.full(len(best), own), block.ids[some[best]], score[best]))
        empty = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        columns = [np.concatenate(c) for c in zip(*(out or [empty]), strict=True)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    return run


def _in_windows(keyed: DataFrame, k: int, reach: int, total: int) -> DataFrame:
    """The k best of each query among the rows within `reach` places of it in the order of `key`.

    The few queries go to the blocks: one query is copied once for each block of its window, and a
    block once for every `QUERY_ROWS` places of its own.
    """
    placed = with_positions(keyed, ["key", "id"])
    documents = durable(pack_blocks(placed, F.floor(F.col("position") / ROWS), "<f8"), "documents")
    queries = durable(pack_blocks(placed.where("asks"), F.floor(F.col("position") / QUERY_ROWS), "<f8"), "queries")

    def touched(size: int, other: int) -> Column:
        """Numbers of the blocks of `other` places that the window of a block of `size` places meets."""
        low = F.greatest(F.col("block") * size - reach, F.lit(0))
        high = F.least(F.col("block") * size + size - 1 + reach, F.lit(total - 1))
        return F.explode(F.sequence(F.floor(low / other), F.floor(high / other)))

    documents = documents.withColumn("q", touched(ROWS, QUERY_ROWS))
    queries = queries.withColumn("d", touched(QUERY_ROWS, ROWS))
    met = queries.groupBy("block", "d").cogroup(documents.groupBy("q", "block"))
    return met.applyInArrow(_search(k, reach), FOUND)


def nearest(
    frame: DataFrame,
    is_query: Column,
    k: int,
    key: str = "vec_id",
    vector: str = "embedding",
    orderings: int = 4,
    window: float | int = 0.25,
    dims: int = 3,
    bits: int = 10,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products found for each query.

    `is_query` is over `id`, the key as long. `window` is what is scored on each side of a query in
    every ordering: a share of all rows (a float), which finds neighbours whatever the data, or a
    number of rows (an int), whose work grows with the rows alone and which suits vectors that lie
    in clusters. Vectors that are null, zero or hold null or non-finite
    components take no part; rows with the query's own id are no candidates, and a repeated
    (id, vector) row counts once. An id may have several vectors; each is searched and found.
    Vectors of several lengths are an error.
    """
    rows = whole_vectors(frame, key, vector).where(F.exists("vector", lambda x: x != 0))
    points = durable(_classes(rows, k), "classes")
    total, least, width = points.agg(F.count("*"), F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if not total:
        return frame.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    one_length(least, width)
    asked = rows.where(is_query).distinct().join(points.select("vector", F.col("id").alias("class")), "vector")
    asked = durable(asked.select(F.col("id").alias("query_id"), "class"), "asked")
    keyed = _keys(points.select("id", "vector"), width, orderings, dims, bits, seed)
    keyed = durable(keyed.join(asked.select(F.col("class").alias("id")).distinct().withColumn("asks", F.lit(True)), "id", "left"), "asking")
    reach = max(1, window if isinstance(window, int) else int(window * total))
    found = []
    for ordering in range(orderings):
        placed = keyed.select("id", "vector", "asks", F.col("keys")[ordering].alias("key"))
        found.append(settled(lambda placed=placed: _in_windows(placed, k + 1, reach, total), "found"))
    merged = reduce(DataFrame.union, found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    classes = best_per_query(merged, k + 1).select(F.col("query_id").alias("class"), F.col("vec_id").alias("near"), "score")
    members = points.select(F.col("id").alias("near"), "members")
    listed = classes.join(members, "near").select("class", F.explode("members").alias("vec_id"), "score")
    answers = asked.join(listed, "class").where("query_id <> vec_id").select("query_id", "vec_id", "score")
    return best_per_query(answers, k)
