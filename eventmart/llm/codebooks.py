"""Vector code compression: product codes whose codebooks member-resident Lloyd rounds fit.

A vector is cut into equal parts; each position has a codebook of 256 entries. The parts lie with
their owners: a durable table whose tasks hold the parts of (position, entry, salt), the salt
spreading a crowded entry. In a round every task assigns its residents anew. Those that keep
their entry stay in the files of their task and are read from there without a shuffle; only those that change entry are
sent to their new owner. Owners add up their residents, so what leaves a task for the new codebook is one row
per entry that it holds. Codebooks have 256 entries of the vectors' length, whatever the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import col
from eventmart.session import durable, release

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
LARGEST = 2**27  # of a component: squared distances then fit 64 bits
_STATE = "row long, position int, entry int, part array<int>, distance long, moved boolean"


def _kept(frame: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(row, id, label, vector array<int>) of the rows whose vector takes part, with a stored row number."""
    inf = float("inf")

    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)

    rows = frame.select(col(key).alias("id"), col(label).alias("label"), col(vector).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vector").isNotNull()).where(F.forall("vector", finite))
    small = F.forall("vector", lambda x: F.abs(x) * SCALE < LARGEST - 1)
    far = F.raise_error(F.lit(f"a component of {LARGEST // SCALE} or more has no code"))
    whole = F.when(small, F.transform("vector", lambda x: F.floor(x * SCALE).cast("int"))).otherwise(far)
    return rows.select(F.monotonically_increasing_id().alias("row"), "id", "label", whole.alias("vector"))


def _parts(table: pa.RecordBatch, width: int) -> np.ndarray:
    flat = table.column("part").flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(-1, width)


def nearest_entries(parts: np.ndarray, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the nearest entry of each part, exactly; ties to the lower index."""
    top = int(max(np.abs(parts).max(initial=0), np.abs(codebook).max(initial=0)))
    # below 2**53 doubles are exact, and their product is the fast one
    kind = np.float64 if 4 * top * top * max(1, parts.shape[1]) < 2**53 else np.int64
    x, c = parts.astype(kind), codebook.astype(kind)
    apart = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(x)), best].astype(np.int64)


def _assign(state: DataFrame, books: np.ndarray) -> DataFrame:
    """Every part with its nearest entry, in the task that holds it; `moved` tells a change of entry."""
    width = books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = _parts(batch, width)
            position, old = batch.column("position").to_numpy(), batch.column("entry").to_numpy()
            entry, distance = np.zeros(len(parts), np.int32), np.zeros(len(parts), np.int64)
            for p in range(len(books)):
                own = np.flatnonzero(position == p)
                if len(own):
                    entry[own], distance[own] = nearest_entries(parts[own], books[p])
            told = [batch.column("row"), batch.column("position"), pa.array(entry), batch.column("part"), pa.array(distance), pa.array(entry != old)]
            yield pa.RecordBatch.from_arrays(told, ["row", "position", "entry", "part", "distance", "moved"])

    return state.mapInArrow(run, _STATE)


def _sums(state: DataFrame, positions: int, entries: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Members and component sums of each entry: added up by the owners, then over the salts of an entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(positions * entries, np.int64)
        total = np.zeros((positions * entries, width), np.int64)
        for batch in batches:
            at = batch.column("position").to_numpy().astype(np.int64) * entries + batch.column("entry").to_numpy()
            if len(at):
                order = np.argsort(at, kind="stable")
                own, first, n = np.unique(at[order], return_index=True, return_counts=True)
                count[own] += n
                total[own] += np.add.reduceat(_parts(batch, width)[order], first, axis=0)
        held = np.flatnonzero(count)
        lists = pa.ListArray.from_arrays(np.arange(len(held) + 1, dtype=np.int32) * width, total[held].ravel())
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(count[held]), lists], ["at", "n", "sums"])

    owners = state.select("position", "entry", "part").mapInArrow(run, "at long, n long, sums array<long>")
    # sums of int components times rows: 38 digits hold them at every size
    spread = owners.select("at", "n", F.posexplode("sums").alias("place", "value"))
    added = spread.groupBy("at", "place").agg(F.sum("n").alias("n"), F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    count = np.zeros(positions * entries, object)
    total = np.zeros((positions * entries, width), object)
    for at, place, n, value in added.collect():  # at most 256 times the length of a vector
        count[at], total[at, place] = n, int(value)
    return count.reshape(positions, entries), total.reshape(positions, entries, width)


def _first_books(kept: DataFrame, width: int) -> np.ndarray:
    """The parts of the vectors with the smallest ids, null ids last: (position, entry, component)."""
    first = kept.orderBy(F.asc_nulls_last("id"), "vector").limit(ENTRIES).select("vector").collect()
    whole = np.array([r[0] for r in first], np.int64).reshape(len(first), PARTS, width)
    return whole.transpose(1, 0, 2)


def _updated(books: np.ndarray, count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Each entry becomes the floor of its members' mean; one without members stays."""
    out = books.copy()
    for p, e in zip(*np.nonzero(count), strict=True):
        out[p, e] = [int(t) // int(count[p, e]) for t in total[p, e]]
    return out


def compress(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """One row per vector: key, code (two hex digits per part), error, label_error, codebooks_sha256.

    Components are floor(1024 x); those beyond 2**17 are an error. Vectors that are null, empty or
    hold null or non-finite components are left out; the others must have one length, a multiple
    of 4. The first codebooks are the parts of the 256 vectors with the smallest keys (null keys
    last, equal keys by vector), or of all if there are fewer. Ties go to the lower entry, entries
    without members stay. error is the squared distance to the code, label_error its sum over rows with an equal
    label, nulls together. Repeated rows each count.
    """
    spark = vectors.sparkSession
    kept = durable(_kept(vectors, key, vector, label).where(F.size("vector") > 0), "vectors")
    low, high = kept.agg(F.min(F.size("vector")), F.max(F.size("vector"))).first()
    if high is None:
        empty = f"`{key}` {vectors.schema[key].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], empty)
    if low != high or high % PARTS:
        raise ValueError(f"vectors of {low} to {high} components have no {PARTS} equal parts")
    width = high // PARTS
    books = _first_books(kept, width)
    entries = books.shape[1]
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts))

    def to_owners(parts: DataFrame) -> DataFrame:
        return parts.repartition("position", "entry", salt)

    cut = F.array(*[F.slice("vector", p * width + 1, width) for p in range(PARTS)])
    parts = kept.select("row", F.posexplode(cut).alias("position", "part"))
    parts = parts.select("row", "position", F.lit(-1).alias("entry"), "part", F.lit(0).cast("long").alias("distance"), F.lit(True).alias("moved"))
    resident, copies = durable(to_owners(_assign(parts, books)), "members"), []
    copies.append(resident)
    for _ in range(ROUNDS):
        books = _updated(books, *_sums(resident, PARTS, entries, width))
        told = durable(_assign(resident, books), "members", by=["moved"])
        release(*copies)
        moved = durable(to_owners(told.where("moved")), "arrivals")
        copies = [told, moved]
        resident = told.where(~F.col("moved")).union(moved)
    places = F.array(*[F.lit(ENTRIES ** (PARTS - 1 - p)) for p in range(PARTS)])
    byte = F.col("entry") * F.element_at(places, F.col("position") + 1).cast("long")
    codes = resident.groupBy("row").agg(F.sum(byte).alias("code"), F.sum("distance").alias("error"))
    code = F.lower(F.lpad(F.hex("code"), 2 * PARTS, "0")).alias("code")
    coded = durable(kept.select("row", "id", "label").join(codes, "row").select("id", "label", code, "error"), "codes")
    release(kept, *copies)
    labels = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label")
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_label"))).select(
        F.col("id").alias(key), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
