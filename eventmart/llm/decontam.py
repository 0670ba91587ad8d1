"""Benchmark decontamination by a prefix-filtered set join with exact containment.

An item is a set of windows of consecutive words, a window a set of word shingles. A document
contains a window only if it contains every shingle of it, so a single one, the rarest, is
the window's necessary prefix: shingles are ordered by how often they stand in all documents,
and only places of such prefixes are joined. The prefix's place within the window fixes where the window would
begin; places that leave no room for it are dropped, the others are compared word for word.

Documents are read twice, for the counts and for the places. A bitmap whose size follows from the benchmark, up to a
fixed limit, keeps most other shingles out of the shuffle; the joins decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventmart.llm.common import col
from eventmart.llm.shingles import STEP, shingle_hashes, word_hashes_of
from eventmart.session import durable, release, settled

WINDOW = 10
WIDTH = 5
PIECE = 1 << 20  # bytes of a text that are split into words at a time
OUT = 1 << 14  # places in one batch on their way to the shuffle
FILTER_BITS = (22, 28)  # log2 of the least and the most bits of the filter; the most are 32 MB
SPREAD = 512  # bits for each shingle of the filter, up to the most: one in so many others passes
# lower case for A-Z; all other ASCII but digits and lower-case letters parts words
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def _pieces(text: str | None) -> Iterator[list[bytes]]:
    """The words of a text in lists of bounded size."""
    plain = (text or "").encode("utf-8", "surrogatepass").translate(_WORDS)
    at = 0
    while at < len(plain):
        end = len(plain) if len(plain) - at <= PIECE else plain.find(b" ", at + PIECE)
        end = len(plain) if end < 0 else end
        yield plain[at:end].split()
        at = end


def words_of(text: str | None) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for piece in _pieces(text) for w in piece]


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word."""
    parts = [word_hashes_of(p) for p in _pieces(text)]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def _spot(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes * STEP) >> np.uint64(64 - bits)


def _windows(items: DataFrame, key: str, text: str, window: int, width: int) -> DataFrame:
    """(item, win, n, words, hashes) of each window of each item; an item of fewer words is one window."""

    @F.pandas_udf("array<struct<n:int,words:string,hashes:array<long>>>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for t in batch:
                words = words_of(t)
                n = min(window, len(words))
                size = min(n, width)
                hashes = shingle_hashes(word_hashes(t), size).view(np.int64)
                starts = range(len(words) - n + 1) if n else ()
                out.append([(n, " ".join(words[i : i + n]), hashes[i : i + n - size + 1].tolist()) for i in starts])
            yield pd.Series(out, dtype=object)

    made = items.select(col(key).alias("item"), F.explode(run(col(text))).alias("w")).select("item", "w.*")
    return made.withColumn("win", F.unhex(F.md5("words")))


def _filter(hashes: DataFrame) -> tuple[np.ndarray, int]:
    """A bitmap over the column `hash`, of SPREAD bits or more for each up to the fixed limit, and log2 of its size."""
    low, high = FILTER_BITS
    bits = min(high, max(low, (SPREAD * hashes.count()).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _spot(batch.column("hash").to_numpy(zero_copy_only=False).view(np.uint64), bits)
            byte, bit = (at >> np.uint64(3)).astype(np.int32), np.int32(1) << (at & np.uint64(7)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(byte), pa.array(bit)], ["byte", "bit"])

    # one row per byte of the bitmap at most, whatever the benchmark
    marked = hashes.mapInArrow(run, "byte int, bit int").groupBy("byte").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[marked["byte"].to_numpy()] = marked["bit"].to_numpy()
    return out, bits


def _held(hashes: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    at = _spot(hashes, bits)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def _counts(docs: DataFrame, text: str, hashes: DataFrame, sizes: list[int]) -> DataFrame:
    """(hash, seen): how often each of `hashes` stands in all documents; those that never do are left out."""
    bitmap, bits = _filter(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [np.zeros(0, np.uint64)]
            for t in batch.column(0).to_pylist():
                words = word_hashes(t)
                for size in sizes:
                    found = shingle_hashes(words, size)
                    kept.append(found[_held(found, bitmap, bits)])
            found, seen = np.unique(np.concatenate(kept), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(seen.astype(np.int64))], ["hash", "seen"])

    counted = docs.select(col(text)).mapInArrow(run, "hash long, seen long").groupBy("hash").agg(F.sum("seen").alias("seen"))
    return counted.join(hashes, "hash", "left_semi")


def _places(docs: DataFrame, key: str, text: str, prefixes: DataFrame, sizes: list[int], window: int, width: int) -> DataFrame:
    """One row per document with n_words (place null), and one per place of a prefix with the words around it."""
    bitmap, bits = _filter(prefixes.select("hash").distinct())
    names = ["row", "key", "n_words", "place", "hash", "ahead", "words"]
    schema = T.StructType(
        [T.StructField(n, t) for n, t in zip(names, [T.LongType(), docs.schema[key].dataType, *[T.LongType()] * 3, T.IntegerType(), T.StringType()], strict=True)]
    )

    def found(text: str, hashes: np.ndarray) -> Iterator[tuple]:
        words: list[str] = []
        for size in sizes:
            shingles = shingle_hashes(hashes, size)
            around = window - size if size == width else 0
            for at in np.flatnonzero(_held(shingles, bitmap, bits)).tolist():
                words = words or words_of(text)
                ahead = min(at, around)
                yield at, int(shingles[at : at + 1].view(np.int64)[0]), ahead, " ".join(words[at - ahead : at + size + around])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(columns: list, n: int) -> pa.RecordBatch:
            types = [pa.int64(), keys, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
            filled = [pa.nulls(n, t) if c is None else pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            return pa.RecordBatch.from_arrays(filled, names)

        for batch in batches:
            rows, texts, keys = batch.column("row").to_pylist(), batch.column("text"), batch.column("key").type
            sizes_of, out = [], []
            for row, t in zip(rows, texts, strict=True):
                t = t.as_py()
                hashes = word_hashes(t)
                sizes_of.append(len(hashes))
                for at, value, ahead, around in found(t, hashes):
                    out.append((row, len(hashes), at, value, ahead, around))
                    if len(out) == OUT:
                        c = list(zip(*out, strict=True))
                        yield told([c[0], None, *c[1:]], len(out))
                        out = []
            if out:
                c = list(zip(*out, strict=True))
                yield told([c[0], None, *c[1:]], len(out))
            heads = [batch.column("row"), batch.column("key"), pa.array(sizes_of, pa.int64())]
            blank = [pa.nulls(len(rows), t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.string())]
            yield pa.RecordBatch.from_arrays(heads + blank, names)

    asked = docs.select(F.monotonically_increasing_id().alias("row"), col(key).alias("key"), col(text).alias("text"))
    return asked.mapInArrow(run, schema)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    width: int = WIDTH,
) -> DataFrame:
    """One row per document: key, n_words, n_hit, n_items, items (their keys as sorted strings), contaminated.

    A window is `window` consecutive words of an item; an item of fewer words, but not none, is
    one window. A word of a document inside any occurrence of a window is hit; n_items counts the
    items with a window that occurs. Null and empty texts have no words. Repeated documents each
    have a row; rows of one item key are one item, those without a key mark words but are no
    item. Without items nothing is hit. Shingles have `width` words, or all of a shorter window.
    """
    held = durable(_windows(items, item_key, item_text, window, width), "windows")
    different = held.groupBy("win").agg(*[F.first(c).alias(c) for c in ("n", "words", "hashes")])
    tokens = durable(different.select("win", "n", "words", F.posexplode("hashes").alias("at", "hash")), "tokens")
    size = F.least("n", F.lit(width))
    sizes = sorted(r[0] for r in tokens.select(size).distinct().collect())  # 1 to `width`
    counts = settled(lambda: _counts(docs, text, tokens.select("hash").distinct(), sizes), "counts")
    # a window with a shingle that no document holds cannot occur
    ranked = tokens.join(counts, "hash", "left").groupBy("win").agg(
        F.first("n").alias("n"),
        F.first("words").alias("window"),
        F.count("seen").alias("present"),
        F.count("*").alias("of"),
        F.min(F.struct("seen", "at", "hash")).alias("rarest"),
    )
    prefixes = durable(ranked.where("present = of").select("win", "n", "window", "rarest.at", "rarest.hash"), "prefixes")
    release(tokens, counts)
    notes = durable(_places(docs, key, text, prefixes, sizes, window, width), "places")
    start = (F.col("place") - F.col("at")).alias("start")
    here = F.array_join(F.slice(F.split("words", " "), F.col("ahead") - F.col("at") + 1, F.col("n")), " ")
    matched = (
        notes.where(F.col("place").isNotNull())
        .join(prefixes, "hash")
        .where((F.col("at") <= F.col("ahead")) & (F.col("place") - F.col("at") + F.col("n") <= F.col("n_words")))
        .where(here == F.col("window"))
        .select("row", start, F.col("n").cast("long").alias("n"), "win")
    )
    matched = durable(matched, "matched")
    # both lists are bounded by one document: its words, and the items that it holds
    spans = F.sort_array(F.collect_set(F.struct("start", (F.col("start") + F.col("n")).alias("end"))))
    nothing = F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("hit"))
    covered = F.aggregate(
        spans,
        nothing,
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["hit"] + F.greatest(F.lit(0).cast("long"), s["end"] - F.greatest(acc["end"], s["start"]))).alias("hit"),
        ),
        lambda acc: acc["hit"],
    )
    hits = matched.groupBy("row").agg(covered.alias("n_hit"))
    named = held.where(F.col("item").isNotNull()).select("win", F.col("item").cast("string").alias("item")).distinct()
    told = matched.select("row", "win").distinct().join(named, "win").select("row", "item").distinct()
    told = told.groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    heads = notes.where(F.col("place").isNull()).select("row", F.col("key").alias(key), "n_words")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    found = F.coalesce("items", F.array().cast("array<string>"))
    return (
        heads.join(hits, "row", "left")
        .join(told, "row", "left")
        .select(
            col(key),
            "n_words",
            n_hit.alias("n_hit"),
            F.size(found).cast("long").alias("n_items"),
            found.alias("items"),
            (n_hit > 0).alias("contaminated"),
        )
    )


def without_contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """The rows of `docs` whose key is that of no contaminated document; rows without a key stay."""
    found = contamination(docs, items, key, **options).where("contaminated").select(col(key).alias("_hit")).distinct()
    return docs.join(found, col(key) == F.col("_hit"), "left_anti")
