"""Best-two-fit packing of tokenised documents into sequences of bounded length.

A sequence is filled greedily, longest piece first. Where a gap is left, its smallest piece is
taken out again if two pieces not yet packed fill the widened gap more tightly. Pieces are dealt
to groups of bounded size by a hash and packed group by group; each group wastes about one
sequence, so the number of sequences does not depend on how many tasks share the work.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import col, fresh, thrifty, with_rows
from eventmart.llm.pretokens import grouped_runs
from eventmart.session import durable

GROUP = 8192  # pieces packed together on average
CACHED = 100_000  # words kept by a task


class _WordIds(dict):
    """Ids of a word as little-endian bytes; unknown words are encoded on first use."""

    def __init__(self, vocabulary: str):
        whole = json.loads(vocabulary)
        model = whole["model"]
        # byte-level vocabularies write bytes as printable characters
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain}
        shown |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(map(shown.__getitem__, t)): i for t, i in model["vocab"].items() if set(t) <= shown.keys()}
        core = tiktoken.Encoding("words", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._piece = core._core_bpe.encode_single_piece
        added = whole.get("added_tokens", [])
        odd = [t["content"] for t in added if any(t[k] for k in ("single_word", "lstrip", "rstrip"))]
        if odd:
            raise ValueError(f"added tokens with options of their own: {odd}")
        self.added = {t["content"]: np.array([t["id"]], "<u4").tobytes() for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self._split = re.compile("(" + "|".join(map(re.escape, longest)) + ")").split if longest else None

    def parts(self, text: str) -> list[str]:
        """The text between added tokens at even places, added tokens at odd ones."""
        return self._split(text) if self._split else [text]

    def __missing__(self, word: str) -> bytes:
        found = np.array(self._piece(word.encode()), "<u4").tobytes()
        self[word] = found
        return found


_words: dict[int, _WordIds] = {}


def _word_ids(vocabulary: str) -> _WordIds:
    key = zlib.crc32(vocabulary.encode())
    if key not in _words:
        _words[key] = _WordIds(vocabulary)
    return _words[key]


def token_bytes(texts: list[str], vocabulary: str, end: int) -> Iterator[tuple[int, bytes]]:
    """(text number, ids as little-endian unsigned 32-bit), each followed by the id `end`.

    As in the library, an added token of the vocabulary is one id wherever it stands in a text.
    """
    known = _word_ids(vocabulary)
    stop = np.array([end], "<u4").tobytes()
    parts: list[str] = []
    after: list[tuple[int, bytes, bool]] = []  # text, id that follows the part, whether the text ends
    for i, t in enumerate(texts):
        split = known.parts(t or "")
        parts += split[::2]
        after += [(i, known.added[t], False) for t in split[1::2]] + [(i, stop, True)]
    open_parts: list[bytes] = []
    at = 0
    for group in grouped_runs(parts):
        if len(known) > CACHED:
            known.clear()
        for k, part in group:
            while at < k:
                i, ids, ends = after[at]
                open_parts.append(ids)
                if ends:
                    yield i, b"".join(open_parts)
                    open_parts = []
                at += 1
            open_parts.append(b"".join(map(known.__getitem__, part)))
    if texts:
        yield after[at][0], b"".join([*open_parts, stop])


def token_pieces(docs: DataFrame, vocabulary_path: str, text: str = "text", capacity: int = 1024, end: int = 2, ids: bool = False) -> DataFrame:
    """One row per piece of each document, with the columns of `docs` except the text.

    Adds piece (from 0), start (the document's ids before it), length, ids_crc32 and, if `ids`,
    token_ids (array<int>). A document of more than `capacity` ids is cut so that only its first
    piece is shorter. A null or empty text is the single id `end`. Strings of added tokens in a
    text are those tokens, as in the library.
    """
    spark = docs.sparkSession
    with open(vocabulary_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())  # one vocabulary file
    columns = [c for c in docs.columns if c.lower() != text.lower()]
    added = ("piece", "start", "length", "ids_crc32", "token_ids")
    columns = [c for c in columns if c.lower() not in added]
    kind = "n long, crc array<long>" + (", ids array<array<int>>" if ids else "")

    @F.pandas_udf(kind)
    def cut(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in thrifty(batches):
            n, crc, kept = [], [], []
            for _, data in token_bytes(batch.tolist(), shared.value, end):
                total = len(data) // 4
                first = total % capacity or capacity
                ends = range(first, total + 1, capacity)
                parts = [data[4 * max(0, e - capacity) if e > first else 0 : 4 * e] for e in ends]
                n.append(total)
                crc.append([zlib.crc32(p) for p in parts])
                if ids:
                    kept.append([np.frombuffer(p, "<u4").astype(np.int32) for p in parts])
            out = {"n": n, "crc": crc} | ({"ids": kept} if ids else {})
            yield pd.DataFrame(out)
        # a worker outlives its task; only the vocabulary stays with it
        _word_ids(shared.value).clear()

    made, at = fresh(docs, "_made"), fresh(docs, "_at")
    rows = docs.withColumn(made, cut(col(text)))
    rows = rows.select(*map(col, columns), made, F.posexplode(f"{made}.crc").alias(at, "ids_crc32"))
    total = F.col(f"{made}.n")
    first = F.when(total % capacity == 0, capacity).otherwise(total % capacity)
    piece = F.col(at)
    out = rows.select(
        *map(col, columns),
        piece.alias("piece"),
        F.when(piece == 0, F.lit(0)).otherwise(first + (piece - 1) * capacity).cast("long").alias("start"),
        F.when(piece == 0, first).otherwise(capacity).cast("long").alias("length"),
        "ids_crc32",
        *([F.col(f"{made}.ids")[piece].alias("token_ids")] if ids else []),
    )
    return out


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Lengths per bin, in the order they are laid down. Lengths are 1..capacity."""
    counts = np.bincount(lengths, minlength=capacity + 1).tolist()
    sizes = [s for s in range(1, capacity + 1) if counts[s]]
    left = len(lengths)

    def take(size: int) -> None:
        counts[size] -= 1
        if not counts[size]:
            del sizes[bisect_right(sizes, size) - 1]

    def give(size: int) -> None:
        if not counts[size]:
            insort(sizes, size)
        counts[size] += 1

    bins = []
    while left:
        gap, packed = capacity, []
        while gap and sizes and sizes[0] <= gap:
            size = sizes[bisect_right(sizes, gap) - 1]
            take(size)
            packed.append(size)
            gap -= size
        if gap and sizes and len(packed) > 1:
            smallest = packed[-1]
            room, best = gap + smallest, (smallest, 0, 0)
            low, high = 0, bisect_right(sizes, room) - 1
            while low <= high and best[0] < room:
                pair = sizes[low] + sizes[high]
                if pair > room or (low == high and counts[sizes[low]] < 2):
                    high -= 1
                    continue
                if pair > best[0]:
                    best = (pair, sizes[high], sizes[low])
                low += 1
            if best[1]:
                packed.pop()
                give(smallest)
                for size in best[1:]:
                    take(size)
                    packed.append(size)
        left -= len(packed)
        bins.append(packed)
    return bins


def pack(pieces: DataFrame, order: list[str], length: str = "length", capacity: int = 1024, group: int = GROUP) -> DataFrame:
    """Adds sequence_id and offset (gapless from 0) to every row of `pieces`.

    `length` is 1..capacity; other values are an error. Among pieces of equal length, the order
    of `order` decides. Repeated rows are pieces of their own; an empty frame stays empty.
    Input columns named sequence_id or offset are replaced.
    """
    pieces = pieces.select([col(c) for c in pieces.columns if c.lower() not in ("sequence_id", "offset")])
    rows, row = with_rows(pieces)
    groups = max(1, -(-rows.count() // group))
    where = fresh(rows, "_group")
    keys = rows.select(
        F.pmod(F.xxhash64(row), F.lit(groups)).alias(where), row, col(length).cast("long").alias("_length"),
        *[col(c).alias(f"_order{i}") for i, c in enumerate(order)],
    )
    schema = f"`{row}` long, sequence_id long, offset long"

    def run(table: pa.Table) -> pa.Table:
        size = table["_length"].to_numpy()
        if len(size) and not 1 <= size.min() <= size.max() <= capacity:
            raise ValueError("a length is outside 1..capacity")
        by = [("_length", "ascending"), *((f"_order{i}", "ascending") for i in range(len(order))), (row, "ascending")]
        table = table.sort_by(by)
        bins = best_two_fit(size, capacity)
        flat = np.array([s for b in bins for s in b], np.int64)
        number = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
        ends = np.cumsum(flat)
        start = ends - flat
        offset = start - start[np.flatnonzero(np.append(True, number[1:] != number[:-1]))][number]
        slots = np.argsort(flat, kind="stable")
        base = (table[where][0].as_py() << 32) if len(flat) else 0
        return pa.table({row: table[row], "sequence_id": number[slots] + base, "offset": offset[slots]})

    placed = keys.groupBy(where).applyInArrow(run, schema)
    return rows.join(placed, row).drop(row)


def sequences(packed: DataFrame) -> DataFrame:
    """Token ids of each sequence, from `pack` over pieces that kept their `token_ids`."""
    laid = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "token_ids"))).alias("laid"))
    return laid.select("sequence_id", F.flatten("laid.token_ids").alias("token_ids"))


def pack_documents(docs: DataFrame, vocabulary_path: str, key: str = "doc_id", text: str = "text", capacity: int = 1024, end: int = 2) -> DataFrame:
    """Pieces of all documents with their places: key, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = durable(token_pieces(docs.select(col(key), col(text)), vocabulary_path, text, capacity, end), "pieces")
    return pack(pieces, [key, "piece"], capacity=capacity)
