"""Line dedup by a suffix array over line ids, built with distributed prefix doubling.

The corpus is the sequence of all non-blank lines in the order of the documents. Level 0 ranks
the line ids; level k + 1 ranks the pairs (rank at i, rank at i + 2**k), so equal ranks at level k
mean equal runs of 2**k lines. Suffixes that differ from all others leave the work at once: they
start no repeated run. Suffixes that share their first n lines form an interval of the suffix
array, told by two overlapping ranks of the level below n.

A run is a stretch of lines that also stands, line for line, at an earlier place. Every line that
lies in a run of at least `min_words` words is deleted. For that the shortest stretch of that many words
that starts at each line, and the shortest that ends there, are looked up: their intervals cover
exactly the lines of all maximal runs, and their lengths bound the number of levels by
log2(min_words).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import col, fresh, thrifty, told_apart, with_positions, with_rows
from eventmart.session import durable, release, settled

MIN_WORDS = 50
_LINE_BITS = 27  # lines of one document; the bits above number the documents
_SPACE = b" \t\r\x0b\x0c"
_LINE = "[^\n \t\r\x0b\x0c][^\n]*"  # a line that is not blank, from its first character that is no space
_HEAD = "^[\n \t\r\x0b\x0c]*\n"  # the blank lines above the first line


def _lines(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split(b"\n")


def shortest_stretches(words: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """For each line the length of the shortest stretch of `least` words from it and up to it; 0 without one."""
    total = np.concatenate([[0], np.cumsum(words)])
    n = len(words)
    end = np.searchsorted(total, total[:-1] + least)
    start = np.searchsorted(total, total[1:] - least, side="right") - 1
    at = np.arange(n)
    return np.where(end <= n, end - at, 0), np.where(start >= 0, at - start + 1, 0)


def _line_ids(min_words: int):
    """Arrays over the non-blank lines of a text: 128-bit id in two halves, shortest stretches."""

    @F.pandas_udf("h1 array<long>, h2 array<long>, ahead array<int>, back array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in thrifty(batches):
            out: dict[str, list] = {"h1": [], "h2": [], "ahead": [], "back": []}
            for text in batch:
                lines = [s for x in _lines(text) if (s := x.strip(_SPACE))]
                if len(lines) >> _LINE_BITS:
                    raise ValueError(f"a document has more than 2**{_LINE_BITS} lines")
                words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
                ahead, back = shortest_stretches(words, min_words)
                ids = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, lines)), "<i8").reshape(-1, 2)
                for name, values in (("h1", ids[:, 0]), ("h2", ids[:, 1]), ("ahead", ahead.astype(np.int32)), ("back", back.astype(np.int32))):
                    out[name].append(values)
            yield pd.DataFrame(out)

    return run


def _rank(suffixes: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """Suffixes whose keys are shared, with `rank`: the place of the keys in their order.

    Hot keys are combined before the shuffle; the join splits them.
    """
    shared = suffixes.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    ranks = with_positions(shared, keys, rank)
    return durable(suffixes.join(ranks, keys).drop(*keys), rank)


def repeated_lines(lines: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(pos long) of every line to delete; `lines` has pos, h1, h2, ahead, back."""
    level = _rank(lines.select("pos", "h1", "h2", "ahead", "back"), ["h1", "h2"], "rank")
    ahead = level.where("ahead > 0").select("pos", F.col("ahead").alias("len"))
    back = level.where("back > 0").select((F.col("pos") - F.col("back") + 1).alias("pos"), F.col("back").alias("len"))
    stretches = durable(ahead.union(back).distinct(), "stretches")
    level = level.select("pos", "rank")
    longest = stretches.agg(F.max("len")).first()[0] or 0
    found, width = [], 1
    while width <= longest:
        own = stretches.where(F.col("len").between(width, 2 * width - 1))
        tail = level.select((F.col("pos") - width).alias("before"), F.col("rank").alias("tail"))
        ends = level.select(F.col("pos").alias("last"), F.col("rank").alias("tail"))
        named = (
            own.join(level, "pos")
            .withColumn("last", F.col("pos") + F.col("len") - width)
            .join(ends, "last")
            .select("pos", "len", "rank", "tail")
        )
        interval = ["len", "rank", "tail"]
        first = named.groupBy(*interval).agg(F.min("pos").alias("first"), F.count("*").alias("n")).where("n > 1")
        copies = named.join(first.drop("n"), interval).where("pos > first").select("pos", "len")
        found.append(durable(copies, "copies"))
        width *= 2
        if width <= longest:
            pairs = level.join(tail, F.col("pos") == F.col("before")).select("pos", "rank", "tail")
            level = _rank(pairs.withColumnRenamed("rank", "head"), ["head", "tail"], "rank")
    if not found:
        return lines.select("pos").limit(0)
    copies = reduce(DataFrame.union, found)
    return copies.select(F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("len") - 1)).alias("pos")).distinct()


def _without(texts: pd.Series, gone: pd.Series) -> pd.Series:
    """Texts without the given non-blank lines; a blank line shares the fate of the line above."""
    out = []
    for text, numbers in zip(texts, gone, strict=True):
        if text is None:
            out.append(None)
            continue
        dropped, kept, seq, keep = set(numbers.tolist()), [], -1, True
        for line in text.split("\n"):
            if line.encode("utf-8", "surrogatepass").strip(_SPACE):
                seq += 1
                keep = seq not in dropped
            if keep:
                kept.append(line)
        out.append("\n".join(kept))
    return pd.Series(out)


def dedup_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """All rows of `docs` with repeated runs taken out of the text, plus n_lines and n_removed.

    Earlier means: a smaller key (null keys come last; equal keys in any fixed order), or further up in
    the same text. Lines are compared without surrounding ASCII white space; blank lines are no lines.
    n_lines counts the lines before. Null and empty texts have no lines and stay as they are; a
    text whose lines are all deleted becomes empty. Columns named n_lines or n_removed are replaced.
    """
    docs = docs.select([col(c) for c in docs.columns if c.lower() not in ("n_lines", "n_removed")])
    rows, row = with_rows(docs)
    number, order, items, out, count, whole = (fresh(rows, f"_{x}") for x in ("number", "order", "items", "gone", "count", "whole"))

    def notes_of_rows() -> DataFrame:
        numbered = with_positions(rows.select(col(row), col(key).alias(order)), [order, row], number).select(row, number)
        split = rows.select(col(row), _line_ids(min_words)(col(text)).alias(items))
        arrays = F.arrays_zip(*[F.col(f"{items}.{c}").alias(c) for c in ("h1", "h2", "ahead", "back")])
        split = durable(split.select(row, F.posexplode(arrays).alias("seq", "line")).select(row, "seq", "line.*"), "lines")
        place = F.shiftleft(col(number), _LINE_BITS).bitwiseOR(F.col("seq").cast("long"))
        lines = durable(split.join(numbered, row).withColumn("pos", place), "placed")
        release(split)
        gone = repeated_lines(lines, min_words).select(
            F.shiftright("pos", _LINE_BITS).alias(number), F.col("pos").bitwiseAND(F.lit((1 << _LINE_BITS) - 1)).cast("int").alias("seq")
        )
        # both lists are bounded by the lines of one document
        listed = gone.groupBy(number).agg(F.collect_list("seq").alias(out))
        held = lines.groupBy(number).agg((F.max("seq") + 1).alias(count))
        named = listed.join(held, number).join(numbered, number)
        return named.select(row, out, (F.size(out) == F.col(count)).alias(whole))

    notes = settled(notes_of_rows, "notes")
    maybe, other = told_apart(rows, row, notes.select(row))
    # a text that loses all lines needs no list of them; only the other texts that change are shuffled
    lost = notes.where(whole).select(row)
    hit, kept = told_apart(maybe, row, lost)
    wrong = durable(hit.select(row).join(lost, row, "left_anti"), "wrong")
    doubt, sure = told_apart(hit, row, wrong)
    joined = kept.union(doubt).join(notes.drop(whole), row, "left")
    touched = col(out).isNotNull()
    # only the texts that change go through Python
    shorter = F.pandas_udf(_without, "string")(F.when(touched, col(text)), col(out))
    cut = F.when(touched, shorter).otherwise(col(text))
    n_lines = F.coalesce(F.regexp_count(col(text), F.lit(_LINE)), F.lit(0)).cast("long").alias("n_lines")
    changed = joined.select(
        *[cut.alias(c) if c.lower() == text.lower() else col(c) for c in docs.columns],
        n_lines,
        F.when(touched, F.size(col(out))).otherwise(0).cast("long").alias("n_removed"),
    )
    head = F.regexp_extract(col(text), _HEAD, 0)
    emptied = sure.select(
        *[F.substring(head, F.lit(1), F.length(head) - 1).alias(c) if c.lower() == text.lower() else col(c) for c in docs.columns],
        n_lines,
        n_lines.alias("n_removed"),
    )
    same = other.select(*map(col, docs.columns), n_lines, F.lit(0).cast("long").alias("n_removed"))
    return same.union(changed).union(emptied)
