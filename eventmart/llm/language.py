"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of n-grams per language are summed over all labelled rows; the resulting matrix of log
probabilities (languages x buckets, its size set by `buckets` and the number of languages, not
by the corpus) is broadcast, and batches of texts are scored in numpy by gathering the rows of
their n-grams and adding them up per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import col, thrifty

ORDERS = (1, 2, 3, 4)
BITS = 15
SLICE = 1 << 17  # characters hashed at a time; the last ones of a slice are carried into the next
UNKNOWN = "und"


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def _slices(texts: list[str]) -> Iterator[tuple[list[int], list[str], bool]]:
    """Groups of (text number, piece) of bounded length, and whether the last text goes on in the next.

    A space ends every text. A full slice ends its group, so a text goes on in the first piece only.
    """
    owners, pieces, size = [], [], 0
    for i, text in enumerate(texts):
        text = text.lower()
        for at in range(0, len(text), SLICE):
            piece = text[at : at + SLICE]
            goes_on = at + SLICE < len(text)
            owners.append(i)
            pieces.append(piece if goes_on else piece + " ")
            size += len(piece) + 1
            if size >= SLICE:
                yield owners, pieces, goes_on
                owners, pieces, size = [], [], 0
    if pieces:
        yield owners, pieces, False


def hashed_ngrams(texts: list[str], bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of arrays: bucket of each n-gram, number of the text it belongs to.

    Letters are lower-cased; a run of other characters counts as one space after a word.
    """
    carried = np.zeros(0, np.uint32)
    for owners, pieces, goes_on in _slices(texts):
        fresh = np.frombuffer("".join(pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
        points = np.concatenate([carried, fresh])
        lengths = np.array([len(p) for p in pieces])
        lengths[0] += len(carried)
        owner = np.repeat(np.arange(len(pieces)), lengths)
        letter = _letters()[points]
        keep = letter.copy()
        keep[1:] |= letter[:-1] & (owner[1:] == owner[:-1])
        points = np.where(letter, points, np.uint32(32))[keep]
        owner = owner[keep]
        number = np.asarray(owners)
        old = int(keep[: len(carried)].sum())  # n-grams that end before here were counted
        # one more than an n-gram needs: a leading space has no word before it and goes
        carried = points[-max(ORDERS) :][owner[-max(ORDERS) :] == len(pieces) - 1] if goes_on else carried[:0]
        hashes = np.zeros(len(points), np.uint32)
        for n in range(1, max(ORDERS) + 1):
            if len(points) < n:
                break
            tail = points[n - 1 :]
            hashes = (hashes[: len(tail)] + tail + np.uint32(n)) * np.uint32(0x9E3779B1)
            if n in ORDERS:
                whole = owner[: len(tail)] == owner[n - 1 :]
                whole[: max(0, old - n + 1)] = False
                mixed = (hashes ^ (hashes >> np.uint32(15))) * np.uint32(0x85EBCA77)
                bucket = (mixed >> np.uint32(32 - bits)).astype(np.int64)
                yield bucket[whole], number[owner[n - 1 :][whole]]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]  # sorted; ties go to the first
    prior: np.ndarray
    log_prob: np.ndarray  # buckets x languages
    bits: int


def _count_batches(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        rows: dict[str, int] = {}
        for batch in thrifty(batches):
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(texts, langs, strict=True):
                by_lang.setdefault(lang, []).append(text)
            for lang, own in by_lang.items():
                rows[lang] = rows.get(lang, 0) + len(own)
                total = counts.setdefault(lang, np.zeros(1 << bits, np.int64))
                for bucket, _ in hashed_ngrams(own, bits):
                    total += np.bincount(bucket, minlength=1 << bits)
        for lang, total in counts.items():
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array([lang] * (len(used) + 1), pa.string()),
                    "bucket": pa.array(np.append(used, -1), pa.int32()),
                    "n": pa.array(np.append(total[used], rows[lang]), pa.int64()),
                }
            )

    return run


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", bits: int = BITS, alpha: float = 0.5) -> LanguageModel:
    """Learn from every row whose text and language are not null.

    The driver receives at most (languages x 2**bits) sums. Without such rows the model knows
    no language and predicts `und` for every text.
    """
    rows = labelled.select(col(text).alias("text"), col(lang).alias("lang")).dropna()
    sums = (
        rows.mapInArrow(_count_batches(bits), "lang string, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = tuple(sorted(sums["lang"].unique()))
    counts, docs = np.full((1 << bits, len(languages)), alpha), np.zeros(len(languages))
    where = np.searchsorted(np.array(languages, object), sums["lang"].to_numpy(object)) if len(sums) else []
    for at, bucket, n in zip(where, sums["bucket"], sums["n"], strict=True):
        if bucket < 0:
            docs[at] = n
        else:
            counts[bucket, at] += n
    prior = np.log(docs / max(docs.sum(), 1))
    return LanguageModel(languages, prior, np.log(counts / counts.sum(axis=0)), bits)


def score_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Most probable language of each text and its posterior probability."""
    known = [t if has_letter(t) and model.languages else "" for t in texts]
    totals = np.tile(model.prior, (len(texts), 1))
    for bucket, owner in hashed_ngrams(known, model.bits):
        if len(bucket):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            totals[owner[first]] += np.add.reduceat(model.log_prob[bucket], first, axis=0)
    if not model.languages:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    best = totals.argmax(axis=1)
    score = 1 / np.exp(totals - totals.max(axis=1, keepdims=True)).sum(axis=1)
    empty = np.array([not t for t in known], bool)
    score[empty] = 0.0
    return [UNKNOWN if e else model.languages[b] for b, e in zip(best, empty, strict=True)], score


def predict(frame: DataFrame, model: LanguageModel, text: str = "text") -> Column:
    """Column struct<lang_pred, score> for the texts of `frame`.

    Null, empty and letterless texts get `und` with score 0. A text with letters gets the
    language of the largest posterior; ties go to the alphabetically first language.
    """
    shared = frame.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in thrifty(batches):
            lang, score = score_texts(shared.value, batch.tolist())
            yield pd.DataFrame({"lang_pred": pd.Series(lang, dtype=object), "score": score})

    return run(col(text))
