"""Corpus preparation in five stages over `documents`; each stage's output is the next one's input.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
"""

from __future__ import annotations

from functools import partial

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import language, lines, packing, pii, simhash
from eventmart.llm.common import col, fresh
from eventmart.session import configure, release, settled

LEAST_SURE = 0.5


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from all labelled rows; rows without a letter or with a posterior of 0.5 or less go."""
    configure(spark)
    guess = fresh(docs, "_guess")
    guessed = docs.withColumn(guess, language.predict(docs, language.fit(docs)))
    sure = (F.col(f"{guess}.lang_pred") != language.UNKNOWN) & (F.col(f"{guess}.score") > LEAST_SURE)
    return guessed.where(sure).select(*map(col, docs.columns))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs of 50 words or more go; so does a document that loses all its lines."""
    configure(spark)
    cut = lines.dedup_lines(docs)
    whole = (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines"))
    return _counted(cut.where(whole), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a Jaccard similarity of 0.8 or more over 5-word shingles the smallest doc_id stays."""
    configure(spark)
    return simhash.keep_unlike(docs, width=5, percent=80)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found identifiers become [EMAIL], [IP], [CARD] or [PHONE]; no document goes."""
    configure(spark)
    return _counted(pii.redact(docs), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of at most 1024 tokens."""
    configure(spark)
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def _counted(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs`, with n_chars of the new text where there is such a column."""
    return out.select(
        *[F.length("text").cast(kind).alias(c) if c == "n_chars" else col(c) for c, kind in docs.dtypes]
    )


STAGES = [
    ("language_id", keep_identified),
    ("line_dedup", drop_repeated_lines),
    ("simhash_dedup", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

# tokenisers, fitted models and component search have no SQL; tests compare with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    made = []
    for name, stage in STAGES:
        # only the result of a stage stays, and only until the next one has read it
        docs = settled(partial(stage, spark, docs, sf_dir), name)
        release(*made)
        made = [docs]
    return docs
