"""Byte-level BPE encoding and decoding by recursive DuckDB queries inside Spark tasks.

Each task splits its texts into words and keeps one row per token and position for those words
that it has not met yet. A recursive query joins neighbouring tokens with the merge table and
contracts the pair of lowest rank in every word, leftmost first, until no pair is left;
an ordered aggregation then reads the ids off and decodes them to bytes. Words repeat, so a task
encodes each once and puts the texts together from the results.

In long words one step contracts all disjoint places of the lowest-ranked pair, counted from the
left. A merge only creates pairs of higher rank, so that equals contracting them one by one, and
a long run of one character takes logarithmically many steps. Before that a long word is cut where
two bytes meet that no token holds side by side, as no merge can cross such a place.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm.common import col
from eventmart.llm.pretokens import grouped_runs

SHORT = 255  # bytes; longer words are contracted one at a time
STEPS = 48  # of one recursive query over a long word; it goes on in the next
ROWS = 1 << 16  # token rows that one recursive query starts with
CACHED = 250_000  # words in each of the two generations that a worker keeps

# one contraction per word and step; a row's key is word * 4096 + position
_SHORT = """
WITH RECURSIVE run AS (
  SELECT 0 AS step, key, tok FROM (SELECT (word::BIGINT << 12) | pos AS key, tok FROM start)
  UNION ALL
  SELECT run.step + 1, run.key, CASE WHEN run.key = best.place THEN best.id ELSE run.tok END
  FROM run JOIN (
    SELECT key >> 12 AS word, min((id::BIGINT << 12) | (key & 4095)) AS first, (first >> 12)::INT AS id,
           (word << 12) | (first & 4095) AS place,
           arg_min(nxt_key, (id::BIGINT << 12) | (key & 4095)) AS gone
    FROM (SELECT key, tok, lead(tok) OVER (ORDER BY key) AS nxt, lead(key) OVER (ORDER BY key) AS nxt_key FROM run) pair
    JOIN merges ON l = tok AND r = nxt
    WHERE key >> 12 = nxt_key >> 12 GROUP BY 1
  ) best ON run.key >> 12 = best.word
  WHERE run.key <> best.gone
),
ends AS (SELECT key >> 12 AS word, max(step) AS step FROM run GROUP BY 1)
SELECT ends.word::INT AS word, (run.key & 4095)::INT AS pos, run.tok
FROM run JOIN ends ON run.step = ends.step AND run.key >> 12 = ends.word
"""

# long words: every disjoint place of the word's lowest pair in one step, counted from the left
_LONG = f"""
WITH RECURSIVE run AS (
  SELECT 0 AS step, word, pos, tok FROM start
  UNION ALL
  SELECT step + 1, word, pos, CASE WHEN take THEN best ELSE tok END
  FROM (
    SELECT *, coalesce(lag(take) OVER line, false) AS eaten
    FROM (
      SELECT *, hit AND (idx - coalesce(max(CASE WHEN hit THEN NULL ELSE idx END) OVER line, 0)) % 2 = 1 AS take
      FROM (
        SELECT *, coalesce(merged = best, false) AS hit
        FROM (
          SELECT p.*, m.id AS merged, min(m.id) OVER (PARTITION BY word) AS best
          FROM (
            SELECT *, lead(tok) OVER line AS nxt, row_number() OVER line AS idx
            FROM run WHERE step < {STEPS}
            WINDOW line AS (PARTITION BY word ORDER BY pos)
          ) p LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt
        ) WHERE best IS NOT NULL
      ) WINDOW line AS (PARTITION BY word ORDER BY pos)
    ) WINDOW line AS (PARTITION BY word ORDER BY pos)
  ) WHERE NOT eaten
),
ends AS (SELECT word, max(step) AS step FROM run GROUP BY word)
SELECT run.step, run.word, run.pos, run.tok FROM run JOIN ends USING (word, step)
"""

_READ = """
SELECT word, count(*) AS n, string_agg(tok::VARCHAR, ',' ORDER BY pos) AS ids,
       string_agg(hex, '' ORDER BY pos) AS hex
FROM done JOIN vocabulary ON id = tok GROUP BY word
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a tiktoken vocabulary file."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class WordEncoder:
    """Encodes words with one in-process DuckDB database that holds the merge table."""

    def __init__(self, data: bytes):
        self.ranks = read_ranks(data)
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.neighbours = np.zeros(1 << 16, bool)  # pairs of bytes that stand side by side in a token
        self.neighbours[[a * 256 + b for t in self.ranks for a, b in zip(t, t[1:])]] = True
        pairs = [
            (self.ranks[t[:i]], self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        left, right, merged = (pa.array(x, pa.int32()) for x in zip(*pairs, strict=True))
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._store("merges", {"l": left, "r": right, "id": merged})
        self._store(
            "vocabulary",
            {"id": pa.array(self.ranks.values(), pa.int32()), "hex": pa.array([t.hex() for t in self.ranks])},
        )
        self.known: dict[str, tuple[int, str, bytes]] = {}  # word -> number of ids, ids, decoded bytes
        self.older: dict[str, tuple[int, str, bytes]] = {}

    def _store(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def learn(self, words: list[str]) -> None:
        """Encode new words and remember them."""
        whole, plain, parts = [], [], {}
        for word in words:
            data = word.encode()
            if data in self.ranks:  # a whole token is never merged on
                whole.append((word, data))
            elif len(data) <= SHORT:
                plain.append((word, data))
            else:
                parts[word] = self._independent(data)
        if whole:
            tokens = np.array([self.ranks[d] for _, d in whole], np.int32)
            places = np.arange(len(whole), dtype=np.int32)
            self._store("done", {"word": pa.array(places), "pos": pa.array(np.zeros_like(places)), "tok": pa.array(tokens)})
            self._read(whole, self.known)
        self._in_chunks(plain, self.known)
        found: dict[bytes, tuple[int, str, bytes]] = {}
        self._in_chunks([(p, p) for p in sorted({p for own in parts.values() for p in own})], found)
        for word, own in parts.items():
            n, ids, data = zip(*map(found.__getitem__, own), strict=True)
            self.known[word] = (sum(n), ",".join(ids), b"".join(data))

    def _independent(self, data: bytes) -> list[bytes]:
        """Parts of a long word between which nothing can merge: no token holds the two bytes at a cut."""
        codes = np.frombuffer(data, np.uint8).astype(np.int32)
        cuts = np.flatnonzero(~self.neighbours[codes[:-1] * 256 + codes[1:]]) + 1
        ends = [0, *cuts.tolist(), len(data)]
        return [data[a:b] for a, b in zip(ends, ends[1:])]

    def _in_chunks(self, given: list[tuple], into: dict) -> None:
        chunk, size = [], 0
        for key, data in given:
            if len(data) > SHORT:
                self._encode([(key, data)], into)
                continue
            chunk.append((key, data))
            size += len(data)
            if size >= ROWS:
                self._encode(chunk, into)
                chunk, size = [], 0
        if chunk:
            self._encode(chunk, into)

    def _encode(self, chunk: list[tuple], into: dict | None = None) -> None:
        lengths = np.array([len(d) for _, d in chunk])
        tokens = self.byte_ids[np.frombuffer(b"".join(d for _, d in chunk), np.uint8)]
        word = np.repeat(np.arange(len(chunk), dtype=np.int32), lengths)
        ends = np.cumsum(lengths)
        pos = (np.arange(len(tokens)) - np.repeat(ends - lengths, lengths)).astype(np.int32)
        self._store("start", {"word": pa.array(word), "pos": pa.array(pos), "tok": pa.array(tokens)})
        if lengths.max() <= SHORT:
            self.db.execute(f"CREATE OR REPLACE TABLE done AS {_SHORT}")
        else:
            self._contract_long()
        self._read(chunk, self.known if into is None else into)

    def _read(self, chunk: list[tuple], into: dict) -> None:
        for at, n, ids, text in self.db.execute(_READ).fetchall():
            into[chunk[at][0]] = (n, ids, bytes.fromhex(text))

    def _contract_long(self) -> None:
        self.db.execute("CREATE OR REPLACE TABLE done (word INT, pos INT, tok INT)")
        while True:
            self.db.execute(f"CREATE OR REPLACE TABLE state AS {_LONG}")
            self.db.execute(f"INSERT INTO done SELECT word, pos, tok FROM state WHERE step < {STEPS}")
            self.db.execute(f"CREATE OR REPLACE TABLE start AS SELECT word, pos, tok FROM state WHERE step = {STEPS}")
            if not self.db.execute("SELECT count(*) FROM start").fetchone()[0]:
                break

    def encode(self, texts: list[str]) -> Iterator[list[tuple[int, list[tuple[int, str, bytes]]]]]:
        """Groups of (text number, encoded words); a long text spreads over several groups."""
        for group in grouped_runs(texts):
            if len(self.known) > CACHED:  # words not met since the last change of generation go
                self.older, self.known = self.known, {}
            known, older = self.known, self.older
            new = {w for _, part in group for w in part if w not in known}
            known.update((w, older[w]) for w in new if w in older)
            self.learn(sorted(w for w in new if w not in older))
            yield [(i, list(map(self.known.__getitem__, part))) for i, part in group]


_encoders: dict[bytes, WordEncoder] = {}


def _encoder(data: bytes) -> WordEncoder:
    """One encoder for each vocabulary and Python worker."""
    key = hashlib.sha256(data).digest()
    if key not in _encoders:
        _encoders[key] = WordEncoder(data)
    return _encoders[key]


def vocabulary_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def encode(spark: SparkSession, text: str, vocabulary: str) -> Column:
    """Column array<int>: the ids of each text. A null text counts as empty: no ids."""
    shared = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))  # one vocabulary file

    @F.pandas_udf("array<int>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = _encoder(shared.value)
        for batch in batches:
            ids: list[list[int]] = [[] for _ in range(len(batch))]
            for group in encoder.encode([t or "" for t in batch]):
                for i, words in group:
                    for _, text_ids, _ in words:
                        ids[i].extend(map(int, text_ids.split(",")))
            yield pd.Series([np.array(x, np.int32) for x in ids])

    return run(col(text))


def decode(spark: SparkSession, ids: str, vocabulary: str) -> Column:
    """Column binary: the bytes that arrays of ids stand for. Null counts as empty.

    An id that the vocabulary lacks is an error.
    """
    shared = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    @F.pandas_udf("binary")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        db = _encoder(shared.value).db
        for batch in batches:
            out = [b""] * len(batch)
            arrays = [np.asarray(x if x is not None else [], np.int32) for x in batch]
            lengths = [len(a) for a in arrays]
            given = pa.table(
                {
                    "doc": pa.array(np.repeat(np.arange(len(arrays)), lengths)),
                    "pos": pa.array(np.concatenate([np.arange(n) for n in lengths] or [np.zeros(0, np.int64)])),
                    "tok": pa.array(np.concatenate(arrays or [np.zeros(0, np.int32)])),
                }
            )
            db.register("ids", given)
            found = db.execute(
                "SELECT doc, string_agg(hex, '' ORDER BY pos), count(*) FROM ids JOIN vocabulary ON id = tok GROUP BY doc"
            ).fetchall()
            db.unregister("ids")
            for doc, text, n in found:
                if n != lengths[doc]:
                    raise ValueError("an id is not in the vocabulary")
                out[doc] = bytes.fromhex(text)
            if sum(n for _, _, n in found) != sum(lengths):
                raise ValueError("an id is not in the vocabulary")
            yield pd.Series(out)

    return run(col(ids))


def round_trip(spark: SparkSession, text: str, vocabulary: str) -> Column:
    """Column struct<n_tokens, ids_sha256, decoded_sha256>: encode, then decode each word's ids.

    ids_sha256 is over the decimal ids joined by commas, decoded_sha256 over the decoded bytes,
    both in lower-case hex. Null and empty texts have no ids and the digests of no bytes.
    """
    shared = spark.sparkContext.broadcast(vocabulary_bytes(vocabulary))

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = _encoder(shared.value)
        for batch in batches:
            n = [0] * len(batch)
            ids = [hashlib.sha256() for _ in n]
            decoded = [hashlib.sha256() for _ in n]
            for group in encoder.encode([t or "" for t in batch]):
                for i, words in group:
                    if words:
                        counts, texts, data = zip(*words, strict=True)
                        ids[i].update((("," if n[i] else "") + ",".join(texts)).encode())
                        decoded[i].update(b"".join(data))
                        n[i] += sum(counts)
            yield pd.DataFrame(
                {
                    "n_tokens": n,
                    "ids_sha256": [h.hexdigest() for h in ids],
                    "decoded_sha256": [h.hexdigest() for h in decoded],
                }
            )

    return run(col(text))


def with_round_trip(frame: DataFrame, text: str, vocabulary: str, into: str) -> DataFrame:
    return frame.withColumn(into, round_trip(frame.sparkSession, text, vocabulary))
