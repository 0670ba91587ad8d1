"""Searches, sharding, shared helpers and the pipeline against brute force and edge cases."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventmart.llm import hilbert, sharding, topk
from eventmart.llm.common import with_positions
from eventmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls, zeros, non-finite parts, repeated rows, a common vector and integer ties."""
    rng = np.random.default_rng(2)
    made = [[float(x) for x in v] for v in rng.integers(-3, 4, (160, 4)) / 2]
    made[40:100] = [[0.5, 1.0, -0.5, 2.0]] * 60
    rows = [(i, v, 1) for i, v in enumerate(made)]
    rows += [(200, None, 1), (220, [1.0, None, 2.0, 0.0], 1), (240, [math.nan] * 4, 1), (260, [math.inf, 0.0, 0.0, 0.0], 1)]
    rows += [(280, [0.0] * 4, 1), (300, [], 1), (None, [1.0] * 4, 1), rows[3], rows[20]]
    return spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("vector", F.lit(2))


def _taking_part(frame, zero: bool):
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in frame.collect() if r.vec_id is not None and r.embedding and None not in r.embedding]
    return [(i, v) for i, v in rows if np.isfinite(v).all() and (zero or v.any())]


def _best(rows, score, k):
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            found = sorted((-score(v, w), j) for j, w in rows if j != i)
            out[i] = [(j, -s) for s, j in found[:k]]
    return out


def _by_query(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def _whole(v):
    return np.floor(64 * v).astype(np.int64)


def test_exact_top_k_equals_brute_force(spark, awkward, monkeypatch):
    rows = _taking_part(awkward, zero=True)
    want = _best(rows, lambda a, b: int(_whole(a) @ _whole(b)), 20)
    for size in (7, 512):  # many blocks, spans and query groups; one of each
        for name, value in (("ROWS", size), ("SPAN", 3), ("QUERIES", 2), ("WIDE", 5)):
            monkeypatch.setattr(topk, name, value)
        got = _by_query(topk.exact_top_k(topk.integer_vectors(awkward, "vec_id", "embedding", 64), F.col("id") % 20 == 0, 20))
        # a repeated candidate row counts each time, a query once
        assert got == want


def test_exact_top_k_with_large_weights(spark):
    big = float(2**30)
    rows = [(0, [big, -big]), (1, [big, -big + 1]), (2, [big + 1, -big]), (20, [-1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    vectors = topk.integer_vectors(frame, "vec_id", "embedding", 1)
    got = _by_query(topk.exact_top_k(vectors, F.col("id") % 20 == 0, 2))
    score = lambda a, b: sum(int(x) * int(y) for x, y in zip(a, b, strict=True))
    assert got == _best(rows, score, 2)


def _clustered(spark, clusters, each, width=32):
    """(vec_id, embedding): points close about distinct directions."""
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(clusters, width))
    points = np.repeat(centres, each, axis=0) + rng.normal(size=(clusters * each, width)) * 0.05
    points /= np.linalg.norm(points, axis=1)[:, None]
    ids = rng.permutation(len(points))
    rows = [(int(i), v.tolist()) for i, v in zip(ids, points, strict=True)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_exact_top_k_moves_few_blocks_of_clustered_vectors(spark, monkeypatch):
    for name, value in (("ROWS", 64), ("SPAN", 4), ("QUERIES", 16)):
        monkeypatch.setattr(topk, name, value)
    frame = _clustered(spark, 20, 256)
    cells = []
    made = topk._cells
    monkeypatch.setattr(topk, "_cells", lambda *a: cells.append(made(*a)) or cells[-1])
    got = _by_query(topk.exact_top_k(topk.integer_vectors(frame, "vec_id", "embedding", 64), F.col("id") % 20 == 0, 10))
    rows = [(r.vec_id, np.array(r.embedding)) for r in frame.collect()]
    assert got == _best(rows, lambda a, b: int(_whole(a) @ _whole(b)), 10)
    blocks, parts = 20 * 256 // 64, 256 // 16
    assert cells[0].count() < blocks * parts / 2


def test_searches_without_rows_or_queries(spark, awkward):
    empty = awkward.limit(0)
    vectors = topk.integer_vectors(empty, "vec_id", "embedding", 64)
    assert topk.exact_top_k(vectors, F.col("id") % 20 == 0, 20).count() == 0
    assert hilbert.nearest(empty, F.col("id") % 20 == 0, 20).count() == 0
    some = topk.integer_vectors(awkward, "vec_id", "embedding", 64)
    assert topk.exact_top_k(some, F.lit(False), 20).count() == 0
    assert hilbert.nearest(awkward, F.lit(False), 20).count() == 0


def test_hilbert_curve_visits_every_cell_once_in_steps():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.stack(np.meshgrid(*[np.arange(2**bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
        keys = hilbert.hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(2 ** (dims * bits)))
        assert (np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_hilbert_with_a_full_window_is_brute_force(spark, awkward):
    seen, rows = set(), []
    for i, v in _taking_part(awkward, zero=False):
        if (i, v.tobytes()) not in seen:
            seen.add((i, v.tobytes()))
            rows.append((i, v))
    got = _by_query(hilbert.nearest(awkward, F.col("id") % 20 == 0, 20, window=1.0))
    want = _best(rows, lambda a, b: float(a @ b), 20)
    assert got.keys() == want.keys()
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert [s for _, s in got[i]] == pytest.approx([s for _, s in want[i]])


def test_hilbert_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    ids, all_vectors = np.array([i for i, _ in rows]), np.stack([v for _, v in rows])
    got = _by_query(QUERIES["op3_hilbert_nearest"](spark, sf))
    hits = total = 0
    for i, v in rows:
        if i % 20 == 0:
            score = all_vectors @ v
            score[ids == i] = -np.inf
            hits += len({j for j, _ in got[i]} & set(ids[np.argsort(-score)[:20]].tolist()))
            total += 20
            assert len(got[i]) == 20
    assert hits / total >= 0.92


def test_hilbert_window_in_rows_finds_clusters(spark, monkeypatch):
    monkeypatch.setattr(hilbert, "ROWS", 100)  # windows that cross blocks of both kinds
    monkeypatch.setattr(hilbert, "QUERY_ROWS", 700)
    frame = _clustered(spark, 50, 60)
    rows = [(r.vec_id, np.array(r.embedding)) for r in frame.collect()]
    want = _best(rows, lambda a, b: float(a @ b), 20)
    got = _by_query(hilbert.nearest(frame, F.col("id") % 20 == 0, 20, window=200))
    assert got.keys() == want.keys()
    hits = sum(len({j for j, _ in got[i]} & {j for j, _ in want[i]}) for i in want)
    assert hits >= 0.9 * 20 * len(want)


def test_searches_refuse_vectors_of_several_lengths(spark):
    ragged = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0]), (20, [3.0, 4.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="same length"):
        hilbert.nearest(ragged, F.col("id") % 20 == 0, 2)
    with pytest.raises(ValueError, match="same length"):
        topk.exact_top_k(topk.integer_vectors(ragged, "vec_id", "embedding", 64), F.col("id") % 20 == 0, 2)


def test_integer_vectors_do_not_end_at_longs(spark):
    rows = [(0, [1e18, -1e300]), (1, [0.99, -0.01])]
    made = topk.integer_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding", 64)
    got = {r.id: r.vector for r in made.collect()}
    assert got == {0: [64e18, -64e300], 1: [63.0, -1.0]}


# ---- sharding


def test_shards_do_not_depend_on_the_batches_of_a_worker(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    frame, before, got = spark.range(0, 3000, 1, 3), spark.conf.get(name), []
    for size in (7, 10_000):
        spark.conf.set(name, size)
        got.append(sorted(sharding.shuffle_into_shards(frame, 5, seed=3).collect()))
    spark.conf.set(name, before)
    assert got[0] == got[1]


def test_hypergeometric_follows_its_law():
    rng = np.random.default_rng(4)
    good, bad, n = 12, 20, 9
    drawn = Counter(sharding.hypergeometric(rng, good, bad, n) for _ in range(20000))
    for k in range(10):
        p = math.comb(good, k) * math.comb(bad, n - k) / math.comb(good + bad, n)
        assert abs(drawn[k] / 20000 - p) < 4 * math.sqrt(p * (1 - p) / 20000) + 1e-4
    huge = [sharding.hypergeometric(rng, 10**12, 3 * 10**12, 10**6) for _ in range(200)]
    assert abs(np.mean(huge) - 250_000) < 5 * 433 / math.sqrt(200) * 2
    assert sharding.hypergeometric(rng, 5, 0, 3) == 3 and sharding.hypergeometric(rng, 0, 5, 3) == 0


def test_matrix_has_exact_margins():
    m = sharding.communication_matrix([5, 0, 17, 1, 30], 4, 1)
    assert m.sum(axis=1).tolist() == [5, 0, 17, 1, 30] and sorted(m.sum(axis=0)) == [13, 13, 13, 14]


def test_shards_hold_every_row_once(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = QUERIES["op4_uniform_shards"](spark, SF).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    slots = {}
    for r in got:
        data = docs[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(slots) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1


def test_shuffle_is_uniform(spark, monkeypatch):
    """Over many seeds, each of 6 rows in 3 partitions takes each (shard, slot) equally often."""
    rows = spark.createDataFrame([(i,) for i in range(6)], "n long").repartition(3).cache()
    seen = Counter()
    for seed in range(60):
        for r in sharding.shuffle_into_shards(rows, 2, seed).collect():
            seen[(r.n, r.shard, r.slot)] += 1
    assert len(seen) == 36 and max(seen.values()) < 26


def test_shards_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(sharding, "BUCKET", 3)
    schema = "doc_id long, text string, shard string, slot string, _row int, _part int, _key string, _bucket int"
    rows = [(None, None, "a", "b", 1, 2, "k", 3)] * 40 + [(i, "t", "a", "b", 1, 2, "k", 3) for i in range(3)]
    out = sharding.shuffle_into_shards(spark.createDataFrame(rows, schema), 5)
    got = out.collect()
    assert len(got) == 43 and sum(r.doc_id is None for r in got) == 40 and got[0]._key == "k"
    sizes = Counter(r.shard for r in got)
    assert sorted(sizes.values()) == [8, 8, 9, 9, 9]
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert sharding.shuffle_into_shards(spark.createDataFrame([], schema), 5).count() == 0
    few = sharding.shuffle_into_shards(spark.createDataFrame(rows[:2], schema), 5)
    assert few.count() == 2


def test_positions_are_the_sorted_order(spark):
    rows = spark.range(500).select((F.col("id") * 7919 % 503).alias("k"), "id").repartition(7)
    got = with_positions(rows, ["k", "id"], "p").orderBy("p").collect()
    assert [r.p for r in got] == list(range(500)) and [r.k for r in got] == sorted(r.k for r in got)
    assert with_positions(rows.limit(0), ["k"]).count() == 0


# ---- pipeline


def test_pipeline_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    texts = {r.doc_id: r.text for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        counts.append(docs.count())
        if name != "packing":
            assert docs.columns == columns and docs.where("n_chars <> length(text)").count() == 0
            assert {r.doc_id for r in docs.select("doc_id").collect()} <= texts.keys()
    assert counts[0] >= counts[1] > 0.9 * counts[0] and counts[1] > counts[2] > counts[3] * 0.99
    assert counts[3] == counts[4]
    again = QUERIES["pipeline"](spark, SF)
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert again.select(key).exceptAll(docs.select(key)).count() == 0 and again.count() == docs.count()


def test_pipeline_edge_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, guess int, _row int"
    rows = [(1, "one two three", "en", "s", 13, 1, 1), (2, None, None, None, None, None, None), (3, "", "en", "s", 0, 1, 1), (4, "12 34", "en", "s", 5, 1, 1)]
    for given in (rows + rows[:1], []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, SF)
            assert name == "packing" or docs.columns == [c.split()[0] for c in schema.split(", ")]
        assert [r.doc_id for r in docs.collect()] == ([1] if given else [])
