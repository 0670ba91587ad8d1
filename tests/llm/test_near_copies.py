"""The near-duplicate stage of the pipeline against brute-force Jaccard similarity."""

from __future__ import annotations

import re

import numpy as np
import pytest

import corpus_pipeline
from eventmart.llm import common, lines, simhash


def _shingles(text: str) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def _stay(texts: dict) -> list:
    """The smallest id of each class, by comparing every pair."""
    sets = {i: _shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(texts)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            both = len(sets[i] & sets[j])
            if 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return sorted(i for i in ids if find(i) == i)


def _corpus() -> dict:
    """Copies with a few words changed, cut or moved, on both sides of the limit, and a shared footer."""
    rng = np.random.default_rng(8)
    footer = " all rights to this page and its footer are held by nobody at all"
    texts = {}
    for _ in range(40):
        words = [f"w{k}" for k in rng.integers(0, 400, rng.integers(30, 250))]
        for _ in range(rng.integers(2, 5)):
            copy = list(words)
            for _ in range(rng.integers(0, 5)):
                copy[rng.integers(0, len(copy))] = f"W{rng.integers(0, 400)}"
            copy = copy[: len(copy) - rng.integers(0, max(1, len(copy) // 20))]
            texts[len(texts)] = " ".join(copy) + (footer if rng.integers(0, 2) else "")
    for text in ("", None, " \n", "one two", "One\ttwo", "one two three four five", "one two three four six"):
        texts[len(texts)] = text
    return texts


@pytest.mark.parametrize(("sample", "several"), [(64, 3), (1, 2)])
def test_near_copies_equal_brute_force(spark, monkeypatch, sample, several):
    """With every text in the sample the footer's shingles are the frequent ones."""
    monkeypatch.setattr(simhash, "SAMPLE", sample)
    monkeypatch.setattr(simhash, "SEVERAL", several)
    texts = _corpus()
    want = _stay(texts)
    assert len(want) < len(texts) - 20
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in got.collect()) == want


def test_near_copies_edge_cases(spark):
    rows = [(None, "a b c d e f", 1), (3, "a b c d e f", 2), (3, "a b c d e f", 3), (None, "alone", 4)]
    got = simhash.keep_unlike(spark.createDataFrame(rows, "doc_id long, text string, node long")).collect()
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == [(3, "a b c d e f")]
    assert [r.text for r in got if r.doc_id is None] == ["alone"]
    assert simhash.keep_unlike(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_near_copies_are_linked_by_fingerprints(spark, monkeypatch):
    """Without a shared leading shingle, similar texts with near fingerprints are still one class; unlike ones never are."""
    found = simhash._members
    monkeypatch.setattr(simhash, "_members", lambda sketches: found(sketches).limit(0))
    texts = {}
    for n in range(40):
        words = [f"w{n}x{k}" for k in range(400)]
        for cut in (0, 1, 2):
            texts[len(texts)] = " ".join(words[cut:])
    prints = {i: simhash.fingerprint_set(simhash.shingle_set(t, 5)) for i, t in texts.items()}
    near = [i for i in texts if i % 3 and (prints[i] ^ prints[i - i % 3]).bit_count() <= simhash.RADIUS]
    assert len(near) > 40
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    stay = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert not stay & set(near)
    assert stay >= set(range(0, 120, 3))


def _below_broadcasts(frame) -> str:
    """The lines of the plan as it was run that stand below a broadcast, down to the next shuffle."""
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    below, top, end = [], None, None
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-*"))
        if end is not None and depth > end:
            continue
        end = None
        if top is not None and depth > top:
            if "ShuffleQueryStage" in line:
                end = depth
            below.append(line)
        else:
            top = depth if "BroadcastExchange" in line else None
    return "\n".join(below)


def test_balls_of_a_crowd_are_not_broadcast(spark, rows, monkeypatch):
    """2,081 rows for each fingerprint of a crowd, which the planner takes for one, do not pass through the driver."""
    monkeypatch.setattr(simhash, "CROWD", 4)
    near = [0x1234567890ABCDEF ^ (1 << bit) for bit in range(12)]
    edges = simhash.links(rows("fp long", *[(fp,) for fp in [*near, 5]]))
    found = {frozenset(r) for r in edges.collect()}
    assert "Generate" not in _below_broadcasts(edges)
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    assert {r.root for r in simhash.components(edges).collect()} == {min(near)} and set().union(*found) == set(near)


def test_linked_texts_of_a_crowd_are_not_broadcast(spark, rows, monkeypatch):
    """The same in the stage of the pipeline, which links texts by their fingerprints."""
    monkeypatch.setattr(simhash, "CROWD", 4)
    near = [0x1234567890ABCDEF ^ (1 << bit) for bit in range(12)]
    pairs = simhash._linked(rows("node long, fp long", *enumerate([*near, near[0], 5])))
    assert pairs.collect() and "Generate" not in _below_broadcasts(pairs)
    assert {tuple(r) for r in simhash.components(pairs).collect()} == {(node, 0) for node in range(13)}


def test_linked_fingerprints_that_are_unlike_stay(spark, monkeypatch):
    monkeypatch.setattr(simhash, "fingerprint_set", lambda hashes: 7)
    rows = [(n, " ".join(f"w{n}x{k}" for k in range(30))) for n in range(20)]
    assert corpus_pipeline.drop_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").count() == 20


def test_linked_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(4)
    prints = [(n, int(p)) for n, p in enumerate(np.repeat(rng.integers(-(2**63), 2**63 - 1, 30), 2))]
    prints += [(100 + n, p ^ (1 << int(rng.integers(0, 63)))) for n, p in prints[::3]]
    got = {(r.a, r.b) for r in simhash._linked(spark.createDataFrame(prints, "node long, fp long")).collect()}
    first = {}
    for node, p in prints:
        first[p] = min(node, first.get(p, node))
    want = {(first[p], node) for node, p in prints if node != first[p]}
    want |= {(min(first[p], first[q]), max(first[p], first[q])) for p in first for q in first if p != q and ((p ^ q) & (2**64 - 1)).bit_count() <= 4}
    assert got == want


def test_only_busy_shingles_are_shuffled(spark):
    """The bitmap of busy keys is joined below the exact join with them."""
    rows = [(n, 2, [n, 5], (0, 9)) for n in range(10)]
    sketches = spark.createDataFrame(rows, "node long, n int, lead array<long>, last struct<rank:long,hash:long>")
    members = simhash._members(sketches)
    assert {r.key for r in members.collect()} == {5}
    joins = [x for x in members._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join " in x]
    assert len(joins) == 2 and "broadcast" in joins[1] and "broadcast" not in joins[0]


def test_told_apart_is_exact_and_keeps_repeated_rows(spark):
    frame = spark.range(3000).selectExpr("id AS x", "id % 700 AS `a key`", "cast(id AS string) AS bits")
    keys = spark.range(0, 700, 9).selectExpr("id AS `a key`")
    maybe, other = common.told_apart(frame, "a key", keys)
    assert maybe.columns == other.columns == frame.columns
    assert maybe.count() + other.count() == 3000 and all(r["a key"] % 9 for r in other.collect())
    assert {r["a key"] for r in maybe.collect()} >= set(range(0, 700, 9))
    left = common.without(frame, "a key", keys).collect()
    assert sorted((r.x, r["a key"], r.bits) for r in left) == [(n, n % 700, str(n)) for n in range(3000) if n % 700 % 9]
    assert common.without(frame, "a key", keys.limit(0)).count() == 3000


@pytest.mark.parametrize("made", [lambda docs: simhash.keep_unlike(docs), lambda docs: lines.dedup_lines(docs)])
def test_texts_that_stay_are_not_shuffled(spark, made):
    """Their part of the result meets nothing but a bitmap of fixed size."""
    texts = [" ".join(f"w{n % 7}x{k}" for k in range(60)) for n in range(9)]
    out = made(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    plan = out._jdf.queryExecution().optimizedPlan()
    stay, rest = plan.children().apply(0).toString(), plan.children().apply(1).toString()
    joins = [x for x in stay.splitlines() if "Join " in x]
    assert len(joins) == 1 and "broadcast" in joins[0]
    assert any("Join " in x and "broadcast" not in x for x in rest.splitlines())


@pytest.mark.parametrize("bits", [6, 24])
def test_texts_that_lose_all_lines_are_not_shuffled(spark, monkeypatch, bits):
    """Their rows meet bitmaps only; a bitmap that mistakes rows for them costs no line."""
    text = "\n".join(" ".join(f"w{n}x{k}" for k in range(30)) for n in range(3))
    texts = [text, f"\n \n{text}\n\t", text, f"{text}\nnew", "\n\n", None, *(f"other {n}" for n in range(90))]
    parts = []

    def told(frame, *args, plain=lines.told_apart):
        parts.append((frame, plain(frame, *args)))
        return parts[-1][1]

    monkeypatch.setattr(common, "FILTER_BITS", bits)
    monkeypatch.setattr(lines, "told_apart", told)
    out = lines.dedup_lines(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3))
    got = {r.doc_id: (r.text, r.n_lines, r.n_removed) for r in out.collect()}
    want = {n: (t, sum(bool(x.strip()) for x in (t or "").split("\n")), 0) for n, t in enumerate(texts)}
    assert got == want | {1: ("\n ", 3, 3), 2: ("", 3, 3), 3: ("new", 4, 3)}
    sure = {r.doc_id for r in parts[-1][1][1].collect()}
    assert sure <= {1, 2} and (bits == 6 or sure == {1, 2})


def test_python_workers_keep_little_between_tasks(spark, monkeypatch):
    import public_tokenizers
    import pyarrow as pa

    from eventmart.llm import packing

    freed = []
    pool = type("Pool", (), {"release_unused": lambda self: freed.append(1)})
    with monkeypatch.context() as patch:
        patch.setattr(pa, "default_memory_pool", pool)
        assert list(common.thrifty(iter("abc"))) == ["a", "b", "c"] and len(freed) == 3

    def words(batches):
        for _ in batches:
            held = sum(map(len, packing._words.values()))
            yield pa.RecordBatch.from_pydict({"held": pa.array([held], pa.int64())})

    docs = spark.range(400).selectExpr("id AS doc_id", "concat('word', id) AS text").repartition(4)
    packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert spark.range(16).repartition(16).mapInArrow(words, "held long").agg({"held": "max"}).first()[0] == 0


def test_equal_sets_and_similar_texts_leave_together(spark):
    base = " ".join(f"w{n}" for n in range(100))
    near = base + " more"
    rows = [(5, base), (3, base), (9, near), (None, base), (7, near), (3, near), (8, "other words"), (None, None), (2, None)]
    out = simhash.keep_unlike(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text is None) for r in out) == [(2, True), (3, False), (8, False)]
