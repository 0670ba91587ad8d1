"""Prefix trie, benchmark decontamination and vector codes against brute force, SQL and edge cases."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from check_oracle import connect, expected, normal, rows
from pyspark.sql import functions as F

from eventmart.llm import codebooks, decontam, prefixes
from eventmart.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"
TURNS = "conv_id long, turn long, role string, text string, place long, h1 string"


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_decontamination", "op13_codebooks"])
def test_equals_sql(spark, name):
    got = normal(rows(QUERIES[name](spark, SF)), 17)
    want = normal(expected(connect(duckdb, SF), ORACLE[name]), 17)
    assert len(got) > 100
    assert got.equals(want)


# -- prefix trie


def _trie(turns: list[tuple]) -> set[tuple]:
    own = defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            role, text = role or "", text or ""
            told = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()  # the order of equal turns
            own[conv].append((turn is not None, turn or 0, told, role, text))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
    out = set()
    for node, ids in members.items():
        below = [m for m in members if m[: len(node)] == node]
        children = [m for m in below if len(m) == len(node) + 1]
        leaves = [m for m in below if not any(len(k) == len(m) + 1 and k[: len(m)] == m for k in below)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in below if m)
        ends = ",".join(map(str, sorted(c for c in ids if built[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        out.add((min(ids), len(node), parent, len(ids), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def _conversations() -> list[tuple]:
    rng = np.random.default_rng(5)
    words = ["", "a", "b", "é b", "long " * 30, None]
    made = []
    for c in [*range(60), -7, -5, 1000, 1003, 77]:
        for turn in range(int(rng.integers(1, 14))):
            made.append((c, turn, ("user", "assistant", None)[rng.integers(0, 3) if turn > 2 else turn % 2], words[rng.integers(0, 2 if turn < 3 else 6)]))
    made += [(20, None, "user", "before all"), (20, None, None, None), (None, 1, "user", "no id"), (41, 3, "user", "tie"), (41, 3, "user", "tie")]
    made += [(500 + 5 * i, 0, "user", "the same") for i in range(40)]  # identical conversations
    return made


@pytest.mark.parametrize(("stretch", "chunk"), [(4096, 4096), (3, 2)])
def test_trie_equals_brute_force(spark, monkeypatch, stretch, chunk):
    """Also with conversations and end lists that fill many stretches and chunks."""
    monkeypatch.setattr(prefixes, "STRETCH", stretch)
    monkeypatch.setattr(prefixes, "CHUNK", chunk)
    made = _conversations()
    got = prefixes.conversation_trie(spark.createDataFrame([(*t, 1, "x") for t in made], TURNS))
    found = [tuple(r) for r in got.collect()]
    want = _trie(made)
    assert len(found) == len(want) > 200
    assert set(found) == want


def test_trie_edge_cases(spark):
    assert prefixes.conversation_trie(spark.createDataFrame([], TURNS)).count() == 0
    only = [(None, 0, "user", "x", 1, "x")]
    assert prefixes.conversation_trie(spark.createDataFrame(only, TURNS)).count() == 0
    # h = 8 of 9 for some id whose base is absent: no turns at all, a member of the root only
    lone = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    got = prefixes.conversation_trie(spark.createDataFrame([(lone, 0, "user", "x", 1, "x")], TURNS)).collect()
    sha = hashlib.sha256(str(lone).encode()).hexdigest()
    assert [tuple(r) for r in got] == [(lone, 0, None, 1, 0, 1, 0, sha)]


def test_trie_of_a_very_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "STRETCH", 64)
    long = spark.range(3000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    got = prefixes.conversation_trie(long)
    assert got.count() == 3001
    assert got.agg(F.max("depth"), F.sum("n_leaves"), F.sum("n_children")).first()[:] == (3000, 3001, 3000)


# -- decontamination


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def _contaminated(docs, items, window=10):
    out = []
    for key, text, *_ in docs:
        words, hit, found = _words(text), set(), set()
        for item, told in items:
            told = _words(told)
            n = min(window, len(told))
            for i in range(len(told) - n + 1 if n else 0):
                for at in range(len(words) - n + 1):
                    if words[at : at + n] == told[i : i + n]:
                        hit.update(range(at, at + n))
                        if item is not None:
                            found.add(str(item))
        out.append((key, len(words), len(hit), len(found), sorted(found), bool(hit)))
    return sorted(out, key=str)


def _benchmark():
    rng = np.random.default_rng(3)
    base = [f"w{i}" for i in range(40)] + ["é1", "ÄB"]
    items = [(i, " ".join(base[k] for k in rng.integers(0, len(base), rng.integers(10, 40)))) for i in range(12)]
    items += [(20, items[0][1]), (21, "one two three"), (22, "the"), (23, ""), (24, None), (None, "nobody owns this passage of exactly ten words right here"), (25, "... !"), (100, "Half of it, ONE-two three four five six")]
    items += [(3, "a second text of item three " * 3), items[4]]
    docs = []
    for i in range(60):
        words = [base[k] for k in rng.integers(0, len(base), rng.integers(0, 60))]
        for _ in range(rng.integers(0, 3)):
            told = (items[rng.integers(0, len(items))][1] or "").split()
            cut = rng.integers(0, max(1, len(told) - 8))
            at = rng.integers(0, len(words) + 1)
            words[at:at] = told[cut : cut + rng.integers(8, 14)]
        docs.append((i, "\n- ".join(words).upper() if i % 3 else ", ".join(words), 1, "x", 2))
    docs += [(900, None, 1, "x", 2), (901, "", 1, "x", 2), (None, "one two three the the", 1, "x", 2), (902, "THE", 1, "x", 2), docs[5], docs[5]]
    return docs, items


@pytest.mark.parametrize(("piece", "out"), [(1 << 20, 1 << 14), (7, 3)])
def test_decontamination_equals_brute_force(spark, monkeypatch, piece, out):
    monkeypatch.setattr(decontam, "PIECE", piece)
    monkeypatch.setattr(decontam, "OUT", out)
    docs, items = _benchmark()
    table = spark.createDataFrame(docs, "doc_id long, text string, row long, item string, hash long")
    bench = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, win long")
    got = decontam.contamination(table, bench)
    want = _contaminated(docs, items)
    assert sum(w[2] > 0 for w in want) > 20
    assert sorted((tuple(r) for r in got.collect()), key=str) == want
    dirty = {w[0] for w in want if w[5]}
    left = decontam.without_contaminated(table, bench).collect()
    assert sorted(str(r.doc_id) for r in left) == sorted(str(d[0]) for d in docs if d[0] is None or d[0] not in dirty)


def test_decontamination_edge_cases(spark):
    docs, items = _benchmark()
    table = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontam.contamination(table.limit(0), bench).count() == 0
    clean = decontam.contamination(table, bench.limit(0)).collect()
    assert len(clean) == len(docs) and not any(r.contaminated or r.n_items for r in clean)
    # a very long word and a very long text
    long = "x" * 3_000_000 + " " + "one two three " * 200_000
    got = decontam.contamination(spark.createDataFrame([(1, long)], "doc_id long, text string"), bench).first()
    assert (got.n_words, got.n_hit, got["items"]) == (600_001, 600_000, ["21"])


# -- codebooks


def _codes(vectors):
    kept = [(i, l, np.floor(1024 * np.array(v, float)).astype(np.int64)) for i, v, l in vectors if v and None not in v and np.isfinite(np.array(v, float)).all()]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2].tolist()))[:256]
    parts = np.array([v.reshape(4, -1) for *_, v in kept])
    books = np.array([v.reshape(4, -1) for *_, v in first]).transpose(1, 0, 2)

    def assign():
        d = ((parts[:, :, None, :] - books[None]) ** 2).sum(axis=3)
        return d.argmin(axis=2), d.min(axis=2)

    for _ in range(4):
        entry, _ = assign()
        for p in range(4):
            for e in range(books.shape[1]):
                own = parts[entry[:, p] == e, p]
                if len(own):
                    books[p, e] = own.sum(axis=0) // len(own)
    entry, d = assign()
    errors = defaultdict(int)
    for (_, label, _), e in zip(kept, d.sum(axis=1), strict=True):
        errors[label] += int(e)
    sha = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return sorted(
        ((i, "".join(f"{e:02x}" for e in row), int(err), errors[label], sha) for (i, label, _), row, err in zip(kept, entry, d.sum(axis=1), strict=True)),
        key=str,
    )


def _vectors(n):
    rng = np.random.default_rng(n)
    made = [(int(i), [float(x) for x in rng.normal(0, 0.4, 8)], int(rng.integers(0, 4)) if i % 7 else None) for i in rng.permutation(n)]
    made += [(i, [0.25, -0.5] * 4, 9) for i in range(n, n + n // 2)]  # a crowded entry
    made += [(i, [float(x) for x in rng.integers(-1, 2, 8)], 8) for i in range(-40, 0)]  # ties
    made += [(5000, None, 1), (5001, [1.0, None] * 4, 1), (5002, [float("nan")] * 8, 1), (5003, [float("inf")] * 8, 1), (5004, [], 1)]
    return [*made, (None, [0.5] * 8, None), made[3], made[3]]


@pytest.mark.parametrize("n", [30, 600])
def test_codes_equal_brute_force(spark, n):
    """With fewer vectors than entries, and with more."""
    made = _vectors(n)
    frame = spark.createDataFrame(made, "vec_id long, embedding array<double>, label int").withColumn("row", F.lit(1)).withColumn("id", F.lit("x"))
    got = codebooks.compress(frame.repartition(5))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _codes(made)


def test_codes_edge_cases(spark):
    schema = "vec_id long, embedding array<float>, label int"
    assert codebooks.compress(spark.createDataFrame([], schema)).count() == 0
    assert codebooks.compress(spark.createDataFrame([(1, None, 1), (2, [], 1)], schema)).count() == 0
    with pytest.raises(ValueError, match="equal parts"):
        codebooks.compress(spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1)], schema))
    with pytest.raises(ValueError, match="equal parts"):
        codebooks.compress(spark.createDataFrame([(1, [1.0] * 6, 1)], schema))
    with pytest.raises(Exception, match="has no code"):
        codebooks.compress(spark.createDataFrame([(1, [1e9] * 4, 1)], schema))


def test_nearest_entries_are_exact_for_large_components():
    rng = np.random.default_rng(1)
    parts, book = rng.integers(-(2**27), 2**27, (50, 8)), rng.integers(-(2**27), 2**27, (9, 8))
    entry, distance = codebooks.nearest_entries(parts, book)
    for x, e, d in zip(parts.tolist(), entry, distance, strict=True):
        all_ = [sum((a - b) ** 2 for a, b in zip(x, c, strict=True)) for c in book.tolist()]
        assert (all_.index(min(all_)), min(all_)) == (e, d)
