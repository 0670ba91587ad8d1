"""Text operators against brute force, other libraries and edge cases."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventmart.llm import bpe, language, licenses, lines, packing, pii, simhash
from eventmart.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")

AWKWARD = [
    None,
    "",
    " \n\t ",
    "a" * 5000,
    "!?" * 400 + "\n\n\n",
    "x\x1c y\x85z\xa0 \n\n t 'S don't we'll 12½² Ünïcode ﬁ 日本語 🤗🤗 é",
    "<|endoftext|> one two",
    "word " * 3000,
    "Line one two three.\r\nLine one two three.\r\n",
]


@pytest.fixture(scope="module")
def awkward(spark):
    """Awkward texts, each twice, with a null id, ties and columns whose names operators use inside."""
    rows = [(i, t, "en" if t else None, "s", len(t or "")) for i, t in enumerate(AWKWARD * 2)]
    rows += [(None, "null id here", "de", None, None), rows[5]]
    extra = spark.createDataFrame(rows, DOCS)
    for name in ("_row", "_ROW", "position", "rank", "piece", "score", "seq", "a.b", "_made", "key", "fp", "_gone", "_added", "_lines"):
        extra = extra.withColumn(name, F.lit("kept"))
    return extra


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


# ---- language


def _grams(text: str) -> Counter:
    """n-grams written the plain way: letters, one space after each word, hashes one by one."""
    runs = "".join(c if c.isalpha() else "\0" for c in text.lower())
    plain = re.sub("\0+", " ", runs).lstrip(" ")
    if text and text.lower()[-1].isalpha():
        plain += " "
    out = Counter()
    for i in range(len(plain)):
        h = 0
        for n in range(1, 5):
            if i + n > len(plain):
                break
            h = (h + ord(plain[i + n - 1]) + n) * 0x9E3779B1 % 2**32
            out[((h ^ h >> 15) * 0x85EBCA77 % 2**32) >> (32 - language.BITS)] += 1
    return out


def test_language_equals_plain_bayes(spark, docs):
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, SF).collect()}
    rows = docs.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows}
    counts, n = defaultdict(Counter), Counter()
    for r in rows:
        if not held[r.doc_id] and r.lang is not None and r.text is not None:
            counts[r.lang].update(_grams(r.text))
            n[r.lang] += 1
    total = {k: sum(c.values()) + 0.5 * 2**language.BITS for k, c in counts.items()}
    for r in rows:
        logs = {
            k: math.log(n[k] / sum(n.values())) + sum(m * math.log((c[b] + 0.5) / total[k]) for b, m in _grams(r.text).items())
            for k, c in counts.items()
        }
        best = max(logs, key=logs.get)
        assert got[r.doc_id].lang_pred == best and got[r.doc_id].held_out == held[r.doc_id]
        assert got[r.doc_id].score == pytest.approx(1 / sum(math.exp(v - logs[best]) for v in logs.values()), abs=1e-6)


def test_language_is_right_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = QUERIES["op1_language_id"](spark, sf).where("held_out").join(truth, "doc_id")
    assert held.where("lang = lang_pred").count() / held.count() > 0.98


def test_language_edge_cases(spark, awkward, nothing):
    model = language.fit(awkward)
    rows = awkward.select("doc_id", "text", language.predict(awkward, model).alias("g")).collect()
    assert len(rows) == len(AWKWARD) * 2 + 2
    for r in rows:
        assert (r.g.lang_pred == "und") == (not language.has_letter(r.text)) and 0 <= r.g.score <= 1
    unlearned = language.fit(nothing)
    assert {r.g.lang_pred for r in awkward.select(language.predict(awkward, unlearned).alias("g")).collect()} == {"und"}
    assert nothing.select(language.predict(nothing, model).alias("g")).count() == 0


@pytest.mark.parametrize("size", [1, 3, 7, 50])
def test_language_counts_ngrams_across_slices(monkeypatch, texts, size):
    some = [t for t in [*list(texts.values())[:5], *AWKWARD[3:7], " .a. b", "ab  \n c d"] if t]
    want = [_grams(t) for t in some]
    monkeypatch.setattr(language, "SLICE", size)
    got = [Counter() for _ in some]
    for buckets, owners in language.hashed_ngrams(some):
        for b, i in zip(buckets.tolist(), owners.tolist(), strict=True):
            got[i][b] += 1
    assert got == want


def test_language_score_does_not_depend_on_neighbours(spark, docs):
    model = language.fit(docs)
    some = [r.text for r in docs.limit(20).collect()]
    together = language.score_texts(model, some)[1]
    assert together.tolist() == [language.score_texts(model, [t])[1][0] for t in some]


# ---- licenses


def test_licenses_found_where_they_stand(spark, texts):
    got = QUERIES["op2_license_scan"](spark, SF).collect()
    found = {(r.doc_id, texts[r.doc_id][r.start : r.end]) for r in got}
    short = [t.rstrip(".") for k, t in licenses.TEMPLATES.items() if len(t) < 90]
    wanted = {(i, s) for i, t in texts.items() for s in short if s in t}
    assert wanted <= found and all(r.differences == 0 for r in got)


def test_licenses_survive_small_edits_and_long_texts(spark, awkward, nothing):
    mit = licenses.TEMPLATES["MIT-notice"]
    edited = mit.replace("free of charge", "without charge").replace("sublicense", "sub-license")
    noise = " ".join(f"w{i}" for i in range(3000))
    for text in (edited, f"{noise}\n{edited}\n{noise}", f"{noise} {edited} {noise}", "\n".join(re.findall(".{1,70}(?: |$)", edited))):
        hits = licenses.scan_text(text)
        assert [h[2] for h in hits] == ["MIT-notice"] and 0 < hits[0][4] <= 6
        assert text[hits[0][0] : hits[0][1]].startswith("Permission") and text[hits[0][0] : hits[0][1]].endswith("Software")
    assert licenses.scan_text("we licensed a warranty of the license to nobody in particular") == []
    assert licenses.scan_licenses(awkward).count() == 0 and licenses.scan_licenses(nothing).count() == 0


# ---- byte-level BPE


def test_bpe_equals_tiktoken(spark, texts):
    ranks = bpe.read_ranks(bpe.vocabulary_bytes(MULTI))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = QUERIES["op5_bpe_round_trip"](spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = own.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_bpe_edge_cases(spark, awkward, nothing):
    ranks = bpe.read_ranks(bpe.vocabulary_bytes(MULTI))
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = awkward.withColumn("ids", bpe.encode(spark, "text", MULTI))
    rows = rows.withColumn("back", bpe.decode(spark, "ids", MULTI)).select("text", "ids", "back").collect()
    for r in rows:
        assert list(r.ids) == own.encode_ordinary(r.text or "") and bytes(r.back).decode() == (r.text or "")
    assert nothing.select(bpe.round_trip(spark, "text", MULTI)).count() == 0


def test_bpe_long_words_equal_tiktoken():
    rng = np.random.default_rng(4)
    data = bpe.vocabulary_bytes(MULTI)
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(data), special_tokens={})
    encoder = bpe.WordEncoder(data)
    words = ["".join(map(chr, rng.integers(97, 123, n))) for n in (256, 3000, 200_000)]
    words += ["".join(map(chr, rng.integers(0x4E00, 0x9000, 2000))), "a" * 3000, "the" * 700, "etaoin" * 300 + "qxzj" * 50, "the"]
    encoder.learn(words)
    for word in words:
        n, ids, back = encoder.known[word]
        assert list(map(int, ids.split(","))) == own.encode_ordinary(word) and n == ids.count(",") + 1 and back == word.encode()


def test_bpe_decodes_whole_tokens_from_their_ids():
    encoder = bpe.WordEncoder(bpe.vocabulary_bytes(MULTI))
    encoder.db.execute("UPDATE vocabulary SET hex = '21' WHERE id = ?", [encoder.ranks[b" the"]])
    encoder.learn([" the"])
    assert encoder.known[" the"] == (1, str(encoder.ranks[b" the"]), b"!")


def test_bpe_tokens_encode_to_themselves():
    """The merge table can reach every token: what contracting all places of one rank at once rests on."""
    encoder = bpe.WordEncoder(bpe.vocabulary_bytes(MULTI))
    some = [t for t in list(encoder.ranks)[300::97] if len(t) > 1]
    chunk = [(t.decode("latin-1"), t) for t in some]
    encoder._encode(chunk)
    assert [encoder.known[w][:2] for w, _ in chunk] == [(1, str(encoder.ranks[t])) for _, t in chunk]


# ---- packing


def test_packing_is_whole_and_tight(spark, texts):
    reference = Tokenizer.from_file(JSON)
    reference.encode_special_tokens = True
    got = QUERIES["op6_best_two_fit"](spark, SF).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids = [*reference.encode(text, add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces))) and len(pieces) == -(-len(ids) // 1024)
        at = 0
        for p in pieces:
            part = np.array(ids[at : at + p.length], "<u4")
            assert p.start == at and p.length == len(part) and p.ids_crc32 == zlib.crc32(part.tobytes())
            assert p.piece == 0 or p.length == 1024
            at += p.length
        assert at == len(ids)
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_seq) <= sum(r.length for r in got) / 1024 * 1.02 + 1


def test_best_two_fit_replaces_the_smallest():
    # greedy 7 + 2 leaves 1; two items of 1 and 2 would fit 3 exactly
    assert packing.best_two_fit(np.array([7, 2, 2, 1]), 10)[0] == [7, 2, 1]
    # greedy 6 + 3 leaves 1; 2 + 2 fill the widened gap of 4
    assert packing.best_two_fit(np.array([6, 3, 2, 2]), 10) == [[6, 2, 2], [3]]
    rng = np.random.default_rng(1)
    for _ in range(30):
        sizes = rng.integers(1, 101, rng.integers(1, 200))
        bins = packing.best_two_fit(sizes, 100)
        assert sorted(x for b in bins for x in b) == sorted(sizes.tolist()) and max(map(sum, bins)) <= 100


def test_packing_edge_cases(spark, awkward, nothing):
    packed = packing.pack(packing.token_pieces(awkward, JSON, ids=True), ["doc_id", "piece"]).cache()
    lone = packed.where("text is null") if "text" in packed.columns else packed.where("length = 1")
    assert lone.count() >= 4  # null and empty texts are the single end id
    laid = packing.sequences(packed).collect()
    assert sum(len(r.token_ids) for r in laid) == packed.agg(F.sum("length")).first()[0]
    assert {c for c in packed.columns} >= {"a.b", "_ROW", "rank"}
    assert packing.pack_documents(nothing, JSON).count() == 0
    with pytest.raises(Exception, match="outside"):
        packing.pack(spark.createDataFrame([(1, 2000)], "doc_id long, length long"), ["doc_id"]).collect()


# ---- SimHash


def _classes(prints: dict) -> dict:
    """Components by comparing every pair."""
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(prints)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def _plain_print(text: str) -> int:
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def test_simhash_equals_all_pairs(spark, texts):
    prints = {i: _plain_print(t) for i, t in texts.items()}
    want = _classes(prints)
    got = QUERIES["op7_simhash_classes"](spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}


@pytest.mark.parametrize("crowd", [2, 64])
def test_simhash_links_in_dense_balls(spark, monkeypatch, crowd):
    """Chains, dense balls and far points; a small CROWD sends them through the whole ball."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(3)
    prints = {}
    for centre in rng.integers(0, 2**63, 6):
        for _ in range(40):
            flips = rng.choice(64, rng.integers(0, 7), replace=False)
            prints[len(prints)] = int(centre) ^ sum(1 << int(f) for f in flips)
    prints |= {len(prints) + i: int(v) for i, v in enumerate(rng.integers(0, 2**63, 50))}
    signed = [(i, p - (1 << 64) if p >> 63 else p) for i, p in prints.items()]
    rows = spark.createDataFrame(signed, "key long, fp long")
    got = {r.key: r.component_id for r in simhash._classes(rows).collect()}
    assert got == _classes(prints)


def test_simhash_edge_cases(spark, awkward, nothing):
    got = simhash.near_duplicates(awkward).collect()
    assert len(got) == len(AWKWARD) * 2 + 2
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[0].fingerprint == by_id[2].fingerprint == "0" * 16 and by_id[11].component_id == 0
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert len(ids) == len(set(ids)) and ids == sorted({r.component_id for r in got if r.component_id is not None})
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


# ---- line runs


def _brute_lines(texts: dict, least: int) -> dict:
    """Longest earlier match from every line, by direct comparison."""
    seq = [(i, n, x.strip()) for i in sorted(texts) for n, x in enumerate(y for y in (texts[i] or "").split("\n") if y.strip())]
    gone = defaultdict(set)
    places = defaultdict(list)
    for p, (i, _, line) in enumerate(seq):
        longest = 0
        for q in places[line]:
            n = 0
            while p + n < len(seq) and seq[p + n][0] == i and seq[q + n][0] == seq[q][0] and seq[p + n][2] == seq[q + n][2]:
                n += 1
            longest = max(longest, n)
        places[line].append(p)
        if sum(len(seq[p + k][2].split()) for k in range(longest)) >= least:
            gone[i].update(seq[p + k][1] for k in range(longest))
    return gone


@pytest.mark.parametrize("least", [1, 7, 50])
def test_line_runs_equal_longest_earlier_match(spark, least):
    rng = np.random.default_rng(least)
    pool = [" ".join(f"w{k}" for k in range(rng.integers(1, 9))) + f" {n}" for n in range(12)]
    texts = {i: "\n".join(pool[k] for k in rng.integers(0, 12, rng.integers(0, 40))) for i in range(30)}
    texts[30], texts[31] = texts[3] + "\n\n" + texts[4], "\n".join(["same line here"] * 60)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: r for r in lines.dedup_lines(docs, min_words=least).collect()}
    gone = _brute_lines(texts, least)
    for i, text in texts.items():
        body = [x for x in text.split("\n") if x.strip()]
        assert got[i].n_removed == len(gone[i]) and got[i].n_lines == len(body)
        assert [x for x in got[i].text.split("\n") if x.strip()] == [x for n, x in enumerate(body) if n not in gone[i]]


def test_line_runs_edge_cases(spark, awkward, nothing):
    out = lines.dedup_lines(awkward)
    assert out.columns == [*awkward.columns, "n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(AWKWARD) * 2 + 2
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[7].text == "word " * 3000 and by_id[16].text == "" and by_id[16].n_removed == 1
    assert by_id[0].text is None and by_id[1].text == "" and by_id[0].n_lines == 0
    assert lines.dedup_lines(nothing).count() == 0


# ---- personal data


def _brute_spans(text: str) -> list:
    """The base patterns as they are written, searched one by one."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if max(map(int, m.group().split("."))) <= 255:
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 13 <= len(d) <= 19 and sum(sum(divmod(x * (1 + k % 2), 10)) for k, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            out.append(("phone", *m.span()))
    return out


def _digest(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def test_base_spans_equal_the_patterns(spark, texts):
    rng = np.random.default_rng(5)
    alphabet = list("ab1234567890..@@ -+()_%\n") + ["4111 1111 1111 1111", "10.0.0.1", "+1 (555) 123-4567", "é", "x@y.zz"]
    made = ["".join(rng.choice(alphabet, rng.integers(1, 60))) for _ in range(1500)]
    for text in [*made, *texts.values(), "1" * 4000, "a@" * 500 + "b.c", "1.2.3.4.5.6.7.8 300.1.1.1 001.002.003.004"]:
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == _brute_spans(text)


def test_personal_data_query(spark, texts):
    got = QUERIES["op10_personal_data"](spark, "/root/testdata/sf0.001").collect()
    assert len(got) == len(texts)
    for r in got:
        base = _brute_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(_digest(base).encode()).hexdigest()
        assert set(filter(None, _digest(base).split(","))) <= set(r.spans.split(",")) | {""}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.KINDS]


def test_contexts_discover_unseen_identifiers(spark):
    rows = [(i, f"Please write to mail user{i}@site{i}.org today or call me at +1 555 010 {1000 + i} soon") for i in range(8)]
    rows += [(20, "Please write to mail admin@intranet today"), (21, "call me at 555-0199-8123 soon"), (22, "token = 55501998123 end"), (23, "a clean text")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[20].spans_text == "email:21:35" and got[20].n_email == 0
    assert got[21].spans_text == "phone:11:24"
    assert got[22].spans_text == got[23].spans_text == ""
    clean = {r.doc_id: r.text for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean[20] == "Please write to mail [EMAIL] today" and clean[23] == "a clean text"
    assert clean[0] == "Please write to mail [EMAIL] today or call me at [PHONE] soon"


def test_numbers_in_several_tokens_are_candidates(spark):
    rows = [(i, f"Please call me at +1 555 010 {1000 + i} soon") for i in range(4)]
    rows += [(10, "just call me at 020 7946 0958, soon"), (11, "just call me at (555) 123-4567 soon"), (12, "sizes 020 7946 0958 of parts")]
    got = {r.doc_id: r.spans_text for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[10] == "phone:16:29" and got[11] == "phone:17:30" and got[12] == ""


@pytest.mark.parametrize("fill", [" ", " " * 300, " *** " * 100])
def test_contexts_take_words_of_any_length_and_distance(fill):
    word = "w" * 500
    text = f"first {word}{fill}x@y{fill}{word} last"
    at = text.index("x@y")
    assert pii.Contexts(text).of(at, at + 3) == [f"first {word} _", f"{word} _ {word}"]
    chained = "mail:a@b.co,c@d.co next"
    places = pii.Contexts(chained)
    assert places.of(5, 11) == ["mail _ c"] and places.of(12, 18) == ["co _ next"]


def test_context_of_many_spans_in_one_token_is_linear():
    text = "a@b.co," * 100_000
    assert len(pii.scan(text)[1]) == 100_000


def _scored(seen, rounds, support, sure):
    """score_patterns written with dictionaries."""
    edges, seeds, shaped = {}, {}, {}
    for kind, _, _, value, patterns, shapes in seen:
        for p in patterns:
            edges.setdefault(p, set()).add(value)
        if patterns and kind >= 0:
            seeds.setdefault(value, set()).add(kind)
        shaped.setdefault(value, set()).update(shapes)
    belief = {(v, k): 1.0 for v, ks in seeds.items() for k in ks}
    for _ in range(rounds):
        scored = {}
        for p, values in edges.items():
            for k in range(4):
                own = [belief[v, k] for v in values if (v, k) in belief]
                if sum(b >= sure for b in own) >= support:
                    scored[p, k] = sum(own) / (len(values) + 0.5)
        doubt = {}
        for (p, k), s in scored.items():
            for v in edges[p]:
                if v not in seeds and k in shaped[v]:
                    doubt[v, k] = doubt.get((v, k), 1.0) * (1 - s)
        belief = {(v, k): 1.0 for v, ks in seeds.items() for k in ks} | {x: 1 - d for x, d in doubt.items()}
    return {x: s for x, s in scored.items() if s >= sure}


def test_found_values_back_patterns_as_in_plain_scoring(spark, texts):
    made = [f"you may call me at +1 555 010 {1000 + i} soon" for i in range(30)]
    # found by the contexts above, and the only ones with a context of their own
    made += [f"you may call me at 555-0199-{8000 + i} soon" for i in range(10)]
    made += [f"my desk line 555-0199-{8000 + i} works" for i in range(10)] + ["my desk line 555-7777-1234 works", "a desk line 2024 works"]
    seen = [s for t in [*made, *texts.values()] for s in pii.scan(t)[1]]
    frame = spark.createDataFrame(seen, "kind int, start long, end long, value string, contexts array<string>, shapes array<int>")
    for rounds in (1, 2, 3):
        want = _scored(seen, rounds, pii.SUPPORT, 0.7)
        got = {(r.pattern, r.kind): r.sureness for r in pii.score_patterns(frame, rounds, sure=0.7).collect()}
        assert got.keys() == want.keys() and all(got[x] == pytest.approx(want[x], abs=1e-9) for x in want)
        assert (("desk line _", 3) in got) == (rounds > 1)


def test_personal_data_edge_cases(spark, awkward, nothing):
    found = pii.find(awkward).collect()
    assert len(found) == len(AWKWARD) * 2 + 2 and all(r.spans_text == "" for r in found)
    assert pii.redact(awkward).exceptAll(awkward).count() == 0 and pii.redact(awkward).columns == awkward.columns
    assert pii.find(nothing).count() == 0 and pii.redact(nothing).count() == 0
