"""SimHash near-duplicates: fingerprints, links by meet-in-the-middle ball hashing, classes.

Two fingerprints at distance r or less meet in a variant that is at most r/2 bits from each. A
ball of radius 2 over 64 bits has 2,081 variants, so the radius is first shared out: of 4
differing bits, one 32-bit half holds at most 2, and within that half 33 variants of radius 1
meet. Each distinct fingerprint thus emits 66 variants; those that collide are verified by
counting the differing bits of all 64. Only fingerprints under a crowded variant (over CROWD
members) emit their whole ball of radius 2: whoever meets there is linked by construction, so
each is tied to the smallest of the meeting instead of to every other.

A fingerprint of 64 bits cannot tell a similarity: texts that share four of five shingles lie up to
16 bits apart, and at that distance any two texts meet in any block. `keep_unlike` therefore
compares the shingle sets of linked fingerprints, and finds the similar texts that lie further apart
by the leading shingles of their sets.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventmart.llm.common import col, fresh, thrifty, told_apart, with_rows, without
from eventmart.llm.graph import components
from eventmart.llm.shingles import shingle_hashes, word_hashes_of
from eventmart.session import durable, release, settled

RADIUS = 4
CROWD = 64
CHUNK = 1 << 16  # shingles hashed at a time
TASK = 8192  # fingerprints whose variants one task makes
SAMPLE = 64  # one text in so many is searched for frequent shingles; they only decide an order
SEVERAL = 3  # texts of the sample that make a shingle frequent
FREQUENT = 1 << 17  # frequent shingles held at most
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _shingle_hashes(text: str | None, width: int, seed: int) -> Iterator[np.ndarray]:
    """Hashes of the word shingles in their order, in chunks of bounded length; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return
    width = min(width, len(words))
    total = len(words) - width + 1
    for at in range(0, total, CHUNK):
        part = words[at : min(total, at + CHUNK) + width - 1]
        line = b" ".join(part)
        lengths = np.fromiter(map(len, part), np.int64, len(part))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(part) - width + 1].tolist()
        shingles = map(line.__getitem__, map(slice, starts, ends[width - 1 :].tolist()))
        yield np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(seed)), np.dtype("<u8"), len(starts))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """The different word shingles of a text: ascending 64-bit hashes, then read as signed."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    return np.unique(shingle_hashes(word_hashes_of(words), min(width, len(words)))).view(np.int64) if words else np.empty(0, np.int64)


def fingerprint_text(text: str | None, width: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash over word shingles; 0 without words.

    Words are split at ASCII white space after lower-casing A-Z. A bit is 1 if it is set in
    over half the shingle hashes, repeats included; fewer than `width` words are one shingle.
    """
    return _majority(_shingle_hashes(text, width, seed))


def _majority(chunks: Iterable[np.ndarray]) -> int:
    """Unsigned number of the bits that over half of all hashes set; 0 without hashes."""
    ones, total = np.zeros(64, np.int64), 0
    for hashes in chunks:
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def fingerprint_set(hashes: np.ndarray) -> int:
    """Unsigned 64-bit SimHash of a set of shingle hashes; 0 if it is empty."""
    return _majority(hashes[at : at + CHUNK] for at in range(0, len(hashes), CHUNK))


def fingerprint(text: str, width: int = 4) -> Column:
    """Column long: the fingerprint's 64 bits (read as signed)."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in thrifty(batches):
            yield pd.Series(np.array([fingerprint_text(t, width) for t in batch], np.uint64).view(np.int64))

    return run(col(text))


def _ball(bits: int, radius: int) -> list[int]:
    """Masks that flip up to `radius` of `bits` bits, as signed 64-bit numbers."""
    masks = [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _variants(prints: DataFrame) -> DataFrame:
    """(fp, key): per 32-bit half, the half with up to one bit flipped; bit 32 of the key tells the half."""
    low = F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned("fp", 32)
    flips = F.array(*[F.lit(m).cast("long") for m in _ball(32, 1)])
    return prints.select("fp", F.explode(flips).alias("flip"), low.alias("low"), high.alias("high")).select(
        "fp",
        F.explode(
            F.array(
                F.col("low").bitwiseXOR(F.col("flip")),
                F.col("high").bitwiseXOR(F.col("flip")).bitwiseOR(F.lit(1 << 32)),
            )
        ).alias("key"),
    )


def _close(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= RADIUS


def links(prints: DataFrame) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (fp long) whose components are those of all links.

    Every edge joins fingerprints at most 4 bits apart, and any two such fingerprints are
    connected through edges.
    """
    prints = durable(prints.select("fp").distinct(), "fingerprints")
    prints = prints.repartition(max(1, prints.count() // TASK))  # a few MB of numbers make many rows
    met = _variants(prints).groupBy("key").agg(F.min("fp").alias("a"), F.max("fp").alias("b"), F.count("*").alias("n"))
    met = durable(met.where("n > 1"), "meetings")
    pairs = met.where("n = 2").where(_close("a", "b")).select("a", "b")
    busy = met.where("n > 2").select("key", "n")
    members = durable(told_apart(_variants(prints), "key", busy.select("key"))[0].join(busy, "key"), "members")
    few = members.where(F.col("n") <= CROWD).select("key", "fp")
    some = (
        few.select("key", F.col("fp").alias("a"))
        .join(few.select("key", F.col("fp").alias("b")), "key")
        .where("a < b")
        .where(_close("a", "b"))
        .select("a", "b")
    )
    crowd = members.where(F.col("n") > CROWD).select("fp").distinct()
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(64, RADIUS // 2)])
    ball = crowd.select("fp", F.explode(masks).alias("mask")).select(
        "fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("key")
    )
    least = ball.groupBy("key").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    # the planner takes a ball for one row: left alone it sends all balls to the driver, to broadcast them
    many = ball.hint("merge").join(least.hint("merge"), "key").where("fp <> a").select("a", F.col("fp").alias("b"))
    return pairs.union(some).union(many).distinct()


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """One row per document: key, fingerprint (16 hex digits) and component_id.

    component_id is the smallest key that can be reached over links of 4 or fewer differing
    bits. Texts without words, nulls included, have fingerprint 0 and are linked like any
    other. Rows with a null key are grouped too but name no component. Repeated rows stay.
    """
    rows = docs.select(col(key).alias("key"), col(text).alias("text"))
    rows = durable(rows.select("key", fingerprint("text", width).alias("fp")), "prints")
    return _classes(rows).select(
        F.col("key").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _classes(rows: DataFrame) -> DataFrame:
    """Adds component_id, the smallest `key` in the class, to rows with a fingerprint `fp`."""
    least = durable(rows.groupBy("fp").agg(F.min("key").alias("least")), "least")
    rooted = durable(components(links(least)), "roots")
    named = least.join(rooted, least["fp"] == rooted["node"], "left").select(
        least["fp"], F.coalesce("root", least["fp"]).alias("root"), "least"
    )
    classes = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(named.select("fp", "root").join(classes, "root").drop("root"), "fp")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """The documents without near-duplicates: of each class, the row with the smallest key stays.

    Of rows that share that key, one stays. All columns are kept as they are.
    """
    rows, row = with_rows(docs)
    order = fresh(rows, "_key")
    prints = rows.select(col(key).alias(order), col(row), fingerprint(text, width).alias("fp"))
    prints = durable(prints, "prints")
    least = durable(prints.groupBy("fp").agg(F.min(F.struct(F.col(order).isNull(), order, row)).alias("first")), "least")
    rooted = durable(components(links(least)), "roots")
    named = least.join(rooted, least["fp"] == rooted["node"], "left")
    first = named.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    return rows.join(first.select(F.col(f"first.{row}").alias(row)), row, "left_semi").drop(row)


def keep_unlike(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """The documents without near copies: of each class, the row with the smallest key stays.

    Two texts are linked if their sets of `width`-word shingles (by 64-bit hashes) have a Jaccard
    similarity of at least `percent` / 100; a class is what links connect. Words are those of
    `fingerprint_text`; texts without words, nulls included, are alike. Of rows that share the
    smallest key, one stays. All columns are kept as they are.

    Sets whose fingerprints are linked (`links`, over the different shingles) are compared first. Most similar
    texts lie further apart than fingerprints are linked, so the others are found by their leading
    shingles. No pair is missed: with the shingles of all texts in one order, sets of that similarity share some among
    their first n - ceil(percent n / 100) + 1, and how many they share there bounds what they share in all.
    Only pairs within the bound are compared in full. The order puts shingles that are frequent
    in a sample last, so that common ones seldom bring texts together.
    """
    rows, row = with_rows(docs)
    order, words = fresh(rows, "_key"), F.col("_words")
    texts = rows.select(col(key).alias(order), col(row).alias("node"), col(text).alias("_words"))
    hot = _frequent(texts.where(F.pmod(F.xxhash64("node"), F.lit(SAMPLE)) == 0), width)
    made = texts.select(order, "node", _leading(words, width, percent, hot).alias("s"))
    sketches = durable(made.select(order, "node", "s.*"), "sketches")
    # equal sets have equal fingerprints
    rank = F.struct(F.col(order).isNull(), order, "node")
    least = sketches.groupBy("same").agg(F.min(rank).alias("first"), F.min("fp").alias("fp"), F.count("*").alias("held"))
    least = durable(least.select("same", "first", F.col("first.node").alias("node"), "fp", "held"), "least")
    firsts = least.where("held > 1").select("same", F.col("node").alias("kept"))
    spare = durable(sketches.select("same", "node").join(firsts, "same").where("node <> kept").select("node"), "spare")
    chosen = durable(without(sketches.select("node", "n", "lead", "last"), "node", spare), "chosen")
    release(sketches)
    members = settled(lambda: _members(chosen), "members")
    release(chosen)
    linked = settled(lambda: _linked(least.select("node", "fp")), "linked")
    rooted = settled(lambda: components(_alike(texts, members, linked, width, percent)), "roots")
    release(members, linked)
    named = least.join(rooted, "node", "left")
    # most sets are a class of their own, whose smallest row stays
    several = named.where("root IS NOT NULL")
    first = several.groupBy("root").agg(F.min("first").alias("first"))
    lost = several.select("root", "node").join(first.select("root", F.col("first.node").alias("kept")), "root").where("node <> kept")
    gone = durable(lost.select("node").union(spare).select(F.col("node").alias(row)), "gone")
    release(least, rooted, spare)
    return without(rows, row, gone).drop(row)


def _frequent(texts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that stand in several texts of a sample, ascending, and in how many; at most FREQUENT."""
    seen = texts.select(F.explode(_sets(F.col("_words"), width)).alias("hash")).groupBy("hash").agg(F.count("*").alias("n"))
    most = seen.where(f"n >= {SEVERAL}").orderBy(F.desc("n"), "hash").limit(FREQUENT).toPandas().sort_values("hash")
    return most["hash"].to_numpy(np.int64), most["n"].to_numpy(np.int64)


def _sets(text: Column, width: int) -> Column:
    """Column array<long>: the different shingles."""

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in thrifty(batches):
            yield pd.Series([shingle_set(t, width) for t in batch], dtype=object)

    return run(text)


def _leading(text: Column, width: int, percent: int, hot: tuple[np.ndarray, np.ndarray]) -> Column:
    """Column struct: of the shingle set a digest, the fingerprint, the size, the first shingles in the common order and where they end."""
    known, often = hot

    @F.pandas_udf("same binary, fp long, n int, lead array<long>, last struct<rank:long,hash:long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in thrifty(batches):
            same, fp, n, lead, last = [], [], [], [], []
            for t in batch:
                found = shingle_set(t, width)
                size = len(found)
                same.append(xxhash.xxh3_128_digest(found.tobytes()))
                fp.append(fingerprint_set(found))
                n.append(size)
                rank = np.zeros(size, np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, found), len(known) - 1)
                    rank = np.where(known[at] == found, often[at], 0)
                first = np.lexsort((found, rank))[: size - -(-percent * size // 100) + 1]
                lead.append(found[first])
                last.append((int(rank[first[-1]]), int(found[first[-1]])) if size else (0, 0))
            ends = pd.DataFrame(last, columns=["rank", "hash"]).to_dict("records")
            yield pd.DataFrame({"same": same, "fp": np.array(fp, np.uint64).view(np.int64), "n": n, "lead": pd.Series(lead, dtype=object), "last": pd.Series(ends, dtype=object)})

    return run(text)


def _linked(prints: DataFrame) -> DataFrame:
    """Pairs (a, b), a < b, of texts (node, fp) whose fingerprints are equal or linked; a fingerprint's smallest text stands for it."""
    named = durable(prints.groupBy("fp").agg(F.min("node").alias("first")), "named")
    same = prints.join(named, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b"))
    met = links(named).join(named.select(F.col("fp").alias("a"), F.col("first").alias("x")), "a")
    met = met.join(named.select(F.col("fp").alias("b"), F.col("first").alias("y")), "b")
    return same.union(met.select(F.least("x", "y"), F.greatest("x", "y")))


def _members(sketches: DataFrame) -> DataFrame:
    """(key, node, n, ahead, last) of each leading shingle that stands in several sets; `ahead` are the shingles before it.

    `rest` is how many shingles of the set follow its leading ones.
    """
    leads = sketches.select("node", "n", (F.col("n") - F.size("lead")).alias("rest"), "last", F.posexplode("lead").alias("ahead", "key"))
    busy = durable(leads.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key"), "busy")
    # not a semi join: the optimizer would move it, and the shuffle of all leading shingles, below the filter
    return told_apart(leads, "key", busy)[0].join(busy, "key")


def _bounded(met: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared) of the pairs in `met`, one row per leading shingle they share, that can be similar enough.

    A shingle that both hold without leading both follows the leading ones of the set whose leading ones end first.
    """
    first = F.col("last_a") <= F.col("last_b")
    # what both sets still hold from the first place on that they share
    left = F.least(F.col("n_a") - F.col("ahead_a"), F.col("n_b") - F.col("ahead_b"))
    pairs = met.groupBy(F.col("node_a").alias("a"), F.col("node_b").alias("b")).agg(
        F.count("*").alias("shared"),
        F.max(left).cast("long").alias("left"),
        F.first(F.when(first, F.col("rest_a")).otherwise(F.col("rest_b"))).alias("rest"),
        F.first(F.col("n_a") + F.col("n_b")).cast("long").alias("both"),
    )
    most = F.least("left", F.col("shared") + F.col("rest"))
    return pairs.where((100 + percent) * most >= percent * F.col("both")).select("a", "b", "shared")


def _alike(texts: DataFrame, members: DataFrame, linked: DataFrame, width: int, percent: int) -> DataFrame:
    """Edges (a, b) between similar texts (of different sets); their components are those of all links.

    First the pairs of `linked` fingerprints are compared, and each set with the smallest one under a shared
    shingle, of those that it may be similar to the one that shares most: most near copies are linked
    by these alone. Then all pairs that share a shingle meet, but for those that lie in one component already.
    """

    def side(frame: DataFrame, s: str) -> DataFrame:
        return frame.select("key", *[F.col(c).alias(f"{c}_{s}") for c in frame.columns if c != "key"])

    # sets of too different sizes are not similar
    enough = (100 + percent) * F.least("n_a", "n_b").cast("long") >= percent * (F.col("n_a") + F.col("n_b")).cast("long")
    facts = ("node", "n", "rest", "last", "ahead")
    least = members.groupBy("key").agg(F.min(F.struct(*facts)).alias("first")).select("key", "first.*")
    star = side(least, "a").join(side(members, "b"), "key").where("node_a < node_b").where(enough)
    star = _bounded(star, percent).groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a"))
    tried = durable(linked.union(star.select("a", "b")).distinct(), "tried")
    sure = durable(_confirmed(tried, texts, width, percent), "sure")
    rooted = settled(lambda: components(sure), "rooted")
    known = members.join(rooted, "node", "left").withColumn("root", F.coalesce("root", "node")).select("key", *facts, "root")
    met = side(known, "a").join(side(known, "b"), "key").where("node_a < node_b AND root_a <> root_b").where(enough)
    pairs = durable(_bounded(met, percent).select("a", "b").join(tried, ["a", "b"], "left_anti"), "pairs")
    release(rooted)
    return sure.union(_confirmed(pairs, texts, width, percent))


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts (node, _words) are similar enough, by their whole shingle sets."""

    @F.pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for left, right in thrifty(batches):
            out = []
            for x, y in zip(left, right, strict=True):
                x, y = shingle_set(x, width), shingle_set(y, width)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                out.append((100 + percent) * shared >= percent * (len(x) + len(y)))
            yield pd.Series(out, dtype=bool)

    nodes = pairs.select(F.col("a").alias("key")).union(pairs.select("b")).distinct()
    near, _ = told_apart(texts.select(F.col("node").alias("key"), "_words"), "key", nodes)
    both = pairs.join(near.select(F.col("key").alias("a"), F.col("_words").alias("x")), "a")
    both = both.join(near.select(F.col("key").alias("b"), F.col("_words").alias("y")), "b")
    return both.where(similar("x", "y")).select("a", "b")
