"""Prefix trie of conversations by whole-sequence collapse.

Texts never move: each turn is a digest and a byte count from the first projection on. A prefix is
named by two running XORs of hashes of (place, turn), so the name of every prefix of a conversation
is one pass over its turns, which are cut into stretches of STRETCH turns however long it is.
Conversations with one name are one weighted sequence. Sequences that are proper prefixes of
others leave by an anti-join; the rest are the leaves. All figures of a node are sums over the
weighted sequences below it, combined before the shuffle, so the root is no hot key.

A sum over the different nodes below a node needs each of them once: a node is owned by the smallest leaf
below it. The nodes a leaf owns are the lower end of its path, so one number per leaf tells them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventmart.llm.common import col, fresh, with_positions
from eventmart.session import durable, release, settled

STRETCH = 4096  # turns that one window orders
CHUNK = 4096  # ids that one text of an end list holds
TURNS = "conv_id long, place long, digest binary, bytes long"
_NODE = ["h1", "h2"]


def numbered_turns(frame: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, place from 0, digest, bytes) of every row with a key, in the order of `turn`, nulls first.

    Null roles and texts are empty. Rows of one conversation with the same turn are ordered by their
    digest; repeated rows each count. A range sort, so a conversation may fill many tasks.
    """
    who, what = (F.coalesce(col(c).cast("string"), F.lit("")) for c in (role, text))
    told = F.concat(F.octet_length(who).cast("string"), F.lit(":"), who, what)
    rows = frame.where(col(key).isNotNull()).select(
        col(key).cast("long").alias("conv_id"),
        F.struct(col(turn).isNotNull().alias("known"), col(turn).alias("turn")).alias("turn"),
        F.unhex(F.md5(told)).alias("digest"),
        F.octet_length(what).cast("long").alias("bytes"),
        F.monotonically_increasing_id().alias("row"),
    )
    placed = with_positions(durable(rows, "turns"), ["conv_id", "turn", "digest", "row"])
    first = placed.groupBy("conv_id").agg(F.min("position").alias("first"))
    return placed.join(first, "conv_id").select("conv_id", (F.col("position") - F.col("first")).alias("place"), "digest", "bytes")


def rebuilt_turns(turns: DataFrame, base: Column, kept: Column) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first `kept` turns of `base` (both over conv_id) and go on with their own.

    Of a base with fewer turns all are taken, of one that is absent none; the own turns start after
    the first `kept`. Returns the conversations (conv_id, n_turns) and their turns, places from 1.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    wanted = sizes.withColumn("base", base).withColumn("kept", kept.cast("long"))
    found = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("kept", F.coalesce("n_base", F.lit(0)))
    plan = wanted.join(found, "base", "left").withColumn("taken", taken)
    plan = plan.withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("kept"), F.lit(0)))
    plan = durable(plan.select("conv_id", "base", "kept", "taken", "n_turns"), "plan")
    heads = (
        plan.where("taken > 0")
        .select("conv_id", "base", "taken")
        .join(turns.withColumnRenamed("conv_id", "base"), "base")
        .where("place < taken")
        .select("conv_id", (F.col("place") + 1).alias("place"), "digest", "bytes")
    )
    tails = (
        turns.join(plan.select("conv_id", "kept", "taken"), "conv_id")
        .where("place >= kept")
        .select("conv_id", (F.col("place") - F.col("kept") + F.col("taken") + 1).alias("place"), "digest", "bytes")
    )
    return plan.select("conv_id", "n_turns"), heads.union(tails)


def _named(turns: DataFrame) -> DataFrame:
    """Adds to each turn the name (h1, h2) of the prefix that ends there, that of its parent, and the bytes before it."""
    own = turns.select(
        "conv_id",
        "place",
        "bytes",
        F.floor((F.col("place") - 1) / STRETCH).alias("stretch"),
        F.xxhash64("place", "digest").alias("x1"),
        F.xxhash64(F.lit("second"), "digest", "place").alias("x2"),
    )
    within = Window.partitionBy("conv_id", "stretch").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    whole = own.groupBy("conv_id", "stretch").agg(
        F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"), F.sum("bytes").alias("sb")
    )
    carried = whole.select(
        "conv_id",
        "stretch",
        F.coalesce(F.bit_xor("s1").over(before), F.lit(0)).alias("c1"),
        F.coalesce(F.bit_xor("s2").over(before), F.lit(0)).alias("c2"),
        F.coalesce(F.sum("sb").over(before), F.lit(0)).alias("cb"),
    ).where("stretch > 0")
    run = own.select(
        "*", *[F.bit_xor(x).over(within).alias(r) for x, r in (("x1", "r1"), ("x2", "r2"))], F.sum("bytes").over(within).alias("rb")
    )
    run = run.join(carried, ["conv_id", "stretch"], "left").na.fill(0, ["c1", "c2", "cb"])
    h1, h2 = (F.col(f"r{i}").bitwiseXOR(F.col(f"c{i}")) for i in (1, 2))
    return run.select(
        "conv_id",
        F.col("place").alias("depth"),
        h1.alias("h1"),
        h2.alias("h2"),
        h1.bitwiseXOR(F.col("x1")).alias("p1"),
        h2.bitwiseXOR(F.col("x2")).alias("p2"),
        (F.col("rb") + F.col("cb") - F.col("bytes")).alias("above"),
        (F.col("rb") + F.col("cb")).alias("upto"),
    )


def _digests(lists: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each name's texts, which follow each other: one state at a time, whatever the length of a list."""
    now, state = None, None

    def done(pairs: list) -> pa.RecordBatch:
        names, sums = [n for n, _ in pairs], [s for _, s in pairs]
        return pa.RecordBatch.from_arrays(
            [pa.array([n[0] for n in names], pa.int64()), pa.array([n[1] for n in names], pa.int64()), pa.array(sums, pa.string())],
            ["h1", "h2", "ends_sha256"],
        )

    for batch in lists:
        out = []
        for h1, h2, ids in zip(*(batch.column(c).to_pylist() for c in ("h1", "h2", "ids")), strict=True):
            if (h1, h2) == now:
                state.update(b",")
            else:
                if now is not None:
                    out.append((now, state.hexdigest()))
                now, state = (h1, h2), hashlib.sha256()
            state.update(ids.encode())
        if out:
            yield done(out)
    if now is not None:
        yield done([(now, state.hexdigest())])


def _end_lists(ends: DataFrame) -> DataFrame:
    """(h1, h2, ends_sha256): the ids of each sequence, joined by parallel tasks in texts of at most CHUNK ids."""
    placed = with_positions(ends.select("h1", "h2", "conv_id"), ["h1", "h2", "conv_id"])
    chunk = F.floor(F.col("position") / CHUNK).alias("chunk")
    ids = F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",")
    texts = placed.groupBy("h1", "h2", chunk).agg(ids.alias("ids"))
    dealt = texts.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "chunk")
    return dealt.mapInArrow(_digests, "h1 long, h2 long, ends_sha256 string")


def prefix_trie(convs: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per different sequence of first turns: the figures of the node and of the subtree below it.

    `convs` has each conv_id once, with n_turns (0 too); `turns` has conv_id, place (from 1 without gaps),
    digest and bytes. Columns: conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves, saved_tokens (bytes that storing each node's last text once
    saves in its subtree), ends_sha256 (of the members that end there). No conversations, no nodes.
    """
    named = durable(_named(turns), "prefixes")
    last = named.select("conv_id", F.col("depth").alias("n_turns"), "h1", "h2", F.col("upto").alias("total"))
    ends = convs.join(last, ["conv_id", "n_turns"], "left").na.fill(0, ["h1", "h2", "total"])
    ends = durable(ends.select("conv_id", "n_turns", "h1", "h2", "total"), "ends")
    # whole sequences: the smallest member stands for all of them
    seqs = ends.groupBy(*_NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.first("n_turns").alias("n_turns"), F.first("total").alias("total")
    )
    seqs = durable(seqs, "sequences")
    root = seqs.select(
        "conv_id", F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in ("h1", "h2")],
        *[F.lit(None).cast("long").alias(c) for c in ("p1", "p2")], *[F.lit(0).cast("long").alias(c) for c in ("above", "upto")],
    )
    paths = named.join(seqs.select("conv_id"), "conv_id", "left_semi").unionByName(root)
    paths = durable(paths.join(seqs.select("conv_id", "weight", "n_turns", "total"), "conv_id"), "paths")
    release(named)
    inner = paths.where("depth < n_turns").select(*_NODE).distinct()
    leaves = durable(seqs.join(inner, _NODE, "left_anti").select("conv_id"), "leaves")
    marked = paths.join(leaves.withColumnRenamed("conv_id", "leaf"), F.col("conv_id") == F.col("leaf"), "left")
    nodes = marked.groupBy(*_NODE).agg(
        F.first("depth").alias("depth"),
        F.first("p1").alias("p1"),
        F.first("p2").alias("p2"),
        F.first("above").alias("above"),
        F.min("conv_id").alias("conv_id"),
        F.sum("weight").alias("n_convs"),
        F.count("leaf").alias("n_leaves"),
        F.min("leaf").alias("owner"),
        F.sum(F.col("weight") * (F.col("total") - F.col("above"))).alias("stored"),
    )
    nodes = durable(nodes, "nodes")
    owned = nodes.groupBy("owner").agg(F.min("above").alias("top"))
    own = paths.join(owned, F.col("conv_id") == F.col("owner"))
    distinct = own.groupBy(*_NODE).agg(F.sum(F.col("total") - F.greatest("above", "top")).alias("needed"))
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("h1"), F.col("p2").alias("h2")).agg(F.count("*").alias("n_children"))
    parents = nodes.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    lists = settled(lambda: _end_lists(ends), "lists")
    nothing = hashlib.sha256(b"").hexdigest()
    return (
        nodes.join(distinct, _NODE)
        .join(children, _NODE, "left")
        .join(lists, _NODE, "left")
        .join(parents, ["p1", "p2"], "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"),
            "n_leaves",
            (F.col("stored") - F.col("needed")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
        )
    )


def conversation_trie(frame: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """`prefix_trie` of conversations rebuilt on the start of another one: (conv_id, turn, role, text) rows.

    Conversation c begins with the first h turns of c - c % every, h = crc32(decimal c) % most, and goes
    on with its own turns after its first h. Rows without a conv_id take no part.
    """
    name = F.col("conv_id")
    kept = F.crc32(name.cast("string").cast("binary")) % most
    turns = settled(lambda: numbered_turns(frame), "numbered")
    return prefix_trie(*rebuilt_turns(turns, name - name % every, kept))
