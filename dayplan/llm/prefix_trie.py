"""Prefix trie of conversations by whole-sequence collapse.

Every conversation is rebuilt (a shared head, then its own turns) and named by a 128-bit hash of its
whole sequence: the exclusive or of one hash per (place, turn), so it is a plain aggregate and the
hashes of all prefixes are running aggregates. Identical conversations collapse into one weighted
sequence, which carries the list of conversations that end there. Sequences that are proper prefixes
of others go by anti join; what is left are the leaves. Only one copy of each sequence is laid out in
prefixes, and the trie is one weighted aggregate of them.

What a subtree adds up is collected without visiting it once per ancestor: every node belongs to the
sequence of its least member, the nodes of one sequence are the tail of its path, so a node's total
is the sum, over the sequences through it, of what each owns from there on.

Texts are read once and never shuffled; long sequences are worked off in blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dayplan.llm.fair_mix import word_count
from dayplan.llm.hot import join_facts
from dayplan.llm.shared import Scratch
from dayplan.operators.dense_index import dense_index

GROUP = 20  # conversations that share the head of the first of them
HEADS = 4  # a head has fewer turns than this
BLOCK = 1024  # turns of one conversation that a window looks at
CHUNK = 512  # ids in one piece of a list of ends

NODE = ["depth", "a", "b"]


def head_turns(conv_id: str) -> Column:
    """Turns that a conversation takes over: crc32 of its decimal id, modulo 4."""
    return F.crc32(F.col(conv_id).cast("string").cast("binary")) % HEADS


def ordered_turns(conversations: DataFrame, scratch: Scratch, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, int]:
    """(conv_id, turn_hash, words, at): all turns in order, numbered over the whole table.

    Order is by conv_id, turn (null first) and, for equal turns, md5 of role and text.
    """
    who, said = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    read = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"),
        F.unhex(F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, said))).alias("turn_hash"),
        word_count(text).alias("words"),
    )
    return dense_index(scratch.write(read, "turns"), "conv_id", "turn", "turn_hash", name="at")


def rebuild(turns: DataFrame, total: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(conv_id, p, turn_hash, words) of rebuilt conversations, and every conv_id.

    A conversation starts with the first turns of the first one of its group, as many as there are
    up to its ``head_turns``, and goes on with its own turns behind its first ``head_turns``.
    """
    sizes = scratch.write(
        turns.groupBy("conv_id").agg(F.min("at").alias("start"), F.count("*").alias("own"))
        .withColumn("h", head_turns("conv_id")).withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP), "sizes")
    bases = sizes.where("conv_id = base").select("base", F.col("own").alias("in_base"))
    known = scratch.write(
        sizes.join(bases, "base", "left")
        .withColumn("head", F.least("h", F.coalesce("in_base", F.lit(0)))).drop("in_base"), "conversations")
    placed = scratch.write(
        join_facts(turns.drop("turn"), known, ["conv_id"], "own", total).withColumn("p", F.col("at") - F.col("start"))
        .select("conv_id", "base", "h", "head", "p", "turn_hash", "words"), "placed")
    taken = (
        placed.where((F.col("conv_id") == F.col("base")) & (F.col("p") < HEADS - 1))
        .select("base", "p", "turn_hash", "words")  # at most three rows for each base
    )
    heads = known.where("head > 0").select("conv_id", "base", "head").join(taken, "base").where("p < head")
    columns = ["conv_id", "p", "turn_hash", "words"]
    own = placed.where("p >= h").withColumn("p", F.col("p") - F.col("h") + F.col("head"))
    return scratch.write(own.select(*columns).unionByName(heads.select(*columns)), "rebuilt"), known.select("conv_id")


def _marks(turns: DataFrame) -> DataFrame:
    """Two 64-bit hashes of every (place, turn)."""
    return turns.withColumns({name: F.xxhash64(F.lit(salt), "p", "turn_hash") for name, salt in (("a", 1), ("b", 2))})


def collapse(rebuilt: DataFrame, ids: DataFrame) -> DataFrame:
    """(conv_id, depth, a, b): length and name of every whole sequence, of turnless ones too."""
    nothing = F.lit(0).cast("bigint")
    marks = _marks(rebuilt).select("conv_id", F.lit(1).cast("bigint").alias("one"), "a", "b")
    return marks.unionByName(ids.select("conv_id", nothing.alias("one"), nothing.alias("a"), nothing.alias("b"))).groupBy(
        "conv_id").agg(F.sum("one").alias("depth"), F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))


def end_lists(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256): digest of the ascending ids of the conversations of each sequence.

    The ids are range partitioned, so a list may lie in many tasks; each gives out pieces of ``CHUNK``
    ids, and one digest is fed piece by piece. No list is ever held whole.
    """
    spark = ends.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = pa.schema([("depth", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids = None, 0, []

        def piece():
            return pa.RecordBatch.from_arrays(
                [*[pa.array([v], pa.int64()) for v in now], pa.array([first], pa.int64()), pa.array([",".join(ids)])],
                names=[*key.names, "first", "ids"])

        for batch in batches:
            for *name, conv in zip(*[c.to_pylist() for c in batch.columns]):
                if now is not None and (name != now or len(ids) == CHUNK):
                    yield piece()
                    ids = []
                if not ids:
                    now, first = name, conv
                ids.append(str(conv))
        if ids:
            yield piece()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None

        def done(names: list, digests: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [*[pa.array([name[k] for name in names], pa.int64()) for k in range(3)], pa.array(digests, pa.string())],
                names=[*key.names, "ends_sha256"])

        for batch in batches:
            names, digests = [], []
            for *name, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if name != now:
                    if state is not None:
                        names.append(now)
                        digests.append(state.hexdigest())
                    now, state = name, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield done(names, digests)
        if state is not None:
            yield done([now], [state.hexdigest()])

    ordered = ends.select(*NODE, "conv_id").repartitionByRange(n, *NODE, "conv_id").sortWithinPartitions(*NODE, "conv_id")
    pieces = ordered.mapInArrow(cut, "depth bigint, a bigint, b bigint, first bigint, ids string")
    return pieces.repartition(n, *NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digest, "depth bigint, a bigint, b bigint, ends_sha256 string")


def _laid_out(rebuilt: DataFrame, total: int, sequences: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, n, len, depth, a, b, words): every prefix of one conversation of each sequence."""
    kept = sequences.select("conv_id", "n", F.col("depth").alias("len"))
    rows = _marks(join_facts(rebuilt, kept, ["conv_id"], "len", total)).withColumn("block", F.expr(f"p div {BLOCK}"))
    rows = scratch.write(rows, "kept")
    upto = Window.partitionBy("conv_id", "block").orderBy("p")
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        rows.where(F.col("len") > BLOCK).groupBy("conv_id", "block")
        .agg(F.bit_xor("a").alias("ca"), F.bit_xor("b").alias("cb"))
        .withColumns({"ca": F.bit_xor("ca").over(before), "cb": F.bit_xor("cb").over(before)}).where("block > 0")
    )
    running = rows.withColumns({"a": F.bit_xor("a").over(upto), "b": F.bit_xor("b").over(upto)})
    nothing = F.lit(0).cast("bigint")
    inner = running.join(carry, ["conv_id", "block"], "left").select(
        "conv_id", "n", "len", (F.col("p") + 1).alias("depth"),
        F.col("a").bitwiseXOR(F.coalesce("ca", nothing)).alias("a"), F.col("b").bitwiseXOR(F.coalesce("cb", nothing)).alias("b"),
        "words")
    roots = kept.select("conv_id", "n", "len", *[nothing.alias(c) for c in ("depth", "a", "b", "words")])
    return inner.unionByName(roots)


def _from_here_on(paths: DataFrame) -> DataFrame:
    """Adds, per prefix of a sequence, sums over its tail, the node above and whether the one below is owned."""
    rows = paths.withColumn("block", F.expr(f"depth div {BLOCK}"))
    along = Window.partitionBy("sequence", "block").orderBy("depth")
    tail = Window.partitionBy("sequence", "block").orderBy(F.col("depth").desc())
    behind = Window.partitionBy("sequence").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = Window.partitionBy("sequence").orderBy("block")
    carry = (
        rows.where(F.col("len") >= BLOCK).groupBy("sequence", "block")
        .agg(F.sum("saved").alias("c_saved"), F.sum("leaf").alias("c_leaf"), F.max_by("conv_id", "depth").alias("last"),
             F.min_by("owned", "depth").alias("first"))
        .select("sequence", "block", F.sum("c_saved").over(behind).alias("c_saved"), F.sum("c_leaf").over(behind).alias("c_leaf"),
                F.lag("last").over(blocks).alias("c_above"), F.lead("first").over(blocks).alias("c_below"))
    )
    inside = rows.withColumns({
        "saved": F.sum("saved").over(tail), "leaf": F.sum("leaf").over(tail),
        "above": F.lag("conv_id").over(along), "below": F.lead("owned").over(along),
    })
    nothing = F.lit(0).cast("bigint")
    return inside.join(carry, ["sequence", "block"], "left").withColumns({
        "saved": F.col("saved") + F.coalesce("c_saved", nothing), "leaf": F.col("leaf") + F.coalesce("c_leaf", nothing),
        "above": F.coalesce("above", "c_above"), "below": F.coalesce("below", "c_below", nothing),
    }).drop("c_saved", "c_leaf", "c_above", "c_below", "block")


def prefix_trie(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """One row per node: conv_id (least member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    A node is a different sequence of first turns (role, text) of the rebuilt conversations, from the
    root of depth 0. Null role or text is empty; rows without a conv_id take no part; equal turns
    of a conversation go by md5 of role and text, repeated rows are repeated turns. No conversations
    give no rows, not even a root. Further columns are not read.
    """
    scratch = Scratch(conversations.sparkSession, "trie")
    turns, total = ordered_turns(conversations, scratch, conv_id, turn, role, text)
    rebuilt, ids = rebuild(turns, total, scratch)
    ends = scratch.write(collapse(rebuilt, ids), "ends")
    sequences = scratch.write(
        ends.groupBy(*NODE).agg(F.count("*").alias("n"), F.min("conv_id").alias("conv_id")), "sequences")
    paths, rows = scratch.write_counting(_laid_out(rebuilt, max(rebuilt.count(), 1), sequences, scratch), "prefixes")
    merged = scratch.write(
        paths.groupBy(*NODE).agg(
            F.min("conv_id").alias("member"), F.sum("n").alias("n_convs"), F.count("*").alias("n_paths"),
            F.max(F.col("depth") < F.col("len")).alias("inner")), "nodes")
    leaves = sequences.select(*NODE).join(merged.where("inner"), NODE, "left_anti").withColumn("leaf", F.lit(1).cast("bigint"))
    nodes = merged.drop("inner").join(leaves, NODE, "left").fillna({"leaf": 0})
    owned = F.col("conv_id") == F.col("member")
    walked = scratch.write(
        join_facts(paths, nodes, NODE, "n_paths", rows).select(
            F.col("conv_id").alias("sequence"), "len", *NODE, F.col("member").alias("conv_id"), "n_convs",
            owned.cast("bigint").alias("owned"),
            F.when(owned, (F.col("n_convs") - 1) * F.col("words")).otherwise(0).alias("saved"),
            F.when(F.col("depth") == F.col("len"), F.col("leaf")).otherwise(0).alias("leaf")), "paths")
    totals = _from_here_on(walked).groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.max("n_convs").alias("n_convs"), F.max("above").alias("parent_conv_id"),
        F.sum("below").alias("n_children"), F.sum("leaf").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    nobody = hashlib.sha256(b"").hexdigest()
    return totals.join(end_lists(ends), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(nobody)).alias("ends_sha256"))
