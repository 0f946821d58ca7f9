"""The trie of conversation prefixes, with totals rolled up over its subtrees."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterflow.llm.centroids import PIECE, subtree_totals
from rosterflow.llm.common import saved, ship
from rosterflow.llm.turns import looked_up, n_words, placed, turn_digest

# Depths whose keys are summed up in one window, and ids written into one chunk of text, as powers of two.
DEPTH_BITS = 10
CHUNK_BITS = 12

NODE = ["depth", "key_1", "key_2"]


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``digest`` and ``words`` of every row with an id; a null role or text is empty."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = conversations.filter(F.col("conv_id").isNotNull())
    return known.select("conv_id", "turn", turn_digest(role, text).alias("digest"), n_words(text).alias("words"))


def shared_prefixes(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt so that they share prefixes: their turns by ``depth``, and their sizes.

    Conversation c takes the first h turns of conversation c - c % 20, h being the CRC-32 of its id
    modulo 4, in place of its own first h. A conversation c - c % 20 stays as it is.
    """
    rows = placed(turns.select("conv_id", "turn", "digest", "words"), "digest").select("conv_id", "place", "digest", "words")
    rows = saved(rows)
    conv_id = F.col("conv_id")
    base = conv_id - conv_id % 20
    borrowed = F.when(base == conv_id, 0).otherwise(F.crc32(conv_id.cast("string").cast("binary")) % 4)
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).select("*", base.alias("base_id"), borrowed.alias("h"))
    base_sizes = sizes.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"))
    sizes = sizes.join(base_sizes, "base_id", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    sizes = saved(sizes.withColumn("n_turns", F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))))
    # Each row learns its conversation's figures; a conversation that holds a large share of all rows is broadcast.
    own = looked_up(rows, sizes.select("conv_id", "h", "taken", "n"), ["conv_id"], "n", rows.count())
    own = own.filter(F.col("place") > F.col("h")).withColumn("depth", F.col("place") - F.col("h") + F.col("taken"))
    first = rows.filter((F.col("place") <= 3) & (conv_id % 20 == 0)).withColumnRenamed("conv_id", "base_id")
    others = sizes.filter("h > 0").select("conv_id", "base_id", "h").join(first, "base_id").filter("place <= h")
    columns = ["conv_id", "depth", "digest", "words"]
    return own.select(columns).union(others.withColumn("depth", F.col("place")).select(columns)), sizes.select("conv_id", "n_turns")


def prefix_keys(turns: DataFrame, sizes: DataFrame) -> DataFrame:
    """The node of every turn: 128 bits that stand for the sequence of turns up to it, and those of its parent.

    A turn's part of a key mixes its digest with its depth; parts are joined by exclusive or, first
    within blocks of depths and then over the blocks, so a long conversation is no single window.
    """
    part = [F.xxhash64("digest", "depth"), F.xxhash64("depth", "digest")]
    turns = turns.select("conv_id", "depth", "words", part[0].alias("part_1"), part[1].alias("part_2"), F.shiftright("depth", DEPTH_BITS).alias("block"))
    block = ["conv_id", "block"]
    so_far = Window.partitionBy(*block).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    within = turns.withColumns({f"so_far_{i}": F.bit_xor(f"part_{i}").over(so_far) for i in (1, 2)})
    blocks = turns.groupBy(*block).agg(*[F.bit_xor(f"part_{i}").alias(f"all_{i}") for i in (1, 2)])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(*block, *[F.coalesce(F.bit_xor(f"all_{i}").over(earlier), F.lit(0)).alias(f"before_{i}") for i in (1, 2)])
    joined = within.join(before.join(sizes, "conv_id"), block)
    key = {i: F.col(f"so_far_{i}").bitwiseXOR(F.col(f"before_{i}")) for i in (1, 2)}
    parent = {i: key[i].bitwiseXOR(F.col(f"part_{i}")) for i in (1, 2)}
    return joined.select(
        F.col("conv_id").alias("member"), "depth", "words", "n_turns",
        *[key[i].alias(f"key_{i}") for i in (1, 2)], *[parent[i].alias(f"parent_{i}") for i in (1, 2)],
    )


def prefix_trie(conversations: DataFrame, piece: int = PIECE, rebuilt: bool = True) -> DataFrame:
    """One row per distinct sequence of first turns (role and text) of conversations, from the empty one on.

    ``conversations`` has ``conv_id``, ``turn``, ``role`` and ``text``; other columns do not count. Turns are ordered by ``turn``,
    nulls first, and of equal ones by the SHA-256 of role and text. With ``rebuilt`` conversations
    first share prefixes as ``shared_prefixes`` says; without it they are taken as they are.

    A node has its smallest member (``conv_id``), ``depth``, its parent's smallest member, the numbers of
    members and children, the leaves of its subtree, the tokens that sharing saves there (members but one times the
    words of the last text, over the subtree's nodes) and the digest of the ids that end at it.
    Subtree totals come from a centroid decomposition (``subtree_totals``).

    A null role or text is empty; rows without ``conv_id`` belong to no conversation and are left out; repeated
    rows are turns of their own; texts of any length are only digested and counted before rows move.
    Without conversations there is no node.
    """
    turns = conversation_turns(conversations)
    if rebuilt:
        turns, sizes = shared_prefixes(turns)
    else:
        turns = placed(turns, "digest").withColumnRenamed("place", "depth")
        sizes = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_turns"))
    sizes = saved(sizes)
    path = saved(prefix_keys(turns, sizes))
    nodes = path.groupBy(*NODE).agg(
        F.min("member").alias("member"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        F.max("parent_1").alias("parent_1"), F.max("parent_2").alias("parent_2"), F.sum(F.col("n_turns") - F.col("depth") + 1).alias("weight"),
    )
    zero = F.lit(0).cast("long")
    root = sizes.agg(F.min("conv_id").alias("member"), F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("n_turns") + 1).alias("weight"))
    root = root.filter("n_convs > 0").select(
        *[zero.alias(k) for k in NODE], "member", "n_convs", zero.alias("words"), *[F.lit(None).cast("long").alias(f"parent_{i}") for i in (1, 2)], "weight"
    )
    nodes = nodes.unionByName(root)
    children = nodes.filter("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("parent_1").alias("key_1"), F.col("parent_2").alias("key_2"))
    nodes = nodes.join(children.agg(F.count(F.lit(1)).alias("n_children")), NODE, "left").fillna(0, ["n_children"])
    nodes = saved(nodes)
    parents = nodes.filter("n_children > 0").select(
        F.col("key_1").alias("parent_1"), F.col("key_2").alias("parent_2"), (F.col("depth") + 1).alias("depth"),
        F.col("member").alias("parent_conv_id"), "n_children",
    )
    # The root has no parent; its keys are null.
    nodes = looked_up(nodes, parents.withColumnRenamed("n_children", "_weight"), ["parent_1", "parent_2", "depth"], "_weight", nodes.count())
    nodes = nodes.withColumns(
        {"n_leaves": F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"), "saved_tokens": (F.col("n_convs") - 1) * F.col("words")}
    )
    totals = subtree_totals(nodes, path, ["n_leaves", "saved_tokens"], piece)
    ends = path.filter("depth = n_turns").select(*NODE, F.col("member").alias("conv_id"))
    ends = ends.union(sizes.filter("n_turns = 0").select(*[zero.alias(k) for k in NODE], "conv_id"))
    return totals.join(end_digests(ends), NODE, "left").select(
        F.col("member").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ids that end at each node, ascending, with commas between them.

    Ids are first written into chunks of at most 4,096, by range; the chunks of a node are then digested
    as they pass, in order, and never held together.
    """
    ship(ends.sparkSession)
    chunk = F.shiftright("conv_id", CHUNK_BITS).alias("chunk")
    ids: Column = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    chunks = ends.groupBy(*NODE, chunk).agg(F.array_join(ids, ",").alias("ids"))
    ordered = chunks.repartition(*NODE).sortWithinPartitions(*NODE, "chunk")
    return ordered.mapInArrow(_digest_runs, "depth long, key_1 long, key_2 long, ends_sha256 string")


def _digest_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, digest, done = None, hashlib.sha256(), []

    def rows() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) if done else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()], strict=True)], [*NODE, "ends_sha256"])

    for batch in batches:
        keys = zip(*[batch.column(k).to_pylist() for k in range(3)], strict=True)
        for key, ids in zip(keys, batch.column(4), strict=True):
            if key != current:
                if current is not None:
                    done.append((*current, digest.hexdigest()))
                current, digest = key, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_buffer())
        yield rows()
        done = []
    if current is not None:
        done.append((*current, digest.hexdigest()))
        yield rows()
