"""Prefix trie of conversations, built by van Emde Boas recursion over depth.

A node is a distinct sequence of the first d turns (role, text). Naming every prefix of every conversation is done
bottom-up over the recursion of the van Emde Boas layout: a segment of 2s turns is cut at half depth s; its upper half
already has the name of its whole prefix (the cut prefix), its lower half already has names relative to the cut, and
one join per level grafts every lower forest under its cut name. All conversations and all segments of a level go
through one join, so the whole naming takes ceil(log2(deepest)) shuffles, and no conversation is ever held whole.
Totals are grafted upward the same way as rows: each node hands its own values to its smallest member, a running
sum down that member's rows gives every ancestor its share, and a group by node adds the shares of all members.

Names are pairs of 64-bit hashes (128 bits); two different prefixes of the same depth share a name with a chance of
about n^2 / 2^129 for n prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carepanel.llm.shared import ship_package, stored

EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def rebuilt_turns(conversations: DataFrame, base_every: int = 100, shared_turns: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rows (conv_id, pos, role, text, n_turns) of every rebuilt conversation, and (conv_id, n_turns) of every conv_id.

    Turns are ordered by turn (null first), then role and text; null role or text is the empty string. Conversation c
    is rebuilt from the first h = crc32(decimal c) % ``shared_turns`` turns of conversation c - c % ``base_every``
    (all if fewer, none if absent), then c's own turns after its first h; c % ``base_every`` has the sign of c, as in
    SQL. Rows of a null conv_id belong to no conversation and are left out; repeated rows are turns of their own.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    numbered = stored(turns.withColumn("pos", F.row_number().over(order) - 1).drop("turn"), "trie-turns")
    lengths = numbered.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    conv = F.col("conv_id")
    ids = lengths.select(
        conv, F.col("length"), (F.crc32(conv.cast("string")) % shared_turns).alias("h"), (conv - conv % base_every).alias("base")
    )
    base_lengths = lengths.select(F.col("conv_id").alias("base"), F.col("length").alias("base_length"))
    ids = ids.join(base_lengths, "base", "left").select(
        "conv_id", "h", "base", F.least("h", F.coalesce("base_length", F.lit(0))).alias("m"), "length"
    ).withColumn("n_turns", F.col("m") + F.greatest(F.col("length") - F.col("h"), F.lit(0)))
    from_base = ids.join(
        numbered.where(F.col("pos") < shared_turns).withColumnRenamed("conv_id", "base"), "base"
    ).where(F.col("pos") < F.col("h")).select("conv_id", "pos", "role", "text", "n_turns")
    own = ids.join(numbered, "conv_id").where(F.col("pos") >= F.col("h")).select(
        "conv_id", (F.col("m") + F.col("pos") - F.col("h")).alias("pos"), "role", "text", "n_turns"
    )
    return from_base.unionByName(own), ids.select("conv_id", "n_turns")


def _combine(cut_a, cut_b, own_a, own_b):
    return F.xxhash64(cut_a, cut_b, own_a, own_b), F.xxhash64(own_b, cut_b, own_a, cut_a, F.lit("graft"))


def prefix_names(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, depth, a, b, chars): the 128-bit name (a, b) of each conversation's prefix of ``depth`` >= 1 turns
    and the code points of that prefix's last text.

    Level k turns segments of 2^k turns, named relative to their start, into segments of 2^(k+1): the lower half of
    each pair joins the name of its upper half at the cut and is renamed under it; the upper half stays.
    """
    rows = turns.select(
        "conv_id",
        (F.col("pos") + 1).alias("depth"),
        F.xxhash64("role", "text").alias("a"),
        F.xxhash64(F.lit("turn"), "text", "role").alias("b"),
        F.char_length("text").cast("long").alias("chars"),
    )
    deepest = turns.agg(F.max("n_turns")).first()[0] or 0
    span = 1
    while span < deepest:
        rows = stored(rows, "trie-level")
        segment = F.floor((F.col("depth") - 1) / span)
        lower = rows.where(segment % 2 == 1)
        cuts = rows.where(F.col("depth") % (2 * span) == span).select(
            "conv_id", F.col("depth").alias("cut"), F.col("a").alias("cut_a"), F.col("b").alias("cut_b")
        )
        grafted = lower.withColumn("cut", segment * span).join(cuts, ["conv_id", "cut"])
        a, b = _combine("cut_a", "cut_b", "a", "b")
        rows = rows.where(segment % 2 == 0).unionByName(grafted.select("conv_id", "depth", a.alias("a"), b.alias("b"), "chars"))
        span *= 2
    return rows


def _digest_ends(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of the comma-joined decimal conv_ids per node, streamed over rows sorted by node and conv_id."""
    key, state = None, None
    for batch in batches:
        out = []
        for depth, a, b, conv in zip(batch["depth"], batch["a"], batch["b"], batch["conv_id"]):
            if (depth, a, b) != key:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = (depth, a, b), hashlib.sha256(str(conv).encode())
            else:
                state.update(b"," + str(conv).encode())
        if out:
            yield pd.DataFrame(out, columns=["depth", "a", "b", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["depth", "a", "b", "ends_sha256"])


def conversation_trie(conversations: DataFrame, base_every: int = 100, shared_turns: int = 6) -> DataFrame:
    """One row per trie node of the rebuilt conversations (see ``rebuilt_turns``), all columns long but the digest.

    conv_id: smallest member; depth; parent_conv_id (root: null); n_convs: members, the rebuilt conversations that start
    with the node (turnless ones are members of the root only); n_children; n_leaves: childless nodes of its subtree,
    itself included; saved_tokens: over its subtree, each node's (n_convs - 1) times the code points of its last text
    (root: none); ends_sha256: SHA-256 hex of the ascending decimal conv_ids of members with exactly ``depth`` turns,
    comma-joined (none: the empty string's hash). An empty table or one of null conv_ids only gives no node.
    """
    spark = conversations.sparkSession
    ship_package(spark)
    turns, lengths = rebuilt_turns(conversations, base_every, shared_turns)
    turns = stored(turns, "trie-rebuilt")
    lengths = stored(lengths, "trie-lengths")
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", zero.alias("depth"), zero.alias("a"), zero.alias("b"), zero.alias("chars"))
    rows = prefix_names(turns).unionByName(roots)
    by_conv = Window.partitionBy("conv_id").orderBy("depth")
    rows = stored(
        rows.withColumn("pa", F.lag("a").over(by_conv)).withColumn("pb", F.lag("b").over(by_conv)), "trie-prefixes"
    )
    node = ["depth", "a", "b"]
    nodes = rows.groupBy(*node).agg(
        F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.max("chars").alias("chars"),
        F.first("pa").alias("pa"),
        F.first("pb").alias("pb"),
    )
    nodes = stored(nodes, "trie-nodes")
    children = nodes.where(F.col("depth") > 0).groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b")
    ).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id")
    )
    nodes = nodes.join(children, node, "left").join(parents, ["depth", "pa", "pb"], "left").select(
        *node, "conv_id", "parent_conv_id", "n_convs", F.coalesce("n_children", zero).alias("n_children"),
        F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("chars")).otherwise(zero).alias("own_saved"),
    )
    nodes = stored(nodes, "trie-linked")
    own = nodes.select(
        "conv_id", "depth", (F.col("n_children") == 0).cast("long").alias("own_leaves"), "own_saved"
    )
    down = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    shares = rows.select("conv_id", *node).join(own, ["conv_id", "depth"], "left").select(
        *node,
        F.sum(F.coalesce("own_leaves", zero)).over(down).alias("leaf_share"),
        F.sum(F.coalesce("own_saved", zero)).over(down).alias("saved_share"),
    )
    totals = shares.groupBy(*node).agg(F.sum("leaf_share").alias("n_leaves"), F.sum("saved_share").alias("saved_tokens"))
    ends = (
        rows.join(lengths.withColumnRenamed("n_turns", "depth"), ["conv_id", "depth"])
        .select(*node, "conv_id")
        .repartition(*node)
        .sortWithinPartitions(*node, "conv_id")
        .mapInPandas(_digest_ends, "depth long, a long, b long, ends_sha256 string")
    )
    return nodes.join(totals, node).join(ends, node, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.col("n_leaves").cast("long").alias("n_leaves"),
        F.col("saved_tokens").cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"),
    )
