"""The trie of conversations that begin alike, by prefix doubling.

No sequence of turns is ever put together. A turn is named by a small number, dense over
all distinct turns; a block of a power of two of turns by a number for its parts' names, in
rounds of joins as many as the logarithm of the longest conversation. A round doubles the
blocks BITS times, as each round costs jobs whatever its rows. Then a prefix of d turns is
named along d's binary digits, the highest first: the name of the shorter prefix without
the lowest BITS digits, and the aligned blocks that fill it up. Equal
names mean equal prefixes, so each name is a node. A node belongs to its least member, and
so do all nodes below that this member has left to itself: a subtree's sum is that of its
members' own nodes from its depth on, which sums along each conversation give.

Every join is on a conversation and a place in it, or on names; names that
many conversations share is one row on the other side, so AQE may split it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomcast.llm.common import cut
from loomcast.operators.reliable import row_numbers

#: Bytes of decimal ids that travel as one row to the task that hashes a node's.
PIECE = 1 << 16
#: Binary digits that a round takes, and so halves of halves that are named at once: a larger step, fewer rounds of joins.
BITS = 3
WIDE = 1 << BITS
#: Turns of a conversation that a task adds up one after the other.
RUN = 1024


def numbered_turns(turns: DataFrame, conv: Column, turn: Column, role: Column, text: Column) -> DataFrame:
    """(conv_id, pos, key, chars): each conversation's turns from 0, by turn (null first), role and text.

    key is the SHA-256 of role and text, chars the text's code points; null role and text
    are empty. Rows without a conversation are left out. One sort over all rows, so that
    a very long conversation spreads over tasks.
    """
    rows = turns.select(conv.cast("long").alias("conv_id"), turn.alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).where("conv_id is not null")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    key = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256))
    laid = cut(rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", key.alias("key"), F.length("text").cast("long").alias("chars")))
    laid = cut(row_numbers(laid, "at")[0])
    return laid.join(laid.groupBy("conv_id").agg(F.min("at").alias("first")), "conv_id").select("conv_id", (F.col("at") - F.col("first")).alias("pos"), "key", "chars")


def _named(rows: DataFrame, pair: list[str], out: str, start: int = 0) -> tuple[DataFrame, int]:
    """rows with a dense number from start for each distinct value of the columns pair, in their stead; and the next number."""
    names, end = row_numbers(cut(rows.select(*pair).distinct()), out, start)
    return cut(rows.join(names, pair).drop(*pair)), end


def _parts(level: DataFrame, n: int) -> DataFrame:
    """(conv_id, j, n0, n1, ...): the first n of the WIDE names of each block of the next level; -1 for those that aren't there."""
    at = F.col("j").bitwiseAND(F.lit(WIDE - 1))
    held = [F.coalesce(F.max(F.when(at == i, F.col("name"))), F.lit(-1)).alias(f"n{i}") for i in range(n)]
    return level.groupBy("conv_id", F.shiftright("j", BITS).alias("j")).agg(*held)


def _blocks(turns: DataFrame, longest: int) -> list[DataFrame]:
    """(conv_id, j, name) of the aligned blocks of 1, WIDE, WIDE^2, ... turns: block j of size s holds turns j s to (j + 1) s - 1."""
    levels = [_named(turns.select("conv_id", F.col("pos").alias("j"), "key"), ["key"], "name")[0]]
    while WIDE ** len(levels) <= longest:
        whole = _parts(levels[-1], WIDE).where(f"n{WIDE - 1} >= 0")
        levels.append(_named(whole, [f"n{i}" for i in range(WIDE)], "name")[0])
    return levels


def _prefixes(convs: DataFrame, turns: DataFrame, longest: int) -> DataFrame:
    """(conv_id, depth, node): the node of each prefix of each conversation; the root is 0.

    In the round of blocks of a size depth counts in their number: a prefix is the one
    without its lowest BITS digits, and as many blocks as those say.
    """
    zero = F.lit(0).cast("long")
    known, used = convs.select("conv_id", zero.alias("depth"), zero.alias("node")), 1
    fills = [f"n{i}" for i in range(WIDE - 1)]
    for level in reversed(_blocks(turns, longest) if longest else []):
        known = known.withColumn("depth", F.col("depth") * WIDE)
        parts = _parts(level, WIDE - 1).where("n0 >= 0").withColumn("depth", F.col("j") * WIDE).drop("j")
        there = sum((F.col(c) >= 0).cast("int") for c in fills)
        met = known.withColumnRenamed("node", "upto").join(parts, ["conv_id", "depth"]).withColumn("more", F.explode(F.sequence(F.lit(1), there)))
        taken = [F.when(F.col("more") > i, F.col(c)).otherwise(-1).alias(c) for i, c in enumerate(fills)]
        new, used = _named(met.select("conv_id", (F.col("depth") + F.col("more")).alias("depth"), "upto", *taken), ["upto", *fills], "node", used)
        known = known.unionByName(new)
    return cut(known)


def _ends_hash(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) of rows (node, conv_id): the hash of each node's ids, ascending, comma-joined.

    Ids are written out in range partitions, a node's in as many as it fills; the hash,
    which has to take them one after the other, streams the pieces.
    """

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, held, size = None, None, [], 0

        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([first], pa.int64()), pa.array([",".join(held)])], names=["node", "first", "ids"])

        for batch in batches:
            out = []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (node != now or size >= PIECE):
                    out.append(piece())
                    held, size = [], 0
                if not held:
                    now, first = node, conv
                held.append(str(conv))
                size += len(held[-1]) + 1
            if out:
                yield pa.Table.from_batches(out).combine_chunks().to_batches()[0]
        if held:
            yield piece()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            nodes, digests = [], []
            for node, ids in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
                if node == now:
                    state.update(b",")
                else:
                    if state is not None:
                        nodes.append(now)
                        digests.append(state.hexdigest())
                    now, state = node, hashlib.sha256()
                state.update(ids.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], names=["node", "ends_sha256"])

    pieces = ends.repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id").mapInArrow(written, "node long, first long, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node long, ends_sha256 string")


def _below(known: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n_leaves, saved_tokens): leaf and saved of nodes, summed over each one's subtree.

    Each node's values stand in its least member's row; a sum runs up every conversation,
    block by block of RUN turns, and a node adds up what its members have from it on.
    """
    rows = known.join(nodes.select("conv_id", "depth", "leaf", "saved"), ["conv_id", "depth"], "left").na.fill(0, ["leaf", "saved"])
    rows = cut(rows.withColumn("block", F.expr(f"depth div {RUN}")))
    later = Window.partitionBy("conv_id").orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("conv_id", "block").agg(F.sum("leaf").alias("l"), F.sum("saved").alias("s"))
    blocks = blocks.select("conv_id", "block", *[F.coalesce(F.sum(c).over(later), F.lit(0)).alias(c) for c in "ls"])
    on = Window.partitionBy("conv_id", "block").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("conv_id", "block", "node", F.sum("leaf").over(on).alias("leaf"), F.sum("saved").over(on).alias("saved")).join(blocks, ["conv_id", "block"])
    return summed.groupBy("node").agg(F.sum(F.col("leaf") + F.col("l")).alias("n_leaves"), F.sum(F.col("saved") + F.col("s")).alias("saved_tokens"))


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row for each distinct beginning of a conversation, the empty one (the root) too.

    turns: (conv_id, pos, key, chars), a conversation's turns numbered from 0 without gaps,
    as numbered_turns gives them; convs: (conv_id), every conversation, turnless ones too.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256): smallest member, turns, the parent's smallest member (null at the root),
    conversations that begin so, nodes one turn longer, childless nodes in the subtree, what
    the subtree's shared turns save in code points, and the hash of the ids that end here.

    Repeated ids in convs count once; without any conversation there is no node; other
    columns are ignored, whatever their names.
    """
    convs = cut(convs.select(F.col("conv_id").cast("long")).distinct())
    turns = cut(turns.select("conv_id", "pos", "key", "chars"))
    longest = (turns.agg(F.max("pos")).first()[0] if not turns.isEmpty() else -1) + 1
    known = _prefixes(convs, turns.select("conv_id", "pos", "key"), longest)
    nodes = known.groupBy("node").agg(F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"))
    above = known.select("conv_id", (F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"))
    texts = turns.select("conv_id", (F.col("pos") + 1).alias("depth"), "chars")
    nodes = cut(nodes.join(above, ["conv_id", "depth"], "left").join(texts, ["conv_id", "depth"], "left"))
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    saved = ((F.col("n_convs") - 1) * F.coalesce("chars", F.lit(0))).cast("long")
    nodes = cut(nodes.select("node", "conv_id", "depth", "parent", "n_convs", "n_children", (F.col("n_children") == 0).cast("long").alias("leaf"), saved.alias("saved")))
    lengths = convs.join(turns.groupBy("conv_id").agg(F.max("pos").alias("last")), "conv_id", "left").select("conv_id", (F.coalesce("last", F.lit(-1)) + 1).alias("depth"))
    hashes = _ends_hash(known.join(lengths, ["conv_id", "depth"]).select("node", "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = nodes.join(_below(known, nodes), "node").join(parents, "parent", "left").join(hashes, "node", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def conversation_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of a table of turns as it stands; see trie and numbered_turns for its cases."""
    numbered = cut(numbered_turns(turns, *(F.col(c) for c in (conv_col, turn_col, role_col, text_col))))
    return trie(numbered, numbered.select("conv_id"))
