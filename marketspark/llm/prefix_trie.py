"""Prefix trie of conversations by SQL ROLLUP over positional turn ids.

A conversation's turns are cut into blocks of ``BLOCK`` columns of turn ids.  A block
row is keyed by the node that the blocks before it lead to, and one
``GROUP BY block, node, ROLLUP (t1, ..., t8)`` with ``grouping_id`` counts every prefix of every
conversation at once; a level whose last column is empty is no prefix.

A node is named by its depth and 128 bits: the exclusive or of hashes of (turn id, position) along its
path.  They combine in any grouping, so the key of a late block needs no pass over the
blocks before it one by one.

Sums over subtrees run along chains: every node belongs to its longest member, so a
conversation owns one run of nodes at the end of its path, and hangs by it from another's.  Values enter
a chain at a depth, chain totals pass on to the place where the chain hangs, and
running sums over each chain finish.  The rounds are as many as chains hang from one
another, not as many as there are turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .ranking import ranked

BLOCK = 8
#: Consecutive ids whose texts are joined before a node's digest streams over them; depths that are summed in one step.
BUCKET, STRIDE = 4096, 1024
_WIDE = "decimal(38,0)"
_LEN = 10**20


def _wide(n: int) -> Column:
    return F.lit(str(n)).cast(_WIDE)


def turn_id(role: Column, text: Column) -> Column:
    """16 bytes of SHA-256 over role and text (null: empty), then the text's code points in 4 bytes."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(whole, 1, 32), F.lpad(F.hex(F.length(text)), 8, "0")))


def _points(turn: Column) -> Column:
    return F.conv(F.hex(F.substring(turn, 17, 4)), 16, 10).cast("long")


def _hashes(turn: Column, at: Column) -> tuple[Column, Column]:
    """Two hashes of a turn at a position, 0 where there is none."""
    return tuple(F.when(turn.isNotNull(), F.xxhash64(turn, at.cast("long"), F.lit(k))).otherwise(F.lit(0)) for k in (0, 1))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, turn_id): turns by turn number, null first, then by id; pos counts from 1.  Rows without conv_id are left out."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), turn_id(F.col("role"), F.col("text")).alias("turn_id"))
    return ranked(materialize(rows, "turns"), "conv_id", ["turn", "turn_id"]).select("conv_id", (F.col("rank") + 1).alias("pos"), "turn_id", "total")


def regrafted(turns: DataFrame, base: Column, head: Column, most: int) -> DataFrame:
    """(conv_id, pos, turn_id), with pos null for a conversation that is left without turns.

    Every conversation begins with the first ``head`` turns (0 to ``most``) of conversation ``base``, all
    if it has fewer and none if it is absent, and goes on with its own turns behind its first ``head``.
    ``base`` and ``head`` are columns over conv_id.
    """
    turns = materialize(turns.withColumns({"base": base.cast("long"), "head": head.cast("long")}), "ordered-turns")
    convs = turns.where("pos = 1").select("conv_id", "base", "head", F.col("total").alias("own"))
    first = turns.where(F.col("pos") <= most).select(F.col("conv_id").alias("b_id"), F.col("pos").alias("b_pos"), F.col("turn_id").alias("b_turn"))
    # At most ``most`` turns of one conversation stand on either side of a match.
    taken = convs.join(first, (F.col("base") == F.col("b_id")) & (F.col("b_pos") <= F.col("head")))
    taken = materialize(taken.select("conv_id", F.col("b_pos").alias("pos"), F.col("b_turn").alias("turn_id")), "grafts")
    had = taken.groupBy("conv_id").agg(F.count("*").alias("had"))
    lengths = convs.join(had, "conv_id", "left").select("conv_id", "own", F.coalesce("had", F.lit(0)).alias("had"), "head")
    late = turns.where(F.col("pos") > F.col("head")).select("conv_id", "pos", "turn_id", "head")
    late = late.join(lengths.select(F.col("conv_id").alias("l_id"), "had"), F.col("conv_id") == F.col("l_id"))
    moved = late.select("conv_id", (F.col("pos") - F.col("head") + F.col("had")).alias("pos"), "turn_id")
    bare = lengths.where((F.col("had") == 0) & (F.col("own") <= F.col("head")))
    none = bare.select("conv_id", F.lit(None).cast("long").alias("pos"), F.lit(None).cast("binary").alias("turn_id"))
    return taken.unionByName(moved).unionByName(none)


def _blocks(turns: DataFrame) -> DataFrame:
    """(conv_id, block, x, y, len, t1 ...): block rows with the key of the node before them and the conversation's length.

    Keys and lengths run through strides of blocks, so a conversation of any length is no one task's work.
    """
    at = F.coalesce(F.col("pos") - 1, F.lit(0))
    a, b = _hashes(F.col("turn_id"), F.col("pos"))
    slot = at % BLOCK
    rows = turns.select("conv_id", F.floor(at / BLOCK).cast("long").alias("block"), slot.alias("slot"), "turn_id", a.alias("a"), b.alias("b"), F.coalesce("pos", F.lit(0)).alias("pos"))
    rows = rows.groupBy("conv_id", "block").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.max("pos").alias("last"),
        *[F.max(F.when(F.col("slot") == i, F.col("turn_id"))).alias(f"t{i + 1}") for i in range(BLOCK)])
    rows = materialize(rows.withColumn("stride", F.floor(F.col("block") / STRIDE)), "blocks")
    whole = rows.groupBy("conv_id", "stride").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"), F.max("last").alias("last"))
    conv = Window.partitionBy("conv_id")
    before = conv.orderBy("stride").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(
        F.col("conv_id").alias("w_id"), F.col("stride").alias("w_stride"), F.max("last").over(conv).alias("len"),
        *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"w{c}") for c in "ab"])
    inside = Window.partitionBy("conv_id", "stride").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumns({f"o{c}": F.coalesce(F.bit_xor(c).over(inside), F.lit(0)) for c in "ab"})
    out = own.join(whole, (F.col("conv_id") == F.col("w_id")) & (F.col("stride") == F.col("w_stride")))
    return out.select(
        "conv_id", "block", F.col("oa").bitwiseXOR(F.col("wa")).alias("x"), F.col("ob").bitwiseXOR(F.col("wb")).alias("y"), "len",
        *[f"t{i + 1}" for i in range(BLOCK)])


def _path_keys() -> list[tuple[Column, Column]]:
    """Keys of the nodes at each level of a block row, level 0 first."""
    keys = [(F.col("x"), F.col("y"))]
    for i in range(1, BLOCK + 1):
        a, b = _hashes(F.col(f"t{i}"), F.col("block") * BLOCK + i)
        keys.append((keys[-1][0].bitwiseXOR(a), keys[-1][1].bitwiseXOR(b)))
    return keys


def _nodes(blocks: DataFrame) -> DataFrame:
    """(depth, x, y, px, py, conv_id, n_convs, owner, points): all prefixes, with the key of the prefix one shorter."""
    columns = ", ".join(f"t{i + 1}" for i in range(BLOCK))
    rolled = blocks.sparkSession.sql(f"""
        SELECT block, x, y, {columns}, {BLOCK} - bit_count(grouping_id()) AS level,
          min(conv_id) AS conv_id, count(*) AS n_convs, max(owner) AS owner
        FROM {{blocks}} GROUP BY block, x, y, ROLLUP ({columns})""", blocks=blocks.withColumn("owner", _owner(F.col("len"), F.col("conv_id"))))
    level = F.col("level")
    last = reduce(lambda rest, i: F.when(level == i, F.col(f"t{i}")).otherwise(rest), range(1, BLOCK + 1), F.lit(None).cast("binary"))
    # A shorter conversation has nothing in the column; the level above has counted it.
    rolled = rolled.withColumn("turn", last).where(F.col("turn").isNotNull() | ((level == 0) & (F.col("block") == 0)))
    keys = _path_keys()
    # Columns above the level are null and change no key, so the last keys are the node's own.
    at = F.col("block") * BLOCK + level
    a, b = _hashes(F.col("turn"), at)
    x, y = keys[-1]
    return rolled.select(
        at.cast("long").alias("depth"), x.alias("x"), y.alias("y"), x.bitwiseXOR(a).alias("px"), y.bitwiseXOR(b).alias("py"),
        "conv_id", "n_convs", "owner", F.coalesce(_points(F.col("turn")), F.lit(0)).alias("points"))


def _owner(length: Column, conv_id: Column) -> Column:
    """One number that orders conversations by length, then id, and aggregates by hash."""
    return length.cast(_WIDE) * _wide(_LEN) + conv_id.cast(_WIDE)


def _ends(blocks: DataFrame) -> DataFrame:
    """(depth, x, y, ends_sha256) of the nodes at which conversations end.

    Ids are joined to texts in buckets of consecutive ids, in parallel; one stream of these texts
    per node, in order, is hashed.
    """
    final = blocks.where((F.floor((F.col("len") - 1) / BLOCK) == F.col("block")) | (F.col("len") == 0))
    x, y = _path_keys()[-1]
    ends = final.select(F.col("len").alias("depth"), x.alias("x"), y.alias("y"), "conv_id", F.floor(F.col("conv_id") / BUCKET).cast("long").alias("bucket"))
    texts = ends.groupBy("depth", "x", "y", "bucket").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    texts = texts.select("depth", "x", "y", "bucket", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    dealt = texts.repartition("depth", "x", "y").sortWithinPartitions("depth", "x", "y", "bucket")
    return dealt.mapInArrow(_digests, "depth long, x long, y long, ends_sha256 string")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, state, out = None, hashlib.sha256(), []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 4
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()])], names=["depth", "x", "y", "ends_sha256"])

    for batch in batches:
        for *own, ids in zip(*(batch.column(c).to_pylist() for c in ("depth", "x", "y", "ids"))):
            if own != node:
                if node is not None:
                    out.append((*node, state.hexdigest()))
                node, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield flush()
    if node is not None:
        out.append((*node, state.hexdigest()))
    yield flush()


def _subtree_sums(nodes: DataFrame) -> DataFrame:
    """(owner, depth, n_children, n_leaves, saved_tokens) of ``nodes`` (owner, depth, p_owner, leaf, saved)."""
    chains = nodes.where(~F.col("p_owner").eqNullSafe(F.col("owner")) & F.col("p_owner").isNotNull()).select(
        F.col("owner").alias("c_owner"), F.col("p_owner").alias("to"), (F.col("depth") - 1).alias("at"))
    chains = materialize(chains, "chains")
    enter = nodes.select("owner", "depth", F.lit(0).cast("long").alias("hung"), "leaf", "saved")
    # Where a chain hangs, it is one child; its sums follow.
    hung = chains.groupBy("to", "at").agg(F.count("*").alias("hung")).select(
        F.col("to").alias("owner"), F.col("at").alias("depth"), "hung", F.lit(0).cast("long").alias("leaf"), F.lit(0).cast("long").alias("saved"))
    parts, flow = [enter, hung], enter
    while True:
        totals = flow.groupBy("owner").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        moved = totals.join(chains, F.col("owner") == F.col("c_owner")).groupBy("to", "at").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        flow = materialize(moved.select(F.col("to").alias("owner"), F.col("at").alias("depth"), F.lit(0).cast("long").alias("hung"), "leaf", "saved"), "flow")
        if flow.isEmpty():
            break
        parts.append(flow)
    sums = ["hung", "leaf", "saved"]
    rows = reduce(DataFrame.unionByName, parts).groupBy("owner", "depth").agg(*[F.sum(c).alias(c) for c in sums])
    rows = materialize(rows.withColumn("stride", F.floor(F.col("depth") / STRIDE)), "chain-sums")
    chain = Window.partitionBy("owner")
    whole = rows.groupBy("owner", "stride").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"), F.max("depth").alias("end"))
    below = chain.orderBy(F.desc("stride")).rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(
        F.col("owner").alias("w_owner"), F.col("stride").alias("w_stride"), F.max("end").over(chain).alias("end"),
        *[F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"w_{c}") for c in ("leaf", "saved")])
    inside = Window.partitionBy("owner", "stride").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = rows.withColumns({f"o_{c}": F.sum(c).over(inside) for c in ("leaf", "saved")})
    out = own.join(whole, (F.col("owner") == F.col("w_owner")) & (F.col("stride") == F.col("w_stride")))
    return out.select(
        "owner", "depth", (F.col("hung") + (F.col("depth") < F.col("end")).cast("long")).alias("n_children"),
        (F.col("o_leaf") + F.col("w_leaf")).alias("n_leaves"), (F.col("o_saved") + F.col("w_saved")).alias("saved_tokens"))


def trie(turns: DataFrame) -> DataFrame:
    """The trie of ``turns`` (conv_id, pos from 1 without gaps, turn_id), one row a node.

    conv_id is the smallest member, parent_conv_id the parent's (null for the root); n_convs, n_children, n_leaves
    (childless nodes of the subtree) and saved_tokens (over the subtree, members less one times the code points of the last text)
    count; ends_sha256 is the digest of the ids that end here.  A row with null pos stands
    for a conversation without turns, which is a member of the root alone.  No rows give no root.
    """
    blocks = materialize(_blocks(turns), "trie-blocks")
    nodes = materialize(_nodes(blocks), "nodes")
    parents = nodes.select(F.col("depth").alias("p_depth"), F.col("x").alias("p_x"), F.col("y").alias("p_y"), F.col("conv_id").alias("p_conv"), F.col("owner").alias("p_owner"))
    # Children of one prefix can be a large part of all nodes: a skewed join, which Spark splits; each matches one row.
    with_parent = nodes.join(parents, (F.col("depth") - 1 == F.col("p_depth")) & (F.col("px") == F.col("p_x")) & (F.col("py") == F.col("p_y")), "left")
    with_parent = with_parent.select("depth", "x", "y", "conv_id", F.col("p_conv").alias("parent_conv_id"), "n_convs", "owner", "p_owner", ((F.col("n_convs") - 1) * F.col("points")).alias("saved"))
    # A node without children is the last of its owner's chain, at the owner's length.
    length = F.floor((F.col("owner") + _wide(_LEN // 2)) / _wide(_LEN)).cast("long")
    with_parent = materialize(with_parent.withColumn("leaf", (F.col("depth") == length).cast("long")), "linked-nodes")
    sums = _subtree_sums(with_parent.select("owner", "depth", "p_owner", "leaf", "saved")).withColumnsRenamed({"owner": "s_owner", "depth": "s_depth"})
    ends = _ends(blocks).withColumnsRenamed({"depth": "e_depth", "x": "e_x", "y": "e_y"})
    out = with_parent.join(sums, (F.col("owner") == F.col("s_owner")) & (F.col("depth") == F.col("s_depth")))
    out = out.join(ends, (F.col("depth") == F.col("e_depth")) & (F.col("x") == F.col("e_x")) & (F.col("y") == F.col("e_y")), "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
