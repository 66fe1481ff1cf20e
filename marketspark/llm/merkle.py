"""Merkle manifest of a table, kept as a postorder append log.

Every source is a tree of fan-out 16 over its rows in id order; the roots of
the sources are the leaves of one more tree.  Trees are built in rounds of aligned
builders: a builder takes the 4096 nodes of one aligned subtree, in order, and
appends each node to its segment of the log when it is complete, so a node stands
behind everything below it.  The next round builds on the segments' last nodes.

Where a node stands follows from subtree sizes alone (``position``): no node has a pointer.
Proofs are extracted from the top down: a segment reads the siblings of its nodes at
their positions in its own log and puts the path of its last node behind them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .ranking import ranked

FAN = 16
#: Levels that one builder completes above its nodes, so 16**3 nodes a segment.
LEVELS = 3
SPAN = FAN**LEVELS
_SIZE = 32
_ARROW = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}


def digest(parts: list[bytes]) -> bytes:
    """SHA-256 over the hexadecimal texts of digests."""
    return hashlib.sha256(b"".join(parts).hex().encode()).digest()


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def position(level: int, index: int, leaves: int, levels: int) -> int:
    """Place in completion order, from 0, of a tree's node; ``levels`` is the level of its root.

    By the time it is complete, so are all nodes of its own and lower levels over the first ``end``
    leaves, and those higher nodes that end before: sums of subtree sizes.
    """
    end = min((index + 1) * FAN**level, leaves)
    done = sum(-(-end // FAN**k) for k in range(level + 1))
    return done + sum((end - 1) // FAN**k for k in range(level + 1, levels + 1)) - 1


def append_log(nodes: list[bytes], levels: int) -> list[bytes]:
    """The nodes of one subtree in completion order; the last is its root.  A last run of fewer nodes, even one, is hashed as well."""
    log: list[bytes] = []
    open_runs: list[list[bytes]] = [[] for _ in range(levels + 1)]

    def append(level: int, node: bytes) -> None:
        log.append(node)
        run = open_runs[level]
        run.append(node)
        if len(run) == FAN and level < levels:
            done = digest(run)
            run.clear()
            append(level + 1, done)

    for node in nodes:
        append(0, node)
    for level in range(levels):
        if open_runs[level]:
            append(level + 1, digest(open_runs[level]))
    return log


class Segment:
    """One builder's part of the log, read by position."""

    def __init__(self, log: bytes, leaves: int, levels: int):
        self.log, self.leaves, self.levels = log, leaves, levels

    def node(self, level: int, index: int) -> bytes:
        at = position(level, index, self.leaves, self.levels) * _SIZE
        return self.log[at : at + _SIZE]

    def run(self, level: int, number: int) -> list[bytes]:
        """The nodes of one run of a level, in order."""
        last = min((number + 1) * FAN, -(-self.leaves // FAN**level))
        return [self.node(level, i) for i in range(number * FAN, last)]

    def paths(self) -> Iterator[bytes]:
        """The encoded siblings of every leaf in turn, from its own level to the segment's root."""
        if not self.levels:
            yield b""
            return
        for number in range(-(-self.leaves // FAN)):
            own = self.run(0, number)
            at = [number // FAN ** (level - 1) for level in range(1, self.levels)]
            above = b"".join(encode(self.run(level, k // FAN), k % FAN) for level, k in enumerate(at, 1))
            for k in range(len(own)):
                yield encode(own, k) + above


def encode(run: list[bytes], at: int) -> bytes:
    """One level of a path: how many siblings stand before and behind the node ``at``, then they."""
    return bytes([at, len(run) - at - 1]) + b"".join(run[:at] + run[at + 1 :])


def decode(path: bytes) -> Iterator[tuple[bytes, bytes]]:
    """The levels of a path: siblings before and behind."""
    at = 0
    while at < len(path):
        middle = at + 2 + path[at] * _SIZE
        end = middle + path[at + 1] * _SIZE
        yield path[at + 2 : middle], path[middle:end]
        at = end


def fold(node: bytes, path: bytes) -> bytes:
    """The root that a node and its path lead to."""
    return reduce(lambda own, sides: digest([sides[0], own, sides[1]]), decode(path), node)


def leaf(*columns: Column) -> Column:
    """SHA-256 of a row's values, each as its length in bytes, a colon and the value; null is a dash."""
    def part(c: Column) -> Column:
        text = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.unhex(F.sha2(F.concat(*map(part, columns)), 256))


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the sorted nodes (tree, block, total, size, node, doc_id, claim) of a partition: its round's nodes, ``total`` in the tree, ``size`` leaves in all."""
    tree_kind = None
    at, nodes, ids, claims = None, [], [], []
    out: list[tuple] = []

    def close() -> None:
        tree, block, total, size = at
        levels = min(LEVELS, height(total))
        log = append_log(nodes, levels)
        out.append((tree, block, total, size, len(nodes), levels, log[-1], b"".join(log), ids.copy(), claims.copy()))
        nodes.clear(), ids.clear(), claims.clear()

    def flush() -> pa.RecordBatch:
        kinds = [tree_kind, pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.binary())]
        columns = list(zip(*out)) or [()] * len(kinds)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=_SEGMENT_NAMES)

    for batch in batches:
        tree_kind = batch.schema.field("tree").type
        for tree, block, total, size, node, doc, claim in zip(*(batch.column(c).to_pylist() for c in _NODE_NAMES)):
            if at is None or (tree, block) != at[:2]:
                if at is not None:
                    close()
                at = (tree, block, total, size)
            nodes.append(node)
            ids.append(doc)
            claims.append(claim)
        if len(out) >= 64:
            yield flush()
    if at is not None:
        close()
        yield flush()


_NODE_NAMES = ["tree", "block", "total", "size", "node", "doc_id", "claim"]
_SEGMENT_NAMES = ["tree", "block", "total", "size", "leaves", "levels", "node", "log", "ids", "claims"]


def _round(nodes: DataFrame) -> DataFrame:
    """Segments over (tree, rank, total, size, node, doc_id, claim); a segment's rank in the next round is its block."""
    kind = nodes.schema["tree"].dataType.simpleString()
    block = F.floor(F.col("rank") / SPAN).cast("long")
    dealt = nodes.withColumn("block", block).repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
    shape = f"tree {kind}, block long, total long, size long, leaves int, levels int, node binary, log binary, ids array<long>, claims array<binary>"
    return materialize(dealt.select(*_NODE_NAMES).mapInArrow(_build, shape), "segments")


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Segments of each round until every tree has its root."""
    rounds = [_round(nodes)]
    while True:
        rest = rounds[-1].where(F.col("total") > SPAN).select(
            "tree", F.col("block").alias("rank"), F.ceil(F.col("total") / SPAN).cast("long").alias("total"), "size", "node",
            F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("claim"))
        if rest.isEmpty():
            return rounds
        rounds.append(_round(rest))


def _roots(rounds: list[DataFrame]) -> DataFrame:
    """(tree, node) of every tree's root."""
    return reduce(DataFrame.unionByName, [r.where(F.col("total") <= SPAN).select("tree", "node") for r in rounds])


class Manifest:
    """The log of a table: ``sources`` and ``top`` hold the segments of each round, lowest first.

    ``leaves``: source, doc_id (long), node (the row's digest) and claim (a digest to be
    checked against the manifest instead, or null).  Rows of a source are ordered by doc_id, null first, then by node.
    An empty table has an empty manifest.
    """

    def __init__(self, leaves: DataFrame):
        order = leaves.select(F.col("source").alias("tree"), "doc_id", "node", "claim")
        self.sources = _rounds(ranked(materialize(order, "leaves"), "tree", ["doc_id", "node"]).withColumn("size", F.col("total")))
        roots = _roots(self.sources).select(F.lit(0).alias("tree"), F.col("tree").alias("source"), "node")
        self.subroots = materialize(ranked(materialize(roots, "subroots"), "tree", ["source"]), "ranked-subroots")
        self.top = _rounds(self.subroots.select(
            "tree", "rank", "total", F.col("total").alias("size"), "node", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("claim")))

    def root(self) -> DataFrame:
        """The one row (root), none for an empty table."""
        return _roots(self.top).select(F.col("node").alias("root"))

    def nodes(self) -> DataFrame:
        """(source, position, level, node): the log of every source's tree, in completion order by position."""
        logs = []
        for number, segments in enumerate(self.sources):
            kind = segments.schema["tree"].dataType.simpleString()
            logs.append(segments.select("tree", "block", "size", "leaves", "levels", "log").mapInArrow(
                _log_rows(number * LEVELS), f"source {kind}, position long, level int, node binary"))
        return reduce(DataFrame.unionByName, logs)

    def extract(self, each: Callable, shape: str) -> DataFrame:
        """Rows of ``each(doc_id, leaf, claim, path, subroot, root)``, a tuple of ``shape`` (long, string, boolean, binary), for every row of the table.

        Segments take the paths of their last nodes from the round above, by a join of one row a segment.
        """
        top = self.top[-1].withColumns({"path": F.lit(b""), "subroot": F.lit(b""), "root": F.col("node")})
        for lower in reversed(self.top[:-1]):
            top = _below(lower, _unit_paths(top))
        paths = _unit_paths(top)
        named = self.subroots.select("rank", F.col("source"), F.col("node").alias("own"))
        paths = materialize(paths.drop("tree", "subroot").join(named, "rank").select(
            F.col("source").alias("tree"), "path", F.col("own").alias("subroot"), "root"), "source-paths")
        down = None
        for segments in reversed(self.sources):
            done = segments.where(F.col("total") <= SPAN)
            ready = done.join(paths.withColumnRenamed("tree", "p_tree"), F.col("tree").eqNullSafe(F.col("p_tree"))).drop("p_tree")
            if down is not None:
                ready = ready.unionByName(_below(segments.where(F.col("total") > SPAN), _unit_paths(down)))
            down = ready
        return down.select("leaves", "levels", "log", "ids", "claims", "path", "subroot", "root").mapInArrow(_leaf_rows(each, shape), shape)


def _below(lower: DataFrame, paths: DataFrame) -> DataFrame:
    """Segments of a lower round with the path of their last node."""
    paths = paths.withColumnsRenamed({"tree": "p_tree"})
    return lower.join(paths, F.col("tree").eqNullSafe(F.col("p_tree")) & (F.col("block") == F.col("rank"))).drop("p_tree", "rank")


def _unit_paths(segments: DataFrame) -> DataFrame:
    """(tree, rank, path, subroot, root) of every node that the segments stand on."""
    kind = segments.schema["tree"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                paths = [p + row["path"] for p in Segment(row["log"], row["leaves"], row["levels"]).paths()]
                n = len(paths)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["tree"]] * n, batch.schema.field("tree").type), pa.array(range(row["block"] * SPAN, row["block"] * SPAN + n), pa.int64()),
                    pa.array(paths, pa.binary()), pa.array([row["subroot"]] * n, pa.binary()), pa.array([row["root"]] * n, pa.binary()),
                ], names=["tree", "rank", "path", "subroot", "root"])

    return segments.select("tree", "block", "leaves", "levels", "log", "path", "subroot", "root").mapInArrow(
        run, f"tree {kind}, rank long, path binary, subroot binary, root binary")


def _leaf_rows(each: Callable, shape: str):
    names, kinds = zip(*(part.split() for part in shape.split(", ")))
    kinds = [_ARROW[k] for k in kinds]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {n: batch.column(n)[i].as_py() for n in batch.schema.names}
                segment = Segment(row["log"], row["leaves"], row["levels"])
                found = [
                    each(doc, segment.node(0, k), claim, path + row["path"], row["subroot"], row["root"])
                    for k, (doc, claim, path) in enumerate(zip(row["ids"], row["claims"], segment.paths()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names=list(names))

    return run


def _log_rows(base: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block, size, leaves, levels, log in zip(*(batch.column(c).to_pylist() for c in ("tree", "block", "size", "leaves", "levels", "log"))):
                segment, top, out = Segment(log, leaves, levels), height(size), []
                # The leaves of a later round are the last nodes of the round before and stand in its log already.
                for level in range(1 if base else 0, levels + 1):
                    for k in range(-(-leaves // FAN**level)):
                        index = block * FAN ** (LEVELS - level) + k
                        out.append((tree, position(base + level, index, size, top), base + level, segment.node(level, k)))
                columns = list(zip(*out)) or [()] * 4
                kinds = [batch.schema.field("tree").type, pa.int64(), pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["source", "position", "level", "node"])

    return run


def _audited(doc: int | None, own: bytes, claim: bytes | None, path: bytes, subroot: bytes, root: bytes) -> tuple:
    siblings = b"".join(before + behind for before, behind in decode(path))
    folded = fold(own if claim is None else claim, path)
    return doc, own.hex(), subroot.hex(), root.hex(), digest([siblings]).hex(), folded.hex(), folded == root


def audit(documents: DataFrame, claim: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``documents``.

    ``claim``: the digest that a holder of the row computes (see ``leaf``), null for the row's own; verified says whether
    it folds to the root with the row's siblings.  Any of doc_id, source, lang, n_chars and text may be null; a null
    id comes first in its source, null is a source of its own, repeated rows are leaves of their own, and
    other columns take no part.  An empty table gives no row.
    """
    own = leaf(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")))
    rows = documents.select("source", F.col("doc_id").cast("long").alias("doc_id"), own.alias("node"), claim.alias("claim"))
    return Manifest(rows).extract(_audited, AUDIT)


AUDIT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
