"""SimHash near-duplicates by vantage-point trees over Hamming distance.

A global tree, fitted on a bounded sample, deals all distinct fingerprints into
shards: each node holds a vantage point and a radius, and a fingerprint goes to the inside or the
outside.  Two fingerprints within ``reach`` bits that part at a node lie within
``reach`` of its radius, so the inner one is sent along as a query to every shard outside that the
triangle inequality doesn't rule out.  So every close pair meets in the home
shard of one of the two.

Inside a shard a second tree of the same kind is searched for all points and queries at once.
A shard returns links that join what is within reach, not all pairs: parts
of the tree that already are in a query's component are passed over, so thousands of variants of one text cost
about one link each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .components import components

REACH = 4
#: Fingerprints a shard on average; shards at most (above it they grow); sampled fingerprints a shard.
SHARD_ROWS, MAX_SHARDS, SAMPLES = 32_768, 1 << 14, 64
LEAF = 128
#: Vantage points tried at a node; the one of widest spread is taken.
TRIED = 8
_BLOCK = 1 << 15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes, words: int = 4) -> int:
    """Bits that are set in over half of the XXH64 (seed 42) of a text's word shingles, repeats included.

    A-Z are lower-cased and words joined by one space; a shorter text is one shingle, one without words gives 0.
    """
    tokens = text.translate(_LOWER).split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    n = max(1, len(tokens) - words + 1)
    lengths = np.fromiter(map(len, tokens), np.int64, len(tokens))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    ends = ends[-n:].tolist()
    of = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _BLOCK):
        h = np.array([of(joined[a:b], 42) for a, b in zip(starts[lo : lo + _BLOCK], ends[lo : lo + _BLOCK])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n).view(">u8")[0])


def _fingerprints(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            found = np.array([fingerprint(t.as_py() or b"", words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], names=["doc_id", "f"])

    return run


def _distance(a: np.ndarray, b) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class Tree:
    """Vantage-point tree over fingerprints: points, radii and children (-1 - k: leaf k) in arrays."""

    def __init__(self, found: np.ndarray, leaf: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.point, self.radius, self.inside, self.outside = [], [], [], []
        self.rows: list[np.ndarray] = []

        def grow(rows: np.ndarray) -> int:
            if len(rows) > leaf:
                own = found[rows]
                tried = rng.choice(len(rows), min(TRIED, len(rows)), replace=False)
                distances = _distance(own[None, :], own[tried][:, None]).astype(np.int16)
                best = int(np.argmax(distances.std(axis=1)))
                d = distances[best]
                radius = int(np.median(d))
                if (d <= radius).all():  # ties up to the largest distance
                    radius = int(d.max()) - 1
                near = d <= radius
                if near.any() and not near.all():
                    node = len(self.point)
                    self.point.append(own[tried[best]])
                    self.radius.append(radius)
                    self.inside.append(0)
                    self.outside.append(0)
                    self.inside[node] = grow(rows[near])
                    self.outside[node] = grow(rows[~near])
                    return node
            self.rows.append(rows)
            return -len(self.rows)

        self.root = grow(np.arange(len(found)))

    def homes(self, found: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, shard, whether it lives there): each fingerprint's home, and the shards outside it that it is to ask."""
        out: list[tuple[np.ndarray, int, bool]] = []
        stack = [(self.root, np.arange(len(found)), True)]
        while stack:
            node, rows, home = stack.pop()
            if not len(rows):
                continue
            if node < 0:
                out.append((rows, -1 - node, home))
                continue
            d = _distance(found[rows], self.point[node]).astype(np.int16)
            radius, near = self.radius[node], d <= self.radius[node]
            if home:
                stack += [(self.inside[node], rows[near], True), (self.outside[node], rows[~near], True)]
                stack.append((self.outside[node], rows[near & (d > radius - reach)], False))
            else:
                stack += [(self.inside[node], rows[d <= radius + reach], False), (self.outside[node], rows[d > radius - reach], False)]
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, bool)
        sizes = [len(r) for r, _, _ in out]
        return (np.concatenate([r for r, _, _ in out]), np.repeat(np.array([s for _, s, _ in out], np.int32), sizes), np.repeat([h for _, _, h in out], sizes))


class Shard:
    """The points of one shard, their tree, and which of them are known to be linked."""

    def __init__(self, points: np.ndarray):
        self.points, self.tree = points, Tree(points, LEAF)
        self.label = np.arange(len(points))
        self.search(points, np.arange(len(points)))

    def uniform(self, label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per inner node and per leaf the one label of all its points, or -1."""
        leaves = np.array([label[r[0]] if (label[r] == label[r[0]]).all() else -1 for r in self.tree.rows])
        nodes = np.full(len(self.tree.point), -1)
        for node in range(len(nodes) - 1, -1, -1):  # children come after their parents
            a, b = (nodes[c] if c >= 0 else leaves[-1 - c] for c in (self.tree.inside[node], self.tree.outside[node]))
            nodes[node] = a if a == b else -1
        return nodes, leaves

    def search(self, asked: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Link ``asked`` with all points within reach.  Returns each one's label, -1 if it has none.

        ``own``: the places of ``asked`` among the points; without it they are queries from elsewhere.
        """
        n = len(self.points)
        label = self.label if own is not None else np.concatenate([self.label, n + np.arange(len(asked))])
        at = own if own is not None else n + np.arange(len(asked))
        nodes, leaves = self.uniform(label)
        stack = [(self.tree.root, np.arange(len(asked)))]
        while stack:
            node, rows = stack.pop()
            same = nodes[node] if node >= 0 else leaves[-1 - node]
            if same >= 0:
                rows = rows[label[at[rows]] != label[same]]
            if not len(rows):
                continue
            if node < 0:
                members = self.tree.rows[-1 - node]
                for lo in range(0, len(rows), 4096):
                    part, known = rows[lo : lo + 4096], label[members]
                    if (known == known[0]).all():  # also what this search has joined so far
                        part = part[label[at[part]] != known[0]]
                    q, p = np.nonzero(_distance(asked[part][:, None], self.points[members][None, :]) <= REACH)
                    label = _joined(label, at[part[q]], members[p])
                continue
            d = _distance(asked[rows], self.tree.point[node]).astype(np.int16)
            radius = self.tree.radius[node]
            stack += [(self.tree.outside[node], rows[d > radius - REACH]), (self.tree.inside[node], rows[d <= radius + REACH])]
        self.label = label[:n]
        if own is not None:
            return self.label
        return np.where(label[n:] < n, label[n:], -1)


def _joined(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the components of a[i] and b[i]; a label is a member of its component, the smallest place."""
    x, y = label[a], label[b]
    apart = x != y
    if not apart.any():
        return label
    pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)])[:, apart], axis=1)
    parent = {}

    def root(i: int) -> int:
        while parent.get(i, i) != i:
            parent[i] = parent.get(parent[i], parent[i])
            i = parent[i]
        return i

    for x, y in pairs.T.tolist():
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    moved = np.arange(len(label))
    for i in parent:
        moved[i] = root(i)
    return moved[label]


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of sorted rows (shard, asks, f): a shard's points come before the queries to it."""
    at, shard, points = None, None, []

    def rows(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def ready() -> Shard:
        return Shard(np.concatenate(points)) if points else Shard(np.zeros(0, np.uint64))

    def close() -> pa.RecordBatch:
        done = shard or ready()
        far = done.label != np.arange(len(done.label))
        return rows(done.points[far], done.points[done.label[far]])

    for batch in batches:
        shards, asks, found = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "asks", "f"))
        found = found.view(np.uint64)
        cuts = np.flatnonzero(np.diff(shards)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(shards)]):
            if lo == hi:
                continue
            if at != shards[lo]:
                if at is not None:
                    yield close()
                at, shard, points = shards[lo], None, []
            first = lo + int(np.searchsorted(asks[lo:hi], 1))
            if first > lo:
                points.append(found[lo:first])
            if first < hi:
                shard = shard or ready()
                if len(shard.points):
                    asked = found[first:hi]
                    label = shard.search(asked)
                    yield rows(asked[label >= 0], shard.points[label[label >= 0]])
    if at is not None:
        yield close()


def links(distinct: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (a, b) that connect all fingerprints of ``distinct`` (f long, no repeats) within ``REACH`` bits of one another.

    The tree is fitted on about ``SAMPLES`` fingerprints a shard, at most 1,048,576, chosen by hash; every fingerprint is dealt.
    """
    n = distinct.count()
    shards = max(1, min(-(-n // shard_rows), MAX_SHARDS))
    sample = np.zeros(0, np.uint64)
    if shards > 1:
        share = min(1.0, shards * SAMPLES / n)
        picked = distinct.where(F.pmod(F.xxhash64("f", F.lit(3)), F.lit(1 << 30)) < int(share * (1 << 30)))
        sample = np.sort(picked.toArrow()["f"].to_numpy().view(np.uint64))
    tree = distinct.sparkSession.sparkContext.broadcast(Tree(sample, max(1, -(-len(sample) // shards))))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("f").to_numpy(zero_copy_only=False)
            row, shard, home = tree.value.homes(found.view(np.uint64), REACH)
            yield pa.RecordBatch.from_arrays([pa.array(shard), pa.array((~home).astype(np.int8)), pa.array(found[row])], names=["shard", "asks", "f"])

    dealt = distinct.mapInArrow(deal, "shard int, asks byte, f long")
    return dealt.repartition("shard").sortWithinPartitions("shard", "asks", "f").mapInArrow(_links, "a long, b long")


def near_duplicates(documents: DataFrame, words: int = 4) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row of ``documents``.

    Rows link when their fingerprints differ in at most ``REACH`` bits; component_id is the smallest doc_id that links reach, itself
    included.  Null and empty texts have fingerprint 0 and link like any other.  A null id gets the component of its
    fingerprint, null if that has no id; rows that share an id are told apart by their fingerprints.
    Repeated rows give repeated results; other columns take no part; an empty table gives no row.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    found = materialize(documents.select("doc_id", "text").mapInArrow(_fingerprints(words), f"doc_id {kind}, f long"), "fingerprints")
    classes = materialize(found.groupBy("f").agg(F.min("doc_id").alias("rep")), "classes")
    label = components(links(classes.select("f")))
    named = classes.join(label.withColumnRenamed("node", "n_f"), F.col("f") == F.col("n_f"), "left").select(
        F.col("f").alias("c_f"), F.coalesce("component", "f").alias("component"), "rep")
    named = materialize(named, "labels")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.select("c_f", "component").join(least, "component").select("c_f", "component_id")
    return found.join(named, F.col("f") == F.col("c_f")).select("doc_id", F.lower(F.lpad(F.hex("f"), 16, "0")).alias("fingerprint"), "component_id")
