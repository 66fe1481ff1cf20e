"""Near-duplicate texts by an exact n-gram Jaccard join with PartEnum signatures.

A text is the set of its distinct word shingles.  Sets are put in bands of
similar size, in which a Jaccard threshold becomes a bound k on the symmetric
difference.  The shingle domain is hashed into n1 parts of three sub-parts each; two
sets within k differ by at most one shingle in some part, so they agree on two of
its three sub-parts, and all two-of-three subsets are enumerated as signatures.
Sets that share a signature are compared exactly, so no link is lost and none is wrong.

Shingles of very many texts (a common line or passage) are left out of the parts: the
difference of what is left is no larger, so nothing is lost, and no signature is
made of them alone.  Any choice of them is right; it is made from counts per task.

A signature over very few shingles would be shared by chance, so there are
``SLACK`` percent more parts than needed.  A set of which no more than these extra parts are
thin leaves out its thin signatures: a similar partner still shares a thick one with
it.  A set with too many parts that hold nothing also sends its first shingles in an order
from rare to frequent, of which two similar sets always share one; empty signatures are never sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..runtime import materialize
from .components import components
from .text import mix, signed, slices

#: Extra parts in percent, and the shingles below which a signature is thin.
SLACK, THIN = 15, (3, 2, 1)
#: A task reports shingles of so many texts among a few million shingles; those of at least
#: FREQUENT_FROM reported texts, FREQUENT at most, are left out.  16 bytes each.
LOCAL_FROM, FREQUENT_FROM, FREQUENT = 6, 40, 1 << 17
_COUNTED = 4_000_000
#: Edits are compared pair by pair once the pairs that share one across components are at most FEW a row, or once a
#: round with local hubs has left more than STUCK of them.
FEW, STUCK = 16, 0.9
#: From so many classes close to one hub their most central one is looked for.
LARGE = 8
#: A set's sketch: for each of 64 x SKETCH hash buckets, whether it holds an odd number of its shingles.
SKETCH = 8
_ODD = [f"odd{i}" for i in range(SKETCH)]
_TURNS = np.array([0x8CB92BA72F3D8DD7, 0xABD1F5D7C3A96D2B, 0xE7037ED1A0B428DB, 0xC6A4A7935BD1E995, 0x9FB21C651E98DF25,
                   0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], np.uint64)
_REMEMBERED = 200_000


def shingle_sets(part, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text of a slice; a shorter text is one shingle as a whole."""
    starts, ends, first = part.words()
    h = part.hashes(starts, ends, lower=True)
    with np.errstate(over="ignore"):
        def chain(at: np.ndarray, n: int) -> np.ndarray:
            out = np.full(len(at), n, np.uint64)
            for i in range(n):
                out = mix(out * _TURNS[0] + h[at + i])
            return out

        rolled = chain(np.arange(max(0, len(h) - words + 1)), words)
        for k, row in enumerate(part.rows):
            a, b = first[k], first[k + 1]
            if b - a >= words:
                yield row, np.unique(rolled[a : b - words + 1])
            else:
                yield row, chain(np.array([a]), int(b - a)) if b > a else h[:0]


class Bands:
    """Size bands of a threshold: sets at least that similar lie in one band or in neighbouring ones."""

    def __init__(self, threshold: Fraction):
        self.threshold, self.low = threshold, [1]

    def of(self, n: int) -> int:
        while self.low[-1] <= n:
            self.low.append(self.top(len(self.low) - 1) + 1)
        return int(np.searchsorted(self.low, n, "right")) - 1

    def top(self, band: int) -> int:
        return int(self.low[band] / self.threshold)

    def difference(self, band: int) -> int:
        """Largest symmetric difference of two similar sets, neither larger than the band's top."""
        t = self.threshold
        return int((1 - t) / (1 + t) * 2 * self.top(band))


def signatures(shingles: np.ndarray, bands: Bands, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Signatures of one set in its own band and, as the smaller partner, in the next.

    ``frequent``: sorted shingles to leave out, ``rank``: their places from rare to frequent.
    """
    own, out = bands.of(len(shingles)), []
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
        often = frequent[at] == shingles
        rare, common = shingles[~often], shingles[often][np.argsort(rank[at[often]])]
    else:
        rare, common = shingles, shingles[:0]
    bands.of(bands.top(own) + 1)
    for band in (own, own + 1):
        k = bands.difference(band)
        if k == 0:
            continue  # only equal sets are similar enough
        need = k // 2 + 1
        slack = need * SLACK // 100
        n1 = need + slack
        with np.errstate(over="ignore"):
            turn = _TURNS[1:2] * np.uint64(band + 1)
            spread = mix(rare + turn)
            place = (spread % np.uint64(3 * n1)).astype(np.int64)
            sums = np.zeros(3 * n1, np.uint64)
            np.add.at(sums, place, mix(spread ^ _TURNS[2]))
            count = np.bincount(place, minlength=3 * n1).reshape(n1, 3)
            sums = sums.reshape(n1, 3)
            left, right = sums[:, [0, 0, 1]], sums[:, [1, 2, 2]]
            which = np.arange(3 * n1, dtype=np.uint64).reshape(n1, 3) + np.uint64(band << 32)
            sig = mix(mix(left * _TURNS[3] + which) + right * _TURNS[4])
        held = count[:, [0, 0, 1]] + count[:, [1, 2, 2]]
        for least in THIN:
            if (held < least).any(1).sum() <= slack:
                out.append(sig[held >= least])
                break
        else:
            n = len(shingles)
            rising = np.concatenate([np.sort(spread), mix(common + turn)])
            prefix = rising[: n - int(-(-bands.threshold * n // 1)) + 1]
            out += [sig[held >= 1], mix(prefix ^ _TURNS[0])]
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _keys(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit keys of a whole set."""
    with np.errstate(over="ignore"):
        pair = [int(mix(mix(shingles ^ t).sum(keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0]) for t in _TURNS[5:7]]
    return pair[0], pair[1]


def _sketch(shingles: np.ndarray) -> tuple[int, ...]:
    place = (mix(shingles ^ _TURNS[5]) % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = (np.bincount(place, minlength=64 * SKETCH) & 1).astype(np.uint8)
    return tuple(np.packbits(odd).view(np.int64).tolist())


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [np.zeros(0, np.uint64)], 0

        def rows(ids: pa.Array, *columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([ids, *(pa.array(c, pa.int64()) for c in columns)], names=["doc_id", "n_shingles", "k1", "k2", *_ODD])

        def often() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(held), return_counts=True)
            h, n = h[n >= LOCAL_FROM], n[n >= LOCAL_FROM]
            held[1:] = []
            return rows(pa.nulls(len(h), kind), -n, h.view(np.int64), *[np.zeros(len(h), np.int64)] * (1 + SKETCH))

        kind = pa.int64()
        for batch in batches:
            found, kind = [], batch.schema.field("doc_id").type
            for part in slices(batch.column("text")):
                for row, s in shingle_sets(part, words):
                    found.append((row, len(s), *_keys(s), *_sketch(s)))
                    held.append(s)
                    size += len(s)
            at, *columns = zip(*found) if found else ((),) * (4 + SKETCH)
            yield rows(batch.column("doc_id").take(pa.array(at, pa.int64())), *columns)
            if size > _COUNTED:
                yield often()
                size = 0
        yield often()

    return run


def _signature_rows(words: int, threshold: Fraction, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, seen, (often, rank) = Bands(threshold), set(), frequent.value
        for batch in batches:
            for part in slices(batch.column("text")):
                sigs, keys = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for _, s in shingle_sets(part, words):
                    if not len(s):
                        continue
                    key = _keys(s)[0]
                    if key in seen:
                        continue  # a copy of a set that this task has already sent
                    if len(seen) >= _REMEMBERED:
                        seen.clear()
                    seen.add(key)
                    sigs.append(signatures(s, bands, often, rank))
                    keys.append(np.full(len(sigs[-1]), key))
                yield pa.RecordBatch.from_arrays([signed(np.concatenate(sigs)), pa.array(np.concatenate(keys))], names=["sig", "k1"])

    return run


def _array_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column("text")):
                found = list(shingle_sets(part, words))
                offsets = np.concatenate([[0], np.cumsum([len(s) for _, s in found])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    pa.array([_keys(s)[0] for _, s in found], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), signed(np.concatenate([s for _, s in found]))),
                ], names=["rep", "shingles"])

    return run


class Join:
    """The steps of the join over one documents table; ``kind`` is the type of doc_id.

    A class of equal sets is named by ``rep``, the first key of its set, since one id may stand on several texts;
    ``classes`` has its smallest id as ``doc_id``.
    """

    def __init__(self, documents: DataFrame, words: int, percent: int):
        self.docs = documents.select("doc_id", "text")
        self.kind = self.docs.schema["doc_id"].dataType.simpleString()
        self.words, self.percent = words, percent

    def sets(self) -> DataFrame:
        """(doc_id, n_shingles, k1, k2, odd*) of every row; rows of negative n_shingles report a frequent shingle k1 instead."""
        out = self.docs.mapInArrow(_set_rows(self.words), f"doc_id {self.kind}, n_shingles long, k1 long, k2 long, {' long, '.join(_ODD)} long")
        return materialize(out, "sets")

    def frequent(self, sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Sorted frequent shingles and their places from rare to frequent; at most FREQUENT."""
        sums = sets.where("n_shingles < 0").groupBy("k1").agg(F.sum(-F.col("n_shingles")).alias("n")).where(F.col("n") >= FREQUENT_FROM)
        found = sums.orderBy(F.desc("n"), "k1").limit(FREQUENT).toArrow()
        h, n = found["k1"].to_numpy().view(np.uint64), found["n"].to_numpy()
        order = np.argsort(h)
        rank = np.empty(len(h), np.int64)
        rank[np.lexsort((h, n))] = np.arange(len(h))
        return h[order], rank[order]

    def classes(self, sets: DataFrame) -> DataFrame:
        """(rep, k1, k2, n, doc_id, odd*) of every set with words and an id."""
        rows = sets.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", F.col("n_shingles").alias("n")).agg(
            F.min("doc_id").alias("doc_id"), *[F.min(x).alias(x) for x in _ODD])  # equal in a class
        self.known = materialize(rows.withColumn("rep", F.col("k1")), "classes")
        return self.known

    def shared(self, classes: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
        """(sig, rep, n): members of the signatures that at least two classes share."""
        held = self.docs.sparkSession.sparkContext.broadcast(frequent)
        sigs = self.docs.mapInArrow(_signature_rows(self.words, Fraction(self.percent, 100), held), "sig long, k1 long")
        bucket = Window.partitionBy("sig")
        many = sigs.withColumns({"lo": F.min("k1").over(bucket), "hi": F.max("k1").over(bucket)}).where("lo < hi").select("sig", "k1")
        many = materialize(many, "signatures")
        return materialize(many.join(classes.select("k1", "rep", "n"), "k1").select("sig", "rep", "n").distinct(), "members")

    def similar_size(self, a: str, b: str):
        return F.least(a, b) * 100 >= F.greatest(a, b) * self.percent

    def arrays_of(self, pairs: DataFrame) -> DataFrame:
        """(a, b, sa, sb): the shingle arrays of both sides of ``pairs`` (a, b)."""
        needed = materialize(pairs.select(F.col("a").alias("rep")).union(pairs.select("b")).distinct(), "needed")
        ids = materialize(self.known.join(needed, "rep", "left_semi").select("doc_id").distinct(), "needed-ids")
        arrays = self.docs.join(ids, "doc_id", "left_semi").mapInArrow(_array_rows(self.words), "rep long, shingles array<long>")
        # An id may stand on other texts as well, and on one text twice.
        arrays = materialize(arrays.join(needed, "rep", "left_semi").dropDuplicates(["rep"]), "arrays")
        with_a = pairs.join(arrays.select(F.col("rep").alias("a"), F.col("shingles").alias("sa")), "a")
        return with_a.join(arrays.select(F.col("rep").alias("b"), F.col("shingles").alias("sb")), "b")

    def verified(self, pairs: DataFrame) -> DataFrame:
        """``pairs`` (a, b) whose sets are similar enough, compared shingle by shingle."""
        both = self.arrays_of(materialize(pairs, "pairs")).withColumn("common", F.size(F.array_intersect("sa", "sb")))
        union = F.size("sa") + F.size("sb") - F.col("common")
        return materialize(both.where(F.col("common") * 100 >= union * self.percent).select("a", "b").distinct(), "verified")

    def stars(self, members: DataFrame) -> DataFrame:
        """(rep, hub, n, hub_n, added, removed, linked, close): every class against one hub, and its difference from it.

        The hub of a signature is its member of most shared signatures; a class takes the
        foremost hub of similar size among its signatures.  So the classes of a large group agree on one hub.
        """
        degree = members.groupBy("rep").agg(F.count("*").alias("degree"))
        ranked = members.join(degree, "rep")
        hub = ranked.groupBy("sig").agg(F.max(F.struct("degree", F.col("rep").alias("r"), "n")).alias("h"))
        met = ranked.join(hub, "sig").where((F.col("rep") != F.col("h.r")) & self.similar_size("n", "h.n"))
        first = met.groupBy("rep", "n").agg(F.max("h").alias("h")).select(
            F.col("rep").alias("a"), F.col("h.r").alias("b"), F.col("h.n").alias("hub_n"), "n")
        both = self.arrays_of(materialize(first, "stars"))
        out = both.select(
            F.col("a").alias("rep"), F.col("b").alias("hub"), F.size("sa").cast("long").alias("n"), F.size("sb").cast("long").alias("hub_n"),
            F.array_except("sa", "sb").alias("added"), F.array_except("sb", "sa").alias("removed"))
        return materialize(self.judged(out), "differences")

    def judged(self, differences: DataFrame) -> DataFrame:
        """``differences`` (n, hub_n, added, removed) with linked and close, which tell how near the hub a class is."""
        n_added, apart = F.size("added"), F.size("added") + F.size("removed")
        p, size = self.percent, F.col("n") + F.col("hub_n")
        return differences.withColumns({
            "linked": (F.col("n") - n_added) * 100 >= (F.col("hub_n") + n_added) * p,
            "close": apart * (100 + p) <= 4 * (100 - p) * size,
        })

    def recentred(self, stars: DataFrame) -> DataFrame:
        """``stars`` with the most central class of a large group as its hub, where that is nearer to the group's classes than the hub.

        The hub of a signature may lie far out in its family; then all others have its own edits in common and few are linked to
        it.  A member whose difference from the hub is d differs from the others by the mean of their
        differences - sum over d of (2 x share of the classes that have the element - 1).  Differences from the new hub follow from those from the old one.
        """
        groups = stars.where("close").groupBy("hub").agg(F.count("*").alias("many")).where(F.col("many") >= LARGE)
        groups = materialize(groups, "large-groups")
        near = stars.where("close").join(groups, "hub").select("hub", "rep", "many", F.explode(F.concat("added", "removed")).alias("e"))
        near = materialize(near, "large-group-edits")
        often = near.groupBy("hub", "e").agg(F.count("*").alias("often"))
        gains = near.join(often, ["hub", "e"]).groupBy("hub", "rep").agg(F.sum(2 * F.col("often") - F.col("many")).alias("gain"))
        centres = gains.groupBy("hub").agg(F.max(F.struct("gain", "rep")).alias("m")).where("m.gain > 0").select("hub", F.col("m.rep").alias("rep"))
        centres = stars.join(centres, ["hub", "rep"]).select(
            "hub", F.col("rep").alias("centre"), F.col("n").alias("c_n"), F.col("added").alias("c_added"), F.col("removed").alias("c_removed"))
        rows = stars.join(materialize(centres, "centres"), "hub", "left").withColumn(
            "moved", F.col("centre").isNotNull() & (F.col("rep") != F.col("centre")))
        new = self.judged(rows.where("moved").select(
            "rep", F.col("centre").alias("hub"), "n", F.col("c_n").alias("hub_n"),
            F.concat(F.array_except("added", "c_added"), F.array_except("c_removed", "removed")).alias("added"),
            F.concat(F.array_except("c_added", "added"), F.array_except("removed", "c_removed")).alias("removed")))
        return materialize(rows.where("NOT moved").select(*stars.columns).unionByName(new), "differences")

    def may_be_similar(self):
        """Whether the sketches (odd*, bodd*) of two sets of n and bn shingles differ in no more buckets than similar sets can."""
        apart = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(f"b{x}"))) for x in _ODD[1:]), F.bit_count(F.col(_ODD[0]).bitwiseXOR(F.col(f"b{_ODD[0]}"))))
        return apart * (100 + self.percent) <= (100 - self.percent) * (F.col("n") + F.col("bn"))

    def edits(self, stars: DataFrame, classes: DataFrame) -> DataFrame:
        """The elements of the differences of classes close to one hub h: two similar classes, of which a is not linked to it, share one.

        If a and b are similar, their differences from h share more than p / (100 + p) of
        b's difference: |da| exceeds the bound for (a, h), and b's size is at most |h| + |db|.  So one of b's first
        elements in any fixed order is in a's difference.  Shingles that are not in h come
        first, rare ones before frequent ones; when the first common element is in h nevertheless, the
        pair's additions are disjoint, which the counts alone nearly always rule out.  Thousands of variants of one text
        are thus compared only where they share an edit, not pair by pair.
        """
        p = self.percent
        near = stars.where("close").select(
            "rep", "hub", "n", "linked", F.size("added").alias("na"), F.size("removed").alias("nr"),
            F.explode(F.concat(
                F.transform("added", lambda e: F.struct(F.lit(0).alias("old"), e.alias("e"))),
                F.transform("removed", lambda e: F.struct(F.lit(1).alias("old"), e.alias("e"))))).alias("d"),
        ).select("rep", "hub", "n", "linked", "na", "nr", "d.old", "d.e")
        near = materialize(near, "edits")
        often = near.groupBy("hub", "e").agg(F.count("*").alias("often")).where("often > 1")
        placed = near.join(often, ["hub", "e"])
        # Elements of one class alone come first in the order and match nothing: they only move the others back.
        alone = F.col("na") + F.col("nr") - F.count("*").over(Window.partitionBy("hub", "rep"))
        new_alone = F.col("na") - F.count_if(F.col("old") == 0).over(Window.partitionBy("hub", "rep"))
        at = F.row_number().over(Window.partitionBy("hub", "rep").orderBy("old", "often", "e"))
        size = F.col("na") + F.col("nr")
        place = at + F.when(F.col("old") == 0, new_alone).otherwise(alone)
        # The mean difference from the others, but for a constant, if the most shared of the elements is in all of them.
        each = Window.partitionBy("hub", "rep")
        placed = placed.withColumn("central", 2 * F.sum("often").over(each) / F.max("often").over(each) - size)
        placed = placed.withColumn("prefix", place <= size - F.floor(size * p / (100 + p))).join(classes.select("rep", *_ODD), "rep")
        return materialize(placed, "placed")

    def may_share(self):
        """Whether the counts of added and removed elements (na, nr, bna, bnr) leave room for two sets that share element e to be similar."""
        p, removed = self.percent, F.least("nr", "bnr")
        most = removed + F.when(F.col("old") == 0, F.least("na", "bna")).otherwise(0)
        enough = 2 * most * (100 + p) >= (F.col("na") + F.col("nr") + F.col("bna") + F.col("bnr")) * (100 + p) - (100 - p) * (F.col("n") + F.col("bn"))
        return enough & self.similar_size("n", "bn") & self.may_be_similar()

    def around_hubs(self, placed: DataFrame, links: DataFrame) -> DataFrame:
        """Links of classes around one hub that leave no similar two of them in different components.

        A shared edit can put most of a family in one bucket, where nearly all are linked with one another
        somehow.  In each round every bucket takes one member as local hub, first the most central
        one, then any by hash, and compares the others with it: one pair a row at most.  When the rounds have left
        few pairs in different components, or join no more, all pairs that are left are compared.  The rows of a
        bucket's main component then meet only those outside it, never one another.
        """
        found, before = links, float("inf")
        sides = [F.col(c).alias(f"b{c}") for c in ("rep", "n", "na", "nr", "c", *_ODD)]
        apart, new = F.col("c") != F.col("bc"), [F.least("rep", "brep").alias("a"), F.greatest("rep", "brep").alias("b")]
        while True:
            rows, left, size = self.mixed_buckets(placed, components(found))
            if left <= FEW * size or left > STUCK * before:
                break
            order = F.col("central") if before == float("inf") else F.xxhash64("rep", "e", F.lit(left))
            local = rows.groupBy("hub", "e").agg(F.max_by(F.struct("rep", "n", "na", "nr", "c", *_ODD), F.struct(order, "rep")).alias("local"))
            pairs = rows.join(local.select("hub", "e", "local.*").select("hub", "e", *sides), ["hub", "e"]).where(apart & self.may_share()).select(*new).distinct()
            found, before = materialize(found.unionByName(self.verified(pairs)), "links-around-hubs"), left
        ones, others = rows.where("NOT linked"), rows.where("prefix")
        inner = ones.where("c = main").join(others.where("c <> main").select("hub", "e", *sides), ["hub", "e"]).where(self.may_share())
        outer = ones.where("c <> main").join(others.select("hub", "e", *sides), ["hub", "e"]).where(apart & self.may_share())
        pairs = inner.select(*new).unionByName(outer.select(*new)).distinct()
        return materialize(found.unionByName(self.verified(pairs)), "links-around-hubs")

    def mixed_buckets(self, placed: DataFrame, label: DataFrame) -> tuple[DataFrame, int, int]:
        """``placed`` with c and main, its own component and the foremost of the bucket (hub, e), where pairs are left to compare, how many pairs and rows."""
        rows = placed.join(label, F.col("rep") == F.col("node"), "left").withColumn("c", F.coalesce("component", "rep")).drop("node", "component")
        rows = materialize(rows, "placed-components")
        groups = rows.groupBy("hub", "e", "c").agg(
            F.count("*").alias("many"), F.count_if(~F.col("linked")).cast("double").alias("l"), F.count_if("prefix").cast("double").alias("r"))
        buckets = groups.groupBy("hub", "e").agg(
            F.max_by("c", F.struct("many", "c")).alias("main"), F.sum("many").alias("members"),
            (F.sum("l") * F.sum("r") - F.sum(F.col("l") * F.col("r"))).alias("left")).where("left > 0")
        buckets = materialize(buckets, "mixed-buckets")
        left, size = buckets.agg(F.coalesce(F.sum("left"), F.lit(0)), F.coalesce(F.sum("members"), F.lit(0))).first()
        return rows.join(buckets.select("hub", "e", "main"), ["hub", "e"]), int(left), int(size)

    def across(self, members: DataFrame, stars: DataFrame, label: DataFrame, classes: DataFrame) -> DataFrame:
        """Candidate pairs of one signature that lie around different hubs and in different components.

        One of a pair is outside the signature's most frequent group, so only these few meet all the others.
        Two sets differ by at least as many shingles as there are buckets in which
        their sketches differ, which rules out nearly all pairs that are not similar.
        """
        own = stars.select(F.col("rep").alias("s_rep"), F.col("hub").alias("star"), F.when(F.col("close"), F.col("hub")).alias("near"))
        rows = members.join(own, F.col("rep") == F.col("s_rep"), "left").join(label, F.col("rep") == F.col("node"), "left").select(
            "sig", "rep", "n", F.coalesce("star", "rep").alias("star"), F.coalesce("near", "rep").alias("near"), F.coalesce("component", "rep").alias("c"))
        rows = materialize(rows, "around")
        groups = rows.groupBy("sig", "near").agg(F.count("*").alias("many"))
        main = groups.groupBy("sig").agg(F.max(F.struct("many", "near")).alias("m"), F.count("*").alias("k")).where("k > 1")
        main = materialize(main.select("sig", F.col("m.near").alias("main")), "mixed")
        mixed = materialize(rows.join(main, "sig").join(classes.select("rep", *_ODD), "rep"), "sketched")
        few = mixed.where("near <> main")
        other = mixed.select("sig", *[F.col(x).alias(f"b{x}") for x in ("rep", "n", "star", "near", "c", *_ODD)])
        new = (F.col("near") != F.col("bnear")) & (F.col("c") != F.col("bc")) & (F.col("star") != F.col("brep")) & (F.col("bstar") != F.col("rep"))
        pairs = few.join(other, "sig").where(new & self.similar_size("n", "bn") & self.may_be_similar())
        return pairs.select(F.least("rep", "brep").alias("a"), F.greatest("rep", "brep").alias("b")).distinct()

    def links(self, members: DataFrame, classes: DataFrame) -> DataFrame:
        """Links that leave no two similar classes in different components."""
        first = self.stars(members)
        stars = self.recentred(first)
        links = first.where("linked").unionByName(stars.where("linked")).select(F.col("rep").alias("a"), F.col("hub").alias("b"))
        links = self.around_hubs(self.edits(stars, classes), links)
        return links.unionByName(self.verified(self.across(members, stars, components(links), classes)))


def labelled_sets(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, k1, k2, c and component_id of every row; c names the component, null without words or without any id for the set."""
    join = Join(documents, words, percent)
    found = join.sets()
    sets = found.where("n_shingles >= 0")
    classes = join.classes(sets)
    label = components(join.links(join.shared(classes, join.frequent(found)), classes))
    named = classes.join(label, classes["rep"] == label["node"], "left").select("k1", "k2", "n", "doc_id", F.coalesce("component", "rep").alias("c"))
    named = materialize(named, "labels")
    least = named.groupBy("c").agg(F.min("doc_id").alias("found"))
    named = named.drop("doc_id").join(least, "c").withColumnsRenamed({"k1": "c1", "k2": "c2"})
    same = (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & (F.col("n_shingles") == F.col("n"))
    return sets.join(named, same, "left").select("doc_id", "n_shingles", "k1", "k2", "c", F.coalesce("found", "doc_id").alias("component_id"))


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of ``documents``.

    Two rows link when 100 x common shingles >= ``percent`` x all their shingles.
    Words are lower-cased in A-Z.  A text with fewer than ``words`` words is one shingle; one without words (null too)
    links with nothing and is its own component.  Rows of equal sets share a
    component whatever their ids; a null id gets the component of its set, if any row of it has an id.  Repeated ids
    are told apart by their texts.  Shingles and sets are compared by 64-bit hashes.
    """
    return labelled_sets(documents, words, percent).select("doc_id", "n_shingles", "component_id")


def set_key(text: Column, words: int) -> Column:
    """First key of a text's set, null for one without words."""
    @F.pandas_udf("long")
    def keys(texts: pd.Series) -> pd.Series:
        out = []
        for part in slices(pa.array(texts, pa.string())):
            out += [_keys(s)[0] if len(s) else None for _, s in shingle_sets(part, words)]
        return pd.Series(out, dtype="Int64")

    return keys(text)


def drop_near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``documents`` with one row of each component: one of its smallest id.  Rows without words or id all stay.

    Rows are told apart by id and set, so a text that shares its id with an unlike one goes and stays by its own component.
    """
    found = materialize(labelled_sets(documents, words, percent).where("n_shingles > 0 AND doc_id IS NOT NULL"), "groups")
    first = found.where("doc_id = component_id").groupBy("c").agg(F.min("k1").alias("first"))
    judged = found.join(first, "c").select("doc_id", "k1", ((F.col("doc_id") == F.col("component_id")) & (F.col("k1") == F.col("first"))).alias("stays"))
    judged = materialize(judged, "judged")
    gone = judged.where("NOT stays").select(F.col("doc_id").alias("__gone"), F.col("k1").alias("__k1")).distinct()
    # Ids on several rows, of one set or of different ones; their rows are looked at one by one.
    several = judged.groupBy(F.col("doc_id").alias("__several")).agg(F.count("*").alias("n")).where("n > 1").select("__several")
    several = materialize(several, "several")
    if several.isEmpty():
        return documents.join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    plain = documents.join(several, F.col("doc_id") == F.col("__several"), "left_anti").join(gone, F.col("doc_id") == F.col("__gone"), "left_anti")
    rows = documents.join(several, F.col("doc_id") == F.col("__several"), "left_semi").withColumn("__key", set_key(F.col("text"), words))
    rows = materialize(rows, "rows-of-several")
    one = rows.where("__key IS NOT NULL").join(gone, (F.col("doc_id") == F.col("__gone")) & (F.col("__key") == F.col("__k1")), "left_anti").dropDuplicates(["doc_id", "__key"])
    return plain.unionByName(one.drop("__key")).unionByName(rows.where("__key IS NULL").drop("__key"))
