"""Language model in a log-frequency Bloom filter.

The filter holds (n-gram, level) for every level from 1 to the quantised log
count of an n-gram.  A count is read by probing level 1, 2, ... until one is absent, so a
wrong answer can only come from a false positive and is seldom far off.  Unigrams and
bigrams of all training tokens go in; a bigram's probability is interpolated with the
add-constant unigram probability.

The filter's bits lie in segments.  An n-gram's bits are all in one segment, so the
segments are built independently, each by the task that holds its n-grams and sized by
that task for FALSE_POSITIVES with the number of (n-gram, level) entries it has.  While
all segments together stay within BROADCAST_BITS, as for a small table, they go to every worker; beyond that
they stay where they are, and the distinct n-grams of CHUNK_BYTES of text are sent to
them and their levels back.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import materialize
from .text import mix, signed, slices

#: Fewest segments; more are made so that one has at most SEGMENT_TOKENS of the training tokens.
SEGMENTS, SEGMENT_TOKENS = 256, 1 << 22
PART_TOKENS = 4_000_000
#: Size of a filter whose number of entries is not known.
MIN_BITS = 1 << 20
#: Largest filter that every worker holds, 8 MB; a larger one is asked by segment.
BROADCAST_BITS = 1 << 26
#: Text whose n-grams are sent together to the segments of a larger filter.
CHUNK_BYTES = 8 << 20
HASHES = 4
#: Share of absent (n-gram, level) entries that a segment takes for present.
FALSE_POSITIVES = 0.01
BITS_PER_ENTRY = -HASHES / math.log(1 - FALSE_POSITIVES ** (1 / HASHES))
LEVEL_BASE = 2.0
LAMBDA = 0.4
#: Words whose exact counts every worker holds; the others' counts are joined.  16 bytes each.
HEAD_WORDS = 1 << 18
ADD = 0.1
#: The filter tells n-grams apart by the leading 48 bits of their hashes, whose sorted gaps take four bytes.
_KEPT = np.uint64(0xFFFFFFFFFFFF0000)
_BIGRAM = np.uint64(0xD6E8FEB86659FD93)
_SEED = np.uint64(0xA0761D6478BD642F)
RARE = mix(np.array([11], np.uint64))[0]
END = int(mix(np.array([7], np.uint64)).view(np.int64)[0])


def _tokens(part) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a slice's texts one after another, each text's end token last, and where each text begins."""
    starts, ends, first = part.words()
    n = len(part.rows)
    last = first[1:] + np.arange(n)
    out = np.empty(len(starts) + n, np.uint64)
    is_word = np.ones(len(out), bool)
    is_word[last] = False
    out[is_word] = part.hashes(starts, ends, lower=True)
    out[last] = np.array([END], np.int64).view(np.uint64)
    return out, np.concatenate([[0], last[:-1] + 1])


def _before(tokens: np.ndarray) -> np.ndarray:
    """The token before each; a text's first token follows the end of another, as any text's end is the same token."""
    return np.concatenate([np.array([END], np.int64).view(np.uint64), tokens[:-1]])


def _bigrams(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * _BIGRAM + tokens)


def _distinct(h: np.ndarray) -> np.ndarray:
    """Distinct hashes, sorted; a plain sort takes a tenth of the time of ``np.unique``'s hash table."""
    h = np.sort(h)
    return h[np.concatenate([h[:1] == h[:1], h[1:] != h[:-1]])]


def _classes(tokens: np.ndarray, vocabulary: np.ndarray | None) -> np.ndarray:
    """Tokens of the vocabulary (sorted hashes; None: all words) as they are, all others as one class."""
    if vocabulary is None:
        return tokens
    if not len(vocabulary):
        return np.full(len(tokens), RARE)
    at = np.minimum(np.searchsorted(vocabulary, tokens), len(vocabulary) - 1)
    return np.where(vocabulary[at] == tokens, tokens, RARE)


def _segment(h: np.ndarray, segments: int = SEGMENTS) -> np.ndarray:
    """The leading bits of the hash; ``segments`` is a power of two."""
    return (h >> np.uint64(65 - int(segments).bit_length())).astype(np.int64)


def _by_segment(h: np.ndarray, segments: int) -> Iterator[tuple[int, slice]]:
    """(segment, its range) of sorted hashes, for each segment that has some."""
    found, first = np.unique(_segment(h, segments), return_index=True)
    for s, lo, hi in zip(found.tolist(), first.tolist(), [*first[1:].tolist(), len(h)]):
        yield s, slice(lo, hi)


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, so that the shuffle's compression finds the equal bytes."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes()


def _numbers(planes: bytes, kind=np.uint64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, -1).T).view(kind).reshape(-1)


def _parts(h: np.ndarray, n: np.ndarray, segments: int) -> pa.RecordBatch:
    """(segment, gaps, n): distinct sorted hashes of each segment as differences, and their counts."""
    rows = [(s, _planes(np.diff(h[at], prepend=np.uint64(0))), _planes(n[at])) for s, at in _by_segment(h, segments)]
    cols = list(zip(*rows)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], names=["segment", "gaps", "n"])


_PARTS = "segment int, gaps binary, n binary"


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes, sorted, and their summed counts."""
    order = np.argsort(h)
    h, n = h[order], n[order]
    first = np.flatnonzero(np.concatenate([h[:1] == h[:1], h[1:] != h[:-1]]))
    return h[first], np.add.reduceat(n, first) if len(first) else n


def _count(texts: DataFrame, grams, segments: int = 0) -> DataFrame:
    """(h, n) of ``grams(tokens)`` over all texts, or their parts by segment; a task sums bounded parts before they are shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            h, n = np.unique(np.concatenate([*held, np.zeros(0, np.uint64)]), return_counts=True)
            held.clear()
            if segments:
                return _parts(*_summed(h & _KEPT, n.astype(np.int64)), segments)
            return pa.RecordBatch.from_arrays([signed(h), pa.array(n.astype(np.int64))], names=["h", "n"])

        for batch in batches:
            for part in slices(batch.column("text")):
                held.append(grams(_tokens(part)[0]))
                if sum(map(len, held)) > PART_TOKENS:
                    yield flush()
        yield flush()

    return texts.select("text").mapInArrow(run, _PARTS if segments else "h long, n long")


def _parts_of(counts: DataFrame, segments: int) -> DataFrame:
    """Parts by segment of a table (h, n) of distinct hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            h = np.concatenate([*(x[0] for x in held), np.zeros(0, np.uint64)])
            n = np.concatenate([*(x[1] for x in held), np.zeros(0, np.int64)])
            held.clear()
            return _parts(*_summed(h & _KEPT, n), segments)

        for batch in batches:
            held.append((batch.column("h").to_numpy().view(np.uint64), batch.column("n").to_numpy()))
            if sum(len(x[0]) for x in held) > PART_TOKENS:
                yield flush()
        yield flush()

    return counts.select("h", "n").mapInArrow(run, _PARTS)


class Filter:
    """Segmented Bloom filter over (hash, level); ``sizes`` are the 64-bit words of each segment, by default equal."""

    def __init__(self, bits: int = MIN_BITS, sizes: np.ndarray | None = None, words: np.ndarray | None = None):
        self.sizes = np.full(SEGMENTS, bits // SEGMENTS // 64) if sizes is None else sizes
        self.first = np.cumsum(self.sizes) - self.sizes
        self.words = np.zeros(int(self.sizes.sum()), np.uint64) if words is None else words

    @classmethod
    def for_entries(cls, entries: int) -> Filter:
        """A filter of one segment with room for so many (hash, level) entries."""
        return cls(sizes=np.array([max(1, math.ceil(entries * BITS_PER_ENTRY / 64))]))

    def places(self, segment: np.ndarray, h: np.ndarray, level: int):
        """(word, bit) of each hash function for a level."""
        bits, first = self.sizes[segment].astype(np.uint64) << np.uint64(6), self.first[segment]
        with np.errstate(over="ignore"):
            a = mix(h ^ (_SEED * np.uint64(level)))
            step = mix(a) | np.uint64(1)
            for _ in range(HASHES):
                at = a % bits
                yield first + (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
                a = a + step

    def add(self, segment: int, h: np.ndarray, levels: np.ndarray):
        for level in range(1, int(levels.max(initial=0)) + 1):
            own = h[levels >= level]
            for word, bit in self.places(np.full(len(own), segment), own, level):
                np.bitwise_or.at(self.words, word, bit)

    def level(self, h: np.ndarray, segment: np.ndarray | None = None) -> np.ndarray:
        """Highest level up to which every probe succeeds."""
        out = np.zeros(len(h), np.int64)
        left, level = np.arange(len(h)), 1
        segment = _segment(h, len(self.sizes)) if segment is None else segment
        while len(left):
            there = np.ones(len(left), bool)
            for word, bit in self.places(segment[left], h[left], level):
                there &= (self.words[word] & bit) != 0
            left = left[there]
            out[left] = level
            level += 1
        return out


def quantise(n: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(n) / np.log(LEVEL_BASE) + 1e-9).astype(np.int64)


def expected(levels: np.ndarray) -> np.ndarray:
    """Middle of the counts that a level stands for; 0 for level 0."""
    low = LEVEL_BASE ** (levels - 1.0)
    return np.where(levels > 0, (low + np.maximum(low, LEVEL_BASE * low - 1)) / 2, 0.0)


def build(parts: DataFrame) -> DataFrame:
    """(segment, size, words) of the finished segments over ``parts``; each is sized by its own entries."""
    def run(key: tuple, group: pa.Table) -> pa.Table:
        h = np.concatenate([np.cumsum(_numbers(x)) for x in group.column("gaps").to_pylist()])
        h, n = _summed(h, np.concatenate([_numbers(x, np.int64) for x in group.column("n").to_pylist()]))
        levels = quantise(n)
        made = Filter.for_entries(int(levels.sum()))
        made.add(0, h, levels)
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "size": pa.array([len(made.words)], pa.int64()), "words": pa.array([made.words.tobytes()], pa.binary())})

    return parts.groupBy("segment").applyInArrow(run, "segment int, size long, words binary")


def _collected(finished: DataFrame, segments: int) -> Filter:
    """All segments in one filter; one without n-grams is a word of zeros."""
    rows = {r["segment"]: np.frombuffer(r["words"], np.uint64) for r in finished.select("segment", "words").collect()}
    words = [rows.get(s, np.zeros(1, np.uint64)) for s in range(segments)]
    return Filter(sizes=np.array([len(w) for w in words]), words=np.concatenate(words))


def train(texts: DataFrame, broadcast_bits: int = BROADCAST_BITS, head_words: int = HEAD_WORDS, vocabulary: int | None = None) -> tuple[dict, DataFrame, DataFrame]:
    """The model as a dictionary of bounded size, the filter's segments and the table (h, n) of all words' counts.

    The model's ``sizes`` and ``words`` are None for a filter of more than ``broadcast_bits``.  With ``vocabulary``,
    bigrams tell only so many words apart.
    """
    words = materialize(_count(texts, lambda t: t).groupBy("h").agg(F.sum("n").alias("n")), "lm-words")
    total = words.agg(F.count("*").alias("types"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    head = words.orderBy(F.desc("n"), "h").limit(head_words).toArrow()
    h, n = head["h"].to_numpy().view(np.uint64), head["n"].to_numpy()
    named, rare = None, 0
    if vocabulary is not None:
        named, rare = np.sort(h[:vocabulary]), max(0, total["n"] - int(n[:vocabulary].sum()))
    order = np.argsort(h)
    segments = SEGMENTS
    while segments * SEGMENT_TOKENS < total["n"]:
        segments *= 2
    shared = texts.sparkSession.sparkContext.broadcast(named)
    pairs = _count(texts, lambda t: _bigrams(_classes(_before(t), shared.value), _classes(t, shared.value)), segments)
    finished = materialize(build(pairs.unionByName(_parts_of(words, segments))), "lm-segments")
    bits = 64 * (finished.agg(F.sum("size")).first()[0] or 0)
    lm = _collected(finished, segments) if bits <= broadcast_bits else None
    model = {
        "segments": segments, "sizes": lm and lm.sizes, "words": lm and lm.words, "head": h[order], "head_n": n[order], "vocabulary": named, "rare": rare,
        "n": int(total["n"]), "types": int(total["types"]), "tail": total["types"] > head.num_rows,
    }
    return model, finished, words


def _asked(model: dict, tokens: np.ndarray) -> np.ndarray:
    """Distinct hashes whose levels the scores of ``tokens`` need, sorted."""
    own, before = _classes(tokens, model["vocabulary"]), _classes(_before(tokens), model["vocabulary"])
    classes = [] if model["vocabulary"] is None else [before]  # else every token before is a token
    return _distinct(np.concatenate([tokens, *classes, _bigrams(before, own)]) & _KEPT)


def _scores(model: dict, level, tokens: np.ndarray) -> np.ndarray:
    """log10 probability of each token after the one before it; ``level`` gives the filter's levels of hashes."""
    floor = model["n"] + ADD * (model["types"] + 1)
    vocabulary, before = model["vocabulary"], _before(tokens)
    own, before = _classes(tokens, vocabulary), _classes(before, vocabulary)
    seen, at = np.unique(tokens, return_inverse=True)
    count = expected(level(seen & _KEPT))[at]
    p = (count + ADD) / floor
    grams, which = np.unique(_bigrams(before, own), return_inverse=True)
    both = expected(level(grams & _KEPT))[which]
    if vocabulary is None:
        c = np.roll(count, 1)  # the last token is an end, which the first one follows
    else:
        firsts, first_at = np.unique(before, return_inverse=True)
        c = expected(level(firsts & _KEPT))
        c[firsts == RARE] = model["rare"]
        c = c[first_at]
    linked = np.where(c > 0, np.minimum(1.0, both / np.maximum(c, 1)), 0.0)
    if vocabulary is not None:
        # Inside the class of all other words a word has its share of their unigram probability.
        linked = np.where(own == RARE, linked * np.minimum(1.0, p * floor / max(1, model["rare"])), linked)
    return np.log10(LAMBDA * linked + (1 - LAMBDA) * p)


_SCORED = ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score", "rest"]


def _tokenised(batch: pa.RecordBatch | pa.Table) -> Iterator[tuple[range, np.ndarray, np.ndarray]]:
    """(rows, tokens, where each text begins) of a batch's slices."""
    return ((part.rows, *_tokens(part)) for part in slices(batch.column("text")))


def _scored(model: dict, level, batch: pa.RecordBatch | pa.Table, tokenised) -> Iterator[list[pa.Array]]:
    """The columns _SCORED of a batch's ``tokenised`` slices, one by one; ``rest`` has the tokens that are not in the head."""
    floor = model["n"] + ADD * (model["types"] + 1)
    for at_rows, tokens, begin in tokenised:
        score = np.add.reduceat(_scores(model, level, tokens), begin)
        seen, at = np.unique(tokens, return_inverse=True)
        place = np.minimum(np.searchsorted(model["head"], seen), max(0, len(model["head"]) - 1))
        hit = model["head"][place] == seen if len(model["head"]) else np.zeros(len(seen), bool)
        c = np.where(hit, model["head_n"][place] if len(model["head"]) else 0, 0)
        terms = np.log10((c + ADD) / floor)
        rest = ~hit & model["tail"]
        terms[rest] = 0.0
        known, base = np.add.reduceat(hit[at].astype(np.int64), begin), np.add.reduceat(terms[at], begin)
        left = rest[at]
        offsets = np.concatenate([[0], np.cumsum(np.add.reduceat(left.astype(np.int32), begin))])
        rows = pa.array(np.arange(at_rows.start, at_rows.stop))
        yield [
            batch.column("doc_id").take(rows), batch.column("held_out").take(rows),
            pa.array(np.diff(np.append(begin, len(tokens)))), pa.array(known), pa.array(base), pa.array(score),
            pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), signed(tokens[left])),
        ]


def _scored_by_segment(docs: DataFrame, shared, finished: DataFrame, schema: str) -> DataFrame:
    """Scores with a filter that stays in its segments.

    A chunk is the rows of one remainder of their hash.  Its distinct hashes go to the segments, sorted, and
    come back as one byte a hash in the same order; so the chunk's texts find them again.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = docs.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 + size // CHUNK_BYTES)).alias("chunk"), "doc_id", "held_out", "text")

    def asked_by(tokenised) -> np.ndarray:
        return _distinct(np.concatenate([_asked(shared.value, tokens) for _, tokens, _ in tokenised]))

    def ask(key: tuple, group: pa.Table) -> pa.Table:
        h = asked_by(_tokenised(group))
        asked = [(s, _planes(np.diff(h[at], prepend=np.uint64(0)))) for s, at in _by_segment(h, shared.value["segments"])]
        return pa.table({
            "chunk": pa.array([key[0].as_py()] * len(asked), pa.int64()), "segment": pa.array([s for s, _ in asked], pa.int32()),
            "gaps": pa.array([x for _, x in asked], pa.binary())})

    def answer(key: tuple, group: pa.Table, segment: pa.Table) -> pa.Table:
        rows = segment.column("words").to_pylist()
        words = np.frombuffer(rows[0], np.uint64) if rows else np.zeros(1, np.uint64)
        lm, out = Filter(sizes=np.array([len(words)]), words=words), []
        for gaps in group.column("gaps").to_pylist():
            h = np.cumsum(_numbers(gaps))
            out.append(lm.level(h, np.zeros(len(h), np.int64)).astype(np.uint8).tobytes())
        return pa.table({"chunk": group.column("chunk"), "segment": group.column("segment"), "levels": pa.array(out, pa.binary())})

    def score(key: tuple, rows: pa.Table, answers: pa.Table) -> pa.Table:
        model, tokenised = shared.value, list(_tokenised(rows))
        asked = asked_by(tokenised)
        levels, told = np.zeros(len(asked), np.int64), dict(zip(answers.column("segment").to_pylist(), answers.column("levels").to_pylist()))
        for s, at in _by_segment(asked, model["segments"]):
            levels[at] = np.frombuffer(told[s], np.uint8)
        return pa.concat_tables([pa.table(x, names=_SCORED) for x in _scored(model, lambda h: levels[np.searchsorted(asked, h)], rows, tokenised)])

    asked = rows.groupBy("chunk").applyInArrow(ask, "chunk long, segment int, gaps binary")
    answers = asked.groupBy("segment").cogroup(finished.select("segment", "words").groupBy("segment")).applyInArrow(answer, "chunk long, segment int, levels binary")
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


def score_documents(documents: DataFrame, held_out: Column, **limits) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Trained on the rows where ``held_out`` is false.  ``base_score`` is exact: the
    counts of the most frequent words are in every worker's memory, those of all
    other words are joined.  ``score`` sums log10(LAMBDA x c(word before, word) / c(word before) +
    (1 - LAMBDA) x p(word)), all counts from the filter.
    Words are told apart by 64-bit hashes.  Null text is empty: the end token
    alone.  Rows are scored each by itself, also repeated ones and null ids.
    """
    docs = documents.select("doc_id", "text", held_out.alias("held_out"))
    model, finished, counted = train(docs.where("NOT held_out"), **limits)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        lm = Filter(sizes=model["sizes"], words=model["words"])
        for batch in batches:
            for columns in _scored(model, lm.level, batch, _tokenised(batch)):
                yield pa.RecordBatch.from_arrays(columns, names=_SCORED)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double, rest array<long>"
    scored = docs.mapInArrow(run, schema) if model["words"] is not None else _scored_by_segment(docs, shared, finished, schema)
    out = ["doc_id", "held_out", "n_tokens", "n_known", F.lit(model["n"]).cast("long").alias("train_tokens"), "base_score", "score"]
    if not model["tail"]:
        return scored.select(*out)
    scored = materialize(scored.withColumn("row", F.monotonically_increasing_id()), "lm-scored")
    rest = scored.select("row", F.explode("rest").alias("h"))
    # Words beyond the head are rare, so no key of this join is hot; equal words of a row are joined once.
    rest = rest.groupBy("h", "row").agg(F.count("*").alias("times")).join(counted.withColumnRenamed("n", "c"), "h", "left")
    floor = float(model["n"] + ADD * (model["types"] + 1))
    term = F.log10((F.coalesce("c", F.lit(0)) + ADD) / floor) * F.col("times")
    added = rest.groupBy("row").agg(F.sum(term).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("known"))
    return scored.join(added, "row", "left").withColumns({
        "n_known": F.col("n_known") + F.coalesce("known", F.lit(0)), "base_score": F.col("base_score") + F.coalesce("more", F.lit(0.0)),
    }).select(*out)
