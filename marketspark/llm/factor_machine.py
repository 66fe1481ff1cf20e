"""Quality classifier: a factorisation machine over a text.

Inputs are hashed lower-cased words, structure statistics and the table's own
``n_chars``.  Every input has a weight and a short factor vector; a pair of inputs
interacts through the product of their factors.  The sum over all pairs is half of
(sum)^2 - (sum of squares) per factor, so scoring is linear in the inputs.

The machine is fitted on at most ``FIT_ROWS`` labelled rows (a documented bound, taken in
hash order of the ids) and then scores every row where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import Slice, slices

WORD_BUCKETS = 1 << 14
FACTORS = 8
#: Most labelled rows that a fit reads.
FIT_ROWS = 6000
EPOCHS, LEAST_STEPS, BATCH, RATE, DECAY = 15, 600, 128, 0.02, 1e-4
PREDICT_FROM = 0.7
STATISTICS = (
    "constant", "log_words", "word_length", "distinct_words", "repeated_pairs", "symbols", "punctuation", "upper", "digits",
    "wide_bytes", "log_lines", "repeated_lines", "log_n_chars",
)
_SYMBOL, _PUNCT, _UPPER, _DIGIT, _WIDE, _NEWLINE = (np.zeros(256, bool) for _ in range(6))
_SYMBOL[[ord(c) for c in "#*$%&|<>@~^_={}[]\\"]] = True
_PUNCT[[ord(c) for c in "!?.,;:"]] = True
_UPPER[65:91] = True
_DIGIT[48:58] = True
_WIDE[128:] = True
_NEWLINE[10] = True


def _repeats(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """Per owner, how many of its hashes equal an earlier one of it."""
    order = np.lexsort((h, owner))
    o, v = owner[order], h[order]
    again = (o[1:] == o[:-1]) & (v[1:] == v[:-1])
    return np.bincount(o[1:][again], minlength=n)


def features(part: Slice, n_chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, input, value) of the word inputs of a slice, sorted by row, and its statistics [row, statistic]."""
    n, data = len(part.rows), part.data
    starts, ends, first = part.words()
    words = np.diff(first)
    owner = np.repeat(np.arange(n), words)
    h = part.hashes(starts, ends, lower=True)
    key, counts = np.unique(owner * WORD_BUCKETS + (h >> np.uint64(20)).astype(np.int64) % WORD_BUCKETS, return_counts=True)
    row, bucket = key // WORD_BUCKETS, key % WORD_BUCKETS
    value = 1 + np.log(counts)
    value /= np.sqrt(np.maximum(np.bincount(row, value * value, n), 1e-12))[row]

    bounds = part.bounds
    of = lambda table: np.diff(np.concatenate([[0], np.cumsum(table[data])])[bounds])
    size, some = np.maximum(np.diff(bounds), 1), np.maximum(words, 1)
    with np.errstate(over="ignore"):
        pair_ok = owner[1:] == owner[:-1]
        pairs = (h[:-1] * np.uint64(0xD6E8FEB86659FD93) + h[1:])[pair_ok]
    # Lines: hashes between newlines and text bounds.
    cut = np.unique(np.concatenate([bounds, np.flatnonzero(_NEWLINE[data]) + 1]))
    line_owner = np.searchsorted(bounds, cut[:-1], "right") - 1
    stop = cut[1:] - (_NEWLINE[data[cut[1:] - 1]] if len(cut) > 1 else 0)
    line_hash = part.hashes(cut[:-1], stop) if len(cut) > 1 else np.zeros(0, np.uint64)
    lines = np.bincount(line_owner, minlength=n)
    stats = np.stack([
        np.ones(n), np.log1p(words) / 5, np.bincount(owner, ends - starts, n) / some / 5,
        np.bincount(row, minlength=n) / some, _repeats(owner[1:][pair_ok], pairs, n) / some,
        np.sqrt(of(_SYMBOL) / size), np.sqrt(of(_PUNCT) / size), np.sqrt(of(_UPPER) / size), np.sqrt(of(_DIGIT) / size),
        of(_WIDE) / size, np.log1p(lines) / 3, _repeats(line_owner, line_hash, n) / np.maximum(lines, 1), np.log1p(np.maximum(n_chars, 0)) / 8,
    ], axis=1)
    return row, bucket, value, stats


class Machine:
    """Weights ``w`` [input] and factors ``v`` [input, factor]; statistics follow the word buckets."""

    def __init__(self, w: np.ndarray, v: np.ndarray):
        self.w, self.v = w, v

    def raw(self, row: np.ndarray, at: np.ndarray, x: np.ndarray, stats: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score before the logistic, and the factor sums [row, factor]."""
        n, dense = len(stats), slice(WORD_BUCKETS, None)
        linear = np.bincount(row, self.w[at] * x, n) + stats @ self.w[dense]
        vx = self.v[at] * x[:, None]
        sums = np.stack([np.bincount(row, vx[:, f], n) for f in range(self.v.shape[1])], 1) + stats @ self.v[dense]
        squares = np.bincount(row, (vx * vx).sum(1), n) + (stats * stats) @ (self.v[dense] ** 2).sum(1)
        return linear + (sums * sums).sum(1) / 2 - squares / 2, sums


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(examples: list[tuple[np.ndarray, np.ndarray, np.ndarray, int]], seed: int = 5) -> Machine:
    """Machine of log loss by Adam over (inputs, values, statistics, label)."""
    rng = np.random.default_rng(seed)
    size = WORD_BUCKETS + len(STATISTICS)
    theta = np.concatenate([np.zeros((size, 1)), rng.normal(0, 0.03, (size, FACTORS))], 1)
    m, s, step = np.zeros_like(theta), np.zeros_like(theta), 0
    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // len(examples)) if examples else 0):
        order = rng.permutation(len(examples))
        for lo in range(0, len(order), BATCH):
            own = [examples[i] for i in order[lo : lo + BATCH]]
            row = np.repeat(np.arange(len(own)), [len(e[0]) for e in own])
            at, x = np.concatenate([e[0] for e in own]), np.concatenate([e[1] for e in own])
            stats, y = np.stack([e[2] for e in own]), np.array([e[3] for e in own])
            machine = Machine(theta[:, 0], theta[:, 1:])
            z, sums = machine.raw(row, at, x, stats)
            error = (logistic(z) - y) / len(own)
            grad = DECAY * theta
            pull = error[row] * x
            flat = np.concatenate([pull[:, None], pull[:, None] * (sums[row] - machine.v[at] * x[:, None])], 1)
            for f in range(FACTORS + 1):
                grad[:WORD_BUCKETS, f] += np.bincount(at, flat[:, f], WORD_BUCKETS)
            grad[WORD_BUCKETS:, 0] += stats.T @ error
            grad[WORD_BUCKETS:, 1:] += stats.T @ (error[:, None] * sums) - ((stats * stats).T @ error)[:, None] * machine.v[WORD_BUCKETS:]
            step += 1
            m += 0.1 * (grad - m)
            s += 0.001 * (grad * grad - s)
            theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    return Machine(theta[:, 0], theta[:, 1:])


def _chars(batch: pa.RecordBatch) -> np.ndarray:
    return np.nan_to_num(batch.column("n_chars").cast(pa.float64()).to_numpy(zero_copy_only=False))


def train(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Machine:
    """Machine from ``labels`` (doc_id, label) of documents; null labels and labels of no document are left out."""
    chosen = labels.where("label IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", F.col("label").cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows)
    # At most fit_rows rows of two numbers.
    rows = documents.select("doc_id", "text", "n_chars").join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = _chars(batch)
            for part in slices(batch.column("text")):
                row, at, x, stats = features(part, chars[part.rows.start : part.rows.stop])
                cuts = np.searchsorted(row, np.arange(len(part.rows) + 1)).astype(np.int32)
                own = pa.array(np.arange(part.rows.start, part.rows.stop))
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc_id").take(own), batch.column("label").take(own),
                    pa.ListArray.from_arrays(cuts, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(cuts, pa.array(x)),
                    pa.array(list(stats), pa.list_(pa.float64())),
                ], names=["doc_id", "label", "at", "x", "stats"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(run, f"doc_id {kind}, label int, at array<int>, x array<double>, stats array<double>").toArrow()
    found = found.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    columns = [[v.values.to_numpy() for v in found[c]] for c in ("at", "x", "stats")]
    return fit(list(zip(*columns, found["label"].to_pylist())))


def score(documents: DataFrame, machine: Machine, *keep: str | Column) -> DataFrame:
    """The columns ``keep`` plus ``score`` and ``predicted`` of every row; null text is empty, null n_chars 0."""
    # Of fixed size: (WORD_BUCKETS + statistics) x (1 + FACTORS).
    shared = documents.sparkSession.sparkContext.broadcast((machine.w, machine.v))
    rows = documents.select(*keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Machine(*shared.value)
        for batch in batches:
            chars, out = _chars(batch), [np.zeros(0)]
            for part in slices(batch.column("__text")):
                out.append(logistic(own.raw(*features(part, chars[part.rows.start : part.rows.stop]))[0]))
            p = np.concatenate(out)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-2], pa.array(p), pa.array((p >= PREDICT_FROM).astype(np.int32))],
                names=[*batch.schema.names[:-2], "score", "predicted"])

    given = documents.select(*keep, F.col("text").alias("__text"), F.col("n_chars"))
    return given.mapInArrow(run, f"{schema}, score double, predicted int")
