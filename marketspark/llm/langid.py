"""Language identification of texts that may mix languages.

Byte n-grams of lower-cased texts are hashed into a fixed number of buckets;
every training text adds to its language's counts.  A document is then taken as
a mixture: expectation-maximisation finds the language proportions under which
its n-grams are likeliest, and the set of languages is chosen by penalised
likelihood, one language more only while the gain exceeds the penalty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import slices

BUCKETS = 1 << 14
ORDERS = (2, 3, 4)
#: Most languages of a model; its size, BUCKETS x MAX_LANGUAGES doubles, bounds what is broadcast.
MAX_LANGUAGES = 256
UNKNOWN = "und"
_ADD = 0.5
#: n-grams of which one text counts as evidence of one independent observation.
_OVERLAP = 6.0


def ngram_buckets(data: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all byte n-grams of one text, every order in a share of the buckets of its own hash."""
    wide = np.concatenate([np.full(1, 32, np.uint8), data, np.full(1, 32, np.uint8)]).astype(np.uint64)
    out = []
    with np.errstate(over="ignore"):
        for n in ORDERS:
            if len(wide) >= n:
                h = np.full(len(wide) - n + 1, n, np.uint64)
                for i in range(n):
                    h = (h ^ wide[i : len(wide) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
                    h ^= h >> np.uint64(29)
                out.append(h % np.uint64(buckets))
    return np.concatenate(out).astype(np.int64) if out else np.zeros(0, np.int64)


def _lowered(texts: pa.Array) -> pa.Array:
    return pc.utf8_lower(pc.fill_null(texts, ""))


def train(rows: DataFrame, buckets: int = BUCKETS) -> tuple[list[str], np.ndarray]:
    """(languages, log likelihoods [language, bucket]) from all of ``rows`` (text, lang).

    Counts are summed per task first, so the shuffle carries at most a row for each
    task, language and bucket.  Raises beyond MAX_LANGUAGES.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for part in slices(_lowered(batch.column("text"))):
                for k, row in enumerate(part.rows):
                    own = held.setdefault(langs[row], np.zeros(buckets, np.int64))
                    own += np.bincount(ngram_buckets(part.data[part.bounds[k] : part.bounds[k + 1]], buckets), minlength=buckets)
            if len(held) > MAX_LANGUAGES:
                raise ValueError(f"more than {MAX_LANGUAGES} languages")
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some), pa.string()), pa.array(some, pa.int32()), pa.array(counts[some])], names=["lang", "bucket", "n"])

    sums = rows.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang").mapInArrow(
        count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = sums.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("counts")).limit(MAX_LANGUAGES + 1).toArrow()
    if found.num_rows > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    model = {}
    for lang, counts in zip(found["lang"].to_pylist(), found["counts"]):
        flat = counts.values
        row = np.full(buckets, _ADD)
        row[flat.field("bucket").to_numpy()] += flat.field("n").to_numpy()
        model[lang] = np.log(row / row.sum())
    langs = sorted(model)
    return langs, np.array([model[g] for g in langs]).reshape(len(langs), buckets)


def mixture(log_p: np.ndarray, counts: np.ndarray, steps: int = 25) -> tuple[np.ndarray, float]:
    """Proportions [language] and log likelihood of counts under a mixture of ``log_p`` [language, n-gram]."""
    top = log_p.max(0)
    p = np.exp(log_p - top)
    theta = np.full(len(p), 1.0 / len(p))
    total = counts.sum()
    for _ in range(steps):
        share = theta @ p
        new = theta * (p @ (counts / share)) / total
        done = np.abs(new - theta).max() < 1e-4
        theta = new
        if done:
            break
    return theta, float(counts @ (np.log(theta @ p) + top))


def identify(log_p: np.ndarray, buckets: np.ndarray, penalty: float = 3.0) -> tuple[np.ndarray, list[int]]:
    """Proportions of all languages and the chosen set, for one text's n-gram buckets.

    The set grows by the language whose mixture with it is likeliest, while the
    gain in log likelihood, per overlapping n-grams, exceeds ``penalty`` x log(n) / 2.
    """
    seen, counts = np.unique(buckets, return_counts=True)
    counts = counts / _OVERLAP
    own = log_p[:, seen]
    alone = own @ counts
    chosen = [int(np.argmax(alone))]
    theta, best = np.ones(1), float(alone[chosen[0]])
    price = penalty * np.log(counts.sum() + 2) / 2
    # The full mixture tells which languages can add anything.
    if len(log_p) > 1:
        every, _ = mixture(own, counts)
        order = [int(g) for g in np.argsort(-every, kind="stable") if int(g) != chosen[0] and every[g] > 0.01]
        for g in order:
            trial, value = mixture(own[[*chosen, g]], counts)
            if value - best <= price:
                continue
            chosen.append(g)
            theta, best = trial, value
    out = np.zeros(len(log_p))
    out[chosen] = theta
    return out, chosen


def predict(df: DataFrame, text: Column, langs: list[str], log_p: np.ndarray) -> DataFrame:
    """``df`` plus ``lang_pred``, ``score`` (its proportion) and ``lang_set``; ``und`` with score 0 without a letter or a model."""
    # At most MAX_LANGUAGES x BUCKETS half-precision-safe floats: 16 MB.
    shared = df.sparkSession.sparkContext.broadcast(log_p.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.astype(np.float64)
        for batch in batches:
            texts = _lowered(batch.column("__text"))
            letters = pc.match_substring_regex(texts, r"\p{L}").to_pylist()
            out: list[tuple] = [(UNKNOWN, 0.0, [])] * batch.num_rows
            for part in slices(texts):
                for k, row in enumerate(part.rows):
                    if letters[row] and langs:
                        grams = ngram_buckets(part.data[part.bounds[k] : part.bounds[k + 1]], model.shape[1])
                        theta, chosen = identify(model, grams)
                        top = max(chosen, key=lambda g: (theta[g], -g))
                        out[row] = langs[top], float(min(1.0, theta[top])), sorted(langs[g] for g in chosen)
            cols = [batch.column(i) for i in range(batch.num_columns - 1)]
            cols += [pa.array(c, t) for c, t in zip(zip(*out), kinds)] if out else [pa.array([], t) for t in kinds]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-1], "lang_pred", "score", "lang_set"])

    kinds = [pa.string(), pa.float64(), pa.list_(pa.string())]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.withColumn("__text", text).mapInArrow(run, f"{schema}, lang_pred string, score double, lang_set array<string>")
