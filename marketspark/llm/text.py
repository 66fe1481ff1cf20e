"""Words of whole texts: the SQL pattern and array kernels for Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D, which is the
same on UTF-8 bytes as on code points.  The kernels work on slices of a batch
of about a megabyte, so their memory does not follow the batch size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"

_SLICE_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the hash base and of its inverse modulo 2**64."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, _SLICE_BYTES * 2)
        inverse = pow(int(_BASE), -1, 1 << 64)
        with np.errstate(over="ignore"):
            for name, base in (("up", _BASE), ("down", np.uint64(inverse))):
                out = np.full(n, base, np.uint64)
                out[0] = 1
                _POWERS[name] = np.cumprod(out)
    return _POWERS["up"], _POWERS["down"]


class Slice:
    """Some consecutive texts of a batch as one byte array.

    ``rows`` is their range in the batch, ``bounds`` their byte bounds.
    """

    def __init__(self, lo: int, hi: int, data: np.ndarray, bounds: np.ndarray):
        self.rows = range(lo, hi)
        self.data = data
        self.bounds = bounds

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and per text the index of its first one."""
        inside = ~_SEPARATOR[self.data]
        n = len(self.data)
        first = np.zeros(n + 1, bool)
        first[self.bounds] = True
        edge = np.ones(n + 1, bool)
        edge[1:n] = ~inside[:-1] | first[1:n]
        starts = np.flatnonzero(inside & edge[:n])
        edge[:n] = ~inside | first[:n]
        edge[n] = True
        ends = np.flatnonzero(inside & edge[1:]) + 1
        return starts, ends, np.searchsorted(starts, self.bounds)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
        """64-bit hash of each byte span; equal spans hash alike anywhere."""
        values = _BYTE_VALUE[_LOWER] if lower else _BYTE_VALUE
        n = len(self.data)
        up, down = _powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values[self.data] * up[:n], out=total[1:])
            return mix((total[ends] - total[starts]) * down[starts])


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = _SLICE_BYTES) -> Iterator[Slice]:
    """Cut a batch's texts (null: empty) into slices of about ``limit`` bytes; a longer text is one slice."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    n = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, n)
        yield Slice(lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
        lo = hi


def signed(x: np.ndarray) -> pa.Array:
    """uint64 hashes as Spark longs."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def n_words(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as remainder 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus, F.lit(0))
