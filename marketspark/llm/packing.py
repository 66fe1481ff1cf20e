"""Pack documents into token sequences by bounded-space online best-fit.

Each scan partition keeps a fixed number of open sequences in a bitset keyed by
free space.  A piece goes where it leaves least room; when none fits and
all places are taken, the fullest sequence closes.  Nothing is shuffled and a task holds
one batch, so a lost task is simply read and packed again with the same result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

TOKENIZER = "byte_bpe_50k.json"
SEQUENCE = 2048
OPEN_BINS = 256
END_ID = 0
#: Marks that are cut off the end of a word; the rest of the word is mostly known without them.
TAIL = ".,!?;:#$%&*"

_CHUNK = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
_OTHER_SPACE = re.compile("[^\\S \\n]|\\u180e")
_LOADED: dict[str, "Encoder"] = {}
#: The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the others from 256 on in order.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: chr(b) for b in _PLAIN} | {b: chr(256 + i) for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}
_SPACE = _BYTE_CHARS[ord(" ")]


class Encoder(dict):
    """Token ids of texts as little-endian uint32 bytes, remembered by chunk.

    The pre-tokeniser of a byte-level BPE never joins a non-space to a space
    that follows, nor a letter to the marks of TAIL or to one newline before it, so the ids of a text are those of its chunks one
    after another.  A text with any space but blank and newline is encoded whole.
    A new chunk that is one Latin word goes to the tokenizer's model directly, past the pre-tokeniser that would leave it as it is
    and past the searches for other spaces and marks, of which it has none.
    A tokenizer of another kind encodes every text whole.
    The memory is two generations of at most ``limit`` chunks.
    """

    def __init__(self, path: str, limit: int = 700_000):
        from tokenizers import Tokenizer
        from tokenizers.models import BPE
        from tokenizers.pre_tokenizers import ByteLevel

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.model, before = self.tokenizer.model, self.tokenizer.pre_tokenizer
        self.by_chunk = (
            isinstance(self.model, BPE) and isinstance(before, ByteLevel) and before.use_regex and not before.add_prefix_space
            and self.tokenizer.normalizer is None
        )
        self.limit, self.older = limit, {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def latin(self, chunk: str) -> bytes | None:
        """Ids of a chunk that is one Latin word, None of any other."""
        spaced = chunk[0] == " "
        word = chunk[1:] if spaced else chunk
        if not word.isalpha():
            return None
        if word.isascii():
            letters = _SPACE + word if spaced else word
        elif max(word) < "\u0250":
            letters = chunk.encode().decode("latin-1").translate(_BYTE_CHARS)
        else:
            return None
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    @staticmethod
    def parts(chunk: str) -> tuple[str, str]:
        """A chunk without the marks of TAIL after its last letter, and these."""
        base = chunk.rstrip(TAIL)
        return (base, chunk[len(base) :]) if base and base[-1].isalpha() and base[-1] < "\u0250" else (chunk, "")

    def keep(self, chunk: str, found: bytes) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[chunk] = found

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = self.latin(chunk)
        if found is None:
            if _OTHER_SPACE.search(chunk):
                raise KeyError(chunk)
            base, tail = self.parts(chunk)
            if tail:
                found = self[base] + self[tail]
            elif chunk[0] == "\n" and chunk[1:2].isalpha() and chunk[1] < "\u0250":
                found = self["\n"] + self[chunk[1:]]
            else:
                found = self.whole(chunk)
        if len(chunk) <= 64:
            self.keep(chunk, found)
        return found

    def ids(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.by_chunk:
            return self.whole(text)
        try:
            return b"".join(map(self.__getitem__, _CHUNK.findall(text)))
        except KeyError:  # a chunk with another space, which is never remembered
            return self.whole(text)


def encoder(path: str | None = None) -> Encoder:
    """The encoder of this worker process for a tokenizer file, by default the public one."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


class BestFit:
    """Open sequences by free space; bit f of ``bits`` says that one with f free tokens is open."""

    def __init__(self, size: int, open_bins: int):
        self.size, self.open_bins = size, open_bins
        self.bits, self.opened, self.next_id = 0, 0, 0
        self.by_free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        found = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.opened -= 1
        return found

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) of a piece of ``length`` tokens."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            at = self._take(free)
        else:
            if self.opened >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)
            free, at = self.size, self.next_id
            self.next_id += 1
        left = free - length
        if left:
            self.by_free[left].append(at)
            self.bits |= 1 << left
            self.opened += 1
        return at, self.size - free


def pieces_of(length: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole sequences at its end, what is over before them."""
    first = length % size if length > size else length
    bounds = [0, *range(first or size, length + 1, size)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:])]


def pack(
    documents: DataFrame, tokenizer_path: str | None = None, size: int = SEQUENCE, open_bins: int = OPEN_BINS, end_id: int = END_ID,
) -> DataFrame:
    """One row for each piece of each row of ``documents`` (doc_id, text).

    Columns: doc_id, piece, start, length, ids (binary, little-endian uint32),
    sequence_id, offset.  A null or empty text is the end id alone.  Repeated
    rows and null ids are packed each by itself.  Within a batch the longest
    pieces are placed first.  ``sequence_id`` holds the partition in its upper half.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = encoder(tokenizer_path), BestFit(size, open_bins)
        base, end = TaskContext.get().partitionId() << 32, np.uint32(end_id).tobytes()
        for batch in batches:
            # Bounded parts of a batch, so that the ids in memory do not follow the batch size.
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                rows = []
                for k, text in enumerate(part.column("text").to_pylist()):
                    ids = encode.ids(text) + end
                    rows += [(k, p, a, n, ids[4 * a : 4 * (a + n)]) for p, (a, n) in enumerate(pieces_of(len(ids) // 4, size))]
                place: list = [None] * len(rows)
                for i in sorted(range(len(rows)), key=lambda i: (-rows[i][3], i)):
                    place[i] = packer.place(rows[i][3])
                row, piece, start, length, ids = zip(*rows)
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()), pa.array(ids, pa.binary()), pa.array([base + s for s, _ in place], pa.int64()),
                    pa.array([o for _, o in place], pa.int64()),
                ], names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, piece int, start long, length long, ids binary, sequence_id long, offset long")
