"""Words and word shingles of a batch of texts, computed on whole byte buffers.

A batch of texts is one byte array and the offsets of its documents, as Arrow
hands it over. Words are found by two table lookups per byte, and each word gets
a 64-bit hash from prefix sums, so no Python object exists per word. All
functions take whole texts; a null text has no bytes.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20  # texts are handled in slices of about this size; a longer text is one slice

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_MASK = (1 << 64) - 1


def mix(values: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def mix_one(x: int) -> int:
    """``mix`` of one value below 2**64."""
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
    x = (x ^ x >> 27) * 0x94D049BB133111EB & 0xFFFFFFFFFFFFFFFF
    return x ^ x >> 31


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def free_name(df, name: str) -> str:
    """``name``, longer by underscores where the frame has a column of that name already."""
    taken = set(map(str.lower, df.columns))
    while name.lower() in taken:
        name += "_"
    return name


class Alphabet:
    """Which bytes belong to words; A-Z are lower-cased first unless ``fold`` is off, all bytes from 0x80 on belong to words."""

    def __init__(self, word_bytes: bytes, fold: bool = True):
        self.lower = np.arange(256, dtype=np.uint8)
        if fold:
            self.lower[ord("A"):ord("Z") + 1] += 32
        member = np.zeros(256, dtype=bool)
        member[list(word_bytes)] = True
        member[0x80:] = True
        self.inside = member[self.lower]
        self.values = _BYTE_VALUES[self.lower]


_PRINTED = bytes(b for b in range(0x80) if b != 0x20 and not 0x09 <= b <= 0x0D)
NOT_SPACE = Alphabet(_PRINTED)
UNCHANGED = Alphabet(_PRINTED, fold=False)
ALPHANUMERIC = Alphabet(b"0123456789abcdefghijklmnopqrstuvwxyz")


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, dtype=np.uint64)
    down = np.full(size, _BASE_INVERSE, dtype=np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


_slice_powers = _powers(1)


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Rising powers of the base and of its inverse, at least ``length`` + 1 of them.

    One table is kept, as long as the slices so far need it; a text longer than usual slices has a table of its own.
    """
    global _slice_powers
    if length > 2 * CHUNK_BYTES:
        return _powers(length + 1)
    if length >= len(_slice_powers[0]):
        _slice_powers = _powers((1 << length.bit_length()) + 1)
    return _slice_powers


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and document offsets of a string or binary array; nulls have no bytes."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(texts) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each slice has about ``limit`` bytes of text, and one row at least."""
    lengths = np.diff(text_buffer(batch.column(batch.schema.get_field_index(column)))[1])
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back()


def give_back() -> None:
    """Hand free memory back to the system: what Arrow and the C library keep for later adds up over the operators that share a worker."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def _c_trim():
    """``malloc_trim`` where the C library has it."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


_trim = _c_trim()


class Words:
    """Words of a batch: byte ``starts`` and ``ends``, ``hashes``, and ``bounds``, the first word of each document."""

    def __init__(self, texts: pa.Array, alphabet: Alphabet):
        self.alphabet = alphabet
        self.data, self.offsets = text_buffer(texts)
        size = len(self.data)
        inside = alphabet.inside[self.data]
        first, last = inside.copy(), inside.copy()
        if size:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            edges = self.offsets[:-1][self.offsets[:-1] < size]
            first[edges] |= inside[edges]
            edges = self.offsets[1:][self.offsets[1:] > 0] - 1
            last[edges] |= inside[edges]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        up, down = powers(size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(alphabet.values[self.data] * up[:size], out=sums[1:])
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * down[self.starts])
        self.bounds = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def window_hashes(self, length: int) -> np.ndarray:
        """Hash of the ``length`` words from each word on, across document ends; 0 words give an empty array."""
        total = len(self.hashes) - length + 1
        if total <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(total, length, dtype=np.uint64)
        for k in range(length):
            out += self.hashes[k:k + total] * np.uint64(pow(_BASE, 2 * k + 3, 1 << 64) | 1)
        return mix(out)

    def text(self, first: int, last: int) -> bytes:
        """Lower-cased bytes of the words first..last-1, joined by one blank."""
        return b" ".join(self.alphabet.lower[self.data[s:e]].tobytes()
                         for s, e in zip(self.starts[first:last], self.ends[first:last]))


def shingle_sets(words: Words, length: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each document.

    A document with fewer words than ``length``, but not none, has its whole
    sequence as its only shingle; one without words has none.
    """
    hashes = words.window_hashes(length)
    for first, last in zip(words.bounds[:-1], words.bounds[1:]):
        if last - first >= length:
            yield np.unique(hashes[first:last - length + 1])
        elif last > first:
            yield whole_hash(words.hashes[first:last])
        else:
            yield np.zeros(0, np.uint64)


def whole_hash(hashes: np.ndarray) -> np.ndarray:
    """One hash for a sequence of word hashes, the same as that of a window of its length."""
    total = len(hashes)
    for k, value in enumerate(hashes.tolist()):
        total += value * (pow(_BASE, 2 * k + 3, 1 << 64) | 1)
    return mix(np.array([total & _MASK], dtype=np.uint64))
