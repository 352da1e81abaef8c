"""Encoding with a SentencePiece BPE vocabulary under seeded merge dropout, and decoding.

Encoding is agenda processing: of all neighbouring symbols whose concatenation is
a piece, the pair with the best score is merged first, the leftmost among equals,
until no candidate is left. Each candidate, given by the spans of its two
symbols, is skipped for good when a hash keyed by seed and document falls below
the dropout rate, so the same seed gives the same pieces wherever the text is
processed, and another seed gives other pieces of the same text. Without dropout
the ids are those of the library.

No piece goes on behind a word with a blank, so agendas of different words never
meet: all words of a slice are processed side by side, one merge of each per
round. Words of more than ``LONG`` symbols have a heap of their own, which takes
n log n steps.

Decoding gives every byte back: blanks are the marker, characters without a piece
are byte pieces, and so is a marker character that the text itself contains.
A null text has null ids and an empty text has none; both decode to themselves.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import free_name, mix, mix_one, slices, text_buffer

MARKER = "▁"
DROPOUT = 0.1
LONG = 256
SLICE_BYTES = 1 << 17  # a merge takes some 200 bytes a character
_NONE = np.int64(1) << 62
_ALL = (1 << 64) - 1
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


class Vocabulary:
    """Pieces of a model file, their ranks (0 is merged first), and which two make which."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        model = SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        byte = [model.is_byte(i) for i in range(size)]
        normal = {p: i for i, p in enumerate(pieces) if not special[i] and not byte[i]}
        if any(MARKER in p.lstrip(MARKER) for p in normal):
            raise ValueError("a piece goes on behind a blank; words of this vocabulary are not independent")
        self.bytes = np.full(256, -1, dtype=np.int64)
        for i in np.flatnonzero(byte):
            self.bytes[int(pieces[i][3:5], 16)] = i
        if (self.bytes < 0).any():
            raise ValueError("the vocabulary has no byte pieces; unknown characters would be lost")
        scores = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        self.characters = np.full(0x110000, -1, dtype=np.int32)
        for p, i in normal.items():
            if len(p) == 1 and p != MARKER:
                self.characters[ord(p)] = i
        self.characters[ord(" ")] = normal[MARKER]
        self.marker = normal[MARKER]
        self._pairs({(normal[p[:k]], normal[p[k:]]): i for p, i in normal.items() for k in range(1, len(p))
                     if p[:k] in normal and p[k:] in normal})
        contents = [b"" if special[i] else bytes([int(p[3:5], 16)]) if byte[i] else p.replace(MARKER, " ").encode()
                    for i, p in enumerate(pieces)]
        self.lengths = np.array([len(c) for c in contents], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.content = np.frombuffer(b"".join(contents), dtype=np.uint8)

    def _pairs(self, pairs: dict[tuple[int, int], int]) -> None:
        self.candidates = {left << 20 | right: int(self.rank[merged]) << 20 | merged for (left, right), merged in pairs.items()}
        bits = max(4, (8 * len(pairs)).bit_length())
        self.mask, self.shift = (1 << bits) - 1, np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, dtype=np.int64)
        self.values = np.full(1 << bits, -1, dtype=np.int32)
        for (left, right), merged in pairs.items():
            key = left << 32 | right
            slot = (key * int(_A) & (1 << 64) - 1) >> int(self.shift)
            while self.keys[slot] >= 0:
                slot = (slot + 1) & self.mask
            self.keys[slot], self.values[slot] = key, merged

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece made of each pair, -1 if there is none."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64) & 0xFFFFFFFF
        slots = (keys.view(np.uint64) * _A >> self.shift).astype(np.int64)
        out = np.where(self.keys[slots] == keys, self.values[slots], -1)
        open_ = np.flatnonzero((self.keys[slots] != keys) & (self.keys[slots] >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            found = self.keys[slots[open_]]
            hit = found == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (found >= 0)]
        return out


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Dropout:
    """Which candidates are skipped; ``base`` has a hash for each document."""

    def __init__(self, rate: float, seed: int, keys: np.ndarray):
        self.limit = np.uint64(min(int(rate * 2.0 ** 64), (1 << 64) - 1))
        self.base = mix(mix(keys.astype(np.int64).view(np.uint64) + _C) + np.uint64(seed * int(_B) & (1 << 64) - 1))

    def skipped(self, doc, start, middle, end) -> np.ndarray:
        """Of candidates with symbols start..middle and middle..end, counted from their document's start."""
        if not self.limit:
            return np.zeros(len(start), dtype=bool)
        start, middle, end = (x.astype(np.uint64) for x in (start, middle, end))
        return mix(self.base[doc] + start * _A + middle * _B + end * _C) < self.limit

    def skipped_one(self, doc: int) -> Callable[[int, int, int], bool]:
        """The same of one candidate at a time in whole numbers, which costs less than arrays of one value."""
        base, limit, a, b, c = int(self.base[doc]), int(self.limit), int(_A), int(_B), int(_C)
        return lambda start, middle, end: limit > 0 and mix_one(base + start * a + middle * b + end * c & _ALL) < limit


def encode_texts(texts: pa.Array, vocab: Vocabulary, rate: float = 0.0, seed: int = 0,
                 keys: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch and the offsets of its texts."""
    data, offsets = text_buffer(texts)
    lead = (data & 0xC0) != 0x80
    ends = np.concatenate([[0], np.cumsum(lead)])[offsets]
    codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    lengths = np.diff(ends)
    shift = np.cumsum(lengths > 0)  # a blank goes before each text that is not empty
    doc = np.repeat(np.arange(len(lengths)), lengths + (lengths > 0))
    first = np.concatenate([[0], np.cumsum(lengths + (lengths > 0))])
    line = np.full(first[-1], ord(" "), dtype=np.int64)
    line[np.arange(len(codes)) + np.repeat(shift, lengths)] = codes
    symbols = vocab.characters[line].astype(np.int64)
    drop = Dropout(rate, seed, np.zeros(len(lengths), np.int64) if keys is None else keys)
    final = _merge_all(symbols, doc, first, vocab, drop)
    at = np.flatnonzero(final != -2)
    unknown = final[at] < 0
    sizes = np.ones(len(at), dtype=np.int64)
    if unknown.any():
        strange = line[at[unknown]]
        known, inverse = np.unique(strange, return_inverse=True)
        spelled = [vocab.bytes[list(chr(c).encode("utf-8"))] for c in known.tolist()]
        sizes[unknown] = np.array([len(s) for s in spelled])[inverse]
        ids = np.repeat(final[at], sizes)
        ids[ids < 0] = np.concatenate([spelled[k] for k in inverse.tolist()])
    else:
        ids = final[at]
    counts = np.concatenate([[0], np.cumsum(sizes)])
    return ids, counts[np.searchsorted(at, first)]


def _merge_all(symbols: np.ndarray, doc: np.ndarray, first: np.ndarray, vocab: Vocabulary, drop: Dropout) -> np.ndarray:
    """Final piece at each place where one starts (-1 for an unknown character), -2 elsewhere."""
    total = len(symbols)
    final = np.full(total, -2, dtype=np.int64)
    if not total:
        return final
    blank = symbols == vocab.marker
    opens = np.zeros(total, dtype=bool)
    opens[1:] = blank[1:] & ~blank[:-1]
    opens[first[:-1][first[:-1] < total]] = True
    starts = np.flatnonzero(opens)
    sizes = np.diff(np.append(starts, total))
    for at, size in zip(starts[sizes > LONG].tolist(), sizes[sizes > LONG].tolist()):
        _merge_long(symbols, at, size, int(doc[at]), int(first[doc[at]]), vocab, drop, final)

    keep = np.repeat(sizes <= LONG, sizes)
    place = np.flatnonzero(keep)
    piece, unit = symbols[keep], np.repeat(np.cumsum(sizes <= LONG) - 1, sizes)[keep]
    ends = place + 1
    # ``best`` of a symbol is rank and piece of the candidate that it forms with its right neighbour.
    best = np.full(len(piece), _NONE)

    def rate(left: np.ndarray) -> None:
        """Look up the candidates that begin at these symbols."""
        left = left[(left >= 0) & (left + 1 < len(piece))]
        left = left[unit[left] == unit[left + 1]]
        made = vocab.merged(piece[left], piece[left + 1])
        left, made = left[made >= 0], made[made >= 0].astype(np.int64)
        home = doc[place[left]]
        origin = first[home]
        lost = drop.skipped(home, place[left] - origin, place[left + 1] - origin, ends[left + 1] - origin)
        left, made = left[~lost], made[~lost]
        best[left] = vocab.rank[made] << 20 | made

    rate(np.arange(len(piece)))
    while len(piece):
        heads = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
        lowest = np.minimum.reduceat(best, heads)
        spans = np.diff(np.append(heads, len(piece)))
        active = np.repeat(lowest < _NONE, spans)
        final[place[~active]] = piece[~active]
        if not active.any():
            break
        wanted = np.repeat(lowest, spans)
        hits = np.flatnonzero((best == wanted) & active)
        hits = hits[np.concatenate([[True], unit[hits[1:]] != unit[hits[:-1]]])]  # the leftmost of each word
        piece[hits] = best[hits] & ((1 << 20) - 1)
        ends[hits] = ends[hits + 1]
        active[hits + 1] = False
        # Candidates that touched the merged symbols are gone; their successors are looked up.
        best[hits] = _NONE
        before = hits[hits > 0] - 1
        before = before[unit[before] == unit[before + 1]]
        best[before] = _NONE
        moved = np.cumsum(active) - 1
        touched = moved[hits]
        place, piece, unit, ends, best = (x[active] for x in (place, piece, unit, ends, best))
        rate(np.concatenate([touched, touched - 1]))
    return final


def _merge_long(symbols, at: int, size: int, doc: int, origin: int, vocab: Vocabulary, drop: Dropout, final) -> None:
    """Agenda of one long word on a heap of whole numbers: rank, piece and place of a candidate, in this order.

    ``best`` of a symbol is the candidate that it forms with its right neighbour; entries
    of the heap that are not the best of their symbol any more are passed over.
    """
    offset, made_of, skipped = at - origin, vocab.candidates, drop.skipped_one(doc)
    word = symbols[at:at + size]
    made = vocab.merged(word[:-1], word[1:]).astype(np.int64)
    left = np.flatnonzero(made >= 0)
    left = left[~drop.skipped(np.full(len(left), doc), left + offset, left + offset + 1, left + offset + 2)]
    heap = [m << 32 | k for m, k in zip((vocab.rank[made[left]] << 20 | made[left]).tolist(), left.tolist())]
    best = [-1] * size
    for key, k in zip(heap, left.tolist()):
        best[k] = key
    heapq.heapify(heap)

    piece, after, before = word.tolist(), list(range(1, size + 1)), list(range(-1, size - 1))
    while heap:
        key = heapq.heappop(heap)
        left = key & 0xFFFFFFFF
        if best[left] != key:
            continue
        right = after[left]
        piece[left], piece[right], best[right] = key >> 32 & 0xFFFFF, None, -1
        after[left] = right = after[right]
        if right < size:
            before[right] = left
        for k in (left, before[left]):
            if k < 0:
                continue
            best[k], middle = -1, after[k]
            if middle < size:
                candidate = made_of.get(piece[k] << 20 | piece[middle]) if piece[k] >= 0 <= piece[middle] else None
                if candidate is not None and not skipped(offset + k, offset + middle, offset + after[middle]):
                    best[k] = candidate << 32 | k
                    heapq.heappush(heap, best[k])
    kept = [k for k, p in enumerate(piece) if p is not None]
    final[at + np.array(kept)] = [piece[k] for k in kept]


def decode_ids(ids: np.ndarray, offsets: np.ndarray, vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch of id sequences and the offsets of its texts."""
    sizes = vocab.lengths[ids]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    source = np.repeat(vocab.starts[ids] - ends[:-1], sizes) + np.arange(ends[-1])
    content, bounds = vocab.content[source], ends[offsets]
    lead = np.ones(len(content), dtype=bool)
    lead[bounds[:-1][np.diff(bounds) > 0]] = False  # the blank before each text
    return content[lead], bounds - np.concatenate([[0], np.cumsum(np.diff(bounds) > 0)])


def encode(docs: DataFrame, model_path: str, rate: float = DROPOUT, seed: int = 0, text_col: str = "text",
           id_col: str = "doc_id", ids_col: str = "token_ids", lossless_col: str | None = None) -> DataFrame:
    """All rows and columns and a column of ids (existing ones of the new names are replaced); no shuffle.

    With ``lossless_col`` the ids are decoded in the same pass, and the column says
    whether they give every byte back.
    """
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias(free_name(docs, "__key"))
    new = [ids_col, *([lossless_col] if lossless_col else [])]
    rows = docs.drop(*new).select("*", key)
    schema = T.StructType([*docs.drop(*new).schema, T.StructField(ids_col, T.ArrayType(T.IntegerType())),
                           *([T.StructField(lossless_col, T.BooleanType())] if lossless_col else [])])
    at = rows.schema.names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for batch in batches:
            for part in slices(batch, text_col, SLICE_BYTES):
                keys = part.column(part.num_columns - 1).to_numpy()
                ids, offsets = encode_texts(part.column(at), vocab, rate, seed, keys)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()),
                                                 mask=part.column(at).is_null())
                same = [pa.array(gives_back(part.column(at), ids, offsets, vocab))] if lossless_col else []
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, *same], names=schema.names)

    return rows.mapInArrow(run, schema)


def gives_back(texts: pa.Array, ids: np.ndarray, offsets: np.ndarray, vocab: Vocabulary) -> np.ndarray:
    """Whether the ids of each text decode to its bytes."""
    data, wanted = text_buffer(texts)
    content, bounds = decode_ids(ids, offsets, vocab)
    if len(content) == len(data) and (bounds == wanted).all():
        wrong = np.concatenate([[0], np.cumsum(content != data)])
        return wrong[wanted[1:]] == wrong[wanted[:-1]]
    return np.array([np.array_equal(content[a:b], data[c:d])
                     for a, b, c, d in zip(bounds[:-1], bounds[1:], wanted[:-1], wanted[1:])])


def decode(tokens: DataFrame, model_path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """All rows and columns and a column of texts (an existing one of that name is replaced); no shuffle."""
    rows = tokens.drop(text_col)
    schema = T.StructType([*rows.schema, T.StructField(text_col, T.BinaryType())])
    at = rows.schema.names.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model_path)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                lists = part.column(at)
                sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                content, bounds = decode_ids(ids, np.concatenate([[0], np.cumsum(sizes)]), vocab)
                texts = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(bounds.astype(np.int64)),
                                                                              pa.py_buffer(content)]).cast(pa.binary())
                texts = pa.compute.if_else(lists.is_null(), pa.scalar(None, pa.binary()), texts)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], names=schema.names)

    out = rows.mapInArrow(run, schema)
    return out.withColumn(text_col, F.col(text_col).cast("string"))
