"""Whole texts through a byte-level BPE of the tokenizers library, with a memory of pieces.

Byte-level BPE merges inside the pieces that its pattern cuts a text into, and a
piece alone is cut into itself. So the pieces of a slice are found with array
operations, each different piece is encoded by the library once, and the ids are
put together. Texts with characters whose class may differ between Unicode
versions, and texts with the string of an added token, go to the library whole.
Either way the ids are the library's for the whole text. ``special_text`` takes
the strings of special tokens as ordinary text; the library's default does not.
"""

from __future__ import annotations

import json
import os
import unicodedata
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import mix, powers, text_buffer

REMEMBERED = 400_000  # pieces kept; then the memory starts anew
OTHER, LETTER, NUMBER, SPACE, UNSURE = range(5)
# Blocks whose character classes do not change between Unicode versions, and white space.
STABLE = ((0x0, 0x370), (0x2010, 0x2028), (0x2030, 0x205F), (0x20A0, 0x20C0))
WHITE_SPACE = (*range(9, 14), 0x20, 0x85, 0xA0)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def character_classes() -> np.ndarray:
    classes = np.full(0x110000, UNSURE, dtype=np.uint8)
    for first, last in STABLE:
        for code in range(first, last):
            kind = unicodedata.category(chr(code))[0]
            classes[code] = {"L": LETTER, "N": NUMBER}.get(kind, OTHER)
    classes[list(WHITE_SPACE)] = SPACE
    return classes


class ByteBpe:
    def __init__(self, path: str, special_text: bool = True):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs as many tasks as there are cores
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = special_text
        with open(path, encoding="utf-8") as file:
            about = json.load(file)
        self.added = [t["content"] for t in about.get("added_tokens") or [] if not (special_text and t["special"])]
        step = about["pre_tokenizer"] or {}
        plain = (step.get("type") == "ByteLevel" and not step.get("add_prefix_space") and step.get("use_regex", True)
                 and about["normalizer"] is None and about["model"]["type"] == "BPE")
        self.size, self.classes = self.library.get_vocab_size(), character_classes() if plain else None
        self._forget()

    @classmethod
    @lru_cache(maxsize=2)
    def load(cls, path: str, special_text: bool = True) -> ByteBpe:
        return cls(path, special_text)

    def _forget(self) -> None:
        # Hashes of the known pieces in order, with the place of each one's ids in the pool.
        self.keys = np.zeros(0, np.uint64)
        self.begins, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch and the number of ids of each text, the end id included."""
        data, offsets = text_buffer(texts)
        codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
        ends = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
        kinds = self.classes[codes] if self.classes is not None else np.full(len(codes), UNSURE, np.uint8)
        unsure = np.concatenate([[0], np.cumsum(kinds == UNSURE)])
        alone = unsure[ends[1:]] > unsure[ends[:-1]]
        for content in self.added:
            alone |= pc.match_substring(texts, content).fill_null(False).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(alone)
        parts, counts = self._by_piece(codes, kinds, ends, whole)
        if len(whole):
            found = self.library.encode_batch_fast([texts[int(k)].as_py() for k in whole], add_special_tokens=False)
            bounds = np.concatenate([[0], np.cumsum(counts)])
            rows = [parts[bounds[k]:bounds[k + 1]] for k in range(len(counts))]
            for k, one in zip(whole.tolist(), found):
                rows[k] = np.array(one.ids, dtype=np.uint32)
            counts, parts = np.array([len(r) for r in rows], dtype=np.int64), np.concatenate(rows)
        if end_id is None:
            return parts, counts
        out = np.full(len(parts) + len(counts), end_id, dtype=np.uint32)
        out[np.arange(len(parts)) + np.repeat(np.arange(len(counts)), counts)] = parts
        return out, counts + 1

    def _by_piece(self, codes, kinds, ends, whole) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts but ``whole``, and their number in each text."""
        skip = np.zeros(len(ends), dtype=bool)
        skip[whole] = True
        starts = piece_starts(codes, kinds, ends)
        stops = np.append(starts[1:], len(codes))
        owner = np.searchsorted(ends, starts, side="right") - 1
        taken = ~skip[owner]
        starts, stops, owner = starts[taken], stops[taken], owner[taken]
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(ends) - 1, np.int64)
        keys = piece_hashes(codes, starts, stops)
        known, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        begins, sizes = self._places(known, codes, starts[first], stops[first])
        counts = sizes[inverse]
        total = np.cumsum(counts)
        source = np.repeat(begins[inverse] - (total - counts), counts) + np.arange(total[-1])
        return self.pool[source], np.bincount(owner, weights=counts, minlength=len(ends) - 1).astype(np.int64)

    def _places(self, known: np.ndarray, codes, starts, stops) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of each piece begin in the pool, and how many there are; ``known`` are hashes in order."""
        if len(self.keys) > REMEMBERED:
            self._forget()
        at = np.searchsorted(self.keys, known)
        new = np.ones(len(known), dtype=bool)
        inside = at < len(self.keys)
        new[inside] = self.keys[at[inside]] != known[inside]
        if new.any():
            text = codes.tobytes().decode("utf-32-le")
            strings = [text[a:b] for a, b in zip(starts[new].tolist(), stops[new].tolist())]
            found = [e.ids for e in self.library.encode_batch_fast(strings, add_special_tokens=False)]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            total = int(sizes.sum())
            while self.used + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
            self.pool[self.used:self.used + total] = np.fromiter(chain.from_iterable(found), np.uint32, total)
            begins = self.used + np.cumsum(sizes) - sizes
            self.used += total
            self.keys = np.insert(self.keys, at[new], known[new])
            self.begins, self.sizes = np.insert(self.begins, at[new], begins), np.insert(self.sizes, at[new], sizes)
            at = np.searchsorted(self.keys, known)
        return self.begins[at], self.sizes[at]


def piece_starts(codes: np.ndarray, kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where the pieces of the pattern start.

    Runs of letters, numbers and other characters are pieces, with one blank before
    them; white space before a piece gives its last character away or stands alone;
    an apostrophe at the start of a piece takes a contraction's letters from the next run.
    """
    total = len(codes)
    opens = np.zeros(total + 1, dtype=bool)
    opens[1:total] = kinds[1:] != kinds[:-1]
    opens[ends] = True
    edge = np.zeros(total + 1, dtype=bool)
    edge[ends] = True
    # The last character of white space before something else starts a piece; a blank is joined to what follows.
    last = np.flatnonzero((kinds == SPACE) & opens[1:] & ~edge[1:])
    opens[last] = True
    blank = last[codes[last] == 0x20]
    opens[blank + 1] = False
    quotes = np.flatnonzero((codes == 0x27) & opens[:total])
    quotes = quotes[(quotes + 1 < total)]
    quotes = quotes[(kinds[quotes + 1] == LETTER) & ~edge[quotes + 1]]
    for at in quotes.tolist():
        for letters in CONTRACTIONS:
            stop = at + 1 + len(letters)
            if stop <= total and not edge[at + 1:stop].any() and "".join(map(chr, codes[at + 1:stop].tolist())) == letters:
                opens[at + 1] = False
                opens[stop] = True
                break
    return np.flatnonzero(opens[:total])


def piece_hashes(codes: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    up, down = powers(len(codes))
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes.astype(np.uint64) + np.uint64(1)) * up[:len(codes)], out=sums[1:])
    return mix((sums[stops] - sums[starts]) * down[starts])
