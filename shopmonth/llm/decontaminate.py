"""Benchmark decontamination: find word windows of test items inside documents.

The windows of all test items, normalised to lower-cased words, form a hash set
that is broadcast; every document is scanned once, window by window, and each
match of hashes is checked against the words themselves. Nothing is shuffled.

Test sets are small beside a corpus, but the size is measured: items beyond
``max_broadcast_bytes`` of text are dealt to several indexes, and the documents
are scanned once for each, so no task ever holds more than one index.

Defined results: a null or wordless text has no words and no hits; an item with
no words has no windows, one with fewer than ``window`` words is one window;
items without an id are left out; rows with the same item id are one item, and
repeated documents are judged one by one. An empty benchmark marks nothing.
Columns of the documents beside the two that are named are never looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.workdir import stage
from .words import ALPHANUMERIC, Words, free_name, slices

WINDOW = 13
MAX_BROADCAST_BYTES = 32 << 20

HITS = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType()),
        T.StructField("first_byte", T.LongType()), T.StructField("end_byte", T.LongType())]))),
])


class Hits(NamedTuple):
    """What one scan finds: word counts, hit flags per word, and item names per document."""

    words: Words
    flags: np.ndarray
    items: list[set[str]]

    def hit_counts(self) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(self.flags)])
        return sums[self.words.bounds[1:]] - sums[self.words.bounds[:-1]]


class _Windows(NamedTuple):
    """Windows of one length, sorted by hash: where their words are in the index's bytes, and which item has them."""

    hashes: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    owners: np.ndarray
    table: np.ndarray

    def near(self, hashes: np.ndarray) -> np.ndarray:
        """Positions of ``hashes`` that the table lets through and that are among the windows'."""
        at = np.flatnonzero(self.table[hashes & np.uint64(len(self.table) - 1)])
        found = np.minimum(np.searchsorted(self.hashes, hashes[at]), len(self.hashes) - 1)
        return at[self.hashes[found] == hashes[at]]


class WindowIndex:
    """Hash set of the items' windows, by window length, with their words and item ids.

    It is made of flat arrays, about 24 bytes a window beside the words themselves and
    at most 16 for the table that turns most other hashes away.
    """

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.names = [name for name, _ in items]
        parts, texts, used, first = {}, [], 0, 0
        batch = pa.RecordBatch.from_arrays([pa.array([text for _, text in items], pa.large_string())], names=["text"])
        for part in slices(batch, "text"):
            words = Words(part.column(0), ALPHANUMERIC)
            sizes = words.ends - words.starts
            ends = np.cumsum(sizes + 1) - 1
            starts = ends - sizes
            line = np.full(len(words.hashes) + int(sizes.sum()), ord(" "), dtype=np.uint8)
            line[np.arange(int(sizes.sum())) + np.repeat(np.arange(len(sizes)), sizes)] = words.alphabet.lower[
                words.data[words.alphabet.inside[words.data]]]
            owners = np.repeat(np.arange(part.num_rows), words.counts)
            lengths = np.minimum(words.counts, window)[owners]
            for length in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == length)
                at = at[at + length <= words.bounds[owners[at] + 1]]
                parts.setdefault(length, []).append((words.window_hashes(length)[at], starts[at] + used,
                                                     (ends[at + length - 1] - starts[at]).astype(np.int32),
                                                     (owners[at] + first).astype(np.int32)))
            texts.append(line.tobytes())
            used, first = used + len(line), first + part.num_rows
        self.text = b"".join(texts)
        self.windows = {length: self._sorted(parts.pop(length)) for length in list(parts)}

    @staticmethod
    def _sorted(parts: list[tuple]) -> _Windows:
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(columns[0], kind="stable")
        hashes, starts, sizes, owners = (c[order] for c in columns)
        table = np.zeros(1 << max(12, (8 * len(hashes)).bit_length()), dtype=bool)
        table[hashes & np.uint64(len(table) - 1)] = True
        return _Windows(hashes, starts, sizes, owners, table)

    def _named(self, windows: _Windows, value: np.uint64) -> dict[bytes, set[str]]:
        """Words of all windows with this hash, and the items that have them."""
        named: dict[bytes, set[str]] = {}
        span = slice(*(int(np.searchsorted(windows.hashes, value, side)) for side in ("left", "right")))
        for start, size, owner in zip(*(c[span].tolist() for c in (windows.starts, windows.sizes, windows.owners))):
            named.setdefault(self.text[start:start + size], set()).add(self.names[owner])
        return named

    def scan(self, texts: pa.Array) -> Hits:
        words = Words(texts, ALPHANUMERIC)
        change = np.zeros(len(words.hashes) + 1, dtype=np.int64)
        items: list[set[str]] = [set() for _ in range(len(texts))]
        for length, windows in self.windows.items():
            hashes = words.window_hashes(length)
            near = windows.near(hashes)
            owners = np.searchsorted(words.bounds, near, side="right") - 1
            inside = near + length <= words.bounds[owners + 1]
            named: dict[np.uint64, dict[bytes, set[str]]] = {}
            for start, owner in zip(near[inside].tolist(), owners[inside].tolist()):
                value = hashes[start]
                if value not in named:
                    named[value] = self._named(windows, value)
                names = named[value].get(words.text(start, start + length))
                if names:
                    change[start] += 1
                    change[start + length] -= 1
                    items[owner] |= names
        return Hits(words, np.cumsum(change[:-1]) > 0, items)


def indexes(benchmark: DataFrame, window: int = WINDOW, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
            item_col: str = "item_id", text_col: str = "text") -> Iterator:
    """Broadcast window indexes that together hold every item; one, unless the items are too large."""
    spark = benchmark.sparkSession
    items = (benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
             .where("item IS NOT NULL AND text IS NOT NULL"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(1, math.ceil(size / max_broadcast_bytes))
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(shards)) == shard) if shards > 1 else items
        rows = [(r.item, r.text) for r in part.collect()]
        yield spark.sparkContext.broadcast(WindowIndex(rows, window))


def scan_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                   text_col: str = "text", max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                   hit_col: str = "hits") -> DataFrame:
    """All rows and columns of ``docs`` and one struct column: words, hit words, items found, hit spans.

    ``spans`` are the longest runs of hit words, as word numbers and as byte
    offsets of the UTF-8 text.
    """
    if hit_col in docs.columns:
        raise ValueError(f"the documents have a column {hit_col} already; name another hit_col")
    out = None
    for index in indexes(benchmark, window, max_broadcast_bytes):
        # A further index takes a pass of its own over what the last one wrote.
        out = _scan(docs if out is None else stage(out, "scanned"), index, text_col, hit_col)
    return out


def _scan(docs: DataFrame, index, text_col: str, hit_col: str) -> DataFrame:
    merge = hit_col in docs.columns
    schema = docs.schema if merge else T.StructType([*docs.schema.fields, T.StructField(hit_col, HITS)])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text_col):
                hits = index.value.scan(part.column(part.schema.get_field_index(text_col)))
                if merge:
                    hits = _merged(hits, part.column(part.schema.get_field_index(hit_col)))
                columns = part.columns[:-1] if merge else part.columns
                yield pa.RecordBatch.from_arrays([*columns, _hit_array(hits)], names=[f.name for f in schema.fields])

    return docs.mapInArrow(scan, schema)


def _merged(hits: Hits, before: pa.Array) -> Hits:
    flags = hits.flags.copy()
    for at, found in enumerate(before.to_pylist()):
        base = hits.words.bounds[at]
        for span in found["spans"]:
            flags[base + span["first_word"]:base + span["end_word"]] = True
        hits.items[at].update(found["items"])
    return Hits(hits.words, flags, hits.items)


def _hit_array(hits: Hits) -> pa.Array:
    words, flags = hits.words, hits.flags
    bounds, counts = words.bounds, hits.hit_counts()
    spans: list[list[dict]] = []
    for at, (first, last) in enumerate(zip(bounds[:-1], bounds[1:])):
        if not counts[at]:
            spans.append([])
            continue
        edges = np.diff(np.concatenate([[0], flags[first:last].astype(np.int8), [0]]))
        base = words.offsets[at]
        spans.append([{"first_word": int(a), "end_word": int(b),
                       "first_byte": int(words.starts[first + a] - base),
                       "end_byte": int(words.ends[first + b - 1] - base)}
                      for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1))])
    span_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("first_word", "end_word", "first_byte", "end_byte")]))
    return pa.StructArray.from_arrays(
        [pa.array(words.counts, pa.int64()), pa.array(counts, pa.int64()),
         pa.array([sorted(s) for s in hits.items], pa.list_(pa.string())), pa.array(spans, span_type)],
        names=["n_words", "n_hit", "items", "spans"])


def is_contaminated(hit_col: str = "hits", share: int = 20):
    """At least one word in ``share`` lies in an occurrence of a test window."""
    hits = F.col(hit_col)
    return (hits["n_hit"] > 0) & (share * hits["n_hit"] >= hits["n_words"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **options) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    hits = free_name(docs, "__hits")
    scanned = scan_documents(docs, benchmark, window, hit_col=hits, **options)
    return scanned.where(~is_contaminated(hits)).drop(hits)


def cut_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
              **options) -> DataFrame:
    """All documents, without the bytes of their hit spans; texts without hits stay as they are."""
    hits = free_name(docs, "__hits")
    scanned = scan_documents(docs, benchmark, window, text_col, hit_col=hits, **options)
    source, spans = F.encode(F.col(text_col), "UTF-8"), F.col(hits)["spans"]
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda s: s["end_byte"]))
    ends = F.concat(F.transform(spans, lambda s: s["first_byte"]), F.array(F.octet_length(text_col).cast("long")))
    kept = F.transform(F.arrays_zip(starts.alias("a"), ends.alias("b")), lambda p: F.decode(
        F.substring(source, (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int")), "UTF-8"))
    text = F.when(F.size(spans) > 0, F.array_join(kept, "")).otherwise(F.col(text_col))
    return scanned.withColumn(text_col, text).drop(hits)
