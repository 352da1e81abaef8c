"""Substring dedup: remove passages that documents with smaller ids hold already.

A passage is a window of 13 words or a run of such windows. Windows are found with
suffix automata of reference shards, over which the passages of documents are streamed:

1. Each window has an anchor, the least hash of its 5-word parts, so equal windows have
   equal anchors. Neighbouring windows with one anchor form a span. Anchors are counted
   over all documents by a shuffle, and only spans whose anchor lies in several
   documents go on.
2. Spans with the same anchor go to the same shard. Equal spans of a slice of documents
   travel as one row, and are one reference passage in the shard. An anchor in more than
   ``HOT`` documents is dealt out by window instead.
3. A shard's automaton holds its spans with the smallest document of every substring.
   Its spans are streamed over it, and matching statistics give the first document of
   each of their windows.
4. First documents are joined back by span. Each document then removes the words of
   windows that start in a smaller one.

Copies of a whole text are told by their digest and never enter a shard. Nothing is
collected. Texts meet their marks and their hits by plain joins on the id, packed for the
way. Spans are named by 128 bits of content.

Defined results: a null text has no words; texts of fewer than 13 words keep them all;
documents without an id keep all words and take none from others; rows with one id are
documents side by side that take nothing from each other. Ids are read as longs. An
empty table gives no rows. Columns that are not named are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.joins import join_facts
from ..sources.workdir import stage, work_folder
from .automaton import SuffixAutomaton
from .words import CHUNK_BYTES, UNCHANGED, Words, mix, powers, slices

WINDOW = 13
GRAM = 5
HOT = 256
SHARD_WORDS = 30_000


class Spans(NamedTuple):
    """Runs of windows with one anchor: first window, number of windows, anchor, document, and the anchor's rank in the document."""

    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    owner: np.ndarray
    group: np.ndarray  # number of the (document, anchor) pair, ascending by document
    first_group: np.ndarray  # of each document


def spans_of(words: Words, window: int = WINDOW, gram: int = GRAM) -> Spans:
    none = np.zeros(0, np.int64)
    documents = len(words.bounds) - 1
    grams = words.window_hashes(gram)
    total = len(words.hashes) - window + 1
    if total <= 0:
        return Spans(none, none, none.astype(np.uint64), none, none, np.zeros(documents, np.int64))
    anchor = grams[:total].copy()
    for k in range(1, window - gram + 1):
        np.minimum(anchor, grams[k:k + total], out=anchor)
    owner = np.repeat(np.arange(documents), words.counts)[:total]
    valid = np.arange(total) + window <= words.bounds[owner + 1]
    opens = valid.copy()
    opens[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
    start = np.flatnonzero(opens)
    closes = np.append(valid[1:] & (anchor[1:] == anchor[:-1]), False)
    stop = np.flatnonzero(valid & ~closes)
    anchor, owner = anchor[start], owner[start]
    order = np.lexsort((anchor, owner))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = (anchor[order][1:] != anchor[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    group = np.empty(len(order), dtype=np.int64)
    group[order] = np.cumsum(fresh) - 1
    first_group = np.searchsorted(owner[order][fresh], np.arange(documents))
    return Spans(start, stop - start + 1, anchor, owner, group, first_group)


class Names:
    """128 bits for any run of words of a batch."""

    def __init__(self, words: Words):
        up, self.down = powers(len(words.hashes))
        self.sums = []
        for salt in (0x51ED270B35A1E3B5, 0xA24BAED4963EE407):
            sums = np.zeros(len(words.hashes) + 1, dtype=np.uint64)
            np.cumsum(mix(words.hashes + np.uint64(salt)) * up[:len(words.hashes)], out=sums[1:])
            self.sums.append(sums)

    def of(self, first: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Names of the words first..last-1."""
        halves = [mix(((sums[last] - sums[first]) * self.down[first]) ^ mix((last - first).astype(np.uint64))) for sums in self.sums]
        data = np.stack(halves, axis=1).tobytes()
        return [data[k:k + 16] for k in range(0, len(data), 16)]


def joined_words(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """All words of a batch with one blank behind each, and where each word starts."""
    sizes = words.ends - words.starts
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    out = np.full(begins[-1], 0x20, dtype=np.uint8)
    shift = np.repeat(np.arange(len(sizes)), sizes)
    out[np.arange(len(shift)) + shift] = words.data[words.alphabet.inside[words.data]]
    return out, begins


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _anchors(units: DataFrame) -> DataFrame:
    """``anchor, id, rank`` of each anchor of each document."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                spans = spans_of(Words(_column(part, "text"), UNCHANGED))
                if not len(spans.group):
                    continue
                _, at = np.unique(spans.group, return_index=True)
                owner = spans.owner[at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(spans.anchor[at].view(np.int64)), _column(part, "id").take(pa.array(owner)),
                     pa.array((spans.group[at] - spans.first_group[owner]).astype(np.int32))], names=["anchor", "id", "rank"])

    return units.select("id", "text").mapInArrow(scan, "anchor long, id long, rank int")


def _shared(anchors: DataFrame, hot: int) -> DataFrame:
    """``id, marks``: ranks of the anchors that lie in several documents, doubled, and odd for hot ones."""
    same = Window.partitionBy("anchor")
    counted = anchors.select("id", "rank", F.min("id").over(same).alias("lowest"), F.max("id").over(same).alias("highest"),
                             F.count(F.lit(1)).over(same).alias("n"))
    mark = F.col("rank").cast("long") * 2 + (F.col("n") > hot).cast("long")
    return (counted.where("lowest < highest").select("id", mark.alias("mark"))
            .groupBy("id").agg(F.array_join(F.sort_array(F.collect_set("mark")), ",").alias("marks")))


def _packed(docs: DataFrame) -> DataFrame:
    """The same rows with their text compressed, for a shuffle."""
    schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in docs.schema.fields])
    place = docs.columns.index("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for part in slices(batch, "text"):
                columns = list(part.columns)
                columns[place] = pa.array([None if t is None else packer.compress(t) for t in columns[place].cast(pa.binary()).to_pylist()],
                                          pa.binary())
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.mapInArrow(pack, schema)


def _unpacked(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices with whole texts, unpacked slice by slice."""
    place, unpacker = batch.schema.get_field_index("text"), zstandard.ZstdDecompressor()
    packed = batch.column(place)
    sizes = [0 if t is None else zstandard.frame_content_size(t) for t in packed.to_pylist()]
    start, held = 0, 0
    for at, size in enumerate(sizes):
        held += size
        if held >= CHUNK_BYTES or at + 1 == len(sizes):
            part = batch.slice(start, at + 1 - start)
            texts = pa.array([None if t is None else unpacker.decompress(t) for t in part.column(place).to_pylist()], pa.binary())
            yield part.set_column(place, "text", texts.cast(pa.string()))
            start, held = at + 1, 0


def _beside(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Documents, packed, with their row of a side table ``(id, text column)``; rows without an id are joined with nothing."""
    value = side.columns[1]
    named = _packed(docs.where("id IS NOT NULL")).join(side, "id", how)
    if how == "inner":
        return named
    return named.unionByName(_packed(docs.where("id IS NULL")).withColumn(value, F.lit(None).cast("string")))


def _passages(units: DataFrame, shared: DataFrame, folder: str) -> DataFrame:
    """``key, name, words, ids`` of each different span of a slice with a shared anchor; hot anchors give their windows one by one."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _unpacked(batch):
                words = Words(_column(part, "text"), UNCHANGED)
                spans = spans_of(words)
                if not len(spans.group):
                    continue
                last = np.append(spans.first_group[1:], spans.group.max() + 1)
                wanted = np.zeros(spans.group.max() + 1, dtype=np.int8)
                for at, marks in enumerate(_column(part, "marks").to_pylist()):
                    marks = np.array(marks.split(","), dtype=np.int64)
                    ranks = marks[spans.first_group[at] + (marks >> 1) < last[at]]
                    wanted[spans.first_group[at] + (ranks >> 1)] |= 1 + (ranks & 1).astype(np.int8)
                kind = wanted[spans.group]
                plain, hot = np.flatnonzero(kind == 1), np.flatnonzero(kind > 1)
                count = spans.count[hot]
                inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                first = np.concatenate([spans.start[plain], np.repeat(spans.start[hot], count) + inside])
                size = np.concatenate([spans.count[plain], np.ones(count.sum(), np.int64)])
                owner = np.concatenate([spans.owner[plain], np.repeat(spans.owner[hot], count)])
                windows = words.window_hashes(WINDOW)
                key = np.concatenate([spans.anchor[plain], mix(windows[first[len(plain):]])])
                stop = first + size + WINDOW - 1
                names = Names(words).of(first, stop)
                text, begins = joined_words(words)
                data = text.tobytes()
                spots: dict[bytes, int] = {}
                spot = np.array([spots.setdefault(name, len(spots)) for name in names], dtype=np.int64)
                _, one = np.unique(spot, return_index=True)
                order = np.argsort(spot, kind="stable")
                bounds = np.searchsorted(spot[order], np.arange(len(spots) + 1))
                found = [data[a:b] for a, b in zip(begins[first[one]].tolist(), (begins[stop[one]] - 1).tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[one].view(np.int64)), pa.array(list(spots), pa.binary()), pa.array(found, pa.binary()).cast(pa.string()),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), _column(part, "id").take(pa.array(owner[order])))],
                    names=["key", "name", "words", "ids"])

    found = _beside(units.select("id", "text"), shared, "inner")
    return stage(found.select("id", "text", "marks").mapInArrow(scan, "key long, name binary, words string, ids array<long>"), "spans", folder)


def shard_owners(texts: list[str], ids: list[int], window: int = WINDOW) -> list[list[int]]:
    """The first document of each window of each text, by one automaton of all of them."""
    numbers: dict[str, int] = {}
    sequences = [[numbers.setdefault(word, len(numbers)) for word in text.split(" ")] for text in texts]
    automaton = SuffixAutomaton()
    for sequence, owner in zip(sequences, ids):
        automaton.add(sequence, owner)
    automaton.finish(window)
    return [automaton.window_owners(sequence, window) for sequence in sequences]


def _first_owners(spans: DataFrame, shard_words: int) -> DataFrame:
    """``name, firsts``: of each different span that some document loses words to, the first document of each window."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def shard() -> pa.RecordBatch:
            owners = shard_owners(texts, lowest)
            kept = [k for k, firsts in enumerate(owners) if min(firsts) < highest[k]]
            return pa.RecordBatch.from_arrays(
                [pa.array([names[k] for k in kept], pa.binary()), pa.array([owners[k] for k in kept], pa.list_(pa.int64()))],
                names=["name", "firsts"])

        texts, names, lowest, highest, held, before = [], [], [], [], 0, None
        for batch in batches:
            for key, name, words, low, high in zip(*(c.to_pylist() for c in batch.columns)):
                if key != before and held >= shard_words:
                    yield shard()
                    texts, names, lowest, highest, held = [], [], [], [], 0
                if key == before and names and name == names[-1]:
                    lowest[-1], highest[-1] = min(low, lowest[-1]), max(high, highest[-1])
                    continue
                texts.append(words)
                names.append(name)
                lowest.append(low)
                highest.append(high)
                held, before = held + words.count(" ") + 1, key
        if texts:
            yield shard()

    bounded = spans.select("key", "name", "words", F.array_min("ids").alias("lowest"), F.array_max("ids").alias("highest"))
    ordered = bounded.repartition("key").sortWithinPartitions("key", "name")
    return ordered.mapInArrow(build, "name binary, firsts array<long>")


def _lost(spans: DataFrame, firsts: DataFrame) -> DataFrame:
    """``id, hits``: of each document the names of spans that lose windows, with a flag for each window."""
    flags = F.array_join(F.transform("firsts", lambda first: F.when(first < F.col("id"), "1").otherwise("0")), "")
    met = join_facts(spans.select("name", F.explode("ids").alias("id")), firsts, "name", "inner").select("id", "name", flags.alias("flags"))
    return (met.where(F.contains("flags", F.lit("1"))).groupBy("id")
            .agg(F.array_join(F.collect_set(F.concat(F.hex("name"), F.col("flags"))), ",").alias("hits")))


def _kept(docs: DataFrame) -> DataFrame:
    """``id, n_words, n_removed, kept`` of documents with their hits and whether they are later copies."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _unpacked(batch):
                words = Words(_column(part, "text"), UNCHANGED)
                gone = removed_words(words, _column(part, "hits").to_pylist(), _column(part, "copy").to_pylist())
                sums = np.concatenate([[0], np.cumsum(gone)])
                text, begins = joined_words(words)
                stays = np.repeat(~gone, np.diff(begins))
                data = text[stays].tobytes()
                ends = np.concatenate([[0], np.cumsum(stays)])[begins[words.bounds]].tolist()
                kept = [data[a:max(a, b - 1)] for a, b in zip(ends[:-1], ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [_column(part, "id"), pa.array(words.counts, pa.int64()),
                     pa.array(np.diff(sums[words.bounds]), pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["id", "n_words", "n_removed", "kept"])

    return docs.select("id", "text", "hits", "copy").mapInArrow(scan, "id long, n_words long, n_removed long, kept string")


def removed_words(words: Words, hits: list[str | None], copies: list[bool]) -> np.ndarray:
    change = np.zeros(len(words.hashes) + 1, dtype=np.int64)
    if any(hits):
        spans, names = spans_of(words), Names(words)
        limits = np.searchsorted(spans.owner, np.arange(len(hits) + 1))
        for at in (k for k, hit in enumerate(hits) if hit):
            flags = {bytes.fromhex(hit[:32]): hit[32:] for hit in hits[at].split(",")}
            mine = slice(limits[at], limits[at + 1])
            start, size = spans.start[mine], spans.count[mine]
            _flag(change, names.of(start, start + size + WINDOW - 1), start, flags)
            if any(len(f) == 1 for f in flags.values()):
                # Windows of hot anchors were named one by one.
                single = np.arange(words.bounds[at], words.bounds[at + 1] - WINDOW + 1)
                _flag(change, names.of(single, single + WINDOW), single, flags)
    for at in (k for k, copy in enumerate(copies) if copy):
        if words.bounds[at + 1] - words.bounds[at] >= WINDOW:
            change[words.bounds[at]] += 1
            change[words.bounds[at + 1]] -= 1
    return np.cumsum(change[:-1]) > 0


def _flag(change: np.ndarray, names: list[bytes], starts: np.ndarray, flags: dict[bytes, str]) -> None:
    for name, start in zip(names, starts.tolist()):
        for k, flag in enumerate(flags.get(name, "")):
            if flag == "1":
                change[start + k] += 1
                change[start + k + WINDOW] -= 1


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT,
                    shard_words: int = SHARD_WORDS) -> DataFrame:
    """``id, n_words, n_removed, kept`` of every document; ``kept`` are its remaining words, joined by one blank."""
    named = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))
    copied = (named.where("id IS NOT NULL").groupBy("digest").agg(F.min("id").alias("first"), F.max("id").alias("last"))
              .where("first < last").select("digest", "first"))
    marked = (join_facts(named, stage(copied, "copied"), "digest", "left")
              .select("id", "text", F.coalesce(F.col("id") > F.col("first"), F.lit(False)).alias("copy")))
    units = marked.where("NOT copy AND id IS NOT NULL AND text IS NOT NULL")
    with work_folder(docs.sparkSession, "passages") as folder:
        shared = stage(_shared(_anchors(units), hot), "shared", folder)
        spans = _passages(units, shared, folder)
        hits = stage(_lost(spans, _first_owners(spans, shard_words)), "hits")
    return _kept(_beside(marked, hits, "left"))
