"""Token-id files: a concatenated id array with Elias-Fano coded document boundaries.

Layout of a file (little endian)::

    magic  ids: 2 or 4 bytes each  boundaries  document ids  footer (JSON)  length of the footer: 8 bytes

The id array of all documents of a file is written without separators; where a
document starts is an Elias-Fano sequence of about 2 + log2(ids / documents)
bits a document, and so are the document ids, which rise within and over files.
A select directory (the place of every 256th set bit) finds any single offset
without unpacking the sequence and without a table of 64-bit offsets.

Files are written by the tasks of a range-partitioned plan and named by a fresh
identifier; the manifest, written by Spark after them, names exactly the files of
the attempts that counted, so a lost executor or a repeated task leaves at most
files nobody reads. Paths go through Arrow's file systems.

Texts are encoded as the library does by default without adding tokens: the
string of a special token in a text becomes its id. Defined results: a null text has the end id only; documents without id come
first; documents with the same id all stay, in any order; no documents, no file.
"""

from __future__ import annotations

import json
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .byte_bpe import ByteBpe
from .words import slices

MAGIC = b"TOKEF\x00\x00\x01"
SELECT_EVERY = 256
SHARD_BYTES = 32 << 20
READ_IDS = 1 << 20


class EliasFano:
    """A rising sequence of whole numbers below ``universe``; ``select`` gives one, ``values`` a range."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, directory: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.directory = count, low_bits, low, high, directory

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        count = len(values)
        low_bits = max(0, int(universe // max(1, count)).bit_length() - 1)
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).reshape(-1), bitorder="little")
        places = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(count)
        flags = np.zeros(int(places[-1]) + 1 if count else 0, dtype=np.uint8)
        flags[places] = 1
        return cls(count, low_bits, low, np.packbits(flags, bitorder="little"),
                   places[::SELECT_EVERY].astype(np.uint32 if len(flags) < 1 << 32 else np.uint64))

    def values(self, first: int = 0, last: int | None = None) -> np.ndarray:
        last = self.count if last is None else min(last, self.count)
        if first >= last:
            return np.zeros(0, dtype=np.int64)
        start = int(self.directory[first // SELECT_EVERY]) // 8
        stop = (int(self.directory[(last - 1) // SELECT_EVERY + 1]) // 8 + 1
                if (last - 1) // SELECT_EVERY + 1 < len(self.directory) else len(self.high))
        places = np.flatnonzero(np.unpackbits(self.high[start:stop], bitorder="little")) + start * 8
        places = places[places >= int(self.directory[first // SELECT_EVERY])]
        skipped = first // SELECT_EVERY * SELECT_EVERY
        places = places[first - skipped:last - skipped]
        high = (places - np.arange(first, last)) << self.low_bits
        begin = first * self.low_bits
        bits = np.unpackbits(self.low[begin // 8:(last * self.low_bits + 7) // 8], bitorder="little")
        bits = bits[begin % 8:begin % 8 + (last - first) * self.low_bits].reshape(last - first, self.low_bits)
        return high + bits.astype(np.int64) @ (np.int64(1) << np.arange(self.low_bits, dtype=np.int64))

    def select(self, index: int) -> int:
        """The value at ``index``; looks at one stretch of the directory."""
        return int(self.values(index, index + 1)[0])

    def pack(self) -> tuple[bytes, dict]:
        parts = [self.low, self.high, self.directory]
        return b"".join(p.tobytes() for p in parts), {
            "count": self.count, "low_bits": self.low_bits, "sizes": [p.nbytes for p in parts],
            "wide": self.directory.dtype == np.uint64}

    @classmethod
    def unpack(cls, data: bytes, about: dict) -> EliasFano:
        low, high, directory = np.split(np.frombuffer(data, np.uint8), np.cumsum(about["sizes"])[:2])
        return cls(about["count"], about["low_bits"], low, high, directory.view(np.uint64 if about["wide"] else np.uint32))


class Writer:
    """Appends documents to one file; holds one number for each document until it is closed."""

    def __init__(self, folder: str, name: str, width: int):
        self.files, base = arrow_fs.FileSystem.from_uri(folder)
        self.files.create_dir(base, recursive=True)
        self.out = self.files.open_output_stream(f"{base}/{name}")
        self.out.write(MAGIC)
        self.width, self.ids, self.lengths, self.docs, self.nulls = width, 0, [], [], 0

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.out.write(ids.astype(f"<u{self.width}").tobytes())
        self.ids += len(ids)
        self.lengths.append(lengths)
        self.nulls += doc_ids.null_count
        self.docs.append(doc_ids.drop_null().to_numpy())

    def close(self) -> dict:
        lengths, docs = np.concatenate(self.lengths), np.concatenate(self.docs).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        least = int(docs[0]) if len(docs) else 0
        bounds, bounds_about = EliasFano.of(starts, self.ids + 1).pack()
        names, names_about = EliasFano.of((docs - least), int(docs[-1]) - least + 1 if len(docs) else 1).pack()
        footer = json.dumps({"ids": self.ids, "width": self.width, "docs": len(lengths), "nulls": self.nulls,
                             "least": least, "bounds": bounds_about, "names": names_about}).encode()
        self.out.write(bounds + names + footer + len(footer).to_bytes(8, "little"))
        self.out.close()
        return {"docs": len(lengths), "ids": self.ids}


class Reader:
    """Random and sequential access to one file; the id array is never read whole."""

    def __init__(self, folder: str, name: str):
        files, base = arrow_fs.FileSystem.from_uri(folder)
        self.file = files.open_input_file(f"{base}/{name}")
        size = self.file.size()
        if self.file.read_at(len(MAGIC), 0) != MAGIC:
            raise ValueError(f"{name} is not a token file")
        length = int.from_bytes(self.file.read_at(8, size - 8), "little")
        self.about = json.loads(self.file.read_at(length, size - 8 - length))
        at = len(MAGIC) + self.about["ids"] * self.about["width"]
        self.parts = {}
        for part in ("bounds", "names"):
            total = sum(self.about[part]["sizes"])
            self.parts[part] = EliasFano.unpack(self.file.read_at(total, at), self.about[part])
            at += total
        self.docs, self.ids = self.about["docs"], self.about["ids"]

    def bounds(self, first: int, last: int) -> np.ndarray:
        """Starts of documents first..last, with the end of the file behind the last one."""
        starts = self.parts["bounds"].values(first, min(last + 1, self.docs))
        return np.append(starts, self.ids) if last >= self.docs else starts

    def doc_ids(self, first: int, last: int) -> list[int | None]:
        nulls = self.about["nulls"]
        known = self.parts["names"].values(max(0, first - nulls), max(0, last - nulls)) + self.about["least"]
        return [None] * max(0, min(nulls, last) - first) + known.tolist()

    def read(self, start: int, stop: int) -> np.ndarray:
        width = self.about["width"]
        return np.frombuffer(self.file.read_at((stop - start) * width, len(MAGIC) + start * width), f"<u{width}")

    def document(self, index: int) -> np.ndarray:
        start, stop = self.bounds(index, index + 1)
        return self.read(int(start), int(stop))


MANIFEST = "shard int, file string, docs long, ids long"


def write_tokens(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_col: str = "doc_id",
                 text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encode all documents into files below ``folder``, in order of their ids; returns the manifest."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ordered = rows.repartitionByRange(max(1, math.ceil(size / shard_bytes)), "id").sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, writer, name = ByteBpe.load(tokenizer_path, False), None, f"tokens-{uuid.uuid4().hex}.bin"
        for batch in batches:
            for part in slices(batch, "text"):
                writer = writer or Writer(folder, name, 2 if max(coder.size, end_id + 1) <= 1 << 16 else 4)
                writer.add(part.column(0), *coder.encode(part.column(1), end_id))
        if writer:
            about = writer.close()
            yield pa.RecordBatch.from_pydict({"shard": pa.array([TaskContext.get().partitionId()], pa.int32()), "file": [name],
                                              "docs": [about["docs"]], "ids": [about["ids"]]})

    path = f"{folder}/manifest"
    ordered.mapInArrow(run, MANIFEST).write.parquet(path)
    return docs.sparkSession.read.schema(MANIFEST).parquet(path)


def read_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_index(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    shards = manifest.select("file", "docs", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, first = Reader(folder, row["file"]), 0
                while first < reader.docs:
                    bounds = reader.bounds(first, first + 4096)
                    count = max(1, int(np.searchsorted(bounds, bounds[0] + READ_IDS, side="right")) - 1)
                    count = min(count, len(bounds) - 1)
                    bounds = bounds[:count + 1]
                    ids = memoryview(reader.read(int(bounds[0]), int(bounds[-1])).astype("<u4")).cast("B")
                    places = ((bounds - bounds[0]) * 4).tolist()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(reader.doc_ids(first, first + count), pa.int64()),
                         pa.array(bounds[:-1] + row["base"], pa.int64()), pa.array(np.diff(bounds), pa.int64()),
                         pa.array([zlib.crc32(ids[a:b]) for a, b in zip(places, places[1:])], pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    first += count

    files = max(1, manifest.count())
    return (shards.repartition(files, "file").select("file", "base")
            .mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def read_documents(manifest: DataFrame, folder: str) -> DataFrame:
    """``doc_id`` and ``token_ids`` of every document, from the files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader = Reader(folder, row["file"])
                for first in range(0, reader.docs, 256):
                    last = min(first + 256, reader.docs)
                    bounds = reader.bounds(first, last)
                    lists = pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()),
                                                     pa.array(reader.read(int(bounds[0]), int(bounds[-1])).astype(np.int32)))
                    yield pa.RecordBatch.from_arrays([pa.array(reader.doc_ids(first, last), pa.int64()), lists],
                                                     names=["doc_id", "token_ids"])

    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(
        run, "doc_id long, token_ids array<int>")
