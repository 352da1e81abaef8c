"""WARC archives of pages, and their transactions put together again.

Writing: every page becomes a request, a response (or a revisit of an earlier
equal payload) and a metadata record, each its own gzip member; request and
metadata name their response in WARC-Concurrent-To. Equal payloads of at least
``REVISIT_BYTES`` are stored once: the one with the largest page id is the
response, all others are revisits that refer to it. Tasks write whole archives
under fresh names and the manifest names those of the attempts that counted.

Reading: archives are parsed as streams, one record at a time, by any Hadoop-like
path that Arrow's file systems know. Transactions are assembled by joins on record
identifiers, in either direction of WARC-Concurrent-To, into one nested row per
capture; requests and metadata whose response is missing are captures without one.

Defined results: a null payload is empty; repeated page ids are captures of their
own; of equal payloads whose largest page id occurs more than once, all of those
are responses; a page without id comes after all others. Header names match in
any case; a record cut off at the end of a file is left out.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workdir import stage

REVISIT_BYTES = 1000
BROADCAST_ROWS = 1_000_000
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the WARC 1.1 standard.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = {"request": "application/http; msgtype=request", "response": "application/http; msgtype=response",
        "revisit": "application/http; msgtype=response", "metadata": "application/warc-fields",
        "warcinfo": "application/warc-fields"}


def record_id(kind: str, page_id: int | None, row: int, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{kind}/{page_id}/{row}/{digest}')}>"


def record(kind: str, fields: dict[str, str | None], block: bytes) -> bytes:
    head = {"WARC-Type": kind, "WARC-Date": DATE, **fields, "Content-Type": HTTP[kind], "Content-Length": str(len(block))}
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def one_line(text: str | None) -> str:
    """A header value; line ends and blanks at the edges would not come back."""
    return "".join(f"%{ord(c):02X}" if c in "\r\n" else c for c in text or "").strip()


def page_records(page_id: int | None, row: int, url: str | None, payload: bytes, refers: tuple[int, int] | None) -> list[bytes]:
    digest = hashlib.sha1(payload).digest()
    name, target = base64.b32encode(digest).decode(), one_line(url)
    main = record_id("response", page_id, row, name)
    host, _, path = target.partition("://")[2].partition("/")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    kind = "response" if refers is None else "revisit"
    return [
        record("request", {"WARC-Record-ID": record_id("request", page_id, row, name), "WARC-Target-URI": target,
                           "WARC-Concurrent-To": main}, f"GET /{path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()),
        record(kind, {"WARC-Record-ID": main, "WARC-Target-URI": target, "WARC-Payload-Digest": f"sha1:{name}",
                      "WARC-Profile": None if refers is None else REVISIT_PROFILE,
                      "WARC-Refers-To": None if refers is None else record_id("response", *refers, name)},
               http + (payload if refers is None else b"")),
        record("metadata", {"WARC-Record-ID": record_id("metadata", page_id, row, name), "WARC-Target-URI": target,
                            "WARC-Concurrent-To": main}, f"page-id: {'' if page_id is None else page_id}\r\n".encode()),
    ]


def with_revisits(pages: DataFrame, at_least: int = REVISIT_BYTES) -> DataFrame:
    """``page_id``, ``row``, ``url``, ``html`` and, for revisits, ``refers_id`` and ``refers_row``.

    ``row`` tells rows of one page id apart. Only payload groups of two and more
    take part in the join; their members are aggregated, never gathered.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.xxhash64("page_id", "url", "html").alias("row"),
                        "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.when(F.octet_length("html") >= at_least, F.unhex(F.sha1(F.encode("html", "UTF-8")))))
    groups = (rows.where("digest IS NOT NULL").groupBy("digest")
              .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("page_id", "row")).alias("last")).where("n > 1")
              .select("digest", F.col("last.page_id").alias("refers_id"), F.col("last.row").alias("refers_row")))
    groups = stage(groups, "payloads")
    groups = F.broadcast(groups) if groups.count() <= BROADCAST_ROWS else groups
    own = F.col("page_id").eqNullSafe(F.col("refers_id"))
    return rows.join(groups, "digest", "left").select(
        "page_id", "row", "url", "html", *[F.when(~own, F.col(c)).alias(c) for c in ("refers_id", "refers_row")])


def write_archives(pages: DataFrame, folder: str, at_least: int = REVISIT_BYTES, level: int = 6) -> DataFrame:
    """Archives below ``folder``, one for each partition; returns the manifest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = arrow_fs.FileSystem.from_uri(folder)
        files.create_dir(base, recursive=True)
        name, out, count = f"pages-{uuid.uuid4().hex}.warc.gz", None, 0

        def put(data: bytes) -> None:
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            out.write(packer.compress(data) + packer.flush())

        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                for page in batch.slice(first, 64).to_pylist():
                    if out is None:
                        out = files.open_output_stream(f"{base}/{name}", compression=None)
                        put(record("warcinfo", {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Filename": name},
                                   b"format: WARC File Format 1.1\r\n"))
                    refers = None if page["refers_row"] is None else (page["refers_id"], page["refers_row"])
                    for data in page_records(page["page_id"], page["row"], page["url"], page["html"].encode("utf-8"), refers):
                        put(data)
                    count += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [name], "pages": [count]})

    path = f"{folder}/manifest"
    with_revisits(pages, at_least).mapInArrow(run, "file string, pages long").write.parquet(path)
    return pages.sparkSession.read.schema("file string, pages long").parquet(path)


def parse(stream, chunk: int = 1 << 16) -> Iterator[tuple[dict[str, list[str]], bytes]]:
    """Headers (by lower-case name) and block of each record of a WARC stream, gzipped by record or plain."""
    buffer = bytearray()
    source = unpacked(stream, chunk)

    def fill(size: int) -> bool:
        while len(buffer) < size:
            data = next(source, None)
            if data is None:
                return False
            buffer.extend(data)
        return True

    while True:
        while fill(2) and buffer[:2] == b"\r\n":
            del buffer[:2]
        stop, seen = -1, 0
        while stop < 0:
            stop = buffer.find(b"\r\n\r\n", seen)
            seen = max(0, len(buffer) - 3)
            if stop < 0 and not fill(len(buffer) + 1):
                return
        lines = bytes(buffer[:stop]).decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
        headers: dict[str, list[str]] = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            headers.setdefault(name.strip().lower(), []).append(value.strip())
        size = int(headers.get("content-length", ["0"])[0])
        if not fill(stop + 4 + size):
            return
        yield headers, bytes(buffer[stop + 4:stop + 4 + size])
        del buffer[:stop + 4 + size]


def unpacked(stream, chunk: int) -> Iterator[bytes]:
    data = stream.read(chunk)
    if data[:2] != b"\x1f\x8b":
        while data:
            yield data
            data = stream.read(chunk)
        return
    member = zlib.decompressobj(31)
    while data:
        yield member.decompress(data, 4 * chunk)
        data = member.unconsumed_tail
        if member.eof:
            data, member = member.unused_data, zlib.decompressobj(31)
        data = data or stream.read(chunk)


def hex_digest(value: str | None) -> str | None:
    """SHA-1 in lower-case hex from ``sha1:`` and base 32 or hex."""
    kind, _, name = (value or "").partition(":")
    if kind.lower() != "sha1":
        return None
    return base64.b32decode(name.upper()).hex() if len(name) == 32 else name.lower()


RECORD = ("record_id string, record_type string, target_uri string, concurrent_to array<string>, refers_to string,"
          "declared_digest string, http_head binary, payload_bytes long, payload_digest string, payload binary")


def read_records(manifest: DataFrame, folder: str) -> DataFrame:
    """One row per record. For HTTP messages the payload is what follows their head; a revisit takes length and
    digest from its headers, since it has no payload of its own."""
    names = [c.split()[0] for c in RECORD.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = arrow_fs.FileSystem.from_uri(folder)
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows, size = [], 0
                with files.open_input_stream(f"{base}/{file}", compression=None) as stream:
                    for headers, block in parse(stream):
                        rows.append(_row(headers, block))
                        size += len(block)
                        if size > 4 << 20 or len(rows) >= 2000:
                            yield _batch(rows, names)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows, names)

    return manifest.select("file").repartition(max(1, manifest.count()), "file").mapInArrow(run, RECORD)


def read_heads(manifest: DataFrame, folder: str) -> DataFrame:
    """The records, without the payloads of responses, as a table below ``folder``; length and digest are of the whole payload.

    ``assemble`` reads its records three times; from this table it does so without parsing the archives again.
    """
    records = read_records(manifest, folder)
    return stage(records.withColumn("payload", F.when(F.col("record_type") != "response", F.col("payload"))), "heads", folder)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    types = [pa.string()] * 3 + [pa.list_(pa.string())] + [pa.string()] * 2 + [pa.binary(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _row(headers: dict[str, list[str]], block: bytes) -> tuple:
    one = lambda name: headers.get(name, [None])[0]
    kind, declared = one("warc-type"), hex_digest(one("warc-payload-digest"))
    head, payload = b"", block
    if (one("content-type") or "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
    if kind == "revisit":
        lengths = [line.partition(b":")[2] for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:")]
        size, digest = (int(lengths[0]) if lengths else None), declared
    else:
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
    return (one("warc-record-id"), kind, one("warc-target-uri"), headers.get("warc-concurrent-to", []), one("warc-refers-to"),
            declared, head, size, digest, payload)


def assemble(records: DataFrame) -> DataFrame:
    """One row per capture: its response or revisit, and its requests and metadata as arrays."""
    main = records.where("record_type IN ('response', 'revisit')")
    others = records.where("record_type IN ('request', 'metadata')")
    named = others.select(F.explode("concurrent_to").alias("capture_id"), "*")
    pointed = (main.select(F.col("record_id").alias("capture_id"), F.explode("concurrent_to").alias("other_id"))
               .join(others, F.col("other_id") == F.col("record_id")).drop("other_id"))
    parts = (named.unionByName(pointed).dropDuplicates(["capture_id", "record_id"])
             .select("capture_id", "record_type", F.struct("record_id", "target_uri", "http_head", "payload").alias("part")))
    of = lambda kind: F.array_sort(F.collect_list(F.when(F.col("record_type") == kind, F.col("part"))))
    parts = parts.groupBy("capture_id").agg(of("request").alias("requests"), of("metadata").alias("metadata"))
    response = main.select("record_id", F.struct(*[c for c in records.columns if c != "concurrent_to"]).alias("response"))
    return (response.join(parts, F.col("record_id") == F.col("capture_id"), "full")
            .select(F.coalesce("record_id", "capture_id").alias("capture_id"), "response", "requests", "metadata"))


def page_captures(captures: DataFrame) -> DataFrame:
    """Page id and payload facts of each capture; ``refers_to`` is the page id of the response referred to."""
    text = F.decode(F.element_at("metadata", 1)["payload"], "UTF-8")
    rows = captures.select("capture_id", "response",
                           F.regexp_extract(text, r"(?m)^page-id: (-?[0-9]+)", 1).try_cast("bigint").alias("page_id"))
    facts = rows.where("response IS NOT NULL").select(
        "capture_id", "page_id", "response.payload_bytes", "response.payload_digest", "response.record_type",
        F.col("response.refers_to").alias("refers"))
    wanted = facts.where("refers IS NOT NULL").select(F.col("refers").alias("capture_id")).distinct()
    target = (facts.join(wanted, "capture_id", "left_semi")
              .groupBy(F.col("capture_id").alias("refers")).agg(F.max("page_id").alias("refers_to")))
    return (facts.join(target, "refers", "left")
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))
