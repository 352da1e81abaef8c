"""Quality by perplexity under an interpolated modified Kneser-Ney model of characters.

The model is trained on all trusted text of each language. Counts are tables:
highest-order counts from the text, lower orders from the number of different
left neighbours, three discounts per order and language from the counts of
counts, and from these the probability of each n-gram and the back-off weight of
each context.

Scoring never broadcasts the model. Documents are packed into blocks of bounded
bytes as they are read, each block lists the n-grams that occur in it, the list is
joined with the model's rows, shard by shard, and the rows found go to the
block's documents, bundled by block in each shard. The packed blocks are the only text that is moved.

One trusted document in ``HELD_OUT`` is not trained on, but never the first of its
language by hash. A document is kept when its perplexity is at most the given quantile
of those of its language's held-out documents, times a margin: what the model has seen
would look too easy. Only a language with so few trusted documents that none is held out
takes the quantile of those that it was trained on.

Defined results: a null or empty text has no perplexity and is not kept; a
language without trusted text has no threshold, and its documents are kept. A
null language is a language of its own. Labels that disagree about a document
make it untrusted. Digits count as one character.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..sources.workdir import stage, work_folder
from .graph import settled
from .words import mix, slices, text_buffer

ORDER = 5
QUANTILE = 0.995
MARGIN = 1.1
HELD_OUT = 5
BLOCK_BYTES = 32 << 20
SLICE_BYTES = 1 << 20
SCORED_BYTES = 1 << 19
SEPARATOR = "\x00"  # in no gram: texts have another character in its place
MARK = ("\x00", "", 0.0, 0.0)
BUNDLE_ROWS = 1 << 20
LISTED_ROWS = 1 << 16  # a batch goes to the JVM as a whole
BROADCAST_ROWS = 1_000_000
BEGIN, END, REPLACEMENT = 2, 3, 0xFFFD
FOLD_ROWS = 1 << 19  # windows that a block gathers before repeated ones go
_SLOTS = 1 << 19


class Characters:
    """Code points of a batch of texts, each text padded by ``order`` - 1 begin marks and an end mark.

    ``starts`` are the windows of ``order`` characters, one for each character and
    end mark that the model predicts; ``bounds`` are the first window of each text.
    """

    def __init__(self, texts: pa.Array, order: int = ORDER):
        data, offsets = text_buffer(texts)
        whole = _whole(len(data) + (order + 1) * len(texts))
        try:
            codes = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
            ends = np.zeros(len(data) + 1, dtype=whole)
            np.cumsum((data & 0xC0) != 0x80, out=ends[1:])
            ends = ends[offsets].astype(np.int64)
        except UnicodeDecodeError:
            parts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
            codes = np.frombuffer("".join(parts).encode("utf-32-le"), dtype=np.uint32)
            ends = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        codes = np.where((codes >= 48) & (codes <= 57), np.uint32(48), codes)
        codes[codes == 0] = REPLACEMENT
        lengths = np.diff(ends)
        last = np.cumsum(lengths + order) - 1
        self.order = order
        self.codes = np.full(len(codes) + order * len(lengths), BEGIN, dtype=np.uint32)
        inside = np.ones(len(self.codes), dtype=bool)
        inside[last] = False
        for k in range(order - 1):
            inside[last - lengths - 1 - k] = False
        self.codes[inside] = codes
        self.codes[last] = END
        self.lengths = lengths
        self.bounds = np.concatenate([[0], np.cumsum(lengths + 1)])
        inside[:] = True
        for k in range(order - 1):
            inside[last - k] = False
        self.starts = np.flatnonzero(inside).astype(whole)

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Matrix of the different windows, and for each window its row there."""
        values = mix(self.codes.astype(np.uint64) + np.uint64(1))
        total = max(0, len(values) - self.order + 1)
        keys = np.zeros(total, dtype=np.uint64)
        for k in range(self.order):
            # Powers, not multiples: with factors in even steps abba and baab would be one.
            keys += values[k:k + total] * np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
        del values
        keys = mix(keys)[self.starts]
        first, inverse = distinct(keys)
        return self.codes[self.starts[first][:, None] + np.arange(self.order)], inverse


def _whole(size: int) -> type:
    """Whole numbers that places below ``size`` fit in; half as wide where that is enough, since most memory is theirs."""
    return np.int32 if size < 1 << 31 else np.int64


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A position of each different key, and for each key its number; keys that share a slot are sorted."""
    whole = _whole(len(keys))
    slots = (keys & np.uint64(_SLOTS - 1)).astype(np.int32)
    owner = np.zeros(_SLOTS, dtype=whole)
    owner[slots] = np.arange(len(keys), dtype=whole)
    rest = np.flatnonzero(keys[owner[slots]] != keys)
    taken = np.zeros(_SLOTS, dtype=bool)
    taken[slots] = True
    number = np.cumsum(taken, dtype=whole) - whole(1)
    inverse = number[slots]
    _, first, others = np.unique(keys[rest], return_index=True, return_inverse=True)
    inverse[rest] = others + number[-1] + 1
    return np.concatenate([owner[taken], rest[first]]), inverse


def as_strings(matrix: np.ndarray) -> np.ndarray:
    """One string for each row of code points."""
    width = matrix.shape[1]
    return np.ascontiguousarray(matrix, dtype=np.uint32).view(f"<U{width}").reshape(-1) if len(matrix) else np.zeros(0, f"<U{width}")


def _language_groups(languages: pa.Array) -> Iterator[tuple[str, pa.Array]]:
    for language in pc.unique(languages).to_pylist():
        yield language, pc.indices_nonzero(pc.equal(languages, language))


def count_ngrams(trusted: DataFrame, order: int = ORDER) -> DataFrame:
    """``lang``, ``gram`` and ``n`` of all windows of the texts; each block is added up before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in slices(batch, "text", BLOCK_BYTES):
                for language, rows in _language_groups(block.column(0)):
                    found = []
                    for part in slices(block.take(rows), "text", SLICE_BYTES):
                        windows, inverse = Characters(part.column(1), order).distinct()
                        found.append(pa.table({"gram": as_strings(windows), "n": np.bincount(inverse, minlength=len(windows))}))
                    grams = pa.concat_tables(found).group_by("gram").aggregate([("n", "sum")])
                    columns = {"lang": pa.array([language] * len(grams), pa.string()), "gram": grams["gram"],
                               "n": grams["n_sum"].cast(pa.int64())}
                    yield from pa.table(columns).to_batches(LISTED_ROWS)

    return (trusted.select("lang", "text").mapInArrow(run, "lang string, gram string, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame, order: int = ORDER,
               stored: Callable[[DataFrame, str], DataFrame] = lambda df, name: df) -> DataFrame:
    """``lang``, ``gram``, ``logp`` and ``back``: log probability of a gram, log back-off weight of it as a context.

    The row with the empty gram has the uniform probability of any character and
    the weight of the empty context. Each order builds on the one below; ``stored``
    may write each step and read it back, so that no plan holds all of them.
    """
    levels = {order: counts}
    for size in range(order - 1, 0, -1):
        levels[size] = stored(levels[size + 1].groupBy("lang", F.substring("gram", 2, size).alias("gram"))
                              .agg(F.count(F.lit(1)).alias("n")), f"level{size}")
    lower = levels[1].groupBy("lang").agg((-F.log(F.count(F.lit(1)) + 1.0)).alias("logp")).withColumn("gram", F.lit(""))
    grams, contexts = [lower], []
    for size in range(1, order + 1):
        level = stored(_discounted(levels[size], size), f"discounted{size}")
        contexts.append(level.groupBy("lang", F.col("context").alias("gram")).agg(F.log(F.first("weight")).alias("back")))
        below = lower.select("lang", F.col("gram").alias("suffix"), F.col("logp").alias("below"))
        lower = stored(level.withColumn("suffix", F.substring("gram", 2, size - 1)).join(below, ["lang", "suffix"])
                       .select("lang", "gram", F.log(F.col("own") + F.col("weight") * F.exp("below")).alias("logp")), f"lower{size}")
        grams.append(lower)
    union = lambda frames: frames[0] if len(frames) == 1 else frames[0].unionByName(union(frames[1:]))
    return union(grams).join(union(contexts), ["lang", "gram"], "full").select("lang", "gram", "logp", "back")


def _discounted(level: DataFrame, size: int) -> DataFrame:
    """``own``, the discounted share of a gram in its context, and ``weight``, what the context passes down."""
    of = lambda n: F.sum(F.when(F.col("n") == n, 1.0).otherwise(0.0))
    ones, twos, threes, fours = (F.greatest(of(n), F.lit(1e-9)) for n in (1, 2, 3, 4))
    y = ones / (ones + 2 * twos)
    discounts = level.groupBy("lang").agg(
        *[F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), k - (k + 1) * y * upper / lower)).alias(f"d{k}")
          for k, lower, upper in ((1, ones, twos), (2, twos, threes), (3, threes, fours))])
    context = Window.partitionBy("lang", "context")  # at most as many rows as there are characters
    cut = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    return (level.withColumn("context", F.substring("gram", 1, size - 1)).join(discounts, "lang")
            .withColumn("cut", cut).withColumn("total", F.sum("n").over(context))
            .withColumn("weight", F.sum("cut").over(context) / F.col("total"))
            .select("lang", "context", "gram", "weight", ((F.col("n") - F.col("cut")) / F.col("total")).alias("own")))


class Shard:
    """The model rows that one block needs, looked up by the code points of a gram."""

    def __init__(self, grams: list[str], logp: np.ndarray, back: np.ndarray, order: int):
        lengths = np.array([len(g) for g in grams], dtype=np.int64)
        codes = np.array(grams, dtype=f"<U{order}").view(np.uint32).reshape(-1, order)
        self.levels = {}
        for size in range(order + 1):
            rows = np.flatnonzero(lengths == size)
            keys = self._keys(codes[rows, :size])
            by_key = np.argsort(keys)
            self.levels[size] = (keys[by_key], logp[rows][by_key], back[rows][by_key])

    @staticmethod
    def _keys(codes: np.ndarray) -> np.ndarray:
        keys = np.zeros(len(codes), dtype=np.uint64)
        for k in range(codes.shape[1]):
            keys = mix(keys + codes[:, k].astype(np.uint64) + np.uint64(1))
        return keys

    def _find(self, codes: np.ndarray, which: int) -> np.ndarray:
        keys, values = self.levels[codes.shape[1]][0], self.levels[codes.shape[1]][which]
        if not len(keys):
            return np.full(len(codes), np.nan)
        wanted = self._keys(codes)
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where(keys[at] == wanted, values[at], np.nan)

    def log_probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Of the last character of each window after the others."""
        order = windows.shape[1]
        out, passed = np.full(len(windows), np.nan), np.zeros(len(windows))
        for size in range(order, -1, -1):
            found = passed + self._find(windows[:, order - size:], 1)
            out = np.where(np.isnan(out), found, out)
            if size:
                passed = passed + np.nan_to_num(self._find(windows[:, order - size:order - 1], 2))
        return out


def needed_grams(windows: np.ndarray) -> pa.Array:
    """All grams and contexts that scoring these windows may look up, by size and in order of their code points.

    In order, because neighbours that share their first characters take fewer bytes where they are moved.
    """
    order = windows.shape[1]
    windows, letters = _ranked(windows)
    parts = [pa.array([""])]
    for size in range(1, order + 1):
        grams = windows[:, order - size:]
        if size < order:
            grams = different_rows(np.concatenate([grams, windows[:, order - 1 - size:order - 1]]), len(letters))
        parts.append(pa.array(as_strings(letters[grams])))
    return pa.concat_arrays([p.cast(pa.string()) for p in parts])


def _ranked(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different windows in order, as places in the array of their characters, and this array."""
    there = np.zeros(0x110000, dtype=bool)
    there[windows.reshape(-1)] = True
    letters = np.flatnonzero(there).astype(np.uint32)
    rank = (np.cumsum(there) - 1).astype(np.int32)
    return different_rows(rank[windows], len(letters)), letters


class Windows:
    """The windows of one language in a block; gathered slice by slice, and repeated ones go whenever the rows have doubled."""

    def __init__(self):
        self.found: list[np.ndarray] = []
        self.rows, self.limit = 0, FOLD_ROWS

    def add(self, windows: np.ndarray) -> None:
        self.found.append(windows)
        self.rows += len(windows)
        if self.rows > self.limit:
            rows, letters = _ranked(self.take())
            self.found, self.rows = [letters[rows]], len(rows)
            self.limit = max(FOLD_ROWS, 2 * self.rows)

    def take(self) -> np.ndarray:
        windows, self.found = np.concatenate(self.found), []
        return windows


def different_rows(rows: np.ndarray, base: int) -> np.ndarray:
    """The different rows of numbers below ``base``, sorted; as one number each where that fits."""
    width = rows.shape[1]
    if base ** width >= 1 << 63:
        return np.unique(rows, axis=0)
    places = np.array([base ** k for k in range(width - 1, -1, -1)], dtype=np.int64)
    keys = np.zeros(len(rows), dtype=np.int64)
    for k in range(width):
        keys += rows[:, k] * places[k]
    keys = np.unique(keys)
    return np.stack([keys // place % base for place in places], axis=1).astype(np.int32)


BUNDLE = "of_block long, lang string, n int, size int, grams binary, logp binary, back binary"


def _bundler():
    """Rows found for one block and language in one row: grams in one string, values as bytes by place, compressed."""
    schema = pa.schema([("of_block", pa.int64()), ("lang", pa.string()), ("n", pa.int32()), ("size", pa.int32()),
                        ("grams", pa.binary()), ("logp", pa.binary()), ("back", pa.binary())])

    def bundles(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        codec = pa.Codec("zstd", 6)
        rows = pa.Table.from_batches(batches).combine_chunks()
        blocks, langs = rows["of_block"].to_numpy(), rows["lang"].combine_chunks().dictionary_encode()
        codes = langs.indices.to_numpy()
        by_block = np.lexsort((codes, blocks))  # stable, so grams stay in the order of the join
        blocks, codes = blocks[by_block], codes[by_block]
        starts = np.flatnonzero(np.concatenate([[True], (blocks[1:] != blocks[:-1]) | (codes[1:] != codes[:-1])]))
        ends = np.append(starts[1:], len(blocks))
        grams = rows["gram"].combine_chunks().take(pa.array(by_block))
        lists = pa.ListArray.from_arrays(pa.array(np.append(starts, len(blocks)), pa.int32()), grams)
        texts = [t.encode() for t in pc.binary_join(lists, SEPARATOR).to_pylist()]
        packed = [pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())]
        for name in ("logp", "back"):
            values = rows[name].to_numpy()[by_block].astype(np.float32)
            packed.append(pa.array([codec.compress(values[a:b].view(np.uint8).reshape(-1, 4).T.tobytes(), asbytes=True)
                                    for a, b in zip(starts, ends)], pa.binary()))
        return pa.RecordBatch.from_arrays(
            [pa.array(blocks[starts]), langs.dictionary.take(pa.array(codes[starts])), pa.array(ends - starts, pa.int32()),
             pa.array([len(t) for t in texts], pa.int32()), *packed], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= BUNDLE_ROWS:
                yield bundles(held)
                held, rows = [], 0
        if held:
            yield bundles(held)

    return run


def unbundled(bundles: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Grams, log probabilities and back-off weights (nan where there is none) of the rows in bundles."""
    codec, grams, values = pa.Codec("zstd"), [], {"logp": [np.zeros(0, np.float32)], "back": [np.zeros(0, np.float32)]}
    for row in bundles.to_pylist():
        grams += codec.decompress(row["grams"], row["size"], asbytes=True).decode().split(SEPARATOR)
        for name, found in values.items():
            planes = np.frombuffer(codec.decompress(row[name], 4 * row["n"], asbytes=True), np.uint8).reshape(4, -1)
            found.append(np.ascontiguousarray(planes.T).view(np.float32).reshape(-1))
    return grams, np.concatenate(values["logp"]), np.concatenate(values["back"])


def perplexities(docs: DataFrame, model: DataFrame, order: int = ORDER, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without its ``text`` and with ``perplexity``; needs columns ``lang`` and ``text``.

    The documents are read twice, for the lists and for the texts. A block is known
    by a hash of its rows; if the second reading dealt rows to blocks otherwise, the
    block would miss its own mark among the rows found, and the job fails.
    """
    kept = [c for c in docs.columns if c != "text"]
    mark = model.sparkSession.createDataFrame([MARK], "lang string, gram string, logp double, back double")
    rows = (docs.mapInArrow(_lister(order, block_bytes), "of_block long, lang string, gram string")
            .join(model.unionByName(mark), ["lang", "gram"])
            .select("of_block", "lang", "gram", F.col("logp").cast("float"), F.col("back").cast("float"))
            .mapInArrow(_bundler(), BUNDLE))
    blocks = docs.mapInArrow(_packer(block_bytes), "block long, packed binary")
    empty = pa.schema([*to_arrow_schema(docs.select(*kept).schema), ("perplexity", pa.float64())]).empty_table()

    def score(packed: pa.Table, rows: pa.Table) -> pa.Table:
        out = [empty]
        if packed.num_rows and not pc.any(pc.equal(rows["lang"], MARK[0])).as_py():
            raise RuntimeError("the documents came in another order when they were read again; write them to a table first")
        for block in packed["packed"]:
            texts = pa.ipc.open_stream(block.as_buffer()).read_all().combine_chunks()
            values = np.full(texts.num_rows, np.nan)
            for language, at in _language_groups(texts["lang"].combine_chunks()):
                mine = rows.filter(pc.equal(rows["lang"], language))
                if mine.num_rows:
                    shard = Shard(*unbundled(mine), order)
                    values[at.to_numpy()] = _scores(texts.select(["text"]).take(at), shard, order)
            out.append(texts.select(kept).append_column("perplexity", pa.array(values, pa.float64(), from_pandas=True))
                       .cast(empty.schema))
        return pa.concat_tables(out)

    schema = T.StructType([*docs.select(*kept).schema, T.StructField("perplexity", T.DoubleType())])
    return blocks.groupBy("block").cogroup(rows.groupBy("of_block")).applyInArrow(score, schema)


def _scores(texts: pa.Table, shard: Shard, order: int) -> np.ndarray:
    values = []
    for batch in texts.combine_chunks().to_batches():
        for part in slices(batch, "text", SCORED_BYTES):
            chars = Characters(part.column(0), order)
            windows, inverse = chars.distinct()
            logs = np.concatenate([[0.0], np.cumsum(shard.log_probabilities(windows)[inverse])])
            mean = (logs[chars.bounds[1:]] - logs[chars.bounds[:-1]]) / (chars.lengths + 1)
            values.append(np.where(chars.lengths > 0, np.exp(-mean), np.nan))
    return np.concatenate(values)


def block_id(block: pa.RecordBatch) -> int:
    """Hash of a block's texts and of where they end."""
    data, offsets = text_buffer(block.column(block.schema.get_field_index("text")))
    state = blake2b(offsets.tobytes(), digest_size=8)
    state.update(data)
    return int.from_bytes(state.digest(), "big", signed=True)


def _lister(order: int, block_bytes: int):
    """The grams that scoring each block of documents looks up, and its mark, in batches of bounded rows."""
    def listed(block: int, language: str, grams: pa.Array) -> Iterator[pa.RecordBatch]:
        for first in range(0, len(grams), LISTED_ROWS):
            part = grams.slice(first, LISTED_ROWS)
            yield pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(block, pa.int64()), len(part)),
                                              pa.repeat(pa.scalar(language, pa.string()), len(part)), part],
                                             names=["of_block", "lang", "gram"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in slices(batch, "text", block_bytes):
                windows: dict[str, Windows] = {}
                for part in slices(block, "text", SLICE_BYTES):
                    texts = part.column(part.schema.get_field_index("text"))
                    for language, rows in _language_groups(part.column(part.schema.get_field_index("lang"))):
                        windows.setdefault(language, Windows()).add(Characters(texts.take(rows), order).distinct()[0])
                name = block_id(block)
                yield from listed(name, MARK[0], pa.array([MARK[1]]))
                while windows:
                    language, found = windows.popitem()
                    yield from listed(name, language, needed_grams(found.take()))

    return run


def _packer(block_bytes: int):
    """One row for each block of documents: its rows, compressed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
        for batch in batches:
            for block in slices(batch, "text", block_bytes):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, block.schema, options=options) as out:
                    out.write_batch(block)
                yield pa.RecordBatch.from_arrays([pa.array([block_id(block)], pa.int64()),
                                                  pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                                                 names=["block", "packed"])

    return run


def trusted_ids(labels: DataFrame) -> DataFrame:
    """Documents that every label calls good, and none toxic."""
    return (labels.groupBy(F.col("doc_id").alias("id"))
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("good"), F.max(F.coalesce("toxic", F.lit(0))).alias("bad"))
            .where("id IS NOT NULL AND good >= 1 AND bad = 0").select("id", F.lit(True).alias("trusted")))


def judged(docs: DataFrame, labels: DataFrame, order: int = ORDER, quantile: float = QUANTILE,
           margin: float = MARGIN) -> DataFrame:
    """``id``, ``hash``, ``lang``, ``perplexity``, ``threshold`` and ``keep`` of every row of the documents.

    ``hash`` is ``row_hash()`` of the row; with ``id`` it leads back to the row.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), row_hash().alias("hash"),
                       F.coalesce("lang", F.lit("")).alias("lang"), "text")
    good = trusted_ids(labels)
    good = F.broadcast(good) if good.count() <= BROADCAST_ROWS else good
    rows = rows.join(good, "id", "left").select("id", "hash", "lang", F.coalesce("trusted", F.lit(False)).alias("trusted"), "text",
                                                F.coalesce(F.octet_length("text") > 0, F.lit(False)).alias("has_text"))
    # One row for each language that has trusted text.
    first = {r.lang: r.least for r in rows.where("trusted AND has_text").groupBy("lang").agg(F.min(F.xxhash64("id")).alias("least")).collect()}
    is_first = F.coalesce(F.create_map(*[F.lit(v) for pair in first.items() for v in pair])[F.col("lang")] == F.xxhash64("id"),
                          F.lit(False)) if first else F.lit(False)
    held_out = F.col("trusted") & (F.pmod(F.xxhash64("id"), F.lit(HELD_OUT)) == 0) & ~is_first
    with work_folder(spark, "quality") as folder:
        counts = stage(count_ngrams(rows.where(F.col("trusted") & ~held_out), order), "counts", folder)
        model = stage(kneser_ney(counts, order, lambda df, name: stage(df, name, folder)), "model", folder)
        scored = settled(perplexities(rows, model, order))
    seen = scored.where(F.col("trusted") & F.col("perplexity").isNotNull()).withColumn("held_out", held_out)
    limit = lambda rows: F.percentile_approx(F.when(rows, F.col("perplexity")), quantile, 10_000)
    limits = seen.groupBy("lang").agg((F.coalesce(limit(F.col("held_out")), limit(~F.col("held_out"))) * margin).alias("threshold"))
    # A language may hold most rows, so its one threshold goes to the rows where the measured table allows it.
    limits = settled(limits)
    known = scored.join(F.broadcast(limits) if limits.count() <= BROADCAST_ROWS else limits, "lang", "left")
    passes = F.col("threshold").isNull() | F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(False))
    return known.select("id", "hash", "lang", "perplexity", "threshold", (F.col("has_text") & passes).alias("keep"))


def row_hash():
    return F.xxhash64("doc_id", "lang", "text")


def keep_good(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns; texts that are null or empty go."""
    rejected = settled(judged(docs, labels, **options).where("NOT keep").select("id", "hash").distinct())
    rejected = F.broadcast(rejected) if rejected.count() <= BROADCAST_ROWS else rejected
    match = row_hash().eqNullSafe(rejected["hash"]) & F.col("doc_id").cast("long").eqNullSafe(rejected["id"])
    return docs.where(F.octet_length("text") > 0).join(rejected, match, "left_anti")
