"""Exact Jaccard components of documents over their word shingles, by a size-aware join.

Documents with equal shingle sets are one set from the start. A pair of sets of
sizes r and s reaches the similarity exactly when it shares o(r, s) shingles:

* small sets enumerate all their o(r, s)-subsets for each size s in reach; two
  small sets belong together exactly when they meet in a subset;
* large sets scan inverted lists. Each set is listed under the shingles of its
  prefix (frequent shingles come last, so the prefix is rare), and two sets that
  belong together meet in a list.

The boundary is the size at which both together cost least, from the counts of
sets by size. Subset sums and shingles are compared by 64-bit hashes.

Only components are asked for, so pairs inside one are not all looked at. First
every member of a list is compared with the list's first set: a group of copies
turns into a star. Then lists whose members all have met are done, and what is
left is compared pair by pair: short lists by a join, long lists in blocks of
bounded bytes that scan inverted lists and return only links that join groups.
Lists are cut into bands of sizes in reach of each other, and pairs whose places
in their lists or whose parity sketches show that they differ too much are
dropped before any shingles are fetched; both tests are exact bounds. No list, however long, meets in one task, and no pair that could link is skipped.

Frequent shingles are those that repeat inside slices of the corpus; they fix
the order of shingles only, and any order gives the same components.

Defined results: null and wordless texts have no shingles and link with nothing;
a document with fewer words than a shingle has its whole sequence as its only
shingle. A document without id is a document like others, but a component is
named by the smallest id in it, and by null if it has none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workdir import work_folder, stage
from .graph import connected_components, settled
from .words import NOT_SPACE, Words, give_back, mix, shingle_sets, slices

ORDERED_SHINGLES = 1 << 17      # size of the table that puts frequent shingles last
REPEATS = 3                     # repeats inside a slice that make a shingle frequent
LIST_WEIGHT = 6                 # cost of a list entry, with its comparisons, in subsets
SMALL_AT_MOST = 48              # sizes tried as the boundary
SHORT_LIST = 48                 # lists up to this length are compared by a join
BLOCK_BYTES = 4 << 20           # of shingles in a block of a long list
SET_BYTES = 1 << 18             # of text whose shingles are made at once
BROADCAST_ROWS = 1_000_000      # of 8-byte keys that may be broadcast


class Similarity:
    """Jaccard similarity of at least ``over`` / ``under``."""

    def __init__(self, over: int, under: int):
        self.over, self.under = over, under

    def overlap(self, r: int, s: int) -> int:
        """Shingles that sets of sizes r and s must share."""
        return -(-self.over * (r + s) // (self.over + self.under))

    def smallest(self, r: int) -> int:
        return -(-self.over * r // self.under)

    def largest(self, r: int) -> int:
        return self.under * r // self.over

    def prefix(self, r: int) -> int:
        return r - self.smallest(r) + 1

    def subsets(self, size: int, boundary: int) -> list[tuple[int, int, int]]:
        """(smaller size, larger size, subset size) for each partner size up to the boundary."""
        partners = range(max(1, self.smallest(size)), min(boundary, self.largest(size)) + 1)
        return [(min(size, s), max(size, s), self.overlap(size, s)) for s in partners
                if self.overlap(size, s) <= min(size, s)]

    def subset_count(self, size: int, boundary: int) -> int:
        return sum(math.comb(size, o) for _, _, o in self.subsets(size, boundary))

    def band(self, size: str):
        """Sizes in reach of each other are in one band or in neighbouring ones."""
        return F.floor(F.log(F.col(size).cast("double")) / math.log(self.under / self.over) + 1e-9).cast("int") if (
            self.under > self.over) else F.col(size).cast("int")

    def sizes_fit(self, left: str, right: str):
        return ((F.col(left) * self.under >= F.col(right) * self.over)
                & (F.col(right) * self.under >= F.col(left) * self.over))


def boundary_by_cost(sizes: dict[int, int], similarity: Similarity) -> int:
    """Largest size that enumerates subsets, so that subsets and list entries cost least together.

    ``sizes`` counts sets by size; all sizes above ``SMALL_AT_MOST`` are in lists anyway.
    """
    def cost(boundary: int) -> int:
        listed = similarity.smallest(boundary + 1)
        return sum(count * ((similarity.subset_count(size, boundary) if size <= boundary else 0)
                            + (LIST_WEIGHT * similarity.prefix(size) if size >= listed else 0))
                   for size, count in sizes.items())
    return min(range(SMALL_AT_MOST + 1), key=cost)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """One bit for each residue of the hashes: whether an odd number of shingles has it.

    Two sketches differ in at most as many bits as the sets differ in shingles, and
    a sketch of half the length is the exclusive or of the halves.
    """
    bits = 1 << min(16, max(8, (len(shingles) - 1).bit_length()))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing_bits(left: np.ndarray, right: np.ndarray) -> int:
    """Least number of shingles that are in one of two sets only, by their sketches."""
    while len(left) > len(right):
        left = left[:len(left) // 2] ^ left[len(left) // 2:]
    while len(right) > len(left):
        right = right[:len(right) // 2] ^ right[len(right) // 2:]
    return int(np.bitwise_count(left ^ right).sum())


def set_name(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = 3, similarity: Similarity | None = None, with_hash: bool = False) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id`` for every row of ``docs``; and ``hash`` of its text, if wanted."""
    similarity = similarity or Similarity(90, 100)
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = texts.select("id", F.coalesce("id", F.xxhash64("text")).alias("row"), "text", F.xxhash64("text").alias("hash"))
    with work_folder(spark, "jaccard") as folder:
        profiles = stage(_profiles(texts, shingle), "profiles", folder)
        sets = profiles.where("size > 0").groupBy("name").agg(F.min("id").alias("id"), F.first("size").alias("size"))
        counts = {r["n"]: r["count"] for r in
                  sets.groupBy(F.least("size", F.lit(SMALL_AT_MOST + 1)).alias("n")).count().collect()}
        boundary = boundary_by_cost(counts, similarity)
        keys = _keys(texts, shingle, similarity, boundary, _frequent(profiles)).dropDuplicates(["name"])
        keys = stage(keys.withColumn("set", F.monotonically_increasing_id()), "keys", folder)
        links = stage(_subset_links(keys), "subsets", folder)
        links = _list_links(texts, shingle, similarity, keys, links, folder)
        named = connected_components(links).withColumnRenamed("node", "set")
        lowest = (sets.join(keys.select("name", "set"), "name").join(named, "set", "left")
                  .select("name", "id", F.coalesce("component", "set").alias("component")))
        names = lowest.groupBy("component").agg(F.min("id").alias("component_id"))
        of_set = lowest.join(names, "component").select("name", "component_id")
        out = (profiles.join(of_set, "name", "left")
               .select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"),
                       F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
                       *(["hash"] if with_hash else [])))
        return settled(out)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                similarity: Similarity | None = None) -> DataFrame:
    """The rows of ``docs`` without near-duplicates, with all their columns.

    Of each component the row with the smallest id stays; of different rows with
    that id, the one with the smallest hash of its text; of rows with the same id
    and text, any one. Rows without words stay, and so do different texts of a
    component in which no row has an id.
    """
    similarity = similarity or Similarity(4, 5)
    found = jaccard_components(docs, id_col, text_col, shingle, similarity, with_hash=True)
    named = found.where("n_shingles > 0")
    first = named.where(F.col(id_col) == F.col("component_id")).groupBy("component_id").agg(F.min("hash").alias("first"))
    gone = named.join(first, "component_id").where(
        ~(F.col(id_col).eqNullSafe(F.col("component_id")) & (F.col("hash") == F.col("first"))))
    gone = settled(gone.select(F.col(id_col).alias("gone_id"), F.col("hash").alias("gone_hash")).distinct())
    repeated = settled(named.groupBy(F.col(id_col).alias("gone_id"), F.col("hash").alias("gone_hash")).count().where("count > 1")
                       .join(gone, ["gone_id", "gone_hash"], "left_anti").select("gone_id", "gone_hash"))

    def rows(keys: DataFrame, how: str) -> DataFrame:
        keys = F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys
        match = F.col(id_col).cast("long").eqNullSafe(keys["gone_id"]) & F.xxhash64(text_col).eqNullSafe(keys["gone_hash"])
        return docs.join(keys, match, how)

    if repeated.isEmpty():
        return rows(gone, "left_anti")
    once = rows(repeated, "left_semi").dropDuplicates([id_col, text_col])
    return rows(gone.unionByName(repeated), "left_anti").unionByName(once)


def _profiles(texts: DataFrame, shingle: int) -> DataFrame:
    """Set key and size of each document; the first of a slice also has the slice's frequent shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [s for few in slices(part, "text", SET_BYTES)
                         for s in shingle_sets(Words(few.column(2), NOT_SPACE), shingle)]
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                often = counts >= REPEATS
                frequent = [{"shingle": h, "n": c} for h, c in
                            zip(values[often].view(np.int64).tolist(), counts[often].tolist())]
                yield pa.RecordBatch.from_arrays([
                    part.column(0), part.column(1), part.column(3), pa.array([len(s) for s in found], pa.int64()),
                    pa.array([set_name(s) if len(s) else None for s in found], pa.binary()),
                    pa.array([frequent] + [None] * (len(found) - 1),
                             pa.list_(pa.struct([("shingle", pa.int64()), ("n", pa.int64())])))],
                    names=["id", "row", "hash", "size", "name", "frequent"])

    return texts.mapInArrow(run, "id long, row long, hash long, size long, name binary, frequent array<struct<shingle:long,n:long>>")


def _frequent(profiles: DataFrame):
    """The most frequent shingles, rarest first, broadcast: an ordering table of fixed largest size."""
    top = (profiles.select(F.explode("frequent").alias("f")).groupBy("f.shingle").agg(F.sum("f.n").alias("n"))
           .orderBy(F.desc("n"), "shingle").limit(ORDERED_SHINGLES).collect())
    shingles = np.array([r.shingle for r in reversed(top)], dtype=np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return profiles.sparkSession.sparkContext.broadcast((shingles[order], order))


def prefix_of(shingles: np.ndarray, length: int, frequent: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """First ``length`` shingles in the order: infrequent ones by hash, then frequent ones from rare to common."""
    if not len(frequent):
        return shingles[:length]
    at = np.minimum(np.searchsorted(frequent, shingles), len(frequent) - 1)
    common = frequent[at] == shingles
    rare = shingles[~common]
    if len(rare) >= length:
        return rare[:length]
    rest = shingles[common][np.argsort(ranks[at[common]])]
    return np.concatenate([rare, rest[:length - len(rare)]])


def _keys(texts: DataFrame, shingle: int, similarity: Similarity, boundary: int, frequent) -> DataFrame:
    """Prefix and subset keys of each document's set."""
    listed = similarity.smallest(boundary + 1)
    picks = {size: [(r, s, np.array(list(combinations(range(size), size - o)), dtype=np.int64)
                     .reshape(math.comb(size, o), size - o))
                    for r, s, o in similarity.subsets(size, boundary)] for size in range(1, boundary + 1)}

    def subsets(shingles: np.ndarray) -> list[dict]:
        values = mix(shingles)
        total = values.sum(dtype=np.uint64)
        return [{"small": r, "large": s, "value": v} for r, s, left_out in picks[len(shingles)]
                for v in mix(total - values[left_out].sum(axis=1, dtype=np.uint64)).view(np.int64).tolist()]

    subset_type = pa.list_(pa.struct([("small", pa.int32()), ("large", pa.int32()), ("value", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SET_BYTES):
                found = list(shingle_sets(Words(part.column(2), NOT_SPACE), shingle))
                keep = np.array([len(s) > 0 for s in found])
                found = [s for s in found if len(s)]
                prefixes = [prefix_of(s, similarity.prefix(len(s)), *frequent.value).view(np.int64)
                            if len(s) >= listed else None for s in found]
                yield pa.RecordBatch.from_arrays([
                    part.column(1).filter(pa.array(keep)), pa.array([len(s) for s in found], pa.int64()),
                    pa.array([set_name(s) for s in found], pa.binary()),
                    pa.array([parity_sketch(s) for s in found], pa.binary()), pa.array(prefixes, pa.list_(pa.int64())),
                    pa.array([subsets(s) if len(s) <= boundary else None for s in found], subset_type)],
                    names=["row", "size", "name", "sketch", "prefix", "subsets"])

    return texts.mapInArrow(run, "row long, size long, name binary, sketch binary, prefix array<long>,"
                                 "subsets array<struct<small:int,large:int,value:long>>")


def _subset_links(keys: DataFrame) -> DataFrame:
    """Each small set with a partner of the other size in every subset they share."""
    rows = keys.select("set", "size", F.explode("subsets").alias("k")).select("set", "size", "k.*")
    of = lambda size: F.min(F.when(F.col("size") == F.col(size), F.col("set")))
    groups = (rows.groupBy("small", "large", "value")
              .agg(of("small").alias("x"), of("large").alias("y"), F.count(F.lit(1)).alias("n"))
              .where("n > 1 AND x IS NOT NULL AND y IS NOT NULL").drop("n"))
    joined = rows.join(groups, ["small", "large", "value"])
    partner = F.when((F.col("size") == F.col("small")) & (F.col("small") < F.col("large")), F.col("y")).otherwise(F.col("x"))
    return joined.select(F.col("set").alias("a"), partner.alias("b")).where("a <> b").distinct()


def _list_links(texts: DataFrame, shingle: int, similarity: Similarity, keys: DataFrame, links: DataFrame,
                folder: str) -> DataFrame:
    """``links`` and those found in the inverted lists."""
    entries = keys.select("set", "size", F.posexplode("prefix").alias("at", "list"))
    entries = _in_lists(entries, folder, "shared")
    # A list is cut into bands of sizes; each set is in its own band and in the next, and ``home`` is its own.
    entries = entries.withColumn("home", F.explode(F.array(F.lit(True), F.lit(False)))).withColumn(
        "list", F.xxhash64("list", similarity.band("size") + F.when(F.col("home"), 0).otherwise(1)))
    entries = _in_lists(entries, folder, "banded")
    heads = entries.groupBy("list").agg(F.sum("size").alias("total"), F.min(F.struct("set", "size", "at")).alias("head"))
    entries = stage(entries.join(heads, "list"), "entries", folder)
    of_head = [F.col(f"head.{c}").alias(f"{c}_a") for c in ("set", "size", "at")]
    of_set = [F.col(c).alias(f"{c}_b") for c in ("set", "size", "at")]
    stars = stage(_with_room(entries.select(*of_head, *of_set).where("set_a <> set_b"), similarity), "near", folder)
    stars = stage(_sketches_close(stars, keys, similarity), "close", folder)
    links = links.unionByName(stage(_verified(texts, shingle, keys, stars, similarity), "stars", folder))

    named = connected_components(links).withColumnRenamed("node", "set")
    entries = entries.drop("head").join(named, "set", "left").withColumn("component", F.coalesce("component", "set"))
    open_lists = (entries.groupBy("list").agg(F.min("component").alias("low"), F.max("component").alias("high"))
                  .where("low <> high").select("list"))
    entries = stage(entries.join(open_lists, "list"), "open", folder)
    pairs = stage(_short_list_pairs(entries.where(F.col("n") <= SHORT_LIST), similarity), "met", folder)
    pairs = stage(_sketches_close(pairs, keys, similarity), "alike", folder)
    links = links.unionByName(stage(_verified(texts, shingle, keys, pairs, similarity), "pairs", folder))
    long_lists = entries.where(F.col("n") > SHORT_LIST)
    return links.unionByName(stage(_long_list_links(texts, shingle, keys, long_lists, similarity), "blocks", folder))


def _in_lists(entries: DataFrame, folder: str, purpose: str) -> DataFrame:
    """Entries of lists with two and more, and their number ``n``; what stands alone is not shuffled with its columns."""
    lists = stage(entries.groupBy("list").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), f"{purpose}-lists", folder)
    lists = F.broadcast(lists) if lists.count() <= BROADCAST_ROWS else lists
    return stage(entries.drop("n").join(lists, "list"), purpose, folder)


def _sketches_close(pairs: DataFrame, keys: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs that do not differ in more shingles than sets of their similarity can; none of those is left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for r, s, x, y in zip(*(batch.column(k).to_pylist() for k in range(2, 6))):
                bits = differing_bits(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
                keep.append(bits <= r + s - 2 * similarity.overlap(r, s))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    side = lambda k: keys.select(
        F.col("set").alias(k), F.col("size").alias(f"size_{k}"), F.col("sketch").alias(f"sketch_{k}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b")
            .mapInArrow(run, "a long, b long"))


def _with_room(pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs whose sizes fit and whose places in the lists they share leave room for the overlap.

    ``pairs`` has a row for each list shared. For a pair with all its lists the
    test is exact: nothing that could reach the similarity is left out.
    """
    met = (pairs.where(similarity.sizes_fit("size_a", "size_b")).groupBy("set_a", "set_b", "size_a", "size_b")
           .agg(F.count(F.lit(1)).alias("n"), F.max("at_a").alias("at_a"), F.max("at_b").alias("at_b")))
    room = F.col("n") + F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b")) - 1
    needed = (F.col("size_a") + F.col("size_b")) * similarity.over
    return (met.where(room * (similarity.over + similarity.under) >= needed)
            .select(F.col("set_a").alias("a"), F.col("set_b").alias("b")))


def _sets(texts: DataFrame, shingle: int, keys: DataFrame, wanted: DataFrame) -> DataFrame:
    """Shingles of some sets, one row for each, taken from the texts again rather than kept for all."""
    rows = keys.join(wanted.distinct(), "set", "left_semi").select("row", "name", "set")
    rows = F.broadcast(rows) if wanted.distinct().count() <= BROADCAST_ROWS // 4 else rows
    texts = texts.join(rows, "row").select("text", "name", "set")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SET_BYTES):
                found = list(shingle_sets(Words(part.column(0), NOT_SPACE), shingle))
                mine = [set_name(s) == name for s, name in zip(found, part.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(2).filter(pa.array(mine, pa.bool_())),
                                                  pa.array([s.tobytes() for s, m in zip(found, mine) if m], pa.binary())],
                                                 names=["set", "shingles"])

    return texts.mapInArrow(run, "set long, shingles binary").dropDuplicates(["set"])


def _verified(texts: DataFrame, shingle: int, keys: DataFrame, pairs: DataFrame, similarity: Similarity) -> DataFrame:
    """The pairs that reach the similarity."""
    over, under = similarity.over, similarity.under
    wanted = pairs.select(F.col("a").alias("set")).unionByName(pairs.select(F.col("b").alias("set")))
    sets = _sets(texts, shingle, keys, wanted)
    left = sets.select(F.col("set").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("set").alias("b"), F.col("shingles").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
                both = np.sort(np.concatenate([x, y]))
                shared = int(np.count_nonzero(both[1:] == both[:-1]))
                keep.append(under * shared >= over * (len(x) + len(y) - shared))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
            give_back()

    return (pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
            .mapInArrow(run, "a long, b long"))


def _short_list_pairs(entries: DataFrame, similarity: Similarity) -> DataFrame:
    """Pairs of different components that meet in short lists."""
    side = lambda k: entries.select(
        "list", *[F.col(c).alias(f"{c}_{k}") for c in ("set", "size", "at", "home", "component")])
    pairs = (side("a").join(side("b"), "list").where("set_a < set_b AND component_a <> component_b")
             .where("home_a OR home_b"))  # a pair that shares two bands counts in one of them
    return _with_room(pairs, similarity)


def _long_list_links(texts: DataFrame, shingle: int, keys: DataFrame, entries: DataFrame,
                     similarity: Similarity) -> DataFrame:
    """Links that join components, from long lists cut into blocks; each pair of blocks is one group."""
    over, under = similarity.over, similarity.under
    sets = _sets(texts, shingle, keys, entries.select("set"))
    blocks = F.ceil(F.col("total") * 8 / BLOCK_BYTES).cast("int")
    dealt = (entries.withColumn("blocks", blocks)
             .withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("list", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "set", "component")
             .join(sets, "set"))

    def scan(group: pa.Table) -> pa.Table:
        links = joining_links(group["set"].to_pylist(), group["component"].to_pylist(),
                              [np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in group["shingles"]], over, under)
        give_back()
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("list", "i", "j").applyInArrow(scan, "a long, b long")


def joining_links(names: list, components: list, sets: list[np.ndarray], over: int, under: int) -> list[tuple]:
    """Links between sets of different groups, each of which joins two groups; inverted lists are scanned per set."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    groups = np.unique(np.array(components), return_inverse=True)[1]
    owners = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    bounds = np.searchsorted(column[order], np.arange(column.max() + 2))
    lists, starts, links = owners[order], np.concatenate([[0], np.cumsum(sizes)]), []
    for at in range(len(sets)):
        if (groups == groups[at]).all():
            continue
        mine = column[starts[at]:starts[at + 1]]
        shared = np.bincount(np.concatenate([lists[bounds[c]:bounds[c + 1]] for c in mine]), minlength=len(sets))
        close = under * shared >= over * (sizes[at] + sizes - shared)
        for other in np.flatnonzero(close & (groups != groups[at])):
            if groups[other] != groups[at]:
                links.append((names[at], names[other]))
                groups[groups == groups[other]] = groups[at]
    return links
