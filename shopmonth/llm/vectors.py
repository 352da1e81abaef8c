"""Embedding near-duplicates by counting collisions of one-dimensional projections.

Vectors are compared within their label. Unit vectors are projected on many random
lines. On each line the vectors of a block are sorted, every query opens a window
around its own place, and each vector inside is one collision with it. A pair at
the threshold collides on a line with a probability known from the normal
distribution, so the count that such a pair reaches with probability ``recall``
follows from the binomial distribution, and so does the window. Pairs that reach
the count are verified by their cosine in double precision.

Equal vectors are one from the start. Each label is cut into blocks of bounded
size and each pair of blocks is one group, so a label with a third of all vectors
is many groups; what leaves a group is one count for each vector and the links
that join components, never all pairs. Work is quadratic in the different vectors
of a label, as it must be where random directions are all that separates pairs
(one line keeps a fifth of the far pairs at this threshold).

Defined results: a vector without label, null, empty, zero, of another length than
its label's first, or with null or non-finite components links with nothing; rows
that share an id are vectors of their own; a component is named by its smallest id.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workdir import stage, work_folder
from .graph import connected_components, settled

THRESHOLD = 0.93
LINES = 32
RECALL = 0.9999
BLOCK = 2048
SEED = 20240101


def calibrated(threshold: float, lines: int = LINES, recall: float = RECALL) -> tuple[float, int]:
    """Half width of the window, and the collisions that a pair at the threshold reaches with the given recall."""
    distance = math.sqrt(2 - 2 * threshold)
    chance = math.erf(1 / math.sqrt(2))  # a window of one standard deviation to each side
    below, count = 0.0, 0
    while True:
        below += math.comb(lines, count) * chance ** count * (1 - chance) ** (lines - count)
        if below > 1 - recall:
            return distance, count
        count += 1


def collisions(queries: np.ndarray, others: np.ndarray, half_width: float) -> np.ndarray:
    """Number of lines on which each other vector lies in the window of each query."""
    width = len(others)
    counts = np.zeros(len(queries) * width, dtype=np.uint8)
    rows = np.arange(len(queries)) * width
    small = np.int32 if len(counts) < 1 << 31 else np.int64
    for line in range(queries.shape[1]):
        order = np.argsort(others[:, line], kind="stable").astype(small)
        places = others[order, line]
        low = np.searchsorted(places, queries[:, line] - half_width, side="left")
        sizes = np.searchsorted(places, queries[:, line] + half_width, side="right") - low
        inside = np.repeat((low - np.cumsum(sizes) + sizes).astype(small), sizes)
        inside += np.arange(len(inside), dtype=small)
        at = order[inside]
        at += np.repeat(rows.astype(small), sizes)
        counts[at] += np.uint8(1)
    return counts.reshape(len(queries), width)


def linked_pairs(left: np.ndarray, right: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of pairs of rows whose cosine reaches the threshold; of one block, each pair once."""
    width, least = calibrated(threshold)
    lines = np.random.default_rng(SEED).standard_normal((left.shape[1], LINES))
    a, b = np.nonzero(collisions(left @ lines, right @ lines, width) >= least)
    if same:
        a, b = a[a < b], b[a < b]
    close = np.einsum("ij,ij->i", left[a], right[b]) >= threshold
    return a[close], b[close]


def unit(vectors: pd.Series) -> np.ndarray:
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    largest = np.abs(matrix).max(axis=1, keepdims=True)  # squares of very large or small numbers would be lost
    matrix = matrix / largest
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label", block: int = BLOCK) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every vector."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v"))
    sound = (F.col("label").isNotNull() & (F.size("v") > 0) & F.exists("v", lambda x: x != 0)
             & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)))
    with work_folder(vectors.sparkSession, "vectors") as folder:
        alike = rows.where("sound").groupBy("label", "v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"))
        alike = stage(alike.select("label", "v", "id", "copies", F.xxhash64("label", "v").alias("key")), "alike", folder)
        sizes = alike.groupBy("label", F.size("v").alias("length")).agg(F.count(F.lit(1)).alias("n"))
        blocks = sizes.select("label", "length", F.ceil(F.col("n") / block).cast("int").alias("blocks"))
        dealt = (alike.withColumn("length", F.size("v")).join(blocks, ["label", "length"])
                 .withColumn("block", F.pmod(F.col("key"), F.col("blocks")).cast("int"))
                 .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
                 .select("label", "length", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                         "block", "key", "copies", "v"))

        def compare(cell: pd.DataFrame) -> pd.DataFrame:
            i, j = cell["i"].iat[0], cell["j"].iat[0]
            left = cell[cell["block"] == i]
            right = cell[cell["block"] == j]
            if not len(left) or not len(right):
                return pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
            matrix = unit(left["v"])
            a, b = linked_pairs(matrix, matrix if i == j else unit(right["v"]), threshold, i == j)
            left_key, right_key = left["key"].to_numpy(), right["key"].to_numpy()
            counts = pd.concat([
                pd.Series(right["copies"].to_numpy()[b], index=left_key[a], dtype="int64"),
                pd.Series(left["copies"].to_numpy()[a], index=right_key[b], dtype="int64")]).groupby(level=0).sum()
            joined = forest(left_key[a], right_key[b])
            return pd.concat([
                pd.DataFrame({"a": counts.index.to_numpy("int64"), "b": pd.array([pd.NA] * len(counts), "Int64"), "n": counts.to_numpy("int64")}),
                pd.DataFrame({"a": [x for x, _ in joined], "b": pd.array([y for _, y in joined], "Int64"), "n": 0}).astype({"a": "int64"})])

        found = stage(dealt.groupBy("label", "length", "i", "j").applyInPandas(compare, "a long, b long, n long"), "found", folder)
        counts = found.where("b IS NULL").groupBy(F.col("a").alias("key")).agg(F.sum("n").alias("n"))
        named = connected_components(found.where("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "key")
        known = alike.join(counts, "key", "left").join(named, "key", "left").withColumn("component", F.coalesce("component", "key"))
        lowest = known.groupBy("component").agg(F.min("id").alias("component_id"))
        known = known.join(lowest, "component").select(
            "label", "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
        out = rows.join(known.withColumn("sound", F.lit(True)), ["sound", "label", "v"], "left")
        component = F.when(F.col("sound"), F.col("component_id")).otherwise(F.col("id"))
        return settled(out.select(
            F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(False)).alias("kept")))


def forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what all links connect, without a circle."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for x, y in zip(left.tolist(), right.tolist()):
        a, b = root(x), root(y)
        if a != b:
            parent[b] = a
            out.append((x, y))
    return out
