"""A bootstrap sample and a silhouette that depend on rows and seed, not on partitions."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .evaluation import SILHOUETTE_SAMPLE

ROWS_PER_RANGE = 1 << 16  # about so many rows are ranked together
BLOCK_ROWS = 1_000


def _hash(*parts):
    return F.md5(F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))


def bootstrap_by_rank(df: DataFrame, key: str = "user_id", rows: int = SILHOUETTE_SAMPLE, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows drawn with replacement, numbered by ``draw``; the same whatever the partitions.

    Rows are ranked by a hash of their key. Ranges of the hash are counted first, so ranks
    come from many small windows and the offsets of the ranges, and nothing is sorted as a
    whole. Draw j takes the row at a rank that is a hash of seed and j. ``key`` should name
    a row; rows with one key are ranked by all their columns. An empty table gives no rows.
    """
    total = df.count()
    digits = max(1, math.ceil(math.log(max(total / ROWS_PER_RANGE, 1), 16)))
    named = df.withColumn("_hash", _hash(F.lit(seed), F.col(key))).withColumn("_range", F.substring("_hash", 1, digits))
    counts = named.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row for each range, a small table.
    before = counts.select("_range", (F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_range").orderBy("_hash", F.xxhash64(*[F.col(c) for c in df.columns]))
    ranked = (named.withColumn("_place", F.row_number().over(inside) - 1).join(before, "_range")
              .withColumn("_rank", F.col("_before") + F.col("_place")))
    number = F.conv(F.substring(_hash(F.lit(seed), F.lit("draw"), F.col("id")), 1, 15), 16, 10).cast("long")
    draws = df.sparkSession.range(rows if total else 0).select(F.col("id").alias("draw"), (number % F.lit(max(total, 1))).alias("_rank"))
    return ranked.join(draws, "_rank").select("draw", *df.columns)


def pairwise_silhouette(sample: DataFrame, vector: str, cluster: str = "cluster", row: str = "draw",
                        block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``row, cluster, silhouette`` with plain Euclidean distances between all rows of a sample.

    Rows are dealt to blocks of about ``block_rows``. Each pair of blocks is a task of its own,
    which adds up the distances from every row to every cluster, so no task holds more than
    two blocks and no matrix exists. The work is the square of the sample: hand in a bounded
    one, stored. ``vector`` is an array of doubles without nulls, ``row`` names the rows.

    A row alone in its cluster, and one at distance 0 from everything, has 0. With a
    single cluster the silhouettes are null.
    """
    sizes = sample.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))  # one row for each cluster
    blocks = max(1, math.ceil(sample.count() / block_rows))
    rows = sample.select(F.col(row).alias("row"), F.col(cluster).alias("own"), F.col(vector).alias("vector"),
                         F.pmod(F.xxhash64(row), F.lit(blocks)).alias("block"))
    others = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))
    left = rows.select("row", "own", "vector", F.col("block").alias("a"), others.alias("b"))
    right = rows.select(F.col("own").alias("other"), "vector", F.col("block").alias("b"), others.alias("a"))

    def distances(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(mine) and len(theirs):
            x, y = np.stack(mine["vector"]), np.stack(theirs["vector"])
            for other, places in theirs.reset_index(drop=True).groupby("other").groups.items():
                total = np.zeros(len(x))
                for start in range(0, len(places), 256):
                    part = y[places[start:start + 256]]
                    total += np.sqrt(((x[:, None, :] - part[None, :, :]) ** 2).sum(2)).sum(1)
                out.append(pd.DataFrame({"row": mine["row"].to_numpy(), "own": mine["own"].to_numpy(), "other": other, "total": total}))
        return pd.concat(out) if out else pd.DataFrame({"row": [], "own": [], "other": [], "total": []})

    kinds = f"row {sample.schema[row].dataType.simpleString()}, own int, other int, total double"
    sums = (left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInPandas(distances, kinds)
            .groupBy("row", "own", "other").agg(F.sum("total").alias("total")))
    known = sums.join(F.broadcast(sizes.withColumnRenamed(cluster, "other")), "other")
    per_row = known.groupBy("row", "own").agg(
        F.max(F.when(F.col("own") == F.col("other"), F.col("n"))).alias("size"),
        F.max(F.when((F.col("own") == F.col("other")) & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("near"),
        F.min(F.when(F.col("own") != F.col("other"), F.col("total") / F.col("n"))).alias("far"))
    widest = F.greatest("near", "far")
    value = (F.when(F.col("far").isNull(), None).when((F.col("size") == 1) | (widest == 0), 0.0)
             .otherwise((F.col("far") - F.col("near")) / widest))
    return per_row.select(F.col("row").alias(row), F.col("own").alias(cluster), value.cast("double").alias("silhouette"))
