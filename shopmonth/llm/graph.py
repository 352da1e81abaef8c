"""Connected components of a link table, and the checkpoint that loops cut their lineage with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.workdir import shared_root


def settled(df: DataFrame) -> DataFrame:
    """Checkpoint in the shared folder; the session's own folder is used where it names one."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def connected_components(links: DataFrame) -> DataFrame:
    """``node`` and ``component``, the smallest node reachable, of every node of the links ``(a, b)``.

    Alternating large and small stars: each round hangs neighbours on the smallest
    node around, so a chain shrinks by half. A node's neighbours are only ever
    aggregated to their minimum, never gathered. Nodes without links are not
    returned; nulls and links of a node to itself are left out.
    """
    edges = _bare(links.select("a", "b"))
    edges = settled(edges)
    state = _state(edges)
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(lowest, "a").where("b > a AND b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        lowest = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(lowest, "a")
        edges = settled(_bare(hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
                              .unionByName(lowest.select("a", F.col("m").alias("b")))))
        before, state = state, _state(edges)
        if state == before:
            break
    leaves = edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def _bare(links: DataFrame) -> DataFrame:
    """Distinct links, each from its larger to its smaller node."""
    return (links.where("a <> b")
            .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
