"""Joins of the event table with a table that has one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
HOT_SHARE = 1e-4   # at most this; less where there are more shuffle partitions
HOT_ROWS = 1_000_000

_ROW_OVERHEAD = 32
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def size_bound(df: DataFrame) -> int | None:
    """Upper bound of a frame's size in memory, from its row count and longest texts.

    None when a column's type gives no bound.
    """
    fixed = _ROW_OVERHEAD
    longest = []
    for field in df.schema.fields:
        fixed += 16
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            longest.append(F.coalesce(F.max(F.octet_length(F.col(field.name))), F.lit(0)))
        elif not isinstance(field.dataType, _FIXED_WIDTH):
            return None
    rows, *lengths = df.agg(F.count(F.lit(1)), *longest).first()
    return rows * (fixed + sum(lengths))


def hot_keys(facts: DataFrame, key: str, share: float | None = None, min_rows: int = HOT_ROWS) -> list:
    """Keys that hold more than ``share`` of all rows and more than ``min_rows``, null included.

    By default the share is that of one shuffle partition, so that no key alone
    outweighs a partition. There are fewer than ``1 / share`` of them by
    construction, so the list is bounded; the counts are combined in the map
    tasks, and the total comes from the same pass.
    """
    if share is None:
        share = min(HOT_SHARE, 1 / max(1, int(facts.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    large = counts.agg(F.sum("n").alias("total"), F.max("n").alias("largest")).first()
    bound = max((large.total or 0) * share, min_rows)
    if (large.largest or 0) <= bound:
        return []
    return [row[0] for row in counts.where(F.col("n") > bound).select(key).collect()]


def join_facts(facts: DataFrame, dim: DataFrame, key: str, how: str = "left",
               broadcast_bytes: int = BROADCAST_BYTES, hot_share: float | None = None,
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """Join a large table with one that holds each key at most once.

    ``how`` is left, inner, left_semi or left_anti. When the measured size bound
    of ``dim`` allows it, it is broadcast and ``facts`` is not shuffled at all.
    Otherwise rows of hot keys (and rows without a key) meet the few matching
    ``dim`` rows by broadcast where they are, and only the rest is shuffled by
    key; without hot keys that is a plain join. Both inputs are read more than
    once, so hand in stored tables.
    """
    bound = size_bound(dim)
    if bound is not None and bound <= broadcast_bytes:
        return facts.join(F.broadcast(dim), key, how)
    hot = hot_keys(facts, key, hot_share, hot_rows)
    if not hot:
        return facts.join(dim, key, how)
    column = F.col(key)
    is_hot = column.isin([value for value in hot if value is not None])
    in_place = column.isNull() | is_hot
    return (facts.where(in_place).join(F.broadcast(dim.where(is_hot)), key, how)
            .unionByName(facts.where(~in_place).join(dim, key, how)))
