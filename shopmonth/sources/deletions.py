"""Deleted users of a month as marks, applied when the month is read.

A table partitioned by ``month`` stays as it is; a second table, partitioned alike, holds
one row for each deleted (month, user). Readers take the marked rows out with an anti join
on month and user. ``compact`` rewrites the months whose share of marked rows has grown
past a limit and drops their marks; no other file changes its name.

Marking twice adds nothing. A compaction that breaks off after a month was rewritten leaves
marks that find no row. Rows without a user are never marked. Writing a month anew makes
its marks void: call ``forget`` with it, or users marked before are missing from it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sinks import drop_path_month, write_months
from .storage import path_exists
from .workdir import stage, work_folder

COMPACT_SHARE = 0.2


class MarkedTable:
    """A table by ``month`` at ``path`` and the marks of its deleted users at ``marks_path``."""

    def __init__(self, spark: SparkSession, path: str, marks_path: str, user: str = "user_id"):
        self.spark, self.path, self.marks_path, self.user = spark, path, marks_path, user

    def stored(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def marks(self) -> DataFrame:
        """``user`` and ``month``, each pair once."""
        kind = self.stored().schema[self.user].dataType
        empty = self.spark.createDataFrame([], "month date").select(F.lit(None).cast(kind).alias(self.user), "month")
        if not path_exists(self.spark, self.marks_path):
            return empty
        return self.spark.read.schema(empty.schema).parquet(self.marks_path).distinct()

    def rows(self) -> DataFrame:
        """The rows that are not marked. Few marks are broadcast by the planner; many meet their rows by month and user."""
        stored = self.stored()
        return stored.join(self.marks(), ["month", self.user], "left_anti").select(*stored.columns)

    def mark(self, gone: DataFrame) -> None:
        """Add the pairs of ``month`` and user that are not marked yet."""
        pairs = gone.select(self.user, "month").dropna().distinct()
        new = pairs.join(self.marks(), ["month", self.user], "left_anti").select(self.user, "month")
        new.hint("rebalance", "month").write.mode("append").partitionBy("month").parquet(self.marks_path)

    def forget(self, months: Iterable[dt.date]) -> None:
        """Drop the marks of months that were written anew or dropped."""
        for month in months:
            drop_path_month(self.spark, self.marks_path, month)

    def drop(self, month: dt.date) -> None:
        drop_path_month(self.spark, self.path, month)
        self.forget([month])

    def marked_shares(self) -> DataFrame:
        """``month``, ``rows_before``, ``marked_rows`` and ``marked_users`` of the months with marks; users are counted before the join."""
        marks = self.marks()
        months = F.broadcast(marks.select("month").distinct())  # one row a month
        per_user = (self.stored().join(months, "month", "left_semi")
                    .groupBy("month", self.user).agg(F.count(F.lit(1)).alias("n")))
        found = per_user.join(marks.withColumn("marked", F.lit(True)), ["month", self.user], "left")
        return found.groupBy("month").agg(
            F.sum("n").alias("rows_before"), F.coalesce(F.sum(F.when(F.col("marked"), F.col("n"))), F.lit(0)).alias("marked_rows"),
            F.count_if("marked").alias("marked_users"))

    def compact(self, share: float = COMPACT_SHARE) -> list[dt.date]:
        """Rewrite the months with at least ``share`` of their rows marked; returns them."""
        due = self.marked_shares().where(F.col("marked_rows") >= share * F.col("rows_before")).select("month").collect()
        months = sorted(row.month for row in due)
        if months:
            with work_folder(self.spark, "compact") as folder:
                kept = stage(self.rows().where(F.col("month").isin(months)).hint("rebalance", "month"), "kept", folder)
                write_months(kept, self.path, months=months)
            self.forget(months)
        return months
