"""A table whose months are replaced as a whole, also by nothing, and read only when complete.

Rows lie below ``data/month=…/version=…``, one version for each write. Which version of a
month counts is said by a pointer, a row in a small table beside the data that is added
after the files are there. Readers join the newest pointers, so they see a month before a
write or after it, never between; a write that breaks off leaves files nobody points at.
Nothing is renamed, which suits object stores.

A write names its months. A named month without rows gets a pointer to a version without
files: the month is empty. Rows of other months are refused. Of two writers of one month
the later pointer counts; with equal numbers, the larger version name.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .storage import delete_path, list_names, path_exists

POINTERS = "month date, number long, version string"


class MonthTable:
    def __init__(self, spark: SparkSession, base: str, schema: T.StructType):
        """``schema`` holds the columns of the rows, ``month`` (a date) among them."""
        self.spark, self.schema = spark, schema
        self.data, self.pointer_path = f"{base.rstrip('/')}/data", f"{base.rstrip('/')}/pointers"

    def pointers(self) -> DataFrame:
        """``month, version`` of all months that were ever written and not dropped."""
        return self._newest().where("version IS NOT NULL").select("month", "version")

    def _newest(self) -> DataFrame:
        if not path_exists(self.spark, self.pointer_path):
            return self.spark.createDataFrame([], POINTERS)
        written = self.spark.read.schema(POINTERS).parquet(self.pointer_path)
        # A struct is larger by its number first; a null version would be the smallest of its number.
        newest = F.max(F.struct("number", F.coalesce("version", F.lit("")).alias("version")))
        return (written.groupBy("month").agg(newest.alias("newest"))
                .select("month", "newest.number", F.nullif("newest.version", F.lit("")).alias("version")))

    def rows(self) -> DataFrame:
        """All rows of the months that are pointed at."""
        if not path_exists(self.spark, self.data):
            return self.spark.createDataFrame([], self.schema)
        stored = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("version", T.StringType())])).parquet(self.data)
        # One pointer a month: small by construction, and the join prunes the folders of other versions.
        return stored.join(F.broadcast(self.pointers()), ["month", "version"], "left_semi").select(*self.schema.names)

    def replace(self, df: DataFrame, months: Iterable[dt.date]) -> str:
        """Make ``df`` the rows of ``months``; returns the version."""
        named, version = sorted(set(months)), uuid.uuid4().hex
        if not named:
            raise ValueError("name the months that the rows stand for")
        inside = F.coalesce(F.col("month").isin(named), F.lit(False))
        guarded = F.when(inside, F.col("month")).otherwise(F.raise_error(F.concat(
            F.lit("a row of another month: "), F.coalesce(F.col("month").cast("string"), F.lit("none")))).cast("date"))
        rows = df.select(*self.schema.names).withColumn("month", guarded)
        rows.withColumn("version", F.lit(version)).write.mode("append").partitionBy("month", "version").parquet(self.data)
        self._point(named, version)
        return version

    def drop(self, months: Iterable[dt.date]) -> None:
        """The months are there no longer; their files stay until ``vacuum``."""
        self._point(sorted(set(months)), None)

    def _point(self, months: list[dt.date], version: str | None) -> None:
        last = self._newest().agg(F.max("number")).first()[0] or 0
        self.spark.createDataFrame([(month, last + 1, version) for month in months], POINTERS).coalesce(1).write.mode("append").parquet(self.pointer_path)

    def vacuum(self) -> int:
        """Delete versions that no pointer names; returns how many. Not to be run while others write or read."""
        wanted = {(f"month={r.month.isoformat()}", f"version={r.version}") for r in self.pointers().collect()}
        gone = 0
        for month in (n for n in list_names(self.spark, self.data) if n.startswith("month=")):
            for version in list_names(self.spark, f"{self.data}/{month}"):
                if (month, version) not in wanted:
                    gone += delete_path(self.spark, f"{self.data}/{month}/{version}")
        return gone
