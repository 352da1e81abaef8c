"""Incremental ingest: every landed file is taken exactly once, into a table or into months that are rebuilt."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.files import CSV_QUOTING
from ..sources.schema import RAW_EVENTS
from ..sources.sinks import write_months
from ..sources.storage import path_exists


def ingest_landed(spark: SparkSession, landing: str, table: str, checkpoint: str,
                  schema: T.StructType = RAW_EVENTS, file_format: str = "csv",
                  options: Mapping[str, str] | None = None,
                  transform: Callable[[DataFrame], DataFrame] | None = None,
                  partition_by: Sequence[str] = (), files_per_batch: int = 1000) -> None:
    """Append the files not seen before to a Parquet table.

    The checkpoint remembers what was read and the sink's log what was committed,
    so a rerun adds nothing and a run broken off halfway resumes without
    duplicates. ``files_per_batch`` bounds the work of one micro-batch, not of
    the run.
    """
    source = _landed_stream(spark, landing, schema, file_format, options, files_per_batch)
    rows = transform(source) if transform else source
    query = (rows.writeStream.format("parquet").outputMode("append").partitionBy(*partition_by)
             .option("path", table).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def _landed_stream(spark: SparkSession, landing: str, schema: T.StructType, file_format: str,
                   options: Mapping[str, str] | None, files_per_batch: int) -> DataFrame:
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        # A file whose header differs from the schema fails the run instead of shifting its columns.
        reader = reader.options(**CSV_QUOTING).option("header", True).option("enforceSchema", False)
    return reader.options(**dict(options or {})).option("maxFilesPerTrigger", files_per_batch).load(landing)


BATCH_LEDGER = "month date, batch long"


def batch_ledger(spark: SparkSession, path: str) -> DataFrame:
    """``month, batch`` of every month a finished batch brought rows of."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], BATCH_LEDGER)
    return spark.read.schema(BATCH_LEDGER).parquet(path).distinct()


def ingest_months(spark: SparkSession, landing: str, base: str, month: Column,
                  rebuild: Callable[[DataFrame, dt.date], None], schema: T.StructType = RAW_EVENTS,
                  file_format: str = "csv", options: Mapping[str, str] | None = None,
                  files_per_batch: int = 1000) -> None:
    """Take the files not seen before, and rebuild the months they bring rows of.

    A batch's rows go to ``{base}/raw/month=…/batch=…``. Then ``rebuild(rows, month)`` is
    called for each of its months with all rows of that month, those of earlier batches
    included, so a late file opens a month again. The entries of the ledger come last.

    A batch that broke off comes again with the same number and the same files: its
    partitions are replaced by equal ones, its months rebuilt, its entries added if they
    are absent. ``rebuild`` must replace its month as a whole. Rows whose month is null are
    kept below Hive's name for null and belong to no month.
    """
    raw, ledger = f"{base}/raw", f"{base}/ledger"

    def take(rows: DataFrame, batch: int) -> None:
        own = rows.sparkSession
        landed = rows.withColumns({"month": month, "batch": F.lit(batch)})
        write_months(landed.hint("rebalance", "month"), raw, ("month", "batch"))
        stored = own.read.schema(T.StructType([*schema.fields, T.StructField("month", T.DateType()),
                                               T.StructField("batch", T.LongType())])).parquet(raw)
        touched = [row.month for row in stored.where(F.col("batch") == batch).select("month").distinct().collect()]
        for one in sorted(m for m in touched if m is not None):
            rebuild(stored.where(F.col("month") == F.lit(one)).select(*schema.names), one)
        entries = own.createDataFrame([(m, batch) for m in touched if m is not None], BATCH_LEDGER)
        absent = entries.join(batch_ledger(own, ledger), ["month", "batch"], "left_anti")
        absent.coalesce(1).write.mode("append").parquet(ledger)

    source = _landed_stream(spark, landing, schema, file_format, options, files_per_batch)
    query = (source.writeStream.foreachBatch(take).option("checkpointLocation", f"{base}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
