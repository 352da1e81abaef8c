"""File scans. Any Hadoop scheme works as a base path."""

from __future__ import annotations

import csv
import datetime as dt
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.months import CSV_SUFFIXES, landed_stem, month_from_label
from .schema import KEY_COLUMNS, RAW_EVENTS
from .storage import encoded_path, first_line, list_files

# Two quotes inside a quoted value are one quote; nothing else is escaped.
CSV_QUOTING = {"quote": '"', "escape": '"'}
DRIVER_FILES = 16  # up to so many headers are read faster by the driver than by a job
WHOLE_FILE = 1 << 40


def csv_header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file; reads its first line only."""
    return header_names(first_line(spark, path), path)


def csv_headers(spark: SparkSession, paths: Sequence[str], driver_files: int = DRIVER_FILES) -> dict[str, tuple[str, ...]]:
    """Column names of each file. More than ``driver_files`` files are opened by one job, a task for each, all at once."""
    if len(paths) <= driver_files:
        return {path: csv_header(spark, path) for path in paths}
    lines = first_lines(spark, paths)
    return {path: header_names(lines.get(plain_path(path), ""), path) for path in paths}


def header_names(line: str, path: str) -> tuple[str, ...]:
    names = tuple(name.strip() for name in next(csv.reader([line.removeprefix("﻿")]), []))
    if len(set(map(str.lower, names))) < len(names):
        raise ValueError(f"{path} names a column twice: {', '.join(names)}")
    return names


def plain_path(path: str) -> str:
    """Path without scheme and authority."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """First line of each text file by its ``plain_path``; a file without bytes is not there.

    The split size of a session of its own makes each file one partition, and a task
    hands back one line and stops reading. What comes to the driver is a line a file,
    as the list of files did before.
    """
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", WHOLE_FILE)
    own.conf.set("spark.sql.files.openCostInBytes", WHOLE_FILE)
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
    lines = own.read.text(list(paths)).select(F.col("_metadata.file_path").alias("file"), "value")
    return {unquote(plain_path(row.file)): row.value for row in lines.mapInArrow(first, "file string, value string").collect()}


def read_events_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType = RAW_EVENTS,
                    mode: str = "PERMISSIVE", null_value: str = "", required: Iterable[str] | None = None,
                    multi_line: bool = False, path_column: str | None = None) -> DataFrame:
    """Typed CSV scan by header name; no inference pass over the files.

    Columns of ``schema`` come first, in its order and with its types, and are
    null where a file lacks them; all others follow as text. Files of one layout
    share a scan, whatever the order of their columns. A file without one of
    ``required`` (by default the schema's key columns) raises, and so does a path
    without files. ``multi_line`` allows line breaks inside quoted text, as our
    own exports may have; such files are not split. Empty text reads as null.
    ``path_column`` adds the URI of each row's file.
    """
    found = [name for one in ([path] if isinstance(path, str) else path) for name in list_files(spark, one, CSV_SUFFIXES)]
    if not found:
        raise FileNotFoundError(f"no CSV file at {path}")
    required = [c for c in KEY_COLUMNS if c in schema.names] if required is None else list(required)
    layouts: dict[tuple[str, ...], list[str]] = {}
    for name, header in csv_headers(spark, found).items():
        layouts.setdefault(header, []).append(name)
    known = {field.name.lower(): field for field in schema.fields}
    scans = []
    for header, names in layouts.items():
        missing = [c for c in required if c.lower() not in map(str.lower, header)]
        if missing:
            raise ValueError(f"{names[0]} lacks the columns {', '.join(missing)}")
        typed = T.StructType([T.StructField(known[c.lower()].name, known[c.lower()].dataType) if c.lower() in known
                              else T.StructField(c, T.StringType()) for c in header])
        scan = (spark.read.schema(typed).options(**CSV_QUOTING).option("header", True).option("enforceSchema", False)
                .option("mode", mode).option("nullValue", null_value).option("multiLine", multi_line).csv(names))
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in typed.names]
        uri = [F.col("_metadata.file_path").alias(path_column)] if path_column else []
        scans.append(scan.select("*", *absent, *uri))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return rows.select(*schema.names, *[c for c in rows.columns if c not in schema.names])


def read_exported_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What ``export_csv``, ``append_csv`` or ``export_csv_file`` wrote, line breaks included."""
    return read_events_csv(spark, path, schema, required=schema.names, multi_line=True)


def landed_files(spark: SparkSession, base: str, month: dt.date) -> list[str]:
    """Files of one month: ``2019-Oct.csv.gz`` or ``2019-Oct.csv``, and all CSV files below ``2019-Oct/``."""
    stem = f"{base.rstrip('/')}/{landed_stem(month)}"
    return [name for place in (f"{stem}.csv.gz", f"{stem}.csv", stem) for name in list_files(spark, place, CSV_SUFFIXES)]


def read_landed_month(spark: SparkSession, base: str, month: dt.date,
                      schema: T.StructType = RAW_EVENTS) -> DataFrame:
    """The landed rows of one month, from one file or many; a month without files raises."""
    found = landed_files(spark, base, month)
    if not found:
        raise FileNotFoundError(f"no file of {landed_stem(month)} below {base}")
    return read_events_csv(spark, found, schema)


def read_landed_folder(spark: SparkSession, base: str,
                       schema: T.StructType = RAW_EVENTS) -> DataFrame:
    """All CSV files below a folder, with their path relative to it and their month.

    The month comes from names like ``2019-Oct.csv.gz``, or from a folder of that
    name; other files give null.
    """
    rows = read_events_csv(spark, base, schema, path_column="source_file")
    named = rows.withColumn("source_file", relative_name(F.col("source_file"), encoded_path(spark, base)))
    return named.withColumn("month", month_of_path("source_file"))


def relative_name(uri: Column, base_path: str) -> Column:
    """Path below the base, decoded; both are compared as they are encoded in URIs, without scheme and authority."""
    base = base_path.rstrip("/") + "/"
    path = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    rest = F.substring(path, len(base) + 1, 1 << 30)
    return F.when(F.startswith(path, F.lit(base)), F.url_decode(F.replace(rest, F.lit("+"), F.lit("%2B"))))


def month_of_path(column: str) -> Column:
    """Month of ``2019-Oct.csv.gz`` or of the nearest folder ``2019-Oct`` above a file."""
    by_name = month_from_label(F.regexp_extract(column, r"([^/.]+)\.[^/]*$", 1))
    return F.coalesce(by_name, month_from_label(F.regexp_extract(column, r"(?:^|.*/)(\d{4}-[A-Z][a-z]{2})/", 1)))


def read_month(table: DataFrame, month: dt.date) -> DataFrame:
    """One month of a month-partitioned table; prunes to its partition."""
    return table.where(F.col("month") == F.lit(month))


def head_rows(df: DataFrame, count: int, order_by: str | None = None) -> DataFrame:
    """First rows; with a key to order by, the same rows on every run."""
    return df.orderBy(order_by).limit(count) if order_by else df.limit(count)


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name and type."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, column_type string")
