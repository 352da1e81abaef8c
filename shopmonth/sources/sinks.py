"""Sinks for monthly tables and exports."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .files import CSV_QUOTING
from .storage import delete_path, list_names, move_path


def write_months(df: DataFrame, path: str, partition_by: Sequence[str] = ("month",), months: Iterable[dt.date] = ()) -> None:
    """Replace the partitions present in ``df``, and empty those of ``months`` that it has no rows of; the others stay.

    Written files have new names, so a named month whose files are still the old ones got
    no rows: it is dropped without looking at the rows again.
    """
    spark = df.sparkSession
    before = {month: list_names(spark, _month_folder(path, month)) for month in months}
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))
    for month, files in before.items():
        if files and files == list_names(spark, _month_folder(path, month)):
            drop_path_month(spark, path, month)


def _month_folder(path: str, month: dt.date) -> str:
    return f"{path.rstrip('/')}/month={month.isoformat()}"


def write_month(df: DataFrame, path: str, month: dt.date) -> None:
    """Replace one month of a table partitioned by ``month``; without rows the month is emptied."""
    write_months(df.withColumn("month", F.lit(month)), path, months=[month])


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def append_csv(df: DataFrame, path: str) -> None:
    """Append gzip CSV parts; each part carries its own header."""
    _csv_writer(df, "append").csv(path)


def export_csv(df: DataFrame, path: str) -> None:
    """Gzip CSV export with as many parts as the plan has partitions."""
    _csv_writer(df, "overwrite").csv(path)


def _csv_writer(df: DataFrame, mode: str):
    # By default the CSV writer strips blanks around values and cuts times to milliseconds.
    return (df.write.mode(mode).options(**CSV_QUOTING).option("header", True).option("compression", "gzip")
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
            .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def export_csv_file(df: DataFrame, folder: str, name: str) -> str:
    """Export as one named gzip CSV file, for results a person downloads.

    One file means one writing task, whatever the size; ``export_csv`` writes the
    same rows in parallel.
    """
    spark = df.sparkSession
    parts = f"{folder.rstrip('/')}/_{name}.parts"
    target = f"{folder.rstrip('/')}/{name}"
    export_csv(df.coalesce(1), parts)
    written = [part for part in list_names(spark, parts) if part.startswith("part-")]
    if len(written) != 1:
        raise RuntimeError(f"expected one part file in {parts}, found {len(written)}")
    move_path(spark, f"{parts}/{written[0]}", target)
    delete_path(spark, parts)
    return target


def empty_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Replace a store by an empty one. Never called by a flow."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def write_jdbc(df: DataFrame, url: str, table: str, options: Mapping[str, str] | None = None,
               connections: int = 8, batch_rows: int = 10_000,
               swap: Callable[[str, str], None] | None = None) -> None:
    """Replace a warehouse table over JDBC.

    ``connections`` bounds how many tasks write at once, so that a large cluster
    does not exhaust the database; credentials and driver come in ``options``.
    With ``swap`` the rows go to ``{table}_staging`` first, and ``swap(staging,
    table)`` puts it in place once all are there, so readers never see a part of
    them. Without it the table is emptied and filled in place, keeping its grants.
    """
    target = f"{table}_staging" if swap else table
    jdbc_writer(df, url, target, options, connections, batch_rows).save()
    if swap:
        swap(target, table)


def jdbc_writer(df, url, table, options=None, connections=8, batch_rows=10_000):
    """The configured writer behind ``write_jdbc``."""
    return (df.write.format("jdbc").mode("overwrite").options(**dict(options or {}))
            .option("url", url).option("dbtable", table)
            .option("truncate", True).option("numPartitions", connections).option("batchsize", batch_rows))


def drop_table_month(spark: SparkSession, table: str, month: dt.date) -> None:
    """Drop one month of a catalog table; nothing happens when it is not there."""
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (month = DATE'{month.isoformat()}')")


def drop_path_month(spark: SparkSession, path: str, month: dt.date) -> bool:
    """Drop one month of a path-based table; False when it is not there."""
    return delete_path(spark, _month_folder(path, month))


def save_catalog_table(df: DataFrame, name: str, partition_by: Sequence[str] = ("month",), months: Iterable[dt.date] = ()) -> None:
    """Publish in a catalog table: the partitions in ``df`` are replaced, those of ``months`` without rows dropped, all others stay.

    Columns go by name. The first call makes the table; later calls need its columns.
    The insert runs in a session of its own, whose settings no other publish shares.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(name):
        df.limit(0).write.partitionBy(*partition_by).format("parquet").saveAsTable(name)
    known = spark.table(name).columns
    if sorted(known) != sorted(df.columns):
        raise ValueError(f"{name} has the columns {', '.join(known)}, the rows have {', '.join(df.columns)}")
    files = lambda month: sorted(spark.table(name).where(F.col("month") == F.lit(month)).inputFiles())
    before = {month: files(month) for month in months}
    own, view = spark.newSession(), f"published_{uuid.uuid4().hex}"
    own.catalog.setCurrentDatabase(spark.catalog.currentDatabase())
    own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    df.createGlobalTempView(view)
    columns = ", ".join(f"`{column}`" for column in known)
    try:
        own.sql(f"INSERT OVERWRITE TABLE {name} SELECT {columns} FROM global_temp.{view}")
    finally:
        spark.catalog.dropGlobalTempView(view)
    spark.catalog.refreshTable(name)
    for month, old in before.items():
        if old and old == files(month):
            drop_table_month(spark, name, month)
