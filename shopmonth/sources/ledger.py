"""The ledger of processed months: a table with one DATE column ``month``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_from_label, month_label
from ..functions.text import decode_string_list, encode_string_list
from .storage import path_exists

LEDGER_SCHEMA = "month date"


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Processed months, each once; empty before the first run."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LEDGER_SCHEMA)
    return spark.read.schema(LEDGER_SCHEMA).parquet(path).distinct()


def absent_months(ledger: DataFrame, months: DataFrame) -> DataFrame:
    """The months to add: those the ledger does not hold yet."""
    return months.select("month").distinct().join(ledger, "month", "left_anti")


def append_months(spark: SparkSession, path: str, months: DataFrame) -> None:
    """Add months that are absent; a second call adds nothing."""
    absent_months(read_ledger(spark, path), months).coalesce(1).write.mode("append").parquet(path)


def with_months(ledger: DataFrame, months: DataFrame) -> DataFrame:
    """Ledger after the append."""
    return ledger.select("month").union(months.select("month")).distinct()


def parse_ledger_json(texts: DataFrame, column: str = "value") -> DataFrame:
    """JSON arrays of ``2019-Oct`` labels → months; labels that do not parse are left out."""
    labels = texts.select(F.explode(decode_string_list(column)).alias("label"))
    return (labels.select(month_from_label("label").alias("month"))
            .where(F.col("month").isNotNull()).distinct())


def read_ledger_json(spark: SparkSession, path: str) -> DataFrame:
    return parse_ledger_json(spark.read.text(path, wholetext=True))


def render_ledger_json(ledger: DataFrame) -> DataFrame:
    """One row with the ledger as a JSON array of labels, oldest first.

    The group holds one entry per calendar month, so it stays small at any data size.
    """
    ordered = F.sort_array(F.collect_set("month"))
    labels = F.transform(ordered, month_label)
    return ledger.agg(encode_string_list(labels).alias("months_json"))
