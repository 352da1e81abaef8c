"""Which months are there, pending, recent, old or expired."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import last_months, month_start, oldest_recent_month

PENDING_WINDOW = 10


def distinct_months(df: DataFrame, time_column: str) -> DataFrame:
    return df.select(month_start(time_column).alias("month")).distinct()


def months_newest_first(months: DataFrame) -> DataFrame:
    return months.orderBy(F.desc("month"))


def month_window(spark: SparkSession, as_of: dt.date, count: int = PENDING_WINDOW,
                 include_current: bool = True) -> DataFrame:
    """The last ``count`` months up to ``as_of``, the running one included by default."""
    window = last_months(F.lit(as_of), count, include_current)
    return spark.range(1).select(F.explode(window).alias("month"))


def pending_months(ledger: DataFrame, as_of: dt.date, count: int = PENDING_WINDOW,
                   include_current: bool = True) -> DataFrame:
    """Months of the window the ledger does not hold, newest first."""
    window = month_window(ledger.sparkSession, as_of, count, include_current)
    return months_newest_first(window.join(ledger, "month", "left_anti"))


def classify_months(months: DataFrame, as_of: dt.date, keep: int = 12) -> DataFrame:
    """Mark each month ``recent`` or ``old`` by date; gaps do not extend the window."""
    bound = F.lit(oldest_recent_month(as_of, keep))
    return months.withColumn("month_class", F.when(F.col("month") >= bound, "recent").otherwise("old"))


def recent_months(months: DataFrame, as_of: dt.date, keep: int = 12) -> DataFrame:
    return months_newest_first(months.where(F.col("month") >= F.lit(oldest_recent_month(as_of, keep))))
