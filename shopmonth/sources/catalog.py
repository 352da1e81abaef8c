"""Catalog scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import FILE_NAME_LIKE, month_from_name


def tables_like(spark: SparkSession, pattern: str, database: str | None = None) -> DataFrame:
    """Names of catalog tables that match a LIKE pattern."""
    found = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    return (found.where(~F.col("isTemporary") & F.col("tableName").like(pattern))
            .select(F.col("tableName").alias("table_name")))


def monthly_names(names: DataFrame, column: str = "table_name") -> DataFrame:
    """Names of the monthly form with their month, newest first; others are left out."""
    return (names.where(F.col(column).like(FILE_NAME_LIKE))
            .select(column, month_from_name(column).alias("month"))
            .where(F.col("month").isNotNull())
            .orderBy(F.desc("month"), column))
