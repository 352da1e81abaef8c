"""Quantiles of any window of months from one small sketch per month.

A month's values are read once, when the month is written; its sketch is one row of a
table partitioned by month. The fence of a window merges the sketches of its months and
reads no fact. Merging keeps the bound on the rank error, whatever the number of months.

Nulls and NaN are no values. A month without values has no sketch, and a window without
any has null quantiles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.sinks import write_months
from ..sources.storage import path_exists
from .quantiles import QUARTILES, fence

SKETCH_SIZE = 2048  # single-sided rank error of about 0.2 % at 99 % confidence, some 40 KB a month
SKETCHES = "sketch binary, rows long, month date"


def month_sketches(df: DataFrame, column: str, size: int = SKETCH_SIZE) -> DataFrame:
    """``sketch``, ``rows`` and ``month``; combined before the shuffle, so a month is as many small buffers as it had tasks."""
    value = F.col(column).cast("double")
    values = df.select("month", value.alias("v")).where("month IS NOT NULL AND v IS NOT NULL AND NOT isnan(v)")
    return (values.groupBy("month").agg(F.kll_sketch_agg_double("v", size).alias("sketch"), F.count(F.lit(1)).alias("rows"))
            .select("sketch", "rows", "month"))


def store_sketches(df: DataFrame, path: str, column: str, months: Iterable[dt.date], size: int = SKETCH_SIZE) -> None:
    """Replace the sketches of ``months`` by those of the rows; a month without values loses its sketch."""
    write_months(month_sketches(df, column, size).coalesce(1), path, months=months)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SKETCHES).parquet(path) if path_exists(spark, path) else spark.createDataFrame([], SKETCHES)


def merged_quantiles(sketches: DataFrame, by: Sequence[str] = (), probabilities: Sequence[float] = QUARTILES) -> DataFrame:
    """``by``, ``rows`` and the array ``quantiles`` of the merged sketches, one row for each group of months."""
    wanted = F.array(*[F.lit(float(p)) for p in probabilities])
    merged = sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch").alias("merged"),
                                       F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
    found = F.when(F.col("rows") > 0, F.kll_sketch_get_quantile_double("merged", wanted))
    return merged.select(*by, "rows", found.alias("quantiles"))


def trailing_windows(sketches: DataFrame, count: int) -> DataFrame:
    """Each sketch once for every window of ``count`` calendar months it lies in; ``window_end`` is a month with a sketch."""
    ends = sketches.select(F.col("month").alias("window_end"))
    inside = sketches.select("*", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("ahead"))
    return (inside.withColumn("window_end", F.add_months("month", F.col("ahead")))
            .join(F.broadcast(ends), "window_end", "left_semi").drop("ahead"))  # one row for each month


def window_fence(sketches: DataFrame, months: Iterable[dt.date]) -> tuple[float, float]:
    """Outlier fence of the rows of ``months``; refused where none of them has a value."""
    wanted = sorted(set(months))
    quartiles = merged_quantiles(sketches.where(F.col("month").isin(wanted))).first().quantiles
    if quartiles is None:
        raise ValueError("no value in the months of the window")
    return fence(*quartiles)
