"""Cleaning of raw events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.months import parse_event_time, utc_clock
from ..functions.text import normalize_text
from ..sources.schema import KEY_COLUMNS, TEXT_COLUMNS
from .quantiles import price_fence

UNKNOWN = "unknown"


def fill_unknown(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    return df.fillna({column: UNKNOWN for column in columns})


def drop_null_keys(df: DataFrame, keys: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(keys))


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One of each set of rows equal in all columns.

    Copies collapse within every map task before the shuffle, so a row repeated
    any number of times never makes a heavy partition.
    """
    return df.dropDuplicates()


def keep_valid_prices(df: DataFrame, column: str = "price") -> DataFrame:
    return df.where(F.col(column) >= 0)


def keep_within_fence(df: DataFrame, lower: float, upper: float, column: str = "price") -> DataFrame:
    """Rows inside the fence, both ends included."""
    return df.where(F.col(column).between(lower, upper))


def keep_parsed_times(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.dropna(subset=[column])


def normalize_texts(df: DataFrame, columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({column: normalize_text(column) for column in columns})


def add_time_parts(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Parse the event time where it is text and add its year and month, by the UTC clock."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        df = df.withColumn(column, parse_event_time(column))
    time = utc_clock(F.col(column)) if isinstance(kind, T.TimestampType) else F.col(column)
    return df.withColumns({"event_year": F.year(time), "event_month": F.month(time)})


def clean_events(raw: DataFrame, bounds: tuple[float, float] | None = None,
                 method: str = "approx", dedup_after_normalize: bool = False) -> DataFrame:
    """Cleaned events of one raw frame.

    The fence comes from the raw rows, duplicates and negative prices included,
    unless the caller passes ``bounds``. All row filters stand before the
    de-duplication: they look at one row each, so the result is the same and only
    surviving rows are shuffled. By default rows are compared as they landed, so
    rows that become equal through trimming or lower case both stay.
    """
    lower, upper = bounds or price_fence(raw, method=method)
    kept = keep_within_fence(keep_valid_prices(drop_null_keys(raw)), lower, upper)
    filled = fill_unknown(kept)
    if dedup_after_normalize:
        return add_time_parts(drop_duplicate_rows(normalize_texts(filled)))
    return add_time_parts(normalize_texts(drop_duplicate_rows(filled)))
