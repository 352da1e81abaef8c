"""Column layout of the raw event files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Names and types of the landed columns, key and text columns, features.
# event_time stays text in the raw layer: a value that does not parse is kept as
# it landed, and becomes null only in the cleaning step.
RAW_EVENTS = T.StructType([
    T.StructField("event_time", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("category_code", T.StringType()),
    T.StructField("brand", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("user_session", T.StringType()),
])

KEY_COLUMNS = ("user_id", "product_id", "user_session")
TEXT_COLUMNS = ("brand", "category_code")

# Event types counted per user, by output column.
ACTIVITY_TYPES = {
    "views": "view",
    "carts": "cart",
    "removals": "remove_from_cart",
    "purchases": "purchase",
}

FEATURE_COLUMNS = ("views", "carts", "removals", "purchases", "sessions", "total_spent")


def require_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Fail before any job runs when a needed column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail on an empty frame; stops at the first row found."""
    if df.isEmpty():
        raise ValueError(f"{what} holds no rows")
    return df
