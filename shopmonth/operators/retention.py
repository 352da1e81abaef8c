"""Retention: months that expire, users who are no longer active.

``time_column`` may be the ``month`` partition column or any date or timestamp;
recent and old rows are told apart by comparing it with a literal, so the scan
prunes to the partitions it needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.months import month_start, oldest_recent_month, shift_month
from .joins import join_facts

KEEP_MONTHS = 12


def is_old(time_column: str, as_of: dt.date, keep: int = KEEP_MONTHS) -> Column:
    return F.col(time_column) < F.lit(oldest_recent_month(as_of, keep))


def recent_rows(events: DataFrame, time_column: str, as_of: dt.date, keep: int = KEEP_MONTHS) -> DataFrame:
    return events.where(F.col(time_column) >= F.lit(oldest_recent_month(as_of, keep)))


def old_rows(events: DataFrame, time_column: str, as_of: dt.date, keep: int = KEEP_MONTHS) -> DataFrame:
    return events.where(is_old(time_column, as_of, keep))


def distinct_users(events: DataFrame, user: str = "user_id") -> DataFrame:
    return events.select(user).where(F.col(user).isNotNull()).distinct()


def active_users(events: DataFrame, as_of: dt.date, user: str = "user_id",
                 time_column: str = "month", keep: int = KEEP_MONTHS) -> DataFrame:
    """Users seen in any of the recent months."""
    return distinct_users(recent_rows(events, time_column, as_of, keep), user)


def inactive_users(events: DataFrame, active: DataFrame, as_of: dt.date, user: str = "user_id",
                   time_column: str = "month", keep: int = KEEP_MONTHS) -> DataFrame:
    """Users of old months who are not active. Both sides hold a user once."""
    return distinct_users(old_rows(events, time_column, as_of, keep), user).join(active, user, "left_anti")


def require_active(active: DataFrame, allow_empty: bool = False) -> DataFrame:
    """Refuse an empty active set, which would delete every old row."""
    if not allow_empty and active.isEmpty():
        raise ValueError("no active user found; pass allow_empty=True to delete all old rows")
    return active


def surviving_old_rows(events: DataFrame, active: DataFrame, as_of: dt.date, user: str = "user_id",
                       time_column: str = "month", keep: int = KEEP_MONTHS, **join_options) -> DataFrame:
    """Rows of old months that stay: those of active users and those without a user.

    A left join with a mark keeps both kinds in one pass over the old months.
    """
    marked = join_facts(old_rows(events, time_column, as_of, keep),
                        active.withColumn("_active", F.lit(True)), user, "left", **join_options)
    return marked.where(F.col("_active").isNotNull() | F.col(user).isNull()).select(events.columns)


def survivors(events: DataFrame, active: DataFrame, as_of: dt.date, user: str = "user_id",
              time_column: str = "month", keep: int = KEEP_MONTHS, **join_options) -> DataFrame:
    """All rows that stay: those not known to be old as they are, and the surviving old ones."""
    untouched = F.col(time_column).isNull() | ~is_old(time_column, as_of, keep)
    return events.where(untouched).unionByName(
        surviving_old_rows(events, active, as_of, user, time_column, keep, **join_options))


def retention_report(events: DataFrame, active: DataFrame, as_of: dt.date, user: str = "user_id",
                     time_column: str = "month", keep: int = KEEP_MONTHS) -> DataFrame:
    """Per old month: rows, deleted users, deleted rows. Months without deletions show 0.

    Rows are counted per month and user first, so the join sees a user at most
    once per month however many events the user has.
    """
    per_user = (old_rows(events, time_column, as_of, keep)
                .groupBy(month_start(time_column).alias("month"), F.col(user))
                .agg(F.count(F.lit(1)).alias("n")))
    marked = per_user.join(active.withColumn("is_active", F.lit(True)), user, "left")
    gone = F.col("is_active").isNull() & F.col(user).isNotNull()
    return marked.groupBy("month").agg(
        F.sum("n").alias("rows_before"),
        F.count_if(gone).alias("deleted_users"),
        F.sum(F.when(gone, F.col("n")).otherwise(0)).alias("deleted_rows"))


def without_month(events: DataFrame, month: dt.date, time_column: str = "month") -> DataFrame:
    """All rows but those of one month; rows without a time stay."""
    column = F.col(time_column)
    next_month = shift_month(month, 1)
    outside = (column < F.lit(month)) | (column >= F.lit(next_month)) | column.isNull()
    return events.where(outside)
