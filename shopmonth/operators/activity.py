"""Per-user behaviour: activity counts, recency / frequency / monetary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.months import elapsed_days
from ..sources.schema import ACTIVITY_TYPES
from .cleaning import keep_parsed_times

def price_sum(column: str = "price", digits: int | None = None) -> Column:
    """Sum of a money column; the doubles as they are.

    Where the data is known to be money, ``digits=2`` adds whole units of that
    decimal place: the same bits in any order of rows, so a rerun or another
    partitioning cannot change features or segments. It rounds prices to that
    place, takes NaN as null, and raises on overflow.
    """
    if digits is None:
        return F.sum(column)
    price = F.col(column)
    units = F.when(~F.isnan(price), F.rint(price * 10 ** digits).cast("long"))
    return F.sum(units).cast("double") / F.lit(10.0 ** digits)


def type_counts(types: Mapping[str, str] = ACTIVITY_TYPES) -> list[Column]:
    return [F.count_if(F.col("event_type") == name).alias(output) for output, name in types.items()]


def user_activity(events: DataFrame, types: Mapping[str, str] = ACTIVITY_TYPES,
                  digits: int | None = None) -> DataFrame:
    """Event counts by type, distinct sessions and the price sum of each user.

    With a single distinct aggregate Spark pre-aggregates by user and session in
    the map tasks and again by user, so a user with a large share of all events
    still reaches the last step as a few partial rows. ``total_spent`` adds the
    prices of all event types, views included; it is 0 when all are null.
    """
    return events.groupBy("user_id").agg(
        *type_counts(types),
        F.countDistinct("user_session").alias("sessions"),
        price_sum(digits=digits).alias("total_spent"),
    ).na.fill(0, subset=["total_spent"])


def event_type_histogram(events: DataFrame) -> DataFrame:
    """Per user the occurring event types with their counts, as a map.

    It says what a list of all events of the user would say, but its size follows
    the number of event types and not the number of events. A user all of whose
    types are null has an empty map.
    """
    counted = events.groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    entries = F.collect_list(F.when(F.col("event_type").isNotNull(), F.struct("event_type", "n")))
    return counted.groupBy("user_id").agg(F.map_from_entries(entries).alias("event_types"))


def histogram_counts(histogram: DataFrame, types: Mapping[str, str] = ACTIVITY_TYPES) -> DataFrame:
    """Read the counts of the named event types back out of the map."""
    counts = [F.coalesce(F.try_element_at("event_types", F.lit(name)), F.lit(0)).alias(output)
              for output, name in types.items()]
    return histogram.select("user_id", *counts)


def latest_event_time(events: DataFrame) -> DataFrame:
    return events.agg(F.max("event_time").alias("latest_time"))


def rfm(events: DataFrame, digits: int | None = None) -> DataFrame:
    """Days since the last event, number of sessions and price sum of each user.

    Days count back from the newest event of all. Rows without a time are left out.
    """
    return _profile(keep_parsed_times(events), [], digits).select(
        "user_id", "recency", F.col("sessions").alias("frequency"),
        F.col("total_spent").alias("monetary"))


def user_profile(events: DataFrame, types: Mapping[str, str] = ACTIVITY_TYPES,
                 digits: int | None = None) -> DataFrame:
    """RFM and activity of each user.

    Both parts group by user, so one grouping computes them and no join is needed.
    """
    return _profile(keep_parsed_times(events), type_counts(types), digits).select(
        "user_id", "recency", F.col("sessions").alias("frequency"),
        F.col("total_spent").alias("monetary"), *types, "sessions", "total_spent")


def _profile(events: DataFrame, counts: list[Column], digits: int | None) -> DataFrame:
    per_user = events.where(F.col("user_id").isNotNull()).groupBy("user_id").agg(
        *counts,
        F.max("event_time").alias("last_time"),
        F.countDistinct("user_session").alias("sessions"),
        F.coalesce(price_sum(digits=digits), F.lit(0.0)).alias("total_spent"))
    newest = latest_event_time(events).scalar()
    return per_user.withColumn("recency", elapsed_days(F.col("last_time"), newest))


def join_rfm_activity(rfm_table: DataFrame, activity: DataFrame) -> DataFrame:
    """Inner join of two per-user tables that already exist."""
    return rfm_table.join(activity, "user_id", "inner").na.fill(0)
