"""The given tables, mapped to the columns the operators expect."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import month_start
from ..operators.joins import join_facts
from ..sources.schema import RAW_EVENTS

# The event types of the given events table, by feature.
EVENT_TYPES = {"views": "view", "carts": "click", "removals": "error", "purchases": "purchase"}
ORDER_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shop_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with time, price and a session per user and day."""
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    return table(spark, sf_dir, "events").select(
        "user_id", F.col("ts").alias("event_time"), "event_type",
        F.col("value").alias("price"), session.alias("user_session"))


def _dirty_price():
    event_id = F.col("event_id")
    return (F.when(event_id % 97 == 0, -F.col("value"))
            .when(event_id % 89 == 0, F.lit(None)).otherwise(F.col("value")).alias("price"))


def _copies():
    """Every tenth event twice."""
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return F.explode(F.when(F.col("event_id") % 10 == 0, twice).otherwise(once)).alias("copy")


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with the dirt of landed files: nulls, negative prices, copies, untidy text."""
    events = table(spark, sf_dir, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"), "p_type", "p_brand")
    joined = join_facts(events, parts, "k", "left")
    event_id, k = F.col("event_id"), F.col("k")
    session = F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string"))
    soiled = joined.select(
        F.col("ts").alias("event_time"), "event_type", k.alias("product_id"),
        F.when(k % 11 != 0, F.col("p_type")).alias("category_code"),
        F.when(k % 7 != 0, F.concat(F.lit("  "), F.upper("p_brand"), F.lit(" "))).alias("brand"),
        _dirty_price(),
        F.when(event_id % 101 != 0, F.col("user_id")).alias("user_id"),
        F.when(event_id % 83 != 0, session).alias("user_session"),
        _copies())
    return soiled.select(RAW_EVENTS.names)


def dirty_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the price of each dirty row; it does not depend on the part."""
    return table(spark, sf_dir, "events").select(_dirty_price(), _copies()).select("price")


def monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` with the month of each order."""
    return table(spark, sf_dir, "orders").withColumn("month", month_start("o_orderdate"))


def newest_order_date(orders: DataFrame) -> dt.date:
    return orders.agg(F.max(F.to_date("o_orderdate"))).first()[0]


def order_months(orders: DataFrame) -> DataFrame:
    return orders.select("month").distinct()


def busy_months(orders: DataFrame) -> DataFrame:
    """Months with at least the average number of orders; they stand for processed ones."""
    counts = orders.groupBy("month").agg(F.count(F.lit(1)).alias("n"))
    average = counts.agg((F.sum("n") / F.count(F.lit(1))).alias("average")).scalar()
    return counts.where(F.col("n") >= average).select("month")
