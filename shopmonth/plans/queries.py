"""Registered queries: each takes a session and a table folder and returns a frame."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.months import (expired_month, file_name, landed_stem, month_label, month_start, parse_event_time, published_table,
                                shift_month, table_label)
from ..functions.text import array_count
from ..operators import activity, boosting, cleaning, evaluation, month_sketches, months, quantiles, registry, retention, sampling, scoring, segments, stable_segments
from ..operators.joins import HOT_SHARE
from ..sources import deletions, files, ledger, month_table, sinks
from ..sources.catalog import monthly_names, tables_like
from ..sources.schema import FEATURE_COLUMNS, RAW_EVENTS, require_columns, require_rows
from ..sources.workdir import new_folder, stage
from ..streaming.ingest import batch_ledger, ingest_landed, ingest_months
from . import flows
from .testbed import (EVENT_TYPES, ORDER_COLUMNS, busy_months, dirty_events, dirty_prices, monthly_orders,
                      newest_order_date, order_months, shop_events, table)

# Centroids for the checks that need fixed labels: purchases and total_spent of
# a light, a middle and a heavy user.
CENTROID_COLUMNS = ("purchases", "total_spent")
CENTROIDS = ((10.0, 2000.0), (13.0, 3000.0), (16.0, 4000.0))
HEAD_ROWS = 500  # fewer than any of the tables, so that the head cuts
MONEY_DIGITS = 2   # the given prices are money

_PARSED = T.StructType([T.StructField("event_time", T.TimestampNTZType())] + RAW_EVENTS.fields[1:])


# --- scans -----------------------------------------------------------------

def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.row_count(table(spark, sf_dir, "events"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.head_rows(table(spark, sf_dir, "events"), 5, "event_id")


def month_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    path = new_folder(spark, "orders-by-month")
    sinks.write_months(orders.hint("rebalance", "month"), path)
    newest = shift_month(newest_order_date(orders), 0)
    return files.read_month(spark.read.parquet(path), newest).select(*ORDER_COLUMNS, "month")


# --- cleaning --------------------------------------------------------------

def _bounds(spark: SparkSession, sf_dir: str, method: str = "exact") -> tuple[float, float]:
    """The fence from the one price column; the rows themselves are then read once, with it as a literal."""
    return quantiles.price_fence(dirty_prices(spark, sf_dir), method=method)


def fill_and_drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_null_keys(cleaning.fill_unknown(dirty_events(spark, sf_dir)))


def fill_numeric_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dirty_events(spark, sf_dir).na.fill(0)


def dedup_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.drop_duplicate_rows(dirty_events(spark, sf_dir))


def valid_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_valid_prices(dirty_events(spark, sf_dir))


def within_fence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.keep_within_fence(dirty_events(spark, sf_dir), *_bounds(spark, sf_dir))


def normalized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.normalize_texts(dirty_events(spark, sf_dir))


def parsed_event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as landed text, some of it broken; unreadable ones are dropped."""
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("at "), F.col("ts").cast("string"))) \
        .otherwise(F.concat(F.col("ts").cast("string"), F.lit(" UTC")))
    landed = table(spark, sf_dir, "events").select("event_id", text.alias("event_time"))
    parsed = cleaning.keep_parsed_times(cleaning.add_time_parts(landed))
    return parsed.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_events(dirty_events(spark, sf_dir), _bounds(spark, sf_dir))


def clean_events_dedup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_events(dirty_events(spark, sf_dir), _bounds(spark, sf_dir), dedup_after_normalize=True)


def clean_events_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean_events(dirty_events(spark, sf_dir), _bounds(spark, sf_dir, "approx"))


# --- quantiles -------------------------------------------------------------

def _fence_row(spark: SparkSession, quartiles: list[float]) -> DataFrame:
    row = [round(float(value), 6) for value in (*quartiles, *quantiles.fence(*quartiles))]
    return spark.createDataFrame([row], "q1 double, q3 double, lower_bound double, upper_bound double")


def _prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(dirty_prices(spark, sf_dir), "prices")


def iqr_bounds_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fence_row(spark, quantiles.exact_quantiles(_prices(spark, sf_dir), "price"))


def iqr_bounds_narrowed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for large tables: bracket the ranks first, then look inside the bracket."""
    return _fence_row(spark, quantiles.exact_quantiles(
        _prices(spark, sf_dir), "price", direct_rows=1000, narrowing_error=0.01))


def iqr_bounds_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = files.head_rows(table(spark, sf_dir, "events").select("event_id", "value"), HEAD_ROWS, "event_id")
    return _fence_row(spark, quantiles.exact_quantiles(head, "value"))


def approx_rank_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each approximate quartile is within one percent of its rank."""
    events = table(spark, sf_dir, "events")
    found = quantiles.approx_quantiles(events, "value")
    ranks = [F.struct(F.lit(p).alias("probability"),
                      ((F.count_if(F.col("value") < v) / F.count("value") <= p + quantiles.RELATIVE_ERROR)
                       & (F.count_if(F.col("value") <= v) / F.count("value") >= p - quantiles.RELATIVE_ERROR)
                       ).alias("within_error")) for p, v in zip(quantiles.QUARTILES, found)]
    return events.agg(F.array(*ranks).alias("ranks")).select(F.inline("ranks"))


def iqr_bounds_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fence_row(spark, quantiles.approx_quantiles(table(spark, sf_dir, "events"), "value"))


# --- user features ---------------------------------------------------------

def user_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.user_activity(shop_events(spark, sf_dir), EVENT_TYPES, MONEY_DIGITS)


def event_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.histogram_counts(activity.event_type_histogram(shop_events(spark, sf_dir)), EVENT_TYPES)


def array_value_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select("p_partkey", array_count(words, "red").alias("red_count"))


def latest_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.latest_event_time(shop_events(spark, sf_dir))


def rfm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.rfm(shop_events(spark, sf_dir), MONEY_DIGITS)


def user_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity.user_profile(shop_events(spark, sf_dir), EVENT_TYPES, MONEY_DIGITS)


def rfm_join_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shop_events(spark, sf_dir)
    return activity.join_rfm_activity(activity.rfm(events, MONEY_DIGITS),
                                      activity.user_activity(events, EVENT_TYPES, MONEY_DIGITS))


# --- segments --------------------------------------------------------------

def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.stored_features(shop_events(spark, sf_dir), EVENT_TYPES, digits=MONEY_DIGITS)


def _fixed_segments(features: DataFrame) -> DataFrame:
    return segments.nearest_centroid(features, CENTROIDS, CENTROID_COLUMNS)


def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = segments.standardize(_features(spark, sf_dir))
    return scaled.select("user_id", *[F.round(f"{c}_z", 6).alias(f"{c}_z") for c in FEATURE_COLUMNS])


def scaler_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same numbers from the estimator stages."""
    features = _features(spark, sf_dir)
    model = Pipeline(stages=segments.scaling_stages()).fit(features)
    values = model.transform(features).select("user_id", vector_to_array("scaled_vector").alias("z"))
    return values.select("user_id", *[F.round(F.col("z")[i], 6).alias(f"{c}_z")
                                      for i, c in enumerate(FEATURE_COLUMNS)])


def nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixed_segments(user_activity(spark, sf_dir)).select("user_id", "cluster")


def named_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = _fixed_segments(user_activity(spark, sf_dir))
    names = {0: segments.SEGMENT_NAMES[0], 2: segments.SEGMENT_NAMES[2]}
    return segments.name_segments(labelled, names).select(
        "user_id", *FEATURE_COLUMNS, "cluster", "cluster_name")


def segment_names_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names from a table: the regions name every other cluster."""
    labelled = _fixed_segments(user_activity(spark, sf_dir)).select("user_id", "cluster")
    names = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") * 2).cast("int").alias("cluster"), F.col("r_name").alias("cluster_name"))
    return segments.join_segment_names(labelled, names)


def events_with_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = shop_events(spark, sf_dir)
    labelled = stage(_fixed_segments(user_activity(spark, sf_dir)).select("user_id", "cluster"), "segments")
    return segments.join_segments(events, labelled)


def events_with_segment_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path for segment tables too large to broadcast: users above the average apart."""
    events = shop_events(spark, sf_dir)
    labelled = stage(_fixed_segments(user_activity(spark, sf_dir)).select("user_id", "cluster"), "segments")
    share = max(1 / labelled.count(), HOT_SHARE)
    return segments.join_segments(events, labelled, broadcast_bytes=0, hot_share=share, hot_rows=0)


def kmeans_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir)
    return segments.assign_segments(segments.fit_segments(features), features)


def kmeans_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users in all, users in several clusters, and users whose own centre is not the nearest one."""
    features = _features(spark, sf_dir)
    model = segments.fit_segments(features, order_by=None)
    scaled = [f"{c}_z" for c in FEATURE_COLUMNS]
    own = segments.assign_segments(model, features).withColumnRenamed("cluster", "assigned")
    nearest = segments.nearest_centroid(segments.standardize(features), segments.cluster_centers(model), scaled)
    return nearest.join(own, "user_id").agg(
        F.count(F.lit(1)).alias("users"),
        (F.count(F.lit(1)) - F.countDistinct("user_id")).alias("repeated"),
        F.count_if(F.col("cluster") != F.col("assigned")).alias("misplaced"))


def pca_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All components together only turn the axes: squared lengths stay those of the scaled features."""
    scores, _ = segments.pca_scores(_features(spark, sf_dir), len(FEATURE_COLUMNS))
    length = F.aggregate(vector_to_array("pca_vector"), F.lit(0.0), lambda total, x: total + x * x)
    return scores.select("user_id", F.round(length, 6).alias("squared_length"))


def pca_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, shares = segments.pca_scores(_features(spark, sf_dir))
    parts = vector_to_array("pca_vector")
    return scores.select("user_id", parts[0].alias("pc1"), parts[1].alias("pc2"),
                         F.lit(sum(shares)).alias("explained_variance"))


def elbow_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores, _ = segments.pca_scores(_features(spark, sf_dir))
    return evaluation.elbow_table(stage(scores, "scores"))


def silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silhouette of the fixed segments in the plane of their two columns."""
    labelled = _fixed_segments(_features(spark, sf_dir))
    vectors = VectorAssembler(inputCols=list(CENTROID_COLUMNS), outputCol="vector").transform(labelled)
    score = evaluation.silhouette(vectors, "vector")
    return spark.createDataFrame([(round(score, 6),)], "silhouette double")


def kmeans_silhouette(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = _features(spark, sf_dir)
    labelled = segments.fit_segments(features).transform(features)
    return spark.createDataFrame([(evaluation.silhouette(labelled, "scaled_vector"),)], "silhouette double")


def bootstrap_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.bootstrap_sample_exact(_features(spark, sf_dir))


# Labelled rows that classifiers are trained on at most.
TRAINING_LIMIT = 2_000


def segment_classifier_cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean accuracy of all settings over 3 folds, and of the best one over 5.

    At most ``TRAINING_LIMIT`` labelled rows are trained on, taken by a hash of the user.
    """
    features = _features(spark, sf_dir)
    labelled = segments.fit_segments(features).transform(features)
    found = boosting.search_boosted(stage(boosting.training_table(labelled, TRAINING_LIMIT), "training"))
    last = spark.createDataFrame([(found.depth, found.rate, found.trees, found.accuracy, 5)],
                                 "max_depth int, learning_rate double, trees int, accuracy double, folds int")
    return found.scores.withColumn("folds", F.lit(3)).unionByName(last)


def classifier_against_majority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search on fixed segments, beside the accuracy of always naming the largest one."""
    rows = stage(boosting.training_table(_fixed_segments(_features(spark, sf_dir)), TRAINING_LIMIT), "training")
    found = boosting.search_boosted(rows)
    largest = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("users"), (F.max("n") / F.sum("n")).alias("majority"))
    return largest.select("users", F.round("majority", 6).alias("majority"), F.lit(found.scores.count()).cast("long").alias("settings"),
                          (F.col("majority") < found.accuracy).alias("better"))


def segment_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as its file has it: default clusters, full elbow, silhouette over all users, full classifier search.

    The classifier trains on at most ``TRAINING_LIMIT`` labelled rows.
    """
    folder = new_folder(spark, "report")
    report = flows.segment_report(shop_events(spark, sf_dir), folder, types=EVENT_TYPES, training_limit=TRAINING_LIMIT,
                                  digits=MONEY_DIGITS)
    path = flows.write_report(report, folder)
    return files.read_exported_csv(spark, path, report.users.schema)


def bootstrap_by_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """10,000 draws of users with replacement, the same whatever the partitions."""
    return sampling.bootstrap_by_rank(_features(spark, sf_dir).repartition(7)).select("draw", "user_id")


def silhouette_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean silhouette with plain Euclidean distances over a bootstrap sample of 10,000 rows."""
    drawn = sampling.bootstrap_by_rank(_fixed_segments(_features(spark, sf_dir)))
    vector = F.array(*[F.col(c).cast("double") for c in CENTROID_COLUMNS])
    rows = sampling.pairwise_silhouette(stage(drawn.select("draw", "cluster", vector.alias("vector")), "drawn"), "vector")
    return rows.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg("silhouette"), 6).alias("silhouette"))


def _stable(features: DataFrame) -> stable_segments.StableSegments:
    return stable_segments.fit_stable(features, lambda df: stage(df, "points"))


def kmeans_fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments from k-means in whole numbers."""
    features = _features(spark, sf_dir)
    return _stable(features).assign(features)


def kmeans_repartitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, and those whose segment changes when the model is fitted on other partitions."""
    features = _features(spark, sf_dir)
    labels = [_stable(features.repartition(parts)).cluster() for parts in (1, 7, 64)]
    changed = (labels[0] != labels[1]) | (labels[0] != labels[2])
    return features.agg(F.count(F.lit(1)).alias("users"), F.count_if(changed).alias("changed"))


def elbow_fixed_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Costs of k = 2 … 10 from one set of rounds."""
    features = _features(spark, sf_dir)
    rows = stage(stable_segments.points(features, stable_segments.fit_scaling(features)), "points")
    return stable_segments.elbow(rows).withColumn("inertia", F.round("inertia", 6))


def score_by_expression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of the orders, scored by the expression of the event users' model."""
    return _order_customers(spark, sf_dir).select("user_id", _stable(_features(spark, sf_dir)).cluster().alias("cluster"))


def _order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of customers known only from their orders."""
    orders = table(spark, sf_dir, "orders")
    return activity.user_activity(orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderstatus").alias("event_type"),
        F.col("o_totalprice").alias("price"), F.col("o_orderdate").cast("string").alias("user_session")),
        {"views": "O", "carts": "P", "removals": "X", "purchases": "F"}, MONEY_DIGITS)


def score_new_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers known only from their orders, scored by the model of the event users."""
    features = _features(spark, sf_dir)
    model = segments.fit_segments(features)
    return scoring.score_customers(_order_customers(spark, sf_dir), model)


def latest_model_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder names built from part types and sizes, one base folder per brand."""
    name = F.concat(F.when(F.col("p_type") == "PROMO", "tmp").otherwise("v"), F.col("p_size").cast("string"))
    names = table(spark, sf_dir, "part").select("p_brand", name.alias("name"))
    return registry.latest_version(names, group_by="p_brand")


# --- months and ledger -----------------------------------------------------

def table_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_months(monthly_orders(spark, sf_dir))
    return found.select("month", month_label("month").alias("label"), table_label("month").alias("table_name"),
                        file_name("month").alias("file_name"))


def months_from_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of good and of broken form, one per month and order status."""
    status = F.col("o_orderstatus")
    name = F.when(status == "F", file_name("month")).when(status == "O", table_label("month")) \
        .otherwise(F.concat(F.lit("data_"), F.year("month").cast("string"), F.lit("-Foo.csv.gz")))
    return monthly_names(monthly_orders(spark, sf_dir).select(name.alias("table_name")).distinct())


def months_newest_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.months_newest_first(months.distinct_months(table(spark, sf_dir, "orders"), "o_orderdate"))


def month_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return months.month_window(spark, newest_order_date(monthly_orders(spark, sf_dir)), 24)


def pending_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    return months.pending_months(busy_months(orders), newest_order_date(orders))


def ledger_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append twice to a stored ledger; the second append adds nothing."""
    orders = monthly_orders(spark, sf_dir)
    path = new_folder(spark, "ledger")
    ledger.append_months(spark, path, busy_months(orders))
    window = months.month_window(spark, newest_order_date(orders))
    ledger.append_months(spark, path, window)
    ledger.append_months(spark, path, window)
    return spark.read.parquet(path)


def ledger_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    return ledger.with_months(busy_months(orders), months.month_window(spark, newest_order_date(orders)))


def ledger_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.render_ledger_json(busy_months(monthly_orders(spark, sf_dir)))


def ledger_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.parse_ledger_json(ledger_json(spark, sf_dir), "months_json")


def expired_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month that expires when each month of the orders is the running one."""
    found = order_months(monthly_orders(spark, sf_dir))
    return found.select("month", expired_month("month").alias("expired_month"))


def month_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    return months.classify_months(order_months(orders), newest_order_date(orders))


def recent_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    return months.recent_months(order_months(orders), newest_order_date(orders))


# --- retention -------------------------------------------------------------

def _active(orders: DataFrame):
    as_of = newest_order_date(orders)
    return as_of, retention.active_users(orders, as_of, "o_custkey", "o_orderdate")


def active_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _active(table(spark, sf_dir, "orders"))[1]


def inactive_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    as_of, active = _active(orders)
    return retention.inactive_users(orders, active, as_of, "o_custkey", "o_orderdate")


def surviving_old_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    as_of, active = _active(orders)
    active = retention.require_active(stage(active, "active"))
    return retention.surviving_old_rows(orders, active, as_of, "o_custkey", "o_orderdate")


def retention_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    as_of, active = _active(orders)
    active = retention.require_active(stage(active, "active"))
    return retention.survivors(orders, active, as_of, "o_custkey", "o_orderdate")


def retention_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    as_of, active = _active(orders)
    return retention.retention_report(orders, active, as_of, "o_custkey", "o_orderdate")


def without_expired_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return retention.without_month(orders, shift_month(newest_order_date(orders), -13), "o_orderdate")


def _stored_orders(spark: SparkSession, orders: DataFrame) -> str:
    path = new_folder(spark, "orders-by-month")
    sinks.write_months(orders.hint("rebalance", "month"), path)
    return path


def drop_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = monthly_orders(spark, sf_dir)
    path = _stored_orders(spark, orders)
    sinks.drop_path_month(spark, path, shift_month(newest_order_date(orders), -13))
    return spark.read.parquet(path)


def retention_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expiry and deletion on a stored table, run twice, and read back."""
    orders = monthly_orders(spark, sf_dir)
    as_of = newest_order_date(orders)
    path = _stored_orders(spark, orders)
    flows.run_retention(spark, path, as_of, "o_custkey")
    flows.run_retention(spark, path, as_of, "o_custkey")
    return spark.read.parquet(path)


# --- sinks and flows -------------------------------------------------------

def month_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all months, replace the newest one again, read everything back."""
    orders = monthly_orders(spark, sf_dir)
    path = _stored_orders(spark, orders)
    newest = shift_month(newest_order_date(orders), 0)
    sinks.write_month(files.read_month(orders, newest), path, newest)
    return spark.read.parquet(path)


def csv_export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "export")
    sinks.export_csv(dirty_events(spark, sf_dir), path)
    return files.read_exported_csv(spark, path, _PARSED)


def append_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases first, everything else appended."""
    raw = dirty_events(spark, sf_dir)
    path = new_folder(spark, "append")
    sinks.append_csv(raw.where("event_type = 'purchase'"), path)
    sinks.append_csv(raw.where("event_type <> 'purchase'"), path)
    return files.read_exported_csv(spark, path, _PARSED)


def raw_copy_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = dirty_events(spark, sf_dir)
    store = flows.Store(new_folder(spark, "store"))
    month = _event_month(spark, sf_dir)
    flows.copy_raw_month(raw, store, month)
    return flows.stored_month(spark, store.raw, month)


def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stream the events file into a table, twice; the second run finds nothing new."""
    target = new_folder(spark, "ingest")
    schema = table(spark, sf_dir, "events").schema
    for _ in range(2):
        ingest_landed(spark, sf_dir, f"{target}/table", f"{target}/checkpoint", schema, "parquet",
                      {"pathGlobFilter": "events.parquet"})
    return spark.read.schema(schema).parquet(f"{target}/table")


def _event_month(spark: SparkSession, sf_dir: str):
    return table(spark, sf_dir, "events").agg(F.max(month_start("ts"))).first()[0]


def monthly_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw copy, clean, segment, publish, ledger; the published month without the segment ids."""
    store = flows.Store(new_folder(spark, "store"))
    month = _event_month(spark, sf_dir)
    flows.process_month(dirty_events(spark, sf_dir), store, month, types=EVENT_TYPES, method="exact",
                        digits=MONEY_DIGITS)
    published = spark.read.parquet(store.published).join(
        F.broadcast(ledger.read_ledger(spark, store.ledger)), "month", "left_semi")
    return published.withColumn("has_segment", F.col("cluster").isNotNull()).drop("cluster", "model_version")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned events with the k-means segment of their user."""
    cleaned = stage(clean_events_approx(spark, sf_dir), "cleaned")
    features = flows.stored_features(cleaned, EVENT_TYPES, digits=MONEY_DIGITS)
    model = segments.fit_segments(features)
    return segments.join_segments(cleaned, segments.assign_segments(model, features))


def _land(spark: SparkSession, rows: DataFrame, place: str, columns: list[str] | None = None) -> None:
    """Dirty events as landed text files, with times as text in UTC."""
    text = F.concat(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit(" UTC"))
    sinks.export_csv(rows.withColumn("event_time", text).select(*(columns or RAW_EVENTS.names)), place)


def landed_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month landed as several files in two layouts, one with its columns turned round and one more of them."""
    raw, base, month = dirty_events(spark, sf_dir), new_folder(spark, "landing"), _event_month(spark, sf_dir)
    place = f"{base}/{landed_stem(month)}"
    extra = raw.where("event_type = 'purchase'").withColumn("category_id", F.col("product_id") * 10)
    _land(spark, extra, f"{place}/purchases", ["category_id", *reversed(RAW_EVENTS.names)])
    _land(spark, raw.where("event_type <> 'purchase'"), f"{place}/other ones")
    return files.read_landed_month(spark, base, month)


def landed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and months by landed folder, names with blanks and signs included."""
    raw, base = dirty_events(spark, sf_dir), new_folder(spark, "landing dir+%41")
    _land(spark, raw.where("event_type = 'purchase'"), f"{base}/2024-Feb/a b")
    _land(spark, raw.where("event_type = 'view'"), f"{base}/deep/2024-Mar")
    found = files.read_landed_folder(spark, base)
    place = F.regexp_replace("source_file", "/[^/]*$", "")
    return found.groupBy(place.alias("place"), "month").agg(F.count(F.lit(1)).alias("n"))


def csv_file_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The user table as one named gzip file, read back."""
    features = _features(spark, sf_dir)
    path = sinks.export_csv_file(features, new_folder(spark, "export"), "users.csv.gz")
    return files.read_exported_csv(spark, path, features.schema)


def bulk_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All landed months copied to the raw store in one job: rows, users and files by month."""
    raw, base = dirty_events(spark, sf_dir), new_folder(spark, "bulk")
    _land(spark, raw.where("event_type = 'purchase'"), f"{base}/landing/2024-Feb")
    _land(spark, raw.where("event_type = 'view'"), f"{base}/landing/deep/2024-Mar")
    store = flows.Store(f"{base}/store")
    for _ in range(2):  # the second copy replaces the first
        flows.copy_raw_folder(spark, f"{base}/landing", store)
    return spark.read.parquet(store.raw).groupBy("month").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("users"), F.count_if(F.col("source_file").isNull()).alias("nameless"))


def emptied_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filled store, then emptied: rows before and after, and the columns that stay."""
    orders = monthly_orders(spark, sf_dir)
    path = _stored_orders(spark, orders)
    before = spark.read.parquet(path).count()
    sinks.empty_table(spark, path, orders.schema)
    after = spark.read.parquet(path)
    return after.agg(F.lit(before).cast("long").alias("before"), F.count(F.lit(1)).alias("after"),
                     F.lit(len(after.columns)).cast("long").alias("columns"))


def catalog_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly tables found in a catalog by pattern; other tables are left out."""
    orders, name = monthly_orders(spark, sf_dir), f"shop_{uuid.uuid4().hex}"
    newest = shift_month(newest_order_date(orders), 0)
    spark.sql(f"CREATE DATABASE {name}")
    try:
        for back in range(3):
            month = shift_month(newest, -back)
            files.read_month(orders, month).write.saveAsTable(f"{name}.{published_table(month)}")
        orders.limit(1).write.saveAsTable(f"{name}.dataless")
        return stage(tables_like(spark, "data_20%", name), "names")
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def landed_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of the last three months have landed; reading one that has not is refused."""
    raw, base, month = dirty_events(spark, sf_dir), new_folder(spark, "landing"), _event_month(spark, sf_dir)
    _land(spark, raw.where("event_type = 'purchase'"), f"{base}/{landed_stem(month)}")
    rows = []
    for back in range(3):
        asked = shift_month(month, -back)
        try:
            rows.append((asked, True, files.read_landed_month(spark, base, asked).count()))
        except FileNotFoundError:
            rows.append((asked, False, 0))
    return spark.createDataFrame(rows, "month date, landed boolean, n long")


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards say to the events, whole, without a column and without rows."""
    events = dirty_events(spark, sf_dir)

    def said(guard) -> str | None:
        try:
            guard()
        except ValueError as refused:
            return str(refused)

    wanted = ("user_id", "price", "brand")
    rows = [("columns there", said(lambda: require_columns(events, wanted))),
            ("columns missing", said(lambda: require_columns(events.drop("price", "brand"), wanted))),
            ("rows there", said(lambda: require_rows(events, "events"))),
            ("rows missing", said(lambda: require_rows(events.where("price < -1e9"), "events")))]
    return spark.createDataFrame(rows, "guard string, message string")


def variance_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Principal components: shares add up, the first two are those of the scores, and scores are not correlated."""
    features = _features(spark, sf_dir)
    scores, shares = segments.pca_scores(features, len(FEATURE_COLUMNS))
    _, two = segments.pca_scores(features)
    parts = vector_to_array("pca_vector")
    total = sum((F.var_samp(parts[k]) for k in range(1, len(FEATURE_COLUMNS))), F.var_samp(parts[0]))
    share = (F.var_samp(parts[0]) + F.var_samp(parts[1])) / total
    return scores.agg(F.count(F.lit(1)).alias("users"), F.lit(round(sum(shares), 6)).alias("all_shares"),
                      (F.abs(share - F.lit(sum(two))) < 1e-9).alias("two_match"),
                      (F.round(F.abs(F.covar_samp(parts[0], parts[1])), 6) + 0.0).alias("covariance"), F.round(total, 6).alias("variance"))


def pending_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landed months through the whole flow; the published tables without the segment ids."""
    raw, base, month = dirty_events(spark, sf_dir), new_folder(spark, "flow"), _event_month(spark, sf_dir)
    _land(spark, raw, f"{base}/landing/{landed_stem(month)}")
    _land(spark, raw.where("event_type = 'purchase'"), f"{base}/landing/{landed_stem(shift_month(month, -1))}")
    store = flows.Store(f"{base}/store")
    for _ in range(2):  # the second run finds nothing pending
        flows.process_pending(spark, f"{base}/landing", store, month, window=2, types=EVENT_TYPES, method="exact",
                              digits=MONEY_DIGITS, k=2)
    return (spark.read.parquet(store.published).where("cluster IS NOT NULL AND model_version IN (1, 2)")
            .drop("cluster", "model_version"))


def catalog_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two months published, one of them again with fewer rows; the other stays."""
    orders = monthly_orders(spark, sf_dir)
    newest, name = shift_month(newest_order_date(orders), 0), f"published_{uuid.uuid4().hex}"
    sinks.save_catalog_table(files.read_month(orders, shift_month(newest, -1)), name)
    sinks.save_catalog_table(files.read_month(orders, newest), name)
    sinks.save_catalog_table(files.read_month(orders, newest).where("o_orderstatus = 'F'"), name, months=[newest])
    try:
        return stage(spark.table(name).select(*orders.columns), "published")
    finally:
        spark.sql(f"DROP TABLE {name}")


def emptied_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A month written again without rows is empty, one with fewer rows has those; all others stay."""
    orders = monthly_orders(spark, sf_dir)
    newest, path = shift_month(newest_order_date(orders), 0), new_folder(spark, "emptied")
    sinks.write_months(orders.hint("rebalance", "month"), path)
    before = shift_month(newest, -1)
    sinks.write_month(files.read_month(orders, newest).where("o_orderkey < 0"), path, newest)
    sinks.write_month(files.read_month(orders, before).where("o_orderstatus = 'F'"), path, before)
    return spark.read.parquet(path).select(*ORDER_COLUMNS, "month")


def month_table_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by pointers, with a month dropped, old versions deleted, and a write that broke off."""
    orders = monthly_orders(spark, sf_dir).select(*ORDER_COLUMNS, "month")
    newest = shift_month(newest_order_date(orders), 0)
    published = month_table.MonthTable(spark, new_folder(spark, "published"), orders.schema)
    published.replace(orders.hint("rebalance", "month"), [r.month for r in order_months(orders).collect()])
    before, dropped = shift_month(newest, -1), shift_month(newest, -2)
    published.replace(files.read_month(orders, newest).where("o_orderkey < 0"), [newest])
    published.replace(files.read_month(orders, before).where("o_orderstatus = 'F'"), [before])
    published.drop([dropped])
    published.vacuum()
    broken = files.read_month(orders, newest).withColumn("version", F.lit("broken-off"))
    broken.write.mode("append").partitionBy("month", "version").parquet(published.data)
    return published.rows()


def event_types_with_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by type where every seventh user has no type on any event."""
    events = shop_events(spark, sf_dir).withColumn("event_type", F.expr("CASE WHEN user_id % 7 <> 0 THEN event_type END"))
    return activity.histogram_counts(activity.event_type_histogram(events), EVENT_TYPES)


def event_times_by_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times landed in several zones, parsed by a session that is far from UTC."""
    away = spark.newSession()
    events = table(away, sf_dir, "events")
    away.conf.set("spark.sql.session.timeZone", "America/New_York")
    zone = F.element_at(F.array(*map(F.lit, (" UTC", "Z", "", "+00:00"))), (F.col("event_id") % 4 + 1).cast("int"))
    landed = events.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), zone).alias("event_time"))
    return cleaning.add_time_parts(landed)


def emptied_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention where the oldest month has inactive users only: the month goes."""
    orders = monthly_orders(spark, sf_dir)
    as_of = newest_order_date(orders)
    oldest = orders.agg(F.min("month")).first()[0]
    active = retention.active_users(orders, as_of, "o_custkey", "o_orderdate")
    kept = orders.where(F.col("month") != oldest).unionByName(
        orders.where(F.col("month") == oldest).join(active, "o_custkey", "left_anti").select(*orders.columns))
    path = _stored_orders(spark, kept)
    flows.run_retention(spark, path, as_of, "o_custkey")
    return spark.read.parquet(path).groupBy("month").agg(F.count(F.lit(1)).alias("n"))


def bootstrap_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Draws in all, and draws of users that are not there."""
    features = _features(spark, sf_dir)
    drawn = evaluation.bootstrap_sample_exact(features, 2 * features.count())
    known = features.select("user_id", F.lit(True).alias("known"))
    return drawn.join(known, "user_id", "left").agg(
        F.count(F.lit(1)).alias("drawn"), F.count_if(F.col("known").isNull()).alias("strangers"))


def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, and those whose segment changes when the model is saved and loaded."""
    features, base = _features(spark, sf_dir), new_folder(spark, "models")
    model = segments.fit_segments(features)
    registry.save_model(model, spark, base)
    again = segments.assign_segments(registry.load_latest_model(spark, base), features).withColumnRenamed("cluster", "again")
    both = segments.assign_segments(model, features).join(again, "user_id")
    return both.agg(F.count(F.lit(1)).alias("users"), F.count_if(F.col("cluster") != F.col("again")).alias("changed"))


def segments_by_spending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment ids, and how many of them spend less on average than the one before."""
    features = _features(spark, sf_dir)
    labelled = segments.fit_segments(features).transform(features)
    average = labelled.groupBy("cluster").agg(F.avg("total_spent").alias("spent"))
    before = F.lag("spent").over(Window.orderBy("cluster"))  # one row for each segment
    return (average.withColumn("falls", F.coalesce(F.col("spent") < before, F.lit(False)))
            .agg(F.count(F.lit(1)).alias("segments"), F.count_if("falls").alias("falling")))


# --- months by sketches, marks and streams -----------------------------------

SKETCH_WINDOW = 3
RANK_ERROR = 0.01


def window_fences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of three months each from stored sketches of one month, the newest stored again: rows, and whether both ranks hold."""
    orders, path = monthly_orders(spark, sf_dir), new_folder(spark, "sketches")
    newest = shift_month(newest_order_date(orders), 0)
    month_sketches.store_sketches(orders, path, "o_totalprice", [])
    month_sketches.store_sketches(files.read_month(orders, newest), path, "o_totalprice", [newest])
    windows = month_sketches.trailing_windows(month_sketches.read_sketches(spark, path), SKETCH_WINDOW)
    found = month_sketches.merged_quantiles(windows, ["window_end"])
    priced = orders.select("o_totalprice", F.explode(F.sequence(F.lit(0), F.lit(SKETCH_WINDOW - 1))).alias("ahead"), "month")
    # One row for each month goes to the orders.
    ranked = priced.withColumn("window_end", F.add_months("month", F.col("ahead"))).join(F.broadcast(found), "window_end")
    price, checks = F.col("o_totalprice"), []
    for k, p in enumerate(quantiles.QUARTILES):
        q = F.col("quantiles")[k]
        below, up_to = F.count_if(price < q) / F.count(F.lit(1)), F.count_if(price <= q) / F.count(F.lit(1))
        checks.append(((below <= p + RANK_ERROR) & (up_to >= p - RANK_ERROR)).alias(f"q{2 * k + 1}_holds"))
    return ranked.groupBy("window_end").agg(F.first("rows").alias("sketched_rows"), *checks)


def _marked_orders(spark: SparkSession, orders: DataFrame) -> deletions.MarkedTable:
    return deletions.MarkedTable(spark, _stored_orders(spark, orders), new_folder(spark, "marks"), "o_custkey")


def retention_by_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What ``retention_run`` leaves, by marks and compaction, run twice."""
    orders = monthly_orders(spark, sf_dir)
    marked = _marked_orders(spark, orders)
    for _ in range(2):
        flows.mark_retention(marked, newest_order_date(orders))
    return marked.rows()


def marks_keep_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention by marks alone: rows left and marked, and stored files that changed apart from the expired month."""
    orders = monthly_orders(spark, sf_dir)
    marked, as_of = _marked_orders(spark, orders), newest_order_date(orders)
    expired = f"/month={shift_month(as_of, -flows.EXPIRY_MONTHS).isoformat()}/"
    before = {name for name in marked.stored().inputFiles() if expired not in name}
    flows.mark_retention(marked, as_of, share=2.0)
    changed = len(before ^ set(marked.stored().inputFiles()))
    hidden = marked.marked_shares().agg(F.coalesce(F.sum("marked_rows"), F.lit(0))).first()[0]
    return marked.rows().agg(F.count(F.lit(1)).alias("left_rows"), F.lit(hidden).cast("long").alias("marked_rows"),
                             F.lit(changed).cast("long").alias("changed_files"))


def landed_many_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``landed_month`` as dozens of files, whose headers one job reads."""
    raw, base, month = dirty_events(spark, sf_dir), new_folder(spark, "landing"), _event_month(spark, sf_dir)
    place = f"{base}/{landed_stem(month)}"
    extra = raw.where("event_type = 'purchase'").withColumn("category_id", F.col("product_id") * 10)
    _land(spark, extra.repartition(files.DRIVER_FILES), f"{place}/purchases+%41", ["category_id", *reversed(RAW_EVENTS.names)])
    _land(spark, raw.where("event_type <> 'purchase'").repartition(files.DRIVER_FILES), f"{place}/other ones")
    return files.read_landed_month(spark, base, month)


def late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that come after their months were cleaned: the months are cleaned again, with all their rows."""
    raw, base, bounds = dirty_events(spark, sf_dir), new_folder(spark, "late"), _bounds(spark, sf_dir)
    month = month_start(parse_event_time("event_time"))

    def rebuild(rows: DataFrame, one) -> None:
        sinks.write_month(cleaning.clean_events(rows, bounds), f"{base}/cleaned", one)

    for name, rows in (("first", raw.where("event_type = 'purchase'")), ("late", raw.where("event_type <> 'purchase'"))):
        _land(spark, rows, f"{base}/landing/{name}")
        for _ in range(2):  # the second run finds nothing new
            ingest_months(spark, f"{base}/landing/*", base, month, rebuild)
    entries = batch_ledger(spark, f"{base}/ledger").groupBy("month").agg(F.count(F.lit(1)).alias("batches"))
    return spark.read.parquet(f"{base}/cleaned").join(F.broadcast(entries), "month")


QUERIES = {query.__name__: query for query in (
    row_count, preview, month_scan,
    fill_and_drop_nulls, fill_numeric_nulls, dedup_rows, valid_prices, within_fence, normalized_texts,
    parsed_event_times, clean_events, clean_events_dedup_last, clean_events_approx,
    iqr_bounds_exact, iqr_bounds_narrowed, iqr_bounds_head, iqr_bounds_approx,
    approx_rank_error,
    user_activity, event_type_counts, array_value_count, latest_event_time, rfm, user_profile,
    rfm_join_activity, scaled_features, scaler_stage, nearest_centroid, named_segments,
    segment_names_joined, events_with_segment, events_with_segment_split,
    kmeans_segments, kmeans_nearest, pca_norms, pca_scores, elbow_table,
    silhouette, kmeans_silhouette, bootstrap_sample,
    segment_classifier_cv, segment_report, score_new_customers, latest_model_version,
    table_labels, months_from_names, months_newest_first, month_window, pending_months,
    ledger_append, ledger_union, ledger_json, ledger_from_json, expired_months, month_classes,
    recent_months, active_users, inactive_users, surviving_old_rows, retention_survivors,
    retention_report, without_expired_month, drop_month, retention_run,
    month_roundtrip, csv_export_roundtrip, append_roundtrip, raw_copy_roundtrip,
    incremental_ingest, monthly_flow, flagship,
    landed_month, landed_folder, pending_flow, catalog_publish, event_types_with_nulls, event_times_by_zone,
    emptied_month, bootstrap_size, model_roundtrip, segments_by_spending, classifier_against_majority,
    csv_file_roundtrip, bulk_copy, emptied_store, catalog_months, landed_months, guards, variance_shares,
    bootstrap_by_rank, silhouette_sample, emptied_publish, month_table_publish, kmeans_fixed_point, kmeans_repartitioned, elbow_fixed_point, score_by_expression,
    window_fences, retention_by_marks, marks_keep_files, landed_many_files, late_files,
)}
