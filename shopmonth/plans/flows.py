"""Composite flows: clean, segment and publish a month; retention; segment report."""

from __future__ import annotations

import datetime as dt
import traceback
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import published_table, shift_month
from ..operators.activity import user_activity, user_profile
from ..operators.cleaning import clean_events
from ..operators.boosting import TRAINING_ROWS, BoostedSearch, search_boosted, training_table
from ..operators.evaluation import (LEARNING_RATES, TREE_COUNTS, TREE_DEPTHS, bootstrap_sample, elbow_table,
                                    silhouette)
from ..operators.months import PENDING_WINDOW, pending_months
from ..operators.registry import latest_model_version, load_latest_model, save_model
from ..operators.retention import (KEEP_MONTHS, active_users, old_rows, require_active, retention_report,
                                   surviving_old_rows)
from ..operators.segments import (DEFAULT_K, DEFAULT_SEED, SEGMENT_NAMES, assign_segments,
                                  explained_variance, fit_segments, join_segments, name_segments)
from ..sources.deletions import COMPACT_SHARE, MarkedTable
from ..sources.files import read_landed_folder, read_landed_month, read_month
from ..sources.ledger import append_months, read_ledger
from ..sources.schema import ACTIVITY_TYPES, FEATURE_COLUMNS, require_rows
from ..sources.sinks import drop_path_month, export_csv_file, write_jdbc, write_month, write_months
from ..sources.storage import path_exists
from ..sources.workdir import stage, work_folder

EXPIRY_MONTHS = 13
SOURCE_FILE = "source_file"
REPORT_K = 5


@dataclass(frozen=True)
class Store:
    """Folders of the tables of one deployment, below a base path of any Hadoop scheme."""

    base: str

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def cleaned(self) -> str:
        return f"{self.base}/cleaned"

    @property
    def published(self) -> str:
        return f"{self.base}/published"

    @property
    def ledger(self) -> str:
        return f"{self.base}/processed_months"

    def models(self, k: int) -> str:
        return f"{self.base}/models/kmeans_k{k}"


def stored_month(spark: SparkSession, path: str, month: dt.date) -> DataFrame:
    """One month of a stored table without its partition column and the name of its landed file.

    Months may differ in their extra columns: those of this month are read.
    """
    one = f"{path.rstrip('/')}/month={month.isoformat()}"
    if path_exists(spark, one):
        return spark.read.parquet(one).drop(SOURCE_FILE)
    return read_month(spark.read.parquet(path), month).drop("month", SOURCE_FILE)


def copy_raw_month(raw: DataFrame, store: Store, month: dt.date) -> None:
    """Keep the landed rows as they are, as splittable Parquet of even files.

    ``source_file`` says which file a row landed in; it is null where the rows do
    not bring it along.
    """
    if SOURCE_FILE not in raw.columns:
        raw = raw.withColumn(SOURCE_FILE, F.lit(None).cast("string"))
    write_month(raw.hint("rebalance"), store.raw, month)


def copy_raw_folder(spark: SparkSession, landing: str, store: Store) -> None:
    """Keep all landed files below a folder in one job, in the layout of ``copy_raw_month``.

    Months are replaced as a whole. A file whose name or folder gives no month is
    refused before anything is written.
    """
    rows = read_landed_folder(spark, landing)
    unlabelled = rows.where("month IS NULL").select(SOURCE_FILE).first()
    if unlabelled:
        raise ValueError(f"no month in the name of {unlabelled[0]}")
    write_months(rows.hint("rebalance", "month"), store.raw)


def clean_month(spark: SparkSession, store: Store, month: dt.date, **options) -> None:
    """Raw month → cleaned month."""
    raw = require_rows(stored_month(spark, store.raw, month), f"raw month {month}")
    write_month(clean_events(raw, **options), store.cleaned, month)


def stored_features(events: DataFrame, types: Mapping[str, str] = ACTIVITY_TYPES,
                    folder: str | None = None, digits: int | None = None) -> DataFrame:
    """Per-user features as a stored table, sorted within its files.

    K-means starts from a sample that depends on the order of rows. With the same
    partitioning a rerun gives the same segments; other file sizes or another
    number of partitions may start it elsewhere.
    """
    return stage(user_activity(events, types, digits).sortWithinPartitions("user_id"), "features", folder)


def segment_month(spark: SparkSession, store: Store, month: dt.date, k: int = DEFAULT_K,
                  seed: int = DEFAULT_SEED, types: Mapping[str, str] = ACTIVITY_TYPES,
                  mode: str = "train", digits: int | None = None) -> PipelineModel:
    """Cleaned month → published month with a segment and the model's version on every event.

    The per-user features are stored before the fit, which reads them many times.
    ``mode="reuse"`` scores with the latest saved model instead of training.
    """
    if mode not in ("train", "reuse"):
        raise ValueError(f"unknown mode {mode!r}")
    events = require_rows(stored_month(spark, store.cleaned, month), f"cleaned month {month}")
    with work_folder(spark, "segment") as folder:
        features = stored_features(events, types, folder, digits)
        if mode == "train":
            model = fit_segments(features, k, seed)
            version = int(save_model(model, spark, store.models(k)).rpartition("/v")[2])
        else:
            version = latest_model_version(spark, store.models(k))
            model = load_latest_model(spark, store.models(k))
        published = join_segments(events, assign_segments(model, features))
        write_month(published.withColumn("model_version", F.lit(version)), store.published, month)
    return model


def publish_month_jdbc(spark: SparkSession, store: Store, month: dt.date, url: str,
                       options: Mapping[str, str] | None = None, **writing) -> None:
    """Copy a published month to its own warehouse table."""
    write_jdbc(stored_month(spark, store.published, month), url, published_table(month), options, **writing)


def process_month(raw: DataFrame, store: Store, month: dt.date, k: int = DEFAULT_K,
                  types: Mapping[str, str] = ACTIVITY_TYPES, mode: str = "train",
                  publish: Callable[[SparkSession, Store, dt.date], None] | None = None,
                  digits: int | None = None, **cleaning) -> None:
    """Raw copy, clean, segment, publish; the ledger entry comes last.

    ``publish`` may carry the published month on, for example over JDBC.

    Each step replaces its month as a whole, so a run that broke off is repeated
    without a trace of the first attempt in the tables; a model that the first
    attempt had saved stays as a version of its own, and the published rows name
    the version they come from.
    """
    spark = raw.sparkSession
    copy_raw_month(raw, store, month)
    clean_month(spark, store, month, **cleaning)
    segment_month(spark, store, month, k, types=types, mode=mode, digits=digits)
    if publish:
        publish(spark, store, month)
    append_months(spark, store.ledger, spark.createDataFrame([(month,)], "month date"))


def process_pending(spark: SparkSession, landing: str, store: Store, as_of: dt.date,
                    window: int = PENDING_WINDOW, include_current: bool = True,
                    read: Callable[[dt.date], DataFrame] | None = None, **options) -> DataFrame:
    """Process every month of the window that is not in the ledger.

    A month that fails (its file may not have landed) does not stop the others
    and stays pending. Returns one row per month: ``month, status, error``.
    """
    read = read or (lambda month: read_landed_month(spark, landing, month))
    outcome = []
    pending = pending_months(read_ledger(spark, store.ledger), as_of, window, include_current)
    for row in pending.collect():
        try:
            process_month(read(row.month), store, row.month, **options)
            outcome.append((row.month, "done", None))
        except Exception as error:
            traceback.print_exc()
            outcome.append((row.month, "failed", str(error)))
    return spark.createDataFrame(outcome, "month date, status string, error string")


def run_retention(spark: SparkSession, path: str, as_of: dt.date, user: str = "user_id",
                  keep: int = KEEP_MONTHS, allow_empty: bool = False, **join_options) -> DataFrame:
    """Drop the expired month and delete inactive users from old months.

    ``path`` is a table partitioned by ``month``. Recent months and old months
    without deletions are not rewritten. The surviving rows are stored in full
    before any partition is replaced, because a plan must not overwrite what it
    reads. Returns the report per old month; a second run deletes nothing.
    """
    drop_path_month(spark, path, shift_month(as_of, -EXPIRY_MONTHS))
    events = spark.read.parquet(path)
    with work_folder(spark, "retention") as folder:
        active = stage(active_users(events, as_of, user, keep=keep), "active", folder)
        require_active(active, allow_empty)
        report = settled_report(stage(retention_report(events, active, as_of, user, keep=keep), "report", folder))
        changed = report.where("deleted_rows > 0").select("month", "rows_before", "deleted_rows").collect()
        if changed:
            affected = events.where(F.col("month").isin([row.month for row in changed]))
            kept = surviving_old_rows(affected, active, as_of, user, keep=keep, **join_options)
            write_months(stage(kept.hint("rebalance", "month"), "survivors", folder), path)
        for row in changed:
            if row.deleted_rows == row.rows_before:
                drop_path_month(spark, path, row.month)
    return report


def mark_retention(table: MarkedTable, as_of: dt.date, keep: int = KEEP_MONTHS, allow_empty: bool = False,
                   share: float = COMPACT_SHARE) -> list[dt.date]:
    """``run_retention`` by marks: inactive users of old months are marked, and only months with many marks are rewritten.

    Both ways leave the same rows to readers. Returns the months that were rewritten;
    a second run marks nothing.
    """
    table.drop(shift_month(as_of, -EXPIRY_MONTHS))
    events, user = table.rows(), table.user
    with work_folder(table.spark, "retention") as folder:
        active = stage(active_users(events, as_of, user, keep=keep), "active", folder)
        require_active(active, allow_empty)
        pairs = old_rows(events, "month", as_of, keep).select("month", user).distinct()
        table.mark(stage(pairs.join(active, user, "left_anti"), "gone", folder))
    return table.compact(share)


def settled_report(report: DataFrame) -> DataFrame:
    """One row per month, as literals: the report outlives the folder of the run."""
    return report.sparkSession.createDataFrame(report.collect(), report.schema)


@dataclass(frozen=True)
class SegmentReport:
    users: DataFrame
    explained_variance: list[float]
    elbow: DataFrame
    silhouette: float
    search: BoostedSearch | None
    accuracy: float | None


def segment_report(events: DataFrame, folder: str, k: int = REPORT_K, seed: int = DEFAULT_SEED,
                   types: Mapping[str, str] = ACTIVITY_TYPES, names: Mapping[int, str] = SEGMENT_NAMES,
                   components: int = 2, max_k: int = 10, sample_rows: int | None = None,
                   classify: bool = True, depths: Sequence[int] = TREE_DEPTHS,
                   rates: Sequence[float] = LEARNING_RATES, trees: Sequence[int] = TREE_COUNTS,
                   search_folds: int = 3, folds: int = 5, training_limit: int = TRAINING_ROWS,
                   digits: int | None = None) -> SegmentReport:
    """Named segments from k-means on principal components, with their quality.

    The tables it makes go to ``folder``, which belongs to the caller and holds the
    users that are returned. The silhouette is over all users; ``sample_rows`` takes
    it over a bootstrap sample. ``training_limit`` bounds the labelled rows that the
    classifier search trains on, taken by a hash of the user; everything else
    covers all of them.
    """
    profile = stage(user_profile(events, types, digits).sortWithinPartitions("user_id"), "profile", folder)
    require_rows(profile, "user profile")
    model = fit_segments(profile, k, seed, pca_components=components)
    labelled = stage(model.transform(profile).select(
        "user_id", *FEATURE_COLUMNS, "pca_vector", "cluster"), "labelled", folder)
    users = name_segments(labelled, names).select("user_id", *FEATURE_COLUMNS, "cluster", "cluster_name")
    scored = bootstrap_sample(labelled, sample_rows, seed) if sample_rows else labelled
    search = accuracy = None
    if classify:
        rows = stage(training_table(labelled, training_limit, seed), "training", folder)
        search = search_boosted(rows, depths, rates, trees, search_folds, folds, seed)
        accuracy = search.accuracy
    return SegmentReport(users, explained_variance(model), elbow_table(labelled, "pca_vector", max_k, seed),
                         silhouette(scored, "pca_vector"), search, accuracy)


def write_report(report: SegmentReport, folder: str, name: str = "segments.csv.gz") -> str:
    """The named segments as one file for people; returns its path."""
    return export_csv_file(report.users, folder, name)
