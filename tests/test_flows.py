import datetime as dt
import gzip
import inspect
import os

import pytest
from pyspark.sql import functions as F

from helpers import month, tuples
from shopmonth.plans import flows
from shopmonth.sources import sinks
from shopmonth.sources.schema import RAW_EVENTS
from shopmonth.streaming.ingest import ingest_landed

AS_OF = dt.date(2019, 12, 5)


def land_month(base, name, days, users=12, kinds=("view", "view", "cart", "remove_from_cart", "purchase")):
    os.makedirs(base, exist_ok=True)
    year_month = {"Oct": "2019-10", "Nov": "2019-11", "Dec": "2019-12"}[name[5:8]]
    lines = [",".join(RAW_EVENTS.names)]
    for i in range(users * days):
        user = i % users
        day = 1 + i // users
        lines.append(f"{year_month}-{day:02d} 10:00:00 UTC,{kinds[(i * 7 + user) % 5]},{i},cat, Brand{user} ,"
                     f"{10 + user},{user},s{user}-{day}")
    lines.append(lines[1])
    with gzip.open(f"{base}/{name}", "wt") as handle:
        handle.write("\n".join(lines) + "\n")


@pytest.fixture
def landed(folder):
    land_month(f"{folder}/landing", "2019-Oct.csv.gz", 20)
    land_month(f"{folder}/landing", "2019-Nov.csv.gz", 10)
    return folder


def test_pending_months_are_processed_once(spark, landed):
    store = flows.Store(f"{landed}/store")
    published = []
    first = flows.process_pending(spark, f"{landed}/landing", store, AS_OF, window=3, k=2, method="exact",
                                  publish=lambda spark, store, month: published.append(month))
    assert [(r.month, r.status) for r in first.collect()] == [
        (month(2019, 12), "failed"), (month(2019, 11), "done"), (month(2019, 10), "done")]
    assert "2019-Dec" in first.first().error
    assert published == [month(2019, 11), month(2019, 10)]
    table = spark.read.parquet(store.published)
    assert tuples(table.groupBy("month").count()) == [(month(2019, 10), 240), (month(2019, 11), 120)]
    assert table.where("cluster IS NULL").count() == 0
    assert tuples(table.select("brand").distinct())[0] == ("brand0",)

    land_month(f"{landed}/landing", "2019-Dec.csv.gz", 2)
    second = flows.process_pending(spark, f"{landed}/landing", store, AS_OF, window=3, k=2, mode="reuse",
                                   method="exact")
    assert tuples(second, "month", "status") == [(month(2019, 12), "done")]
    assert flows.process_pending(spark, f"{landed}/landing", store, AS_OF, window=3).count() == 0
    assert sorted(os.listdir(store.models(2))) == ["v1", "v2"]
    assert len(tuples(spark.read.parquet(store.ledger))) == 3


def test_rerun_of_a_month_replaces_it(spark, landed):
    store = flows.Store(f"{landed}/store")
    raw = flows.read_landed_month(spark, f"{landed}/landing", month(2019, 10))
    segments = []
    for _ in range(2):
        flows.process_month(raw, store, month(2019, 10), k=2, method="exact")
        segments.append(tuples(spark.read.parquet(store.published), "user_id", "cluster"))
    assert segments[0] == segments[1]
    assert spark.read.parquet(store.published).count() == 240
    assert spark.read.parquet(store.ledger).count() == 1


def test_failed_publish_leaves_the_month_pending(spark, landed):
    store = flows.Store(f"{landed}/store")
    raw = flows.read_landed_month(spark, f"{landed}/landing", month(2019, 10))

    def broken(*_):
        raise OSError("warehouse is away")

    with pytest.raises(OSError):
        flows.process_month(raw, store, month(2019, 10), k=2, method="exact", publish=broken)
    assert flows.read_ledger(spark, store.ledger).count() == 0


def test_empty_month_fails(spark, landed):
    store = flows.Store(f"{landed}/store")
    raw = flows.read_landed_month(spark, f"{landed}/landing", month(2019, 10))
    with pytest.raises(Exception):
        flows.process_month(raw.limit(0), store, month(2019, 10))
    with pytest.raises(ValueError):
        flows.segment_month(spark, store, month(2019, 10), mode="guess")


def test_folder_copy(spark, landed):
    store = flows.Store(f"{landed}/store")
    flows.copy_raw_folder(spark, f"{landed}/landing", store)
    got = tuples(spark.read.parquet(store.raw).groupBy("month", "source_file").count())
    assert got == [(month(2019, 10), "2019-Oct.csv.gz", 241), (month(2019, 11), "2019-Nov.csv.gz", 121)]


def test_jdbc_publish_reaches_the_driver(spark, landed):
    store = flows.Store(f"{landed}/store")
    sinks.write_month(spark.range(3), store.published, month(2019, 10))
    with pytest.raises(Exception, match="no.such.Driver"):
        flows.publish_month_jdbc(spark, store, month(2019, 10), "jdbc:none://db", {"driver": "no.such.Driver"})


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0, "hot_share": 0.3, "hot_rows": 0}])
def test_retention_run(spark, folder, options):
    """13 months back is dropped; user 2 leaves the old months; an emptied month disappears."""
    rows = [(1, month(2019, 12)), (1, month(2018, 12)), (2, month(2018, 12)), (2, month(2018, 10)),
            (None, month(2018, 12)), (1, month(2018, 11)), (2, month(2018, 6)), (1, month(2018, 6)),
            (1, month(2018, 5))]
    path = f"{folder}/t"
    sinks.write_months(spark.createDataFrame(rows, "user_id long, month date"), path)
    report = flows.run_retention(spark, path, AS_OF, **options)
    assert tuples(report, "month", "deleted_users", "deleted_rows") == [
        (month(2018, 5), 0, 0), (month(2018, 6), 1, 1), (month(2018, 10), 1, 1), (month(2018, 12), 1, 1)]
    expected = [(None, month(2018, 12)), (1, month(2018, 5)), (1, month(2018, 6)), (1, month(2018, 12)),
                (1, month(2019, 12))]
    assert tuples(spark.read.parquet(path)) == expected
    assert "month=2018-10-01" not in os.listdir(path)
    again = flows.run_retention(spark, path, AS_OF, **options)
    assert again.agg(F.sum("deleted_rows")).first()[0] == 0
    assert tuples(spark.read.parquet(path)) == expected


def test_retention_without_active_users_stops(spark, folder):
    path = f"{folder}/t"
    sinks.write_months(spark.createDataFrame([(1, month(2015, 1))], "user_id long, month date"), path)
    with pytest.raises(ValueError):
        flows.run_retention(spark, path, AS_OF)
    assert spark.read.parquet(path).count() == 1


def test_report_by_defaults_takes_all_users(spark, folder):
    assert inspect.signature(flows.segment_report).parameters["sample_rows"].default is None


def test_raw_layers_are_one(spark, landed):
    """Rows copied by folder are cleaned like rows copied by month; a file without a month is refused."""
    store = flows.Store(f"{landed}/store")
    land_month(f"{landed}/landing/2019-Oct", "2019-Oct-again.csv.gz", 20)
    flows.copy_raw_folder(spark, f"{landed}/landing", store)
    flows.clean_month(spark, store, month(2019, 10), method="exact")
    cleaned = flows.stored_month(spark, store.cleaned, month(2019, 10))
    assert cleaned.count() == 240 and "source_file" not in cleaned.columns
    flows.copy_raw_month(flows.read_landed_month(spark, f"{landed}/landing", month(2019, 10)), store, month(2019, 10))
    assert spark.read.parquet(store.raw).columns[-2:] == ["source_file", "month"]
    land_month(f"{landed}/landing", "2019-Nov.csv.gz", 1)
    os.rename(f"{landed}/landing/2019-Nov.csv.gz", f"{landed}/landing/extra.csv.gz")
    with pytest.raises(ValueError, match="extra.csv.gz"):
        flows.copy_raw_folder(spark, f"{landed}/landing", store)


def test_segment_report(spark, folder):
    rows = [(u, dt.datetime(2019, 10, 1 + e % 28), ("view", "cart", "purchase")[(u + e) % 3], float(u % 5 * 10 + e),
             f"{u}-{e % 4}") for u in range(40) for e in range(5 + u % 7)]
    events = spark.createDataFrame(
        rows, "user_id long, event_time timestamp_ntz, event_type string, price double, user_session string")
    report = flows.segment_report(events, folder, k=3, max_k=3, depths=(1,), rates=(0.1,), trees=(2,),
                                  search_folds=2, folds=2, training_limit=30)
    assert os.path.basename(flows.write_report(report, folder)) in os.listdir(folder)
    assert report.users.columns[-2:] == ["cluster", "cluster_name"] and report.users.count() == 40
    assert len(report.explained_variance) == 2 and -1 <= report.silhouette <= 1
    assert report.elbow.count() == 2 and report.search.scores.count() == 1 and 0 <= report.accuracy <= 1


def test_incremental_ingest(spark, landed):
    landing, table, checkpoint = f"{landed}/landing", f"{landed}/table", f"{landed}/checkpoint"
    ingest_landed(spark, landing, table, checkpoint)
    assert spark.read.parquet(table).count() == 362
    ingest_landed(spark, landing, table, checkpoint)
    assert spark.read.parquet(table).count() == 362
    land_month(landing, "2019-Dec.csv.gz", 1)
    ingest_landed(spark, landing, table, checkpoint, files_per_batch=1)
    assert spark.read.parquet(table).count() == 375
