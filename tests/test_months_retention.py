import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import month, tuples
from shopmonth.operators import months as M
from shopmonth.operators import retention as R
from shopmonth.sources import ledger as L

AS_OF = dt.date(2024, 1, 15)


def month_frame(spark, *items):
    return spark.createDataFrame([(m,) for m in items], "month date")


def test_pending_months_newest_first(spark):
    ledger = month_frame(spark, month(2023, 12), month(2023, 10))
    got = [r.month for r in M.pending_months(ledger, AS_OF, 4).collect()]
    assert got == [month(2024, 1), month(2023, 11)]
    got = [r.month for r in M.pending_months(ledger, AS_OF, 4, include_current=False).collect()]
    assert got == [month(2023, 11), month(2023, 9)]
    window = {r.month for r in M.month_window(spark, AS_OF, 4).collect()}
    assert window <= {month(2024, 1), month(2023, 11)} | {r.month for r in ledger.collect()}


def test_month_classes_use_the_date_not_the_rank(spark):
    months = month_frame(spark, month(2023, 2), month(2023, 1), month(2020, 5), month(2024, 1))
    got = tuples(M.classify_months(months, AS_OF))
    assert got == [(month(2020, 5), "old"), (month(2023, 1), "old"), (month(2023, 2), "recent"),
                   (month(2024, 1), "recent")]
    assert [r.month for r in M.recent_months(months, AS_OF).collect()] == [month(2024, 1), month(2023, 2)]


def test_ledger_append_is_idempotent(spark, folder):
    path = f"{folder}/ledger"
    assert L.read_ledger(spark, path).count() == 0
    added = month_frame(spark, month(2023, 1), month(2023, 1), month(2023, 2))
    L.append_months(spark, path, added)
    L.append_months(spark, path, added)
    L.append_months(spark, path, month_frame(spark, month(2023, 3)))
    assert tuples(spark.read.parquet(path)) == [(month(2023, 1),), (month(2023, 2),), (month(2023, 3),)]


def test_ledger_json(spark, folder):
    with open(f"{folder}/months.json", "w") as handle:
        handle.write('[\n  "2019-Oct",\n  "2019-Nov",\n  "bad"\n]')
    ledger = L.read_ledger_json(spark, f"{folder}/months.json")
    assert tuples(ledger) == [(month(2019, 10),), (month(2019, 11),)]
    assert L.render_ledger_json(ledger).first()[0] == '["2019-Oct","2019-Nov"]'


@pytest.fixture
def table(spark):
    """User 1 active, 2 only old, 3 only in the boundary month, 4 active, plus rows without a user."""
    return spark.createDataFrame([
        (1, month(2022, 5)), (1, month(2024, 1)), (2, month(2022, 5)), (2, month(2022, 6)),
        (3, month(2023, 1)), (4, month(2023, 2)), (4, month(2022, 6)),
        (None, month(2022, 5)), (None, month(2023, 6)), (2, None),
    ], "user_id long, month date").withColumn("v", F.monotonically_increasing_id())


def test_active_and_inactive_users(table):
    active = R.active_users(table, AS_OF)
    assert tuples(active) == [(1,), (4,)]
    assert tuples(R.inactive_users(table, active, AS_OF)) == [(2,), (3,)]


@pytest.mark.parametrize("options", [{}, {"broadcast_bytes": 0},
                                     {"broadcast_bytes": 0, "hot_share": 0.3, "hot_rows": 0}])
def test_survivors(table, options):
    active = R.active_users(table, AS_OF)
    old = R.surviving_old_rows(table, active, AS_OF, **options)
    assert tuples(old, "user_id", "month") == [
        (None, month(2022, 5)), (1, month(2022, 5)), (4, month(2022, 6))]
    kept = R.survivors(table, active, AS_OF, **options)
    assert kept.columns == table.columns
    assert tuples(kept, "user_id", "month") == [
        (None, month(2022, 5)), (None, month(2023, 6)), (1, month(2022, 5)), (1, month(2024, 1)),
        (2, None), (4, month(2022, 6)), (4, month(2023, 2))]
    assert tuples(R.survivors(kept, R.active_users(kept, AS_OF), AS_OF, **options)) == tuples(kept)


def test_report(table):
    got = tuples(R.retention_report(table, R.active_users(table, AS_OF), AS_OF))
    assert got == [(month(2022, 5), 3, 1, 1), (month(2022, 6), 2, 1, 1), (month(2023, 1), 1, 1, 1)]


def test_empty_active_set_is_refused(table):
    nobody = R.active_users(table, dt.date(2040, 1, 1))
    with pytest.raises(ValueError):
        R.require_active(nobody)
    assert R.require_active(nobody, allow_empty=True) is nobody


def test_without_month(table):
    assert R.without_month(table, month(2022, 5)).count() == 7
    stamped = table.select(F.col("month").cast("timestamp_ntz").alias("at"))
    assert R.without_month(stamped, month(2022, 5), "at").count() == 7
