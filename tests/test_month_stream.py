"""Headers read by one job, and streams that rebuild months."""

import datetime as dt
import gzip
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopmonth.sources import files
from shopmonth.sources.sinks import write_month
from shopmonth.streaming.ingest import batch_ledger, ingest_months

SCHEMA = T.StructType([T.StructField("day", T.DateType()), T.StructField("n", T.IntegerType())])
JAN, FEB = dt.date(2024, 1, 1), dt.date(2024, 2, 1)


def put(path, text, packed=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with (gzip.open if packed else open)(path, "wb") as out:
        out.write(text.encode())


def test_headers_by_a_job_equal_those_of_the_driver(spark, folder):
    put(f"{folder}/a b+%41.csv", "x,y\n1,2\n")
    put(f"{folder}/ü.csv.gz", '"x, z", y\n' + "3,4\n" * 50_000, packed=True)
    put(f"{folder}/empty.csv", "")
    put(f"{folder}/bom.csv", "﻿x,y\n")
    put(f"{folder}/only.csv", "x")
    put(f"{folder}/large.csv", "x,y\n" + "5,6\n" * 400_000)
    names = files.list_files(spark, folder, (".csv", ".csv.gz"))
    by_job = files.csv_headers(spark, names, driver_files=0)
    assert by_job == files.csv_headers(spark, names, driver_files=100) == {n: files.csv_header(spark, n) for n in names}
    assert by_job[next(n for n in names if "ü" in n)] == ("x, z", "y")


def test_many_files_are_one_job(spark, folder):
    for k in range(60):
        put(f"{folder}/{k}.csv", "day,n\n2024-01-05,1\n" if k % 2 else "n,day\n1,2024-01-05\n")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("headers", "headers")
    try:
        lines = files.first_lines(spark, files.list_files(spark, folder))
        # Listing so many paths may be a job of its own.
        assert len(tracker.getJobIdsForGroup("headers")) <= 2
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(set(lines.values())) == ["day,n", "n,day"] and len(lines) == 60
    rows = files.read_events_csv(spark, folder, SCHEMA, required=["n"])
    assert rows.agg(F.sum("n"), F.count("day")).first() == (60, 60)


def test_a_name_twice_is_refused_by_both(spark, folder):
    put(f"{folder}/a.csv", "x,X\n")
    for driver_files in (0, 10):
        with pytest.raises(ValueError, match="twice"):
            files.csv_headers(spark, files.list_files(spark, folder), driver_files)


def stream(spark, folder, rebuilt, **options):
    def rebuild(rows, month):
        rebuilt.append(month)
        write_month(rows.groupBy("n").count(), f"{folder}/out", month)

    ingest_months(spark, f"{folder}/in", folder, F.trunc("day", "MM"), rebuild, SCHEMA, **options)


def counts(spark, folder):
    return {(r.month, r.n): r["count"] for r in spark.read.parquet(f"{folder}/out").collect()}


def test_a_late_file_opens_its_month_again(spark, folder):
    rebuilt = []
    put(f"{folder}/in/1.csv", "day,n\n2024-01-05,1\n2024-02-07,2\n,9\n")
    stream(spark, folder, rebuilt)
    assert rebuilt == [JAN, FEB] and counts(spark, folder) == {(JAN, 1): 1, (FEB, 2): 1}
    put(f"{folder}/in/2.csv", "day,n\n2024-01-09,1\n2024-01-09,3\n")
    for _ in range(2):
        stream(spark, folder, rebuilt)
    assert rebuilt == [JAN, FEB, JAN] and counts(spark, folder) == {(JAN, 1): 2, (JAN, 3): 1, (FEB, 2): 1}
    assert sorted(map(tuple, batch_ledger(spark, f"{folder}/ledger").collect())) == [(JAN, 0), (JAN, 1), (FEB, 0)]
    assert spark.read.parquet(f"{folder}/raw").where("month IS NULL").count() == 1


def test_a_batch_that_broke_off_comes_again_without_a_trace(spark, folder):
    put(f"{folder}/in/1.csv", "day,n\n2024-01-05,1\n2024-02-07,2\n")
    fails = [True]

    def rebuild(rows, month):
        if month == FEB and fails:
            fails.clear()
            raise OSError("lost")
        write_month(rows.groupBy("n").count(), f"{folder}/out", month)

    month = F.trunc("day", "MM")
    with pytest.raises(Exception, match="lost"):
        ingest_months(spark, f"{folder}/in", folder, month, rebuild, SCHEMA)
    assert batch_ledger(spark, f"{folder}/ledger").count() == 0
    for _ in range(2):
        ingest_months(spark, f"{folder}/in", folder, month, rebuild, SCHEMA)
    assert counts(spark, folder) == {(JAN, 1): 1, (FEB, 2): 1}
    assert spark.read.parquet(f"{folder}/raw").count() == 2 and batch_ledger(spark, f"{folder}/ledger").count() == 2


def test_each_batch_takes_its_files(spark, folder):
    for k in range(3):
        put(f"{folder}/in/{k}.csv", f"day,n\n2024-01-0{k + 1},{k}\n")
    rebuilt = []
    stream(spark, folder, rebuilt, files_per_batch=1)
    assert rebuilt == [JAN] * 3 and counts(spark, folder) == {(JAN, k): 1 for k in range(3)}
    assert batch_ledger(spark, f"{folder}/ledger").count() == 3
