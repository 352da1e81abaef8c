import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import month
from shopmonth.functions import months as M
from shopmonth.functions import text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} {t}" for k, (t, _) in values.items())
    return spark.createDataFrame([tuple(v for _, v in values.values())], schema).select(column).first()[0]


@pytest.mark.parametrize("given, expected", [
    ("  ACME ", "acme"), ("\tACME\t", "\tacme\t"), ("   ", ""), (None, None), ("NA", "na")])
def test_normalize_text(spark, given, expected):
    assert one(spark, X.normalize_text("s"), s=("string", given)) == expected


def test_array_count(spark):
    assert one(spark, X.array_count("a", "x"), a=("array<string>", ["x", "y", "x", None])) == 2
    assert one(spark, X.array_count("a", "x"), a=("array<string>", [])) == 0


def test_label_for(spark):
    labels = {0: "zero", 1: "one"}
    for key, expected in ((0, "zero"), (1, "one"), (7, "other"), (None, "other")):
        assert one(spark, X.label_for("k", labels, "other"), k=("int", key)) == expected
    assert one(spark, X.label_for("k", {}, "other"), k=("int", 1)) == "other"


def test_string_list_json(spark):
    assert one(spark, X.decode_string_list("s"), s=("string", '["2019-Oct", "2019-Nov"]')) == ["2019-Oct", "2019-Nov"]
    assert one(spark, X.decode_string_list("s"), s=("string", "not json")) is None
    assert one(spark, X.encode_string_list("a"), a=("array<string>", ["a", "b"])) == '["a","b"]'


@pytest.mark.parametrize("name, expected", [
    ("v2", 2), ("v10", 10), ("v10_old", 10), ("tmp", None), ("v", None), ("xv3", None)])
def test_version_number(spark, name, expected):
    assert one(spark, X.version_number("s"), s=("string", name)) == expected


@pytest.mark.parametrize("given, expected", [
    ("2019-10-01 00:00:05 UTC", dt.datetime(2019, 10, 1, 0, 0, 5)),
    ("2019-10-01 12:00:00", dt.datetime(2019, 10, 1, 12)), ("2019-10-01", dt.datetime(2019, 10, 1)),
    ("2019-10-01 01:00:00+02:00", dt.datetime(2019, 9, 30, 23)), ("2019-10-01T01:00:00.5Z", dt.datetime(2019, 10, 1, 1, 0, 0, 500000)),
    ("yesterday", None), ("", None), (None, None)])
def test_parse_event_time(spark, given, expected):
    parsed = M.parse_event_time("s")
    assert one(spark, parsed, s=("string", given)) == expected


def test_elapsed_days_counts_whole_days(spark):
    end = dt.datetime(2019, 10, 3, 0, 0, 0)
    late = M.elapsed_days("a", "b")
    assert one(spark, late, a=("timestamp_ntz", dt.datetime(2019, 10, 2, 23, 59)), b=("timestamp_ntz", end)) == 0
    assert one(spark, late, a=("timestamp_ntz", dt.datetime(2019, 10, 2)), b=("timestamp_ntz", end)) == 1
    assert one(spark, late, a=("timestamp_ntz", dt.datetime(2019, 9, 3, 0, 0, 1)), b=("timestamp_ntz", end)) == 29


def test_month_names(spark):
    d = ("date", dt.date(2019, 10, 1))
    assert one(spark, M.month_label("d"), d=d) == "2019-Oct"
    assert one(spark, M.file_name("d"), d=d) == "data_2019-Oct.csv.gz"
    assert one(spark, M.table_label("d"), d=d) == "data_2019_oct"
    assert M.landed_file(dt.date(2019, 10, 1)) == "2019-Oct.csv.gz"
    assert M.published_table(dt.date(2019, 10, 1)) == "data_2019_oct"


@pytest.mark.parametrize("name, expected", [
    ("data_2019-Oct.csv.gz", month(2019, 10)), ("data_2020-Jan.csv.gz", month(2020, 1)),
    ("data_2019-Foo.csv.gz", None), ("data_2019-oct.csv.gz", None), ("data_2019_oct", None),
    ("data_20x9-Oct.csv.gz", None), ("other", None), ("", None), (None, None)])
def test_month_from_name(spark, name, expected):
    assert one(spark, M.month_from_name("s"), s=("string", name)) == expected


def test_last_months(spark):
    got = one(spark, M.last_months("d", 3), d=("date", dt.date(2020, 1, 31)))
    assert got == [month(2019, 11), month(2019, 12), month(2020, 1)]
    got = one(spark, M.last_months("d", 2, include_current=False), d=("date", dt.date(2020, 1, 31)))
    assert got == [month(2019, 11), month(2019, 12)]


@pytest.mark.parametrize("as_of, expected", [
    (dt.date(2024, 1, 15), month(2022, 12)), (dt.date(2024, 2, 29), month(2023, 1)),
    (dt.date(2024, 12, 31), month(2023, 11))])
def test_expired_month(spark, as_of, expected):
    assert one(spark, M.expired_month("d"), d=("date", as_of)) == expected
    assert M.shift_month(as_of, -13) == expected


def test_oldest_recent_month():
    assert M.oldest_recent_month(dt.date(2024, 1, 31)) == month(2023, 2)
    assert M.oldest_recent_month(dt.date(2024, 12, 1)) == month(2024, 1)
    assert M.oldest_recent_month(dt.date(2024, 6, 1), keep=1) == month(2024, 6)


def test_every_month_name(spark):
    for number in range(1, 13):
        label = one(spark, M.month_label("d"), d=("date", dt.date(2021, number, 1)))
        assert M.landed_file(dt.date(2021, number, 1)) == f"{label}.csv.gz"
        assert one(spark, M.month_from_label(F.lit(label)), d=("int", 1)) == month(2021, number)
