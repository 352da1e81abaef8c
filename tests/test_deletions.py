"""Deletion by marks, compaction, and retention by both ways."""

import datetime as dt

import pytest

from shopmonth.plans.flows import mark_retention, run_retention
from shopmonth.sources.deletions import MarkedTable
from shopmonth.sources.sinks import write_months
from shopmonth.sources.storage import list_names, path_exists

JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))
ROWS = [("a", 1, JAN), ("a", 2, JAN), ("b", 3, JAN), (None, 4, JAN), ("a", 5, FEB), ("b", 6, FEB), ("c", 7, FEB), ("c", 7, FEB), ("b", 8, MAR)]


def marked(spark, folder, rows=ROWS):
    write_months(spark.createDataFrame(rows, "user_id string, n int, month date").repartition(1), f"{folder}/t")
    return MarkedTable(spark, f"{folder}/t", f"{folder}/marks")


def pairs(spark, rows):
    return spark.createDataFrame(rows, "month date, user_id string")


def left(table):
    return sorted((r.n for r in table.rows().collect()))


def test_marked_rows_are_not_read_and_files_stay(spark, folder):
    table = marked(spark, folder)
    before = sorted(table.stored().inputFiles())
    assert left(table) == [1, 2, 3, 4, 5, 6, 7, 7, 8]
    for _ in range(2):
        table.mark(pairs(spark, [(JAN, "a"), (JAN, "a"), (FEB, "c"), (FEB, "nobody"), (JAN, None), (None, "a")]))
    assert left(table) == [3, 4, 5, 6, 8] and table.marks().count() == 3
    assert spark.read.parquet(f"{folder}/marks").count() == 3
    assert sorted(table.stored().inputFiles()) == before and table.rows().columns == table.stored().columns


def test_only_months_with_many_marks_are_rewritten(spark, folder):
    table = marked(spark, folder)
    table.mark(pairs(spark, [(JAN, "b"), (FEB, "a"), (FEB, "c")]))
    shares = {r.month: (r.rows_before, r.marked_rows, r.marked_users) for r in table.marked_shares().collect()}
    assert shares == {JAN: (4, 1, 1), FEB: (4, 3, 2)}
    before = {m: list_names(spark, f"{folder}/t/month={m}") for m in (JAN, FEB, MAR)}
    assert table.compact(0.5) == [FEB]
    after = {m: list_names(spark, f"{folder}/t/month={m}") for m in (JAN, FEB, MAR)}
    assert after[JAN] == before[JAN] and after[MAR] == before[MAR] and after[FEB] != before[FEB]
    assert left(table) == [1, 2, 4, 6, 8] and {r.month for r in table.marks().collect()} == {JAN}
    assert table.compact(0.5) == []


def test_a_month_without_rows_left_goes(spark, folder):
    table = marked(spark, folder)
    table.mark(pairs(spark, [(MAR, "b")]))
    assert table.compact() == [MAR] and not path_exists(spark, f"{folder}/t/month={MAR}")
    assert left(table) == [1, 2, 3, 4, 5, 6, 7, 7] and table.marks().count() == 0


def test_a_compaction_that_broke_off_can_be_repeated(spark, folder):
    table = marked(spark, folder)
    table.mark(pairs(spark, [(JAN, "a")]))
    table.compact(0.5)
    table.mark(pairs(spark, [(JAN, "a")]))  # as if the marks had stayed
    assert left(table) == [3, 4, 5, 6, 7, 7, 8] and table.compact(0.5) == []
    table.forget([JAN])
    assert table.marks().count() == 0


@pytest.mark.parametrize("share", [0.0, 0.4, 2.0])
def test_both_ways_of_retention_leave_the_same_rows(spark, folder, share):
    as_of = dt.date(2024, 12, 15)
    old, expired = dt.date(2023, 12, 1), dt.date(2023, 11, 1)
    rows = [("a", 1, expired), ("a", 2, old), ("b", 3, old), (None, 4, old), ("a", 5, dt.date(2024, 5, 1)), ("d", 6, dt.date(2022, 1, 1))]
    table = marked(spark, f"{folder}/one", rows)
    marked(spark, f"{folder}/two", rows)
    for _ in range(2):
        mark_retention(table, as_of, share=share)
        run_retention(spark, f"{folder}/two/t", as_of)
    assert left(table) == sorted(r.n for r in spark.read.parquet(f"{folder}/two/t").collect()) == [2, 4, 5]
    assert mark_retention(table, as_of, share=2.0) == []


def test_retention_without_active_users_is_refused(spark, folder):
    table = marked(spark, folder, [("a", 1, dt.date(2020, 1, 1))])
    with pytest.raises(ValueError, match="no active user"):
        mark_retention(table, dt.date(2024, 12, 15))
    assert left(table) == [1]
