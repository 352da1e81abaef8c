"""Quantiles of windows of months from stored sketches."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmonth.operators import month_sketches as ms

JAN, FEB, MAR, JUN = (dt.date(2024, m, 1) for m in (1, 2, 3, 6))


def stored(spark, folder, rows, months):
    df = spark.createDataFrame(rows, "v double, month date, clash string")
    ms.store_sketches(df, f"{folder}/sketches", "v", months)
    return ms.read_sketches(spark, f"{folder}/sketches")


def test_ranks_of_a_merged_window_hold(spark, folder):
    rng = np.random.default_rng(3)
    by_month = {JAN: rng.lognormal(size=30_000), FEB: np.full(50_000, 1.0), MAR: rng.normal(size=20_000)}
    rows = [(float(v), m, "x") for m, values in by_month.items() for v in values]
    sketches = stored(spark, folder, rows, by_month)
    everything = np.sort(np.concatenate(list(by_month.values())))
    probabilities = (0.01, 0.25, 0.5, 0.75, 0.99)
    row = ms.merged_quantiles(sketches, probabilities=probabilities).first()
    assert row.rows == len(everything)
    for p, q in zip(probabilities, row.quantiles):
        low, high = np.searchsorted(everything, q, "left"), np.searchsorted(everything, q, "right")
        assert low / len(everything) - 0.005 <= p <= high / len(everything) + 0.005
    assert max(len(r.sketch) for r in sketches.collect()) < 100_000


def test_few_values_are_exact_and_nulls_are_none(spark, folder):
    rows = [(float(v), JAN, None) for v in (5, 1, 4, 2, 3)] + [(None, JAN, None), (float("nan"), JAN, None), (9.0, None, None), (None, FEB, None)]
    sketches = stored(spark, folder, rows, [JAN, FEB])
    assert [(r.month, r.rows) for r in sketches.collect()] == [(JAN, 5)]
    assert ms.merged_quantiles(sketches, probabilities=(0.0, 0.5, 1.0)).first().quantiles == [1.0, 3.0, 5.0]
    assert ms.window_fence(sketches, [JAN, FEB]) == ms.window_fence(sketches, [JAN])
    with pytest.raises(ValueError, match="no value"):
        ms.window_fence(sketches, [FEB])


def test_a_month_stored_again_is_replaced_also_by_nothing(spark, folder):
    stored(spark, folder, [(1.0, JAN, None), (2.0, FEB, None)], [JAN, FEB])
    sketches = stored(spark, folder, [(7.0, JAN, None)], [JAN])
    assert {r.month: r.quantiles for r in ms.merged_quantiles(sketches, ["month"], (0.5,)).collect()} == {JAN: [7.0], FEB: [2.0]}
    sketches = stored(spark, folder, [], [JAN])
    assert [r.month for r in sketches.collect()] == [FEB]
    assert ms.read_sketches(spark, f"{folder}/none").count() == 0


def test_windows_go_by_calendar(spark, folder):
    sketches = stored(spark, folder, [(1.0, JAN, None), (2.0, FEB, None), (3.0, MAR, None), (4.0, JUN, None)], [])
    found = ms.merged_quantiles(ms.trailing_windows(sketches, 2), ["window_end"], (1.0,))
    assert {r.window_end: (r.rows, r.quantiles[0]) for r in found.collect()} == {JAN: (1, 1.0), FEB: (2, 2.0), MAR: (2, 3.0), JUN: (1, 4.0)}


def test_facts_are_not_read_again(spark, folder):
    sketches = stored(spark, folder, [(1.0, JAN, None)], [JAN])
    read = ms.merged_quantiles(sketches.where(F.col("month").isin([JAN]))).inputFiles()
    assert read and all("/sketches/" in name for name in read)
