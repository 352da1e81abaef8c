import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import event, raw, tuples
from shopmonth.operators import cleaning as C
from shopmonth.sources.schema import require_columns, require_rows

WIDE = (-1e9, 1e9)


def test_null_keys_are_dropped_and_texts_filled(spark):
    df = raw(spark, [event(user=None), event(product=None), event(session=None),
                     event(brand=None, category=None, user=2)])
    got = C.clean_events(df, WIDE)
    assert tuples(got, "user_id", "brand", "category_code") == [(2, "unknown", "unknown")]


def test_exact_duplicates_collapse(spark):
    df = raw(spark, [event()] * 5 + [event(price=11.0)])
    assert C.clean_events(df, WIDE).count() == 2


def test_rows_equal_after_normalising_stay_by_default(spark):
    df = raw(spark, [event(brand="Acme"), event(brand=" acme ")])
    assert C.clean_events(df, WIDE).count() == 2
    assert C.clean_events(df, WIDE, dedup_after_normalize=True).count() == 1


def test_price_rules(spark):
    prices = [0.0, -0.01, None, float("nan"), 5.0, 20.0, 20.01, 4.99]
    df = raw(spark, [event(price=p, product=i) for i, p in enumerate(prices)])
    assert tuples(C.clean_events(df, (5.0, 20.0)), "price") == [(20.0,), (5.0,)]
    assert tuples(C.clean_events(df, (-5.0, 5.0)), "price") == [(0.0,), (4.99,), (5.0,)]


def test_fence_comes_from_raw_rows(spark):
    """Negative prices and rows without a user count for the quartiles."""
    df = raw(spark, [event(price=float(p), product=p) for p in range(1, 10)]
             + [event(price=-100.0, product=100), event(price=-100.0, user=None)])
    low, high = C.price_fence(df, method="exact")
    import numpy as np
    q1, q3 = np.quantile([*range(1, 10), -100.0, -100.0], [0.25, 0.75])
    assert (low, high) == (q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))


def test_bad_times_become_null_and_stay(spark):
    df = raw(spark, [event(time="broken"), event(time="2020-02-29 23:59:59 UTC")])
    got = C.clean_events(df, WIDE)
    assert tuples(got, "event_year", "event_month") == [(None, None), (2020, 2)]
    assert C.keep_parsed_times(got).count() == 1


def test_blank_brand_and_null_words(spark):
    df = raw(spark, [event(brand="   "), event(brand="NA", product=2), event(brand="NULL", product=3),
                     event(brand="\tX", product=4)])
    assert tuples(C.clean_events(df, WIDE), "brand") == [("",), ("\tx",), ("na",), ("null",)]


def test_extra_columns_pass_through(spark):
    df = raw(spark, [event()]).withColumn("category_id", F.lit(7))
    got = C.clean_events(df, WIDE)
    assert got.columns == [*df.columns, "event_year", "event_month"]


def test_timestamps_are_taken_as_they_are(spark):
    df = raw(spark, [event()]).withColumn("event_time", F.lit(dt.datetime(2019, 10, 5)).cast("timestamp_ntz"))
    got = C.clean_events(df, WIDE)
    assert got.schema["event_time"].dataType.simpleString() == "timestamp_ntz"
    assert tuples(got, "event_year", "event_month") == [(2019, 10)]


def test_cleaning_again_with_the_same_fence_changes_nothing(spark):
    df = raw(spark, [event(brand=" A "), event(brand="b", price=3.0), event(price=500.0)])
    once = C.clean_events(df, (0.0, 100.0))
    again = C.clean_events(once.drop("event_year", "event_month"), (0.0, 100.0))
    assert tuples(once) == tuples(again)


def test_filters_stand_below_the_shuffle(spark, folder):
    raw(spark, [event()]).write.parquet(f"{folder}/raw")
    plan = C.clean_events(spark.read.parquet(f"{folder}/raw"), (0.0, 50.0))._jdf.queryExecution().toString()
    assert "LessThanOrEqual(price,50.0)" in plan and "GreaterThanOrEqual(price,0.0)" in plan


def test_guards(spark):
    df = raw(spark, [event()])
    assert require_columns(df, ["price"]) is df
    with pytest.raises(ValueError, match="missing columns: no_such, other"):
        require_columns(df, ["price", "no_such", "other"])
    assert require_rows(df) is df
    with pytest.raises(ValueError, match="march holds no rows"):
        require_rows(df.limit(0), "march")
