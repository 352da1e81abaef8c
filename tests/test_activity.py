import datetime as dt

import pytest

from helpers import tuples
from shopmonth.operators import activity as A

SCHEMA = "user_id long, event_time timestamp_ntz, event_type string, price double, user_session string"


def at(day, hour=0):
    return dt.datetime(2019, 10, day, hour)


@pytest.fixture
def events(spark):
    return spark.createDataFrame([
        (1, at(1), "view", 10.1, "a"), (1, at(1, 5), "view", 0.2, "a"), (1, at(2), "cart", 5.0, "b"),
        (1, at(3), "purchase", 5.0, None), (2, at(9, 23), "remove_from_cart", None, "c"),
        (2, at(10, 22), "other", None, "c"), (3, None, "view", 7.0, "d"),
    ], SCHEMA)


def test_user_activity(events):
    assert tuples(A.user_activity(events, digits=2)) == [
        (1, 2, 1, 0, 1, 2, 20.3), (2, 0, 0, 1, 0, 1, 0.0), (3, 1, 0, 0, 0, 1, 7.0)]


def test_other_type_names(events):
    got = A.user_activity(events, {"others": "other"})
    assert got.columns == ["user_id", "others", "sessions", "total_spent"]


def test_null_users_stay_one_group(spark):
    df = spark.createDataFrame([(None, at(1), "view", 1.0, "a"), (0, at(1), "view", 2.0, "b")], SCHEMA)
    assert tuples(A.user_activity(df), "user_id", "total_spent") == [(None, 1.0), (0, 2.0)]


def test_sums_do_not_depend_on_order(spark):
    rows = [(1, at(1), "view", 0.1 * i, "a") for i in range(1000)]
    sums = {A.user_activity(spark.createDataFrame(rows[::step], SCHEMA).repartition(n), digits=2).first().total_spent
            for step, n in ((1, 1), (1, 7), (-1, 3))}
    assert sums == {49950.0}
    plain = A.user_activity(spark.createDataFrame(rows, SCHEMA)).first().total_spent
    assert plain == pytest.approx(49950.0)


def test_small_and_large_prices_are_kept(spark):
    small = [(1, at(1), "view", 0.00004, "a")] * 1000
    assert A.user_activity(spark.createDataFrame(small, SCHEMA)).first().total_spent == pytest.approx(0.04)
    large = [(1, at(1), "view", 1e300, "a"), (1, at(1), "view", float("inf"), "a")]
    assert A.user_activity(spark.createDataFrame(large, SCHEMA)).first().total_spent == float("inf")


def test_users_without_types_stay(spark):
    events = spark.createDataFrame([(1, at(1), None, 1.0, "a"), (2, at(1), "view", 1.0, "a")], SCHEMA)
    assert tuples(A.histogram_counts(A.event_type_histogram(events)), "user_id", "views", "carts") == [(1, 0, 0), (2, 1, 0)]


def test_histogram(events):
    histogram = A.event_type_histogram(events)
    maps = {r.user_id: r.event_types for r in histogram.collect()}
    assert maps[1] == {"view": 2, "cart": 1, "purchase": 1} and maps[2] == {"remove_from_cart": 1, "other": 1}
    assert tuples(A.histogram_counts(histogram)) == [(1, 2, 1, 0, 1), (2, 0, 0, 1, 0), (3, 1, 0, 0, 0)]


def test_rfm_counts_whole_days_and_skips_rows_without_time(events):
    assert tuples(A.rfm(events, digits=2)) == [(1, 7, 2, 20.3), (2, 0, 1, 0.0)]


def test_profile_equals_join(events):
    timed = events.where("event_time IS NOT NULL")
    joined = A.join_rfm_activity(A.rfm(events), A.user_activity(timed))
    profile = A.user_profile(events)
    assert profile.columns == joined.columns
    assert tuples(profile) == tuples(joined)


def test_one_distinct_plans_two_small_exchanges(events):
    plan = A.user_activity(events)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Expand" not in plan
