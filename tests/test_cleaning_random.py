"""Cleaning and retention on random rows, against the rules written out in plain Python."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from helpers import month, raw, tuples
from shopmonth.operators import cleaning as C
from shopmonth.operators import retention as R

LIMITS = settings(max_examples=8, deadline=None, derandomize=True,
                  suppress_health_check=[HealthCheck.function_scoped_fixture])

rows = st.lists(st.tuples(
    st.sampled_from(["2019-10-01 00:00:00 UTC", "2019-11-30 23:59:59", "bad", None]),
    st.sampled_from(["view", "cart", None]),
    st.sampled_from([1, 2, None]),
    st.sampled_from([" A.B ", "a.b", None]),
    st.sampled_from([" Acme", "acme", "", None]),
    st.sampled_from([-5.0, 0.0, 1.0, 2.5, 3.0, 1000.0, None]),
    st.sampled_from([7, 8, None]),
    st.sampled_from(["s", "t", None])), min_size=5, max_size=60)


def cleaned(items, low, high):
    kept = set()
    for time, kind, product, category, brand, price, user, session in items:
        if None in (product, user, session, price) or not (price >= 0 and low <= price <= high):
            continue
        category = "unknown" if category is None else category
        kept.add((time, kind, product, category, "unknown" if brand in (None, "") else brand, price, user, session))
    years = {"2019-10-01 00:00:00 UTC": (2019, 10), "2019-11-30 23:59:59": (2019, 11)}
    return sorted([(r[1], r[2], r[3].lower().strip(" "), r[4].lower().strip(" "), r[5], r[6], r[7],
                    *years.get(r[0], (None, None))) for r in kept], key=str)


@LIMITS
@given(items=rows)
def test_cleaning(spark, items):
    # An empty text is not null in a frame, only in a CSV file.
    items = [(*r[:4], r[4] or None, *r[5:]) for r in items]
    prices = [r[5] for r in items if r[5] is not None]
    if not prices:
        return
    q1, q3 = np.quantile(prices, [0.25, 0.75])
    expected = cleaned(items, q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    got = C.clean_events(raw(spark, items), method="exact").drop("event_time")
    order = ["event_type", "product_id", "category_code", "brand", "price", "user_id", "user_session",
             "event_year", "event_month"]
    assert sorted([tuple(r) for r in got.select(order).collect()], key=str) == expected


@LIMITS
@given(items=st.lists(st.tuples(st.sampled_from([1, 2, 3, 4, None]),
                                st.sampled_from([(2022, 1), (2022, 12), (2023, 1), (2023, 2), (2024, 1)])),
                      min_size=1, max_size=40))
def test_retention(spark, items):
    items = [(user, month(*m)) for user, m in items]
    table = spark.createDataFrame(items, "user_id long, month date")
    as_of, bound = dt.date(2024, 1, 20), month(2023, 2)
    active = {user for user, m in items if m >= bound and user is not None}
    expected = [(u, m) for u, m in items if m >= bound or u is None or u in active]
    got = R.survivors(table, R.active_users(table, as_of), as_of, broadcast_bytes=0, hot_share=0.3, hot_rows=0)
    assert tuples(got) == sorted(expected, key=lambda r: [(v is not None, str(v)) for v in r])
