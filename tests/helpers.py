"""Small hand-made inputs."""

import datetime as dt

from shopmonth.sources.schema import RAW_EVENTS

DAY = dt.date


def raw(spark, rows):
    """Rows in the order of the raw columns."""
    return spark.createDataFrame(rows, RAW_EVENTS)


def event(time="2019-10-01 00:00:00 UTC", kind="view", product=1, category="a.b", brand="acme",
          price=10.0, user=1, session="s1"):
    return (time, kind, product, category, brand, price, user, session)


def tuples(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])


def month(year, number):
    return dt.date(year, number, 1)
