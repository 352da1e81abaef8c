"""Registered queries against their SQL on whole tables."""

import pytest

import compare
from shopmonth.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    sf = f"{compare.TESTDATA}/sf0.001"
    con, df = compare.duck(sf), QUERIES[name](spark, sf)
    assert compare.types_of_spark(df) == compare.types_of_sql(con, ORACLES[name])
    assert compare.rows_of_spark(df) == compare.rows_of_sql(con, ORACLES[name])
