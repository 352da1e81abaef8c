"""Registered queries against SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import compare
from shopmonth.plans.oracles import ORACLES
from shopmonth.plans.queries import QUERIES

SF_DIR = f"{compare.TESTDATA}/sf0.001"
# The queries of the optional subpackage are tested in its own folder.
OWN = list(QUERIES)


@pytest.fixture(scope="module")
def con():
    return compare.duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, con, name):
    sql = entry.oracle_sql()[name]
    df = entry.queries()[name](spark, SF_DIR)
    assert compare.types_of_spark(df) == compare.types_of_sql(con, sql)
    assert compare.rows_of_spark(df) == compare.rows_of_sql(con, sql)


@pytest.mark.parametrize("name", sorted(set(OWN) - set(ORACLES)))
def test_gives_rows(spark, name):
    assert entry.queries()[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "user_id" and df.columns[-1] == "cluster"
    assert df.where("cluster IS NULL").count() == 0
