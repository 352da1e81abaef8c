import pytest
from pyspark.sql import functions as F

from helpers import tuples
from shopmonth.operators import joins as J


@pytest.fixture
def facts(spark):
    """A third of the rows on key 1, some without a key, some on keys the other side lacks."""
    key = (F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 17 == 0, None)
           .otherwise(F.col("id") % 50)).cast("long")
    return spark.range(900).select(key.alias("k"), F.col("id").alias("v"))


@pytest.fixture
def dim(spark):
    return spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).cast("int").alias("w"))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
@pytest.mark.parametrize("options", [
    {}, {"broadcast_bytes": 0}, {"broadcast_bytes": 0, "hot_share": 0.2, "hot_rows": 0},
    {"broadcast_bytes": 0, "hot_share": 0.01, "hot_rows": 0}])
def test_all_paths_agree(facts, dim, how, options):
    expected = facts.join(dim, "k", how)
    got = J.join_facts(facts, dim, "k", how, **options)
    assert got.columns == expected.columns
    assert tuples(got) == tuples(expected)


def test_only_null_is_hot(spark, dim):
    facts = spark.createDataFrame([(None, i) for i in range(90)] + [(i, i) for i in range(60)], "k long, v long")
    got = J.join_facts(facts, dim, "k", "left", broadcast_bytes=0, hot_share=0.3, hot_rows=0)
    assert tuples(got) == tuples(facts.join(dim, "k", "left"))


def test_hot_keys_are_bounded(facts):
    assert J.hot_keys(facts, "k", 0.2, 0) == [1]
    assert len(J.hot_keys(facts, "k", 0.001, 0)) <= 1000
    assert J.hot_keys(facts, "k", 0.2) == []


def test_hot_rows_are_not_shuffled(facts, dim):
    plan = J.join_facts(facts, dim, "k", "left", broadcast_bytes=0, hot_share=0.2, hot_rows=0)
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in text and "strategy=broadcast" in text


def test_size_bound(spark, dim):
    assert J.size_bound(dim) == 40 * (J._ROW_OVERHEAD + 32)
    texts = spark.createDataFrame([(1, "ab"), (2, None), (3, "äöü")], "k long, s string")
    assert J.size_bound(texts) == 3 * (J._ROW_OVERHEAD + 32 + 6)
    assert J.size_bound(texts.limit(0)) == 0
    assert J.size_bound(dim.withColumn("a", F.array("w"))) is None
