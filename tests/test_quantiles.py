import numpy as np
import pytest
from pyspark.sql import functions as F

from shopmonth.operators import quantiles as Q


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "price double")


PROBABILITIES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


@pytest.mark.parametrize("direct_rows", [10 ** 6, 50, 300])
@pytest.mark.parametrize("name", ["spread", "hot", "two_values", "constant", "heavy_tail"])
def test_exact_quantiles(spark, name, direct_rows):
    rng = np.random.default_rng(7)
    values = {
        "spread": rng.normal(size=4000),
        "hot": np.concatenate([np.full(1500, 42.0), rng.uniform(0, 100, 2500)]),
        "two_values": np.repeat([1.0, 2.0], [1001, 3001]),
        "constant": np.full(3000, 5.0),
        "heavy_tail": rng.pareto(0.5, 4000),
    }[name]
    got = Q.exact_quantiles(frame(spark, values.tolist()), "price", PROBABILITIES,
                            direct_rows=direct_rows, narrowing_error=0.01)
    assert got == pytest.approx(np.quantile(values, PROBABILITIES).tolist(), rel=1e-12)


def test_nulls_and_nan_are_ignored(spark):
    df = frame(spark, [1.0, None, 2.0, float("nan"), 3.0])
    assert Q.exact_quantiles(df, "price", [0.5, 1.0]) == [2.0, 3.0]


def test_no_values(spark):
    df = frame(spark, [None])
    assert Q.exact_quantiles(df, "price", [0.5]) == [None]
    for method in ("exact", "approx"):
        with pytest.raises(ValueError):
            Q.price_fence(df, method=method)


def test_bracket_reaches_the_scan(spark, folder):
    frame(spark, list(map(float, range(5000)))).write.parquet(f"{folder}/v")
    stored = spark.read.parquet(f"{folder}/v")
    assert Q.exact_quantiles(stored, "price", [0.25], 100, 0.005) == [1249.75]
    plan = Q._inside(stored.withColumnRenamed("price", "v"), [(3.0, 9.0)])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(price), GreaterThan(price,3.0), LessThan(price,9.0)]" in plan


def test_both_ways_give_the_same_bits(spark):
    rng = np.random.default_rng(8)
    values = [*rng.exponential(size=2000).tolist(), *[float("inf")] * 500, -float("inf"), 0.1, 0.1, 0.1]
    df = frame(spark, values).cache()
    wanted = [k / 48 for k in range(49)]
    direct = Q.exact_quantiles(df, "price", wanted)
    narrowed = Q.exact_quantiles(df, "price", wanted, direct_rows=50, narrowing_error=0.002)
    assert [float(x).hex() for x in direct] == [float(x).hex() for x in narrowed]


@pytest.mark.parametrize("error", [0.01, 0.05])
def test_approx_rank_error(spark, error):
    values = np.random.default_rng(3).exponential(size=20_000)
    got = Q.approx_quantiles(frame(spark, values.tolist()), "price", (0.25, 0.75), error)
    for p, value in zip((0.25, 0.75), got):
        assert abs((values <= value).mean() - p) <= error + 1 / len(values)


def test_fence_and_head(spark):
    assert Q.fence(10.0, 20.0) == (-5.0, 35.0)
    df = spark.range(100).select(F.col("id").cast("double").alias("price"), (-F.col("id")).alias("key"))
    assert Q.price_fence(df, method="exact", head=5, head_order="key") == Q.fence(96.0, 98.0)
    with pytest.raises(ValueError):
        Q.price_fence(df, method="guess")
