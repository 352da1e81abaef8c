"""Bootstrap by rank and pairwise silhouettes against plain versions."""

import hashlib
import math
import random

import pytest

from shopmonth.operators import sampling


def md5(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


@pytest.mark.parametrize("rows_per_range", [1 << 16, 5])
def test_draws_depend_on_keys_only(spark, monkeypatch, rows_per_range):
    monkeypatch.setattr(sampling, "ROWS_PER_RANGE", rows_per_range)
    keys = random.Random(1).sample(range(10_000), 300)
    order = sorted(keys, key=lambda k: md5(7, k))
    wanted = [(j, order[int(md5(7, "draw", j)[:15], 16) % 300]) for j in range(1000)]
    for parts in (1, 7, 64):
        df = spark.createDataFrame([(k, k * 2) for k in keys], "user_id long, v long").repartition(parts)
        found = sampling.bootstrap_by_rank(df, rows=1000, seed=7)
        assert sorted((r.draw, r.user_id) for r in found.collect()) == wanted
        assert found.where("v <> 2 * user_id").isEmpty()


def test_nulls_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (3, 1), (3, 1)], "user_id long, v int")
    drawn = [sorted(map(tuple, sampling.bootstrap_by_rank(df.repartition(p), rows=50).collect()), key=str) for p in (1, 3)]
    assert drawn[0] == drawn[1] and len(drawn[0]) == 50
    assert sampling.bootstrap_by_rank(df.limit(0)).count() == 0


@pytest.mark.parametrize("block_rows", [1_000, 7])
def test_pairwise_silhouette(spark, block_rows):
    rng = random.Random(3)
    rows = [(k, rng.choice([0, 1, 1, 2]), [rng.choice([0.0, 1.5, rng.random()]), rng.random() * 3]) for k in range(60)]
    rows += [(60, 9, [5.0, 5.0]), (61, 4, [2.0, 2.0]), (62, 4, [2.0, 2.0])]
    found = sampling.pairwise_silhouette(spark.createDataFrame(rows, "draw long, cluster int, v array<double>"), "v", block_rows=block_rows)
    wanted = {}
    for k, own, x in rows:
        means = {}
        for c in {r[1] for r in rows}:
            d = [math.dist(x, y) for j, o, y in rows if o == c and j != k]
            means[c] = sum(d) / len(d) if d else 0.0
        near, far = means.pop(own), min(means.values())
        wanted[k] = 0.0 if sum(o == own for _, o, _ in rows) == 1 else (far - near) / max(far, near)
    assert {r.draw: round(r.silhouette, 9) for r in found.collect()} == {k: round(v, 9) for k, v in wanted.items()}


def test_one_cluster_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0, [1.0]), (2, 0, [2.0])], "draw long, cluster int, v array<double>")
    assert [r.silhouette for r in sampling.pairwise_silhouette(df, "v").collect()] == [None, None]
    assert sampling.pairwise_silhouette(df.limit(0), "v").count() == 0
