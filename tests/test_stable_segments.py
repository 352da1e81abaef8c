"""K-means in whole numbers against a plain version in Python integers."""

import hashlib
import math
import random

import pytest

from shopmonth.operators import stable_segments as S

COLUMNS = ("views", "total_spent")


def table(spark, rows, parts):
    return spark.createDataFrame(rows, "user_id long, views long, total_spent double").repartition(parts)


def random_rows(n, seed):
    rng = random.Random(seed)
    rows = [(k, rng.choice([0, 1, 5, 40]), round(rng.choice([10, 500, 9000]) * rng.random(), 2)) for k in range(n)]
    return rows + [(n, None, None), (n + 1, 3, None), (None, 2, 7.5)]


def plain(rows, k, rounds=S.ROUNDS):
    units = [(key, [math.floor(float(v or 0) * u + 0.5) for v, u in zip(values, (1.0, 100.0))]) for key, *values in rows]
    n, z = len(units), [(key, []) for key, _ in units]
    for c in range(2):
        column = [u[c] for _, u in units]
        s, q = sum(column), sum(x * x for x in column)
        mean, deviation = float(s) / n, math.sqrt(float(n * q - s * s) / float(n * (n - 1)))
        for (_, out), x in zip(z, column):
            out.append(math.floor((float(x) - mean) / deviation * float(S.SCALE) + 0.5) if deviation else 0)
    name = lambda j, key: hashlib.md5(f"42:{j}:{'' if key is None else key}".encode()).hexdigest()
    order = lambda key: (key is not None, key or 0)
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    centres = [min(z, key=lambda p: (name(0, p[0]), order(p[0])))[1]]
    while len(centres) < k:
        races = [(-math.log((int(name(len(centres), key)[:15], 16) + 1) / float(1 << 60)) / float(d), order(key), p)
                 for key, p in z if (d := min(away(p, c) for c in centres)) > 0]
        if not races:
            break
        centres.append(min(races)[2])
    for _ in range(rounds):
        groups = [[] for _ in centres]
        for _, p in z:
            groups[min(range(len(centres)), key=lambda i: (away(p, centres[i]), i))].append(p)
        centres = [[math.floor(float(sum(v)) / float(len(g)) + 0.5) for v in zip(*g)] if g else c for g, c in zip(groups, centres)]
    return centres, sum(min(away(p, c) for c in centres) for _, p in z)


@pytest.mark.parametrize("k", [2, 5])
def test_centres_labels_and_costs(spark, k):
    rows = random_rows(80, k)
    centres, cost = plain(rows, k)
    found = []
    for parts in (1, 7):
        features = table(spark, rows, parts)
        placed = S.points(features, S.fit_scaling(features, COLUMNS)).persist()
        seeds = S.draw_seeds(placed, 6)
        runs = S.lloyd(placed, {j: seeds[:j] for j in range(2, 7)})
        assert sorted(map(list, runs[k].centres)) == sorted(centres) and runs[k].cost == cost
        assert S.elbow(placed, 6).where(f"k = {k}").first().inertia == cost / S.SCALE ** 2
        model = S.fit_stable(features, lambda df: df.persist(), k, columns=COLUMNS)
        found.append(sorted(map(tuple, model.assign(features).collect()), key=str))
        spent = [c[1] for c in model.centres]
        assert spent == sorted(spent)
        placed.unpersist()
    assert found[0] == found[1]


def test_few_different_rows_and_none(spark):
    features = table(spark, [(1, 2, 5.0), (2, 2, 5.0), (3, 2, 9.0)], 2)
    model = S.fit_stable(features, lambda df: df.persist(), 4, columns=COLUMNS)
    assert len(model.centres) == 2
    assert sorted(map(tuple, model.assign(features).collect())) == [(1, 0), (2, 0), (3, 1)]
    with pytest.raises(ValueError):
        S.fit_stable(features.limit(0), lambda df: df, 2, columns=COLUMNS)


def test_huge_sums_of_distances_stay_exact(spark):
    far = S.LARGEST
    rows = spark.range(3000).selectExpr(f"array(CAST(CASE WHEN id % 2 = 0 THEN {far} ELSE -{far} END AS BIGINT), 0L) AS z", "id AS key")
    assert S.lloyd(rows, {1: [(0, 0)]}, 0)[1].cost == 3000 * far * far
