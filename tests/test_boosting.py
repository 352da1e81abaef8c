"""Boosted trees: real fits on small tables, against plain computations."""

import numpy as np
import pandas as pd

from shopmonth.operators import boosting


def noisy(rows, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(rows, 3)).round(2)
    label = (x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 0] > 0.5)
    return x, np.where(rng.random(rows) < 0.05, 0, label)


def test_one_tree_takes_the_best_split_of_each_class():
    x, label = noisy(80)
    edges = boosting.bin_edges(x)
    bins = boosting.binned(x, edges)
    gradient = np.full((80, 3), 1 / 3) - (label[:, None] == np.arange(3))
    hessian = np.full((80, 3), 2 / 3 * 2 / 3)
    trees = boosting.grow(bins, gradient, hessian, 1, max(map(len, edges)) + 1)
    for c in range(3):
        best, split = -1, None
        for f in range(3):
            for e in edges[f]:
                left = x[:, f] <= e
                sides = [(gradient[s, c].sum(), hessian[s, c].sum()) for s in (left, ~left)]
                gain = sum(g * g / (h + 1) for g, h in sides) - gradient[:, c].sum() ** 2 / (hessian[:, c].sum() + 1)
                if min(h for _, h in sides) >= 1 and gain > best + 1e-12:
                    best, split = gain, left
        weight = np.where(split, -gradient[split, c].sum() / (hessian[split, c].sum() + 1),
                          -gradient[~split, c].sum() / (hessian[~split, c].sum() + 1))
        assert np.allclose(trees.scores(bins)[:, c], weight)


def test_prefix_of_a_longer_fit_is_the_shorter_fit():
    x, label = noisy(300)
    train = pd.DataFrame({"features": list(x[:200]), "label": label[:200]})
    test = pd.DataFrame({"features": list(x[200:]), "label": label[200:]})
    both = boosting.staged_accuracy(train, test, 3, 0.1, (10, 25))
    assert both == [*boosting.staged_accuracy(train, test, 3, 0.1, (10,)), *boosting.staged_accuracy(train, test, 3, 0.1, (25,))]
    assert both[-1][1] >= 85


def test_search_of_the_whole_grid_does_not_depend_on_partitions(spark):
    x, label = noisy(400, 1)
    rows = [(k, *map(float, v), int(c)) for k, (v, c) in enumerate(zip(x, label))]
    frame = spark.createDataFrame(rows, "user_id long, a double, b double, c double, cluster int")
    found = []
    for parts in (1, 7):
        table = boosting.training_table(frame.repartition(parts), 300, columns=("a", "b", "c")).persist()
        search = boosting.search_boosted(table)
        assert table.count() == 300 and search.scores.count() == 8
        found.append((sorted(map(tuple, search.scores.collect())), search.depth, search.rate, search.trees, search.accuracy))
        table.unpersist()
    assert found[0] == found[1]
    majority = np.bincount(label).max() / len(label)
    assert found[0][-1] > majority + 0.1 and max(r[-1] for r in found[0][0]) > majority + 0.1


def test_few_rows_one_class_and_nulls(spark):
    frame = spark.createDataFrame([(None, 1.0, 0), (1, 2.0, 0), (2, 2.0, 0), (3, 5.0, None)], "user_id long, a double, cluster int")
    table = boosting.training_table(frame, columns=("a",))
    assert table.count() == 3
    assert boosting.search_boosted(table, folds=2).accuracy == 1.0
    folds = boosting.with_folds(boosting.training_table(frame.limit(0), columns=("a",)), 3)
    assert folds.count() == 0
