"""The registered classifier queries, with their whole grid and real trees."""

import compare
from shopmonth.plans import queries

SF_DIR = f"{compare.TESTDATA}/sf0.001"


def test_whole_grid_and_five_folds(spark):
    rows = queries.segment_classifier_cv(spark, SF_DIR).collect()
    assert sorted(r.folds for r in rows) == [3] * 8 + [5]
    assert {(r.max_depth, r.learning_rate, r.trees) for r in rows} == {(d, x, t) for d in (3, 5) for x in (0.1, 0.01) for t in (50, 100)}
    assert all(0 <= r.accuracy <= 1 for r in rows)
