import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from helpers import tuples
from shopmonth.operators import evaluation as E
from shopmonth.operators import registry as G
from shopmonth.operators import scoring
from shopmonth.operators import segments as S
from shopmonth.sources.schema import FEATURE_COLUMNS


@pytest.fixture(scope="module")
def features(spark):
    """Four groups of users far apart, their numbers in no order of spending."""
    rng = np.random.default_rng(5)
    rows = []
    for user in range(200):
        group = user % 4
        base = [50 * ((group + 1) % 4), 5 * group, group % 2, 3 * group, 2 + group, 1000.0 * ((group * 3) % 4 + 1)]
        noise = rng.integers(0, 3, size=5).tolist()
        rows.append((user, *[int(b + n) for b, n in zip(base[:5], noise)], float(base[5] + rng.uniform(0, 5))))
    return spark.createDataFrame(
        rows, "user_id long, views long, carts long, removals long, purchases long, sessions long, total_spent double"
    ).coalesce(2).cache()


@pytest.fixture(scope="module")
def model(features):
    return S.fit_segments(features)


def test_every_user_gets_one_cluster(features, model):
    got = S.assign_segments(model, features)
    assert got.count() == got.select("user_id").distinct().count() == 200
    assert {r.cluster for r in got.collect()} == {0, 1, 2, 3}
    assert tuples(got) == tuples(S.assign_segments(model, features.repartition(5)))


def test_clusters_are_numbered_by_spending(features, model):
    means = model.transform(features).groupBy("cluster").agg(F.avg("total_spent").alias("m")).orderBy("cluster")
    values = [r.m for r in means.collect()]
    assert values == sorted(values)
    raw = S.fit_segments(features, order_by=None).transform(features)
    assert raw.where("cluster <> raw_cluster").count() == 0


def test_numbers_do_not_depend_on_the_fit(features, model):
    """Well separated groups get the same numbers from another seed and partitioning."""
    other = S.fit_segments(features.repartition(7), seed=1)
    assert tuples(S.assign_segments(other, features)) == tuples(S.assign_segments(model, features))


def test_pca_model(features):
    model = S.fit_segments(features, k=4, pca_components=2)
    shares = S.explained_variance(model)
    assert len(shares) == 2 and 0 < sum(shares) <= 1 + 1e-9
    assert S.explained_variance(S.fit_segments(features, k=2)) == []
    assert {len(center) for center in S.cluster_centers(model)} == {len(FEATURE_COLUMNS)}
    scores, again = S.pca_scores(features)
    assert again == pytest.approx(shares) and scores.count() == 200


def test_standardize_equals_the_scaler(features, model):
    constant = features.withColumn("removals", F.lit(3).cast("long"))
    fitted = S.fit_segments(constant, k=2)
    z = fitted.transform(constant).select("user_id", vector_to_array("scaled_vector").alias("z"))
    columns = [f"{c}_z" for c in FEATURE_COLUMNS]
    both = S.standardize(constant).join(z, "user_id").select("z", *columns).collect()
    for row in both:
        assert row.z == pytest.approx([row[c] for c in columns], abs=1e-9)
        assert row.removals_z == 0.0


def test_nearest_centroid(spark):
    points = [(1, 0.0, 0.0), (2, 5.0, 0.0), (3, 9.0, 1.0), (4, 10.0, 0.0)]
    df = spark.createDataFrame(points, "u int, a double, b double")
    got = S.nearest_centroid(df, [(0.0, 0.0), (10.0, 0.0)], ("a", "b"))
    assert tuples(got, "u", "cluster") == [(1, 0), (2, 0), (3, 1), (4, 1)]


def test_names(spark):
    df = spark.createDataFrame([(1, 0), (2, 4), (3, 9), (4, None)], "user_id int, cluster int")
    assert tuples(S.name_segments(df), "user_id", "cluster_name") == [
        (1, "Occasional Spender"), (2, "Top Spender"), (3, "Other"), (4, "Other")]
    names = spark.createDataFrame([(0, "zero")], "cluster int, cluster_name string")
    assert tuples(S.join_segment_names(df, names), "user_id", "cluster_name") == [
        (1, "zero"), (2, "Other"), (3, "Other"), (4, "Other")]


def test_join_keeps_every_event(spark):
    events = spark.createDataFrame([("a", 1), ("b", 1), ("c", 2), ("d", None)], "e string, user_id long")
    segments = spark.createDataFrame([(1, 3)], "user_id long, cluster int")
    got = S.join_segments(events, segments)
    assert got.columns == ["user_id", "e", "cluster"]
    assert tuples(got, "e", "cluster") == [("a", 3), ("b", 3), ("c", None), ("d", None)]


def test_registry(spark, features, model, folder):
    base = f"{folder}/models"
    assert G.latest_model_version(spark, base) == 0
    with pytest.raises(FileNotFoundError):
        G.load_latest_model(spark, base)
    assert G.save_model(model, spark, base).endswith("/v1")
    assert G.save_model(S.fit_segments(features, k=2), spark, base).endswith("/v2")
    loaded = G.load_latest_model(spark, base)
    assert {r.cluster for r in S.assign_segments(loaded, features).collect()} == {0, 1}
    names = spark.createDataFrame([("v2",), ("v10",), ("tmp",)], "name string")
    assert G.latest_version(names).first()[0] == 10


def test_scoring(spark, features, model):
    got = scoring.score_customers(features.limit(5), model, {0: "low"})
    assert got.columns == [*features.columns, "cluster", "segment"]
    for row in got.collect():
        assert row.segment == ("low" if row.cluster == 0 else "Segment Inconnu")
    scaled = model.transform(features).select(
        vector_to_array("scaled_vector").alias("z"), "raw_cluster").collect()
    centers = np.array(S.cluster_centers(model))
    for row in scaled:
        assert row.raw_cluster == np.argmin(((centers - np.array(row.z)) ** 2).sum(axis=1))
    with pytest.raises(ValueError, match="views"):
        scoring.score_customers(features.drop("views"), model)


def test_elbow(features, model):
    vectors = model.transform(features)
    got = [tuple(r) for r in E.elbow_table(vectors, "scaled_vector", max_k=5).orderBy("k").collect()]
    assert [k for k, _ in got] == [2, 3, 4, 5]
    assert got[0][1] > got[2][1] and all(cost >= 0 for _, cost in got)


def test_silhouette(features, model):
    """Against the definition, over all pairs."""
    labelled = model.transform(features)
    rows = labelled.select(vector_to_array("scaled_vector").alias("z"), "cluster").collect()
    z, c = np.array([r.z for r in rows]), np.array([r.cluster for r in rows])
    d = ((z[:, None, :] - z[None, :, :]) ** 2).sum(axis=2)
    own = np.array([d[i, c == c[i]].sum() / ((c == c[i]).sum() - 1) for i in range(len(c))])
    near = np.array([min(d[i, c == k].mean() for k in set(c) - {c[i]}) for i in range(len(c))])
    expected = ((near - own) / np.maximum(near, own)).mean()
    assert E.silhouette(labelled, "scaled_vector") == pytest.approx(expected)


def test_bootstrap(features):
    exact = E.bootstrap_sample_exact(features, 500, seed=1)
    assert exact.count() == 500
    assert exact.select("user_id").distinct().count() < 200
    assert 300 < E.bootstrap_sample(features, 500, seed=1).count() < 700
    assert E.bootstrap_sample_exact(features.limit(0), 5).count() == 0


def test_classifier(features, model):
    rows = E.training_rows(S.fit_segments(features, k=2).transform(features)).cache()
    result = E.search_classifier(rows, depths=(1, 2), rates=(0.1,), trees=(2,), folds=2)
    assert [(r.max_depth, r.trees) for r in result.scores.collect()] == [(1, 2), (2, 2)]
    best = max(r.accuracy for r in result.scores.collect())
    assert best > 0.9 and result.depth in (1, 2)
    assert result.model.transform(rows).where("prediction = label").count() > 180
    assert E.cross_validate(rows, 1, 0.1, 2, folds=2) > 0.9
