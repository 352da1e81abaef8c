"""Quality of segments, and classifiers that predict them."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, OneVsRest, OneVsRestModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schema import FEATURE_COLUMNS

# The searched settings.
TREE_DEPTHS = (3, 5)
LEARNING_RATES = (0.1, 0.01)
TREE_COUNTS = (50, 100)
SILHOUETTE_SAMPLE = 10_000


def elbow_table(vectors: DataFrame, column: str = "pca_vector", max_k: int = 10,
                seed: int = 42, parallelism: int = 4) -> DataFrame:
    """Cost of k-means for k = 2 … ``max_k``.

    The fits are independent and share one cached copy of the vectors;
    ``parallelism`` of them run at the same time.
    """
    spark = vectors.sparkSession
    cached = vectors.select(column).persist(StorageLevel.MEMORY_AND_DISK)

    def cost(k: int) -> tuple[int, float]:
        model = KMeans(k=k, seed=seed, featuresCol=column).fit(cached)
        return k, float(model.summary.trainingCost)

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            costs = list(pool.map(inheritable_thread_target(spark)(cost), range(2, max_k + 1)))
    finally:
        cached.unpersist()
    return spark.createDataFrame(costs, "k int, inertia double")


def silhouette(labelled: DataFrame, vector: str, cluster: str = "cluster") -> float:
    """Mean silhouette with squared Euclidean distance over all rows.

    The distance sums follow from per-cluster totals, so there is no pairwise
    work; plain Euclidean distances, which need all pairs, would give another
    number on the same labels.
    """
    return ClusteringEvaluator(featuresCol=vector, predictionCol=cluster).evaluate(labelled)


def bootstrap_sample(df: DataFrame, rows: int = SILHOUETTE_SAMPLE, seed: int = 42) -> DataFrame:
    """About ``rows`` rows drawn with replacement."""
    total = df.count()
    return df.sample(True, rows / total, seed) if total else df


def bootstrap_sample_exact(df: DataFrame, rows: int = SILHOUETTE_SAMPLE, seed: int = 42) -> DataFrame:
    """Exactly ``rows`` rows drawn with replacement.

    Every row stands for a slot, numbered within its partition. How many draws each
    partition gets is a multinomial draw over the partitions' sizes, one number per
    partition on the driver; which of its rows they hit is drawn where the rows are.
    Nothing is sorted or gathered, and ``df`` should be a stored table, since its
    rows must come in the same partitions twice.
    """
    number = df.select("*", F.spark_partition_id().alias("_part"))
    sizes = number.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect()
    total = sum(row.n for row in sizes)
    if total == 0:
        return df
    generator = np.random.default_rng(seed)
    drawn = generator.multinomial(rows, [row.n / total for row in sizes])
    wanted = {row._part: (int(row.n), int(k)) for row, k in zip(sizes, drawn)}

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, start = None, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            if counts is None:
                part = batch.column(batch.num_columns - 1)[0].as_py()
                size, hits = wanted[part]
                counts = np.bincount(np.random.default_rng((seed, part)).integers(0, size, hits), minlength=size)
            times = counts[start:start + batch.num_rows]
            start += batch.num_rows
            picked = pa.array(np.repeat(np.arange(batch.num_rows), times))
            yield batch.select(batch.schema.names[:-1]).take(picked)

    return number.mapInArrow(draw, df.schema)


def bounded_training(rows: DataFrame, limit: int | None, seed: int = 42) -> DataFrame:
    """All labelled rows, or about ``limit`` of them, drawn evenly; a bound on training, not on scoring."""
    total = rows.count() if limit else 0
    return rows.sample(False, limit / total, seed) if limit and total > limit else rows


@dataclass(frozen=True)
class SearchResult:
    scores: DataFrame
    model: OneVsRestModel
    depth: int
    rate: float
    trees: int


def training_rows(features: DataFrame, cluster: str = "cluster",
                  columns: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Unscaled feature vector and numeric label."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features")
    return assembler.transform(features).select("features", F.col(cluster).cast("double").alias("label"))


def search_classifier(rows: DataFrame, depths: Sequence[int] = TREE_DEPTHS,
                      rates: Sequence[float] = LEARNING_RATES, trees: Sequence[int] = TREE_COUNTS,
                      folds: int = 3, parallelism: int = 4, seed: int = 42) -> SearchResult:
    """Cross-validated search over gradient-boosted trees, one against the rest.

    Every setting trains one forest per class and fold, so ``rows`` should be a
    stored table; ``parallelism`` settings train at the same time.
    """
    base = GBTClassifier(seed=seed)
    grid = (ParamGridBuilder().addGrid(base.maxDepth, list(depths)).addGrid(base.stepSize, list(rates))
            .addGrid(base.maxIter, list(trees)).build())
    fitted = _validator(OneVsRest(classifier=base), grid, folds, parallelism, seed).fit(rows)
    settings = [(setting[base.maxDepth], float(setting[base.stepSize]), setting[base.maxIter])
                for setting in grid]
    scored = [(*setting, float(score)) for setting, score in zip(settings, fitted.avgMetrics)]
    best = max(range(len(scored)), key=lambda i: scored[i][3])
    scores = rows.sparkSession.createDataFrame(
        scored, "max_depth int, learning_rate double, trees int, accuracy double")
    return SearchResult(scores, fitted.bestModel, *settings[best])


def cross_validate(rows: DataFrame, depth: int, rate: float, trees: int, folds: int = 5,
                   parallelism: int = 4, seed: int = 42) -> float:
    """Mean accuracy of one setting over shuffled folds."""
    base = GBTClassifier(seed=seed, maxDepth=depth, stepSize=rate, maxIter=trees)
    outer = OneVsRest(classifier=base)
    fitted = _validator(outer, ParamGridBuilder().build(), folds, parallelism, seed).fit(rows)
    return float(fitted.avgMetrics[0])


def _validator(estimator, grid, folds, parallelism, seed) -> CrossValidator:
    return CrossValidator(estimator=estimator, estimatorParamMaps=grid, numFolds=folds, seed=seed,
                          parallelism=parallelism,
                          evaluator=MulticlassClassificationEvaluator(metricName="accuracy"))
