"""Search over boosted trees: all settings and folds are fitted side by side, one group of rows each.

The labelled rows are a bounded table (``training_table``), so the search is spread by
models: every (depth, rate, fold) is a group of its own, and Spark fits the groups at
once. The number of trees costs nothing extra: a fit of 100 trees holds the fit of 50
as its first 50, so both are scored on the way. The trees of all classes of a round grow
together, one histogram for each level, with the second-order gains of softmax loss.

Folds and the bounded rows are chosen by a hash of the key, so scores depend on rows and
seed, not on partitions. Rows without a label are left out; rows without a key stay.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.schema import FEATURE_COLUMNS
from .evaluation import LEARNING_RATES, TREE_COUNTS, TREE_DEPTHS

TRAINING_ROWS = 100_000  # a fold of this many rows and six features fits easily in one task
BINS = 256
# Regularisation of leaf weights and least weight of a child.
LEAF_PENALTY = 1.0
LEAST_CHILD_WEIGHT = 1.0

SCORE_SCHEMA = "max_depth int, learning_rate double, trees int, fold int, correct long, total long"


def training_table(labelled: DataFrame, limit: int = TRAINING_ROWS, seed: int = 42, cluster: str = "cluster",
                   columns: Sequence[str] = FEATURE_COLUMNS, key: str = "user_id") -> DataFrame:
    """``key, features, label`` of all labelled rows, or of the ``limit`` first by a hash of the key."""
    rows = labelled.where(F.col(cluster).isNotNull()).select(
        F.col(key).alias("key"), F.array(*[F.col(c).cast("double") for c in columns]).alias("features"),
        F.col(cluster).cast("int").alias("label"))
    return rows.orderBy(F.xxhash64(F.lit(seed), "key"), "key", "features", "label").limit(limit)


def with_folds(rows: DataFrame, folds: int, seed: int = 42, stratified: bool = True) -> DataFrame:
    """Rows dealt to ``fold`` in the order of a hash; within each label if ``stratified``."""
    order = Window.partitionBy(*(["label"] if stratified else [F.lit(0)])).orderBy(F.xxhash64(F.lit(seed), "key"), "key", "features", "label")
    return rows.withColumn("fold", ((F.row_number().over(order) - 1) % folds).cast("int"))


def bin_edges(features: np.ndarray, bins: int = BINS) -> list[np.ndarray]:
    """Borders between the bins of each column: between all values where they are few, else at quantiles."""
    edges = []
    for column in features.T:
        values = np.unique(column)
        middles = (values[1:] + values[:-1]) / 2
        edges.append(middles if len(middles) < bins else np.unique(np.quantile(column, np.arange(1, bins) / bins)))
    return edges


def binned(features: np.ndarray, edges: Sequence[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, features.T)], axis=1)


class Trees:
    """Trees of one round, one for each class: split feature and bin of each inner node, weight of each leaf."""

    def __init__(self, classes: int, depth: int):
        self.feature = np.full((classes, 2 ** depth), -1, dtype=np.int64)
        self.bin = np.zeros((classes, 2 ** depth), dtype=np.int64)
        self.weight = np.zeros((classes, 2 ** (depth + 1)))
        self.depth = depth

    def scores(self, bins: np.ndarray) -> np.ndarray:
        """Weight of the leaf that each row falls into, for every class; nodes count from 1, children of n are 2n and 2n + 1."""
        rows, classes = np.arange(len(bins))[:, None], np.arange(len(self.feature))[None, :]
        node = np.ones((len(bins), len(self.feature)), dtype=np.int64)
        for _ in range(self.depth):
            inner = node < self.feature.shape[1]
            at = np.where(inner, node, 0)
            feature = np.where(inner, self.feature[classes, at], -1)
            right = bins[rows, np.maximum(feature, 0)] > self.bin[classes, at]
            node = np.where(feature >= 0, 2 * node + right, node)
        return self.weight[classes, node]


def grow(bins: np.ndarray, gradient: np.ndarray, hessian: np.ndarray, depth: int, size: int) -> Trees:
    """One tree for each class; ``gradient`` and ``hessian`` are (rows, classes), ``size`` bins at most in a column."""
    rows, classes = gradient.shape
    columns = bins.shape[1]
    trees = Trees(classes, depth)
    node = np.ones((rows, classes), dtype=np.int64)
    alive = np.ones((rows, classes), dtype=bool)
    which = np.broadcast_to(np.arange(classes), (rows, classes))
    for level in range(depth + 1):
        width = 2 ** level
        slot = which * width + node - width
        if level == depth:
            break
        place = (slot[:, :, None] * columns + np.arange(columns)) * size + bins[:, None, :]
        shape, picked = (classes * width, columns, size), alive
        g, h = (np.bincount(place[picked].ravel(), np.repeat(v[picked], columns), minlength=np.prod(shape)).reshape(shape)
                for v in (gradient, hessian))
        g_left, h_left = g.cumsum(2), h.cumsum(2)
        g_all, h_all = g_left[:, :, -1:], h_left[:, :, -1:]
        g_right, h_right = g_all - g_left, h_all - h_left
        gain = (g_left ** 2 / (h_left + LEAF_PENALTY) + g_right ** 2 / (h_right + LEAF_PENALTY) - g_all ** 2 / (h_all + LEAF_PENALTY))
        gain[(h_left < LEAST_CHILD_WEIGHT) | (h_right < LEAST_CHILD_WEIGHT)] = -1.0
        flat = gain.reshape(classes * width, -1)
        best = flat.argmax(1)
        splits = flat[np.arange(len(best)), best] > 1e-6
        owner, number = np.divmod(np.arange(classes * width), width)
        trees.feature[owner, width + number] = np.where(splits, best // size, -1)
        trees.bin[owner, width + number] = best % size
        alive = alive & splits[slot]
        chosen = trees.feature[which, node]
        right = np.take_along_axis(bins, np.maximum(chosen, 0), 1) > trees.bin[which, node]
        node = np.where(alive, 2 * node + right, node)
        if not alive.any():
            break
    place = which * trees.weight.shape[1] + node
    g, h = (np.bincount(place.ravel(), v.ravel(), minlength=trees.weight.size).reshape(trees.weight.shape) for v in (gradient, hessian))
    trees.weight = -g / (h + LEAF_PENALTY)
    return trees


def boosted(features: np.ndarray, labels: np.ndarray, depth: int, rate: float, rounds: int):
    """Yields the bin edges first, then the trees of one round after the other."""
    edges = bin_edges(features)
    bins, size = binned(features, edges), max((len(e) for e in edges), default=0) + 1
    wanted = labels[:, None] == np.arange(labels.max() + 1)
    margin = np.zeros(wanted.shape)
    yield edges
    for _ in range(rounds):
        share = np.exp(margin - margin.max(1, keepdims=True))
        share /= share.sum(1, keepdims=True)
        trees = grow(bins, share - wanted, np.maximum(2 * share * (1 - share), 1e-16), depth, size)
        trees.weight *= rate
        margin += trees.scores(bins)
        yield trees


def staged_accuracy(train: pd.DataFrame, test: pd.DataFrame, depth: int, rate: float, counts: Sequence[int]) -> list[tuple[int, int]]:
    """(number of trees, rows of ``test`` put into their class) at each of ``counts``, from one fit."""
    features, wanted = np.stack(test["features"]), test["label"].to_numpy()
    steps = boosted(np.stack(train["features"]), train["label"].to_numpy(), depth, rate, max(counts))
    bins, margin, out = binned(features, next(steps)), 0.0, []
    for number, trees in enumerate(steps, 1):
        margin = margin + trees.scores(bins)
        if number in counts:
            out.append((number, int((margin.argmax(1) == wanted).sum())))
    return out


def fold_scores(rows: DataFrame, folds: int, depths: Sequence[int], rates: Sequence[float], counts: Sequence[int],
                seed: int = 42, stratified: bool = True) -> DataFrame:
    """Rows put right in each fold, for every setting; ``rows`` are a bounded ``training_table``."""
    tasks = [(depth, float(rate), fold) for depth in depths for rate in rates for fold in range(folds)]
    copies = F.explode(F.array(*[F.struct(F.lit(d).alias("max_depth"), F.lit(r).alias("learning_rate"), F.lit(f).alias("held_out"))
                                 for d, r, f in tasks]))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        depth, rate, fold = group[["max_depth", "learning_rate", "held_out"]].iloc[0]
        test = group["fold"] == fold
        if test.all() or not test.any():
            return pd.DataFrame([], columns=["max_depth", "learning_rate", "trees", "fold", "correct", "total"])
        # The order of rows decides about the last bits of sums.
        train = group[~test].sort_values(["key", "label"], kind="stable")
        found = staged_accuracy(train, group[test], int(depth), rate, counts)
        return pd.DataFrame([(int(depth), rate, trees, int(fold), right, int(test.sum())) for trees, right in found],
                            columns=["max_depth", "learning_rate", "trees", "fold", "correct", "total"])

    dealt = with_folds(rows, folds, seed, stratified).select("*", copies.alias("task")).select("key", "features", "label", "fold", "task.*")
    return (dealt.repartition(len(tasks), "max_depth", "learning_rate", "held_out")
            .groupBy("max_depth", "learning_rate", "held_out").applyInPandas(fit, SCORE_SCHEMA))


@dataclass(frozen=True)
class BoostedSearch:
    scores: DataFrame
    depth: int
    rate: float
    trees: int
    accuracy: float


def mean_accuracy(scores: DataFrame) -> DataFrame:
    """Mean of the folds' accuracies for every setting."""
    return scores.groupBy("max_depth", "learning_rate", "trees").agg(F.avg(F.col("correct") / F.col("total")).alias("accuracy"))


def search_boosted(rows: DataFrame, depths: Sequence[int] = TREE_DEPTHS, rates: Sequence[float] = LEARNING_RATES,
                   counts: Sequence[int] = TREE_COUNTS, search_folds: int = 3, folds: int = 5, seed: int = 42) -> BoostedSearch:
    """Cross-validated search over all settings, then the mean accuracy of the best one over other folds.

    ``rows`` are a stored ``training_table``. Of equally good settings the first by depth,
    rate (larger first) and number of trees is taken.
    """
    found = mean_accuracy(fold_scores(rows, search_folds, depths, rates, counts, seed)).collect()  # one row for each setting
    if not found:
        raise ValueError("too few labelled rows for the folds")
    scores = rows.sparkSession.createDataFrame(found, "max_depth int, learning_rate double, trees int, accuracy double")
    best = min(found, key=lambda r: (-r.accuracy, r.max_depth, -r.learning_rate, r.trees))
    final = mean_accuracy(fold_scores(rows, folds, [best.max_depth], [best.learning_rate], [best.trees], seed + 1, False)).first()
    return BoostedSearch(scores, best.max_depth, best.learning_rate, best.trees, float(final.accuracy))
