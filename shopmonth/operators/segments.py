"""User segments: features → standardised vector → k-means → stable segment ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, PCAModel, SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import label_for
from ..sources.schema import FEATURE_COLUMNS, require_columns
from .joins import join_facts

DEFAULT_K = 4
DEFAULT_SEED = 42

# Segment names by id, and what other ids are called.
SEGMENT_NAMES = {
    0: "Occasional Spender",
    1: "Window Shopper",
    2: "Loyal Customer",
    3: "Heavy Cart User",
    4: "Top Spender",
}
OTHER_SEGMENT = "Other"


def scaling_stages(columns: Sequence[str] = FEATURE_COLUMNS) -> list:
    """Assemble the features and bring them to mean 0 and sample deviation 1."""
    return [
        VectorAssembler(inputCols=list(columns), outputCol="raw_vector"),
        StandardScaler(inputCol="raw_vector", outputCol="scaled_vector", withMean=True, withStd=True),
    ]


def fit_segments(features: DataFrame, k: int = DEFAULT_K, seed: int = DEFAULT_SEED,
                 columns: Sequence[str] = FEATURE_COLUMNS, pca_components: int | None = None,
                 order_by: str | None = "total_spent") -> PipelineModel:
    """Fit scaling and k-means as one model that also scores new users.

    The features are read several times: hand in a stored table. K-means numbers
    its clusters arbitrarily, so a last stage renumbers them by the rising centre
    of ``order_by``; None keeps the raw numbers.
    """
    require_columns(features, columns)
    if order_by is not None and order_by not in columns:
        raise ValueError(f"order_by must be one of the columns or None, not {order_by!r}")
    stages = scaling_stages(columns)
    vector = "scaled_vector"
    if pca_components:
        stages.append(PCA(k=pca_components, inputCol=vector, outputCol="pca_vector"))
        vector = "pca_vector"
    stages.append(KMeans(k=k, seed=seed, featuresCol=vector, predictionCol="raw_cluster"))
    fitted = Pipeline(stages=stages).fit(features)
    numbers = _rising_order(fitted, list(columns).index(order_by)) if order_by else {i: i for i in range(k)}
    cases = " ".join(f"WHEN {raw} THEN {number}" for raw, number in sorted(numbers.items()))
    renumber = SQLTransformer(
        statement=f"SELECT *, CASE raw_cluster {cases} END AS cluster FROM __THIS__")
    return PipelineModel(fitted.stages + [renumber])


def cluster_centers(model: PipelineModel) -> list[list[float]]:
    """Raw cluster centres in the standardised feature space (k rows, driver side)."""
    kmeans = next(stage for stage in model.stages if isinstance(stage, KMeansModel))
    components = next((stage.pc.toArray() for stage in model.stages if isinstance(stage, PCAModel)), None)
    centers = kmeans.clusterCenters()
    if components is not None:
        centers = [components @ center for center in centers]
    return [[float(value) for value in center] for center in centers]


def explained_variance(model: PipelineModel) -> list[float]:
    """Variance share of each principal component; empty without that stage."""
    return [float(share) for stage in model.stages if isinstance(stage, PCAModel)
            for share in stage.explainedVariance]


def _rising_order(model: PipelineModel, position: int) -> dict[int, int]:
    centers = cluster_centers(model)
    order = sorted(range(len(centers)), key=lambda i: (centers[i][position], centers[i]))
    return {raw: number for number, raw in enumerate(order)}


def assign_segments(model: PipelineModel, features: DataFrame) -> DataFrame:
    """``user_id, cluster`` of each row of a feature table."""
    return model.transform(features).select("user_id", "cluster")


def join_segments(events: DataFrame, segments: DataFrame, **join_options) -> DataFrame:
    """Left join of the segment onto every event, ``user_id`` first."""
    return join_facts(events, segments, "user_id", "left", **join_options)


def name_segments(segments: DataFrame, names: dict[int, str] = SEGMENT_NAMES,
                  default: str = OTHER_SEGMENT) -> DataFrame:
    return segments.withColumn("cluster_name", label_for("cluster", names, default))


def join_segment_names(segments: DataFrame, names: DataFrame, default: str = OTHER_SEGMENT) -> DataFrame:
    """Names from a table instead of a literal map; a cluster with several names gets the first by the alphabet.

    Broadcast only while the measured size allows it.
    """
    names = names.groupBy("cluster").agg(F.min("cluster_name").alias("cluster_name"))
    return (join_facts(segments, names, "cluster", "left")
            .withColumn("cluster_name", F.coalesce("cluster_name", F.lit(default))))


def standardize(df: DataFrame, columns: Sequence[str] = FEATURE_COLUMNS, suffix: str = "_z") -> DataFrame:
    """Mean 0 and sample deviation 1 per column; a constant column becomes 0.

    The same numbers as the scaler stage, as plain columns. Like the scaler's fit
    this runs one job, for two numbers per column; applying them needs none.
    """
    moments = df.agg(*[F.avg(c).alias(f"{c}_mean") for c in columns],
                     *[F.stddev_samp(c).alias(f"{c}_std") for c in columns]).first()
    return df.select(*df.columns, *[
        ((F.col(c) - moments[f"{c}_mean"]) / moments[f"{c}_std"] if moments[f"{c}_std"] else F.lit(0.0))
        .alias(f"{c}{suffix}") for c in columns])


def nearest_centroid(df: DataFrame, centroids: Sequence[Sequence[float]],
                     columns: Sequence[str]) -> DataFrame:
    """Id of the nearest fixed centroid by squared distance; the lower id wins a tie."""
    distances = F.array(*[
        sum(((F.col(c) - F.lit(float(x))) * (F.col(c) - F.lit(float(x))) for c, x in zip(columns, centroid)),
            F.lit(0.0))
        for centroid in centroids])
    nearest = F.array_position("_distances", F.array_min("_distances")) - 1
    return (df.withColumn("_distances", distances)
            .withColumn("cluster", nearest.cast("int")).drop("_distances"))


def pca_scores(features: DataFrame, components: int = 2,
               columns: Sequence[str] = FEATURE_COLUMNS) -> tuple[DataFrame, list[float]]:
    """Principal component scores of the standardised features, and the variance shares."""
    stages = scaling_stages(columns) + [PCA(k=components, inputCol="scaled_vector", outputCol="pca_vector")]
    model = Pipeline(stages=stages).fit(features)
    shares = [float(share) for share in model.stages[-1].explainedVariance]
    return model.transform(features).select("user_id", "pca_vector"), shares
