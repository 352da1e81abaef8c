"""Segments of new customers, as a batch."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from ..functions.text import label_for
from ..sources.schema import FEATURE_COLUMNS, require_columns
from .segments import SEGMENT_NAMES

# Fixed value: label of a cluster the lookup does not know.
UNKNOWN_SEGMENT = "Segment Inconnu"


def score_customers(customers: DataFrame, model: PipelineModel,
                    names: Mapping[int, str] = SEGMENT_NAMES,
                    default: str = UNKNOWN_SEGMENT) -> DataFrame:
    """Cluster and segment name of each customer. All six features are required.

    The model that scales also predicts, so new customers go through exactly what
    the training rows went through.
    """
    require_columns(customers, FEATURE_COLUMNS)
    scored = model.transform(customers)
    return scored.select(*customers.columns, "cluster", label_for("cluster", names, default).alias("segment"))
