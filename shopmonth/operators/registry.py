"""Numbered model folders ``v1, v2, …`` below a base path."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import version_number
from ..sources.storage import list_names, move_path, path_exists


def latest_version(names: DataFrame, column: str = "name", group_by: str | None = None) -> DataFrame:
    """Highest version among folder names, 0 when there is none."""
    highest = F.coalesce(F.max(version_number(column)), F.lit(0)).alias("latest_version")
    return names.groupBy(group_by).agg(highest) if group_by else names.agg(highest)


def complete_versions(spark: SparkSession, base: str) -> list[str]:
    """Version folders whose model was saved to the end."""
    return [name for name in list_names(spark, base) if path_exists(spark, f"{base.rstrip('/')}/{name}/metadata/_SUCCESS")]


def latest_model_version(spark: SparkSession, base: str) -> int:
    names = spark.createDataFrame([(name,) for name in complete_versions(spark, base)], "name string")
    return latest_version(names).first()[0]


def save_model(model: PipelineModel, spark: SparkSession, base: str) -> str:
    """Save as the next version; an existing version is never overwritten.

    The model is written under a temporary name and renamed when it is complete,
    so a save that broke off is never taken for a version. Numbers of folders that
    are there but not complete are not used again.
    """
    base = base.rstrip("/")
    names = spark.createDataFrame([(name,) for name in list_names(spark, base)], "name string")
    path, work = f"{base}/v{latest_version(names).first()[0] + 1}", f"{base}/_saving-{uuid.uuid4().hex}"
    model.save(work)
    move_path(spark, work, path)
    return path


def load_latest_model(spark: SparkSession, base: str) -> PipelineModel:
    version = latest_model_version(spark, base)
    if version == 0:
        raise FileNotFoundError(f"no model version below {base}")
    return load_model(base, version)


def load_model(base: str, version: int) -> PipelineModel:
    return PipelineModel.load(f"{base.rstrip('/')}/v{version}")
