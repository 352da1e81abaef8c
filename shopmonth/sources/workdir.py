"""The shared folder in which intermediate tables are written."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from .storage import delete_path

_local_fallback: str | None = None


def shared_root(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster
    without it is refused, because no executor could read another's local disk.
    Whether a ``file:`` path is a shared mount only its owner can know, so it is taken.
    """
    global _local_fallback
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_fallback is None:
        _local_fallback = tempfile.mkdtemp(prefix="shopmonth-")
        atexit.register(shutil.rmtree, _local_fallback, ignore_errors=True)
    return _local_fallback


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing has used before."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def work_folder(spark: SparkSession, purpose: str) -> Iterator[str]:
    """A new folder for the intermediate tables of one step, deleted when the step ends."""
    path = new_folder(spark, purpose)
    try:
        yield path
    finally:
        delete_path(spark, path)


def stage(df: DataFrame, purpose: str, folder: str | None = None) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage so that several consumers (model fits, size checks, joins)
    read one columnar copy, which also outlives a lost executor. Without a
    ``folder`` the copy stays, for results that are read later.
    """
    spark = df.sparkSession
    path = f"{folder}/{purpose}" if folder else new_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
