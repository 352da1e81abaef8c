"""File system calls on any Hadoop scheme: list, move, delete."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def encoded_path(spark: SparkSession, path: str) -> str:
    """Absolute path without scheme and authority, encoded as in a URI."""
    fs, target = _file_system(spark, path)
    return fs.makeQualified(target).toUri().getRawPath()


def list_files(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ("",)) -> list[str]:
    """The file at a path, or all files below it, whose names end in a suffix (in any case).

    Names that begin with a dot or an underscore are left out, also as folders.
    """
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    found, open_ = [], [fs.getFileStatus(target)]
    while open_:
        status = open_.pop()
        name = status.getPath().getName()
        if status.isDirectory():
            open_ += [s for s in fs.listStatus(status.getPath()) if s.getPath().getName()[0] not in "._"]
        elif name.lower().endswith(suffixes):
            found.append(status.getPath().toString())
    return sorted(found)


def first_line(spark: SparkSession, path: str) -> str:
    """First line of a text file, unpacked by its suffix; empty for an empty file."""
    jvm = spark.sparkContext._jvm
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(
            spark.sparkContext._jsc.hadoopConfiguration()).getCodec(target)
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; empty when the folder does not exist."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(target))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _file_system(spark, source)
    _, target_path = _file_system(spark, target)
    if not fs.exists(source_path):
        raise FileNotFoundError(source)
    if fs.exists(target_path):
        fs.delete(target_path, False)
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete recursively; False when there was nothing."""
    fs, target = _file_system(spark, path)
    return fs.delete(target, True)
