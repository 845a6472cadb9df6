"""Files and folders of any file system that Spark reads."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def at(spark: SparkSession, path: str) -> tuple:
    """(file system, path) of a path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all in it; none there is no error."""
    fs, where = at(spark, path)
    fs.delete(where, True)


def _moved(fs, path, to) -> bool:
    """Whether a move went well; some file systems raise where others say no."""
    try:
        return fs.rename(path, to)
    except Py4JJavaError:
        return False


def replace(spark: SparkSession, path: str, to: str) -> None:
    """Move a folder to where another one may be. The other one steps aside first and comes back if the move fails."""
    fs, here = at(spark, path)
    _, there = at(spark, to)
    _, aside = at(spark, f"{path}-before")
    fs.mkdirs(there.getParent())
    had = fs.exists(there)
    if had and not _moved(fs, there, aside):
        raise OSError(f"{to} could not be moved away")
    if not _moved(fs, here, there):
        if had:
            _moved(fs, aside, there)
        raise OSError(f"{path} could not be moved to {to}")
    fs.delete(aside, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if there is no such folder."""
    fs, where = at(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []
