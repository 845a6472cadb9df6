"""A folder kept like another one, extras deleted."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnos.plans.staging import stage
from limnos.sources import files
from limnos.sources.files import at, exists
from limnos.sources.snapshots import list_files

COPY, DELETE, KEEP = "copy", "delete", "keep"


def _listed(spark: SparkSession, root: str) -> DataFrame:
    """Files under root by their path from there; none where there is no such folder."""
    if not exists(spark, root):
        return spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    fs, where = at(spark, root)
    prefix = fs.makeQualified(where).toString().rstrip("/") + "/"
    return list_files(spark, root).withColumn("path", F.substring_index("path", prefix, -1))


def plan(spark: SparkSession, source: str, target: str) -> DataFrame:
    """(path, length, action) of the files of both: copy where target lacks it or has another length or an older one, else keep; delete extras."""
    a, b = _listed(spark, source).alias("a"), _listed(spark, target).alias("b")
    stale = F.col("b.path").isNull() | (F.col("a.length") != F.col("b.length")) | (F.col("a.modificationTime") > F.col("b.modificationTime"))
    action = F.when(F.col("a.path").isNull(), DELETE).when(stale, COPY).otherwise(KEEP)
    return a.join(b, F.col("a.path") == F.col("b.path"), "full").select(F.coalesce("a.path", "b.path").alias("path"), F.coalesce("a.length", "b.length").alias("length"), action.alias("action"))


def copy(spark: SparkSession, source: str, target: str) -> None:
    """Copy a file to a path whose folders may not be there yet, over what is there."""
    here, of = at(spark, source)
    there, to = at(spark, target)
    there.mkdirs(to.getParent())
    if not spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy(here, of, there, to, False, True, spark.sparkContext._jsc.hadoopConfiguration()):
        raise OSError(f"{source} could not be copied")


def mirror(spark: SparkSession, source: str, target: str, delete: bool = True, threads: int = 8) -> DataFrame:
    """Make target like source and give the plan that was carried out; a missing source is an error.

    Contents go through the driver, some files at a time, so this is for files that are ready and not for rows: those a
    job writes to their place at once. Hidden files (names that start with "_" or ".") stay as they are.
    """
    if not exists(spark, source):
        raise FileNotFoundError(source)
    steps = stage(plan(spark, source, target).filter((F.col("action") != KEEP) & (F.lit(delete) | (F.col("action") != DELETE))), "mirror")

    def carry_out(row) -> None:
        there = f"{target}/{row['path']}"
        files.delete(spark, there) if row["action"] == DELETE else copy(spark, f"{source}/{row['path']}", there)

    with ThreadPoolExecutor(threads) as pool:
        for _ in pool.map(carry_out, steps.toLocalIterator()):
            pass
    return steps
