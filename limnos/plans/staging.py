"""Intermediate tables written once and read again.

They lie in the folder that ``spark.checkpoint.dir`` names, which all executors share, so a lost executor
loses no staged rows. Only a local session without that setting (a test) gets a folder of this process; on a
cluster it is an error, as rows that one machine wrote to its own disk are not there for the others.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of the session; set here only where the session names none."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        set_dir = spark.sparkContext.getCheckpointDir()
        if not set_dir and not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = set_dir or f"file://{tempfile.mkdtemp(prefix='limnos-')}"
        if not set_dir:
            spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/limnos-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write df to the shared folder as Parquet and read it back, cutting its lineage."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(*frames: DataFrame) -> None:
    """Delete the files of staged tables that nothing reads any more."""
    for df in frames:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(conf).delete(where, True)


def bounded_join(left: DataFrame, right: DataFrame, keys: list[str], how: str, most: int = 200_000, salts: int = 16) -> DataFrame:
    """Join on non-null keys with a right side that has a row for each key.

    Up to `most` rows of the right side (counted, so it should be staged) are broadcast. Beyond that the left
    rows of each key are dealt over `salts` shares and the right side is repeated for each, so that a key with
    a third of all rows is not one task.
    """
    n = right.limit(most + 1).count()
    if n <= most:
        return left.join(F.broadcast(right), keys, how)
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)).cast("int"))
    every = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(every, [*keys, "__salt"], how).drop("__salt")


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once: inside, it is a bound variable and not an expression."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
