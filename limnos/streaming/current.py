"""A table of current readings kept up with new snapshots by a file stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from limnos.plans.canonical import Readings
from limnos.schema import READINGS
from limnos.sources.files import children, delete, exists


class StreamError(RuntimeError):
    """Generations that don't follow each other."""


def stream_snapshots(spark: SparkSession, root: str, schema: StructType = READINGS, files: int = 1000) -> DataFrame:
    """New Parquet files under root, up to so many in a batch."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").option("maxFilesPerTrigger", files).parquet(root)


def generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete generations under a path, ascending."""
    return sorted(int(name.split("=")[1]) for name in children(spark, path) if name.startswith("generation=") and exists(spark, f"{path}/{name}/_SUCCESS"))


def keep_current(stream: DataFrame, path: str, checkpoint: str, readings: Readings | None = None, keep: int = 2, **trigger) -> StreamingQuery:
    """Keep the canonical readings of all that came so far under path, a generation for each batch.

    A batch is merged with the generation before it and written as the next one, so a batch that is run again
    after a failure writes the same rows; late corrections win by their version as in a batch query. The last `keep`
    generations stay. A batch whose generation before is missing is an error, as older readings would be lost, and so is
    a stream that starts anew over a path that holds generations of another one.
    """
    readings = readings or Readings()
    if keep < 2:
        raise ValueError("a batch that is run again needs the generation before its own")

    def merge(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        done = generations(spark, path)
        if n and n - 1 not in done:
            raise StreamError(f"{path} has no generation {n - 1} to go on from")
        if not n and any(done):
            raise StreamError(f"{path} holds generations of another stream; its checkpoint isn't {checkpoint}")
        rows = batch.unionByName(spark.read.schema(batch.schema).parquet(f"{path}/generation={n - 1}")) if n else batch
        readings.canonical(rows).write.mode("overwrite").parquet(f"{path}/generation={n}")
        for old in done:
            if old <= n - keep:
                delete(spark, f"{path}/generation={old}")

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def current(spark: SparkSession, path: str, schema: StructType = READINGS) -> DataFrame:
    """The last complete generation."""
    done = generations(spark, path)
    if not done:
        raise StreamError(f"{path} has no complete generation")
    return spark.read.schema(schema).parquet(f"{path}/generation={done[-1]}")
