"""Snapshots written once a day, exports named by their last date, and cached results."""

from __future__ import annotations

import logging
import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from limnos.operators.tidy import strict_max
from limnos.plans.canonical import Readings
from limnos.schema import DATE, READINGS
from limnos.sources.files import delete, exists, replace

log = logging.getLogger(__name__)


class SnapshotError(RuntimeError):
    """A snapshot that can't be used."""


def snapshot_path(root: str, as_of: date) -> str:
    return f"{root.rstrip('/')}/{as_of:%Y/%m}/snapshot_{as_of:%Y-%m-%d}"


def write_snapshot(df: DataFrame, root: str, as_of: date, schema: StructType = READINGS) -> DataFrame:
    """Write the day's snapshot, in place of one of the same day, and give its summary.

    Rows stream from their tasks to the files of a hidden folder, which is read again: a snapshot without rows or
    without the date column is an error and leaves the day's earlier one as it was. Only a good one takes its place.
    """
    spark, path = df.sparkSession, snapshot_path(root, as_of)
    fresh = f"{root.rstrip('/')}/_incoming/{uuid.uuid4().hex}"
    try:
        df.write.parquet(fresh)
        summary = verify_snapshot(spark, fresh, path)
        replace(spark, fresh, path)
    finally:
        delete(spark, fresh)  # what was refused; a good one isn't there any more
    return summary


def verify_snapshot(spark: SparkSession, path: str, name: str | None = None) -> DataFrame:
    """The summary of a written snapshot, as one row. name: what messages call it, else the path."""
    df, name = spark.read.parquet(path), name or path
    if DATE not in df.columns:
        raise SnapshotError(f"{name} has no column {DATE}")
    row = Readings().summary(df).first()
    if not row["n_rows"]:
        raise SnapshotError(f"{name} has no rows")
    log.info("%s: %s rows of %s stations, %s to %s", name, f"{row['n_rows']:,}", row["stations"], row["min_date"], row["max_date"])
    return spark.createDataFrame([row], "n_rows long, stations long, min_date timestamp, max_date timestamp")


def stamped_path(df: DataFrame, folder: str, prefix: str, date_col: str = DATE) -> str:
    """folder/prefix_yyyyMMdd by the last date; a null date among the rows makes that unknown, which is an error."""
    last = df.agg(F.date_format(strict_max(date_col), "yyyyMMdd").alias("d")).first()["d"]
    if last is None:
        raise SnapshotError(f"the last {date_col} is unknown")
    return f"{folder.rstrip('/')}/{prefix}_{last}"


def export(df: DataFrame, path: str, columns: list[str] | None = None, limit: int | None = None) -> str:
    """Write a table, or some columns or any `limit` rows of it, over what is there."""
    out = df.select(*columns) if columns else df
    (out if limit is None else out.limit(limit)).write.mode("overwrite").parquet(path)
    return path


def export_stamped(df: DataFrame, folder: str, prefix: str, date_col: str = DATE) -> str:
    return export(df, stamped_path(df, folder, prefix, date_col))


def save_table(df: DataFrame, name: str, overwrite: bool = True) -> None:
    """Persist as a table; without overwrite an existing one is an error."""
    df.write.mode("overwrite" if overwrite else "errorifexists").saveAsTable(name)


def register(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def cached(spark: SparkSession, path: str, make, refresh: bool = False) -> DataFrame:
    """The result kept at a path; made and written if there is none yet or a new one is asked for."""
    if refresh or not exists(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def export_page(df: DataFrame, path: str) -> str:
    """A page of a table as CSV with a header, in one file: only for results of a page's size."""
    df.coalesce(1).write.mode("overwrite").option("header", "true").csv(path)
    return path
