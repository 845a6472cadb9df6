"""Parquet sources: the snapshot tree, historic files of other shapes, and dimensions."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, TimestampNTZType

from limnos.schema import READINGS
from limnos.sources.files import exists

log = logging.getLogger(__name__)


def scan_snapshots(spark: SparkSession, root: str, schema: StructType = READINGS) -> DataFrame:
    """All Parquet files under root, single snapshots and chunked ones alike, under one explicit schema."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(root)


def scan_files(spark: SparkSession, *paths: str) -> DataFrame:
    """One table of many files: columns of all of them, null where a file lacks one; a column of two types is an error."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def scan_sql(spark: SparkSession, path: str, sql: str, **args) -> DataFrame:
    """A query over a file, named {table} in the text; values come as named arguments, never as text."""
    return spark.sql(sql, args=args or None, table=spark.read.parquet(path))


def adapt_historic(df: DataFrame, schema: StructType = READINGS, names: dict[str, str] | None = None) -> DataFrame:
    """A historic file in the shape of readings: other names, text for numbers, times without zone, lacking columns.

    Text that is no number becomes null; naive times are UTC; columns that readings don't have are left out.
    """
    df = df.withColumnsRenamed(names or {"Qualifiers": "Qualifier"})
    kinds = {f.name: f.dataType for f in df.schema}
    out = []
    for f in schema:
        c = F.col(f"`{f.name}`")
        if f.name not in kinds:
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif isinstance(kinds[f.name], TimestampNTZType):
            out.append(F.to_utc_timestamp(c.cast("timestamp"), F.current_timezone()).alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """path, length and modificationTime of all files under root; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    return files.select("path", "length", "modificationTime")


def optional(spark: SparkSession, path: str, schema: StructType, read=None) -> DataFrame:
    """The table at a path, or an empty one with a warning where there is none."""
    if exists(spark, path):
        return read(spark, path) if read else spark.read.schema(schema).parquet(path)
    log.warning("%s does not exist: going on without it", path)
    return spark.createDataFrame([], schema)


def station_list(spark: SparkSession, path: str, column: str = "stationid") -> DataFrame:
    """Station ids of a spreadsheet (where a reader for it is installed) or of a CSV file."""
    schema = StructType().add(column, "string")

    def read(spark, path):
        if path.endswith((".xlsx", ".xls")):
            import pandas as pd

            return spark.createDataFrame(pd.read_excel(path, usecols=[column], dtype=str), schema)
        return spark.read.option("header", "true").csv(path).select(F.col(column).cast("string"))

    return optional(spark, path, schema, read).filter(F.col(column).isNotNull()).distinct()


def catalog(stations: DataFrame, province: str | None = None, column: str = "PROV_TERR_STATE_LOC") -> DataFrame:
    """The station dimension, of one province or all."""
    return stations if province is None else stations.filter(F.col(column) == province)


def tables(spark: SparkSession) -> list[str]:
    return [t.name for t in spark.catalog.listTables()]


def fields(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table)]
