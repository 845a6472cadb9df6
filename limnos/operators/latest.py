"""One row of many: the latest version, the first occurrence, the repeated ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    # row_number() = 1 plans as a group limit before and after the shuffle, so a task sends a row for each key
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__n", n).filter(F.col("__n") == 1).drop("__n")


def latest_by(df: DataFrame, keys: list[str], version: str, ties: list[str] = ()) -> DataFrame:
    """The whole row of the highest version of each key. A null version loses to any other.

    Rows that tie on the version are decided by `ties`, highest first; without any, by all other columns, so
    that a rerun keeps the same row.
    """
    ties = list(ties) or [c for c in df.columns if c not in (*keys, version)]
    return _first(df, keys, [F.col(c).desc_nulls_last() for c in (version, *ties)])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order, all columns kept."""
    return _first(df, keys, [F.col(c).asc_nulls_last() for c in order])


def repeated(df: DataFrame, keys: list[str]) -> DataFrame:
    """All rows whose key comes more than once; null keys are equal."""
    n = F.count("*").over(Window.partitionBy(*keys))
    return df.withColumn("__n", n).filter(F.col("__n") > 1).drop("__n")
