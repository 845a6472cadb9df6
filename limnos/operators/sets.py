"""Rows as sets, and joins in which nulls are equal."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class SchemaError(ValueError):
    """Frames that can't be put together."""


def common(a: DataFrame, b: DataFrame) -> list[str]:
    """Columns that both frames have, in the order of a."""
    return [c for c in a.columns if c in b.columns]


def bind_rows(*frames: DataFrame) -> DataFrame:
    """All rows of all frames by column name, nulls where a frame has no such column.

    A column that has different types in two frames is an error here and now, instead of a cast.
    """
    types: dict[str, str] = {}
    for df in frames:
        for name, kind in df.dtypes:
            if types.setdefault(name, kind) != kind and "void" not in (kind, types[name]):
                raise SchemaError(f"column {name} is {types[name]} in one frame and {kind} in another")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def rows_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b).distinct()


def rows_intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b.select(*a.columns))


def rows_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b.select(*a.columns))


def same(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality of keys, which still joins by hash or sort."""
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def left_join(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """All rows of a with the other columns of b; null keys match null keys."""
    b = b.alias("b")
    return a.join(b, same(a, b, keys), "left").select(*[a[c] for c in a.columns], *[b[c] for c in b.columns if c not in a.columns])


def natural_left_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """left_join on all columns that both have. There must be one: this never becomes a cross product."""
    keys = common(a, b)
    if not keys:
        raise SchemaError("the frames have no column in common")
    return left_join(a, b, keys)


def members(df: DataFrame, column: str, of: DataFrame, of_column: str) -> DataFrame:
    """Rows whose value is among those of the other frame's column."""
    return df.join(of.select(F.col(of_column).alias("__m")), F.col(column) == F.col("__m"), "left_semi")


def missing(df: DataFrame, column: str, of: DataFrame, of_column: str) -> DataFrame:
    """Distinct values of a column that the other frame's column doesn't have."""
    return df.select(column).join(of.select(F.col(of_column).alias("__m")), F.col(column).eqNullSafe(F.col("__m")), "left_anti").distinct()


def where_in(df: DataFrame, column: str, values: list | None) -> DataFrame:
    """Rows whose value is listed; None lists all, an empty list none."""
    return df if values is None else df.filter(F.col(column).isin(list(values)))
