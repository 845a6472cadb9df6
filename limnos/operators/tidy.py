"""Types, columns and order of frames that were put together from many files."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnos.plans.staging import stage


def strict_max(column: str) -> Column:
    """The maximum, null as soon as one value is; null of no rows."""
    return F.when(F.count("*") == F.count(column), F.max(column))


def strict_min(column: str) -> Column:
    return F.when(F.count("*") == F.count(column), F.min(column))


def strict_range(column: str) -> tuple[Column, Column]:
    return strict_min(column), strict_max(column)


def drop_null_columns(df: DataFrame) -> DataFrame:
    """Without the columns that hold nulls only: one pass that counts, then a projection."""
    n = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if n[c]])


def conform_types(like: DataFrame, df: DataFrame) -> DataFrame:
    """df with the shared columns cast to the types that `like` has; what can't be cast is null."""
    types = {f.name: f.dataType for f in like.schema}
    return df.select(*[F.col(f"`{c}`").try_cast(types[c]).alias(c) if c in types and types[c] != df.schema[c].dataType else F.col(f"`{c}`") for c in df.columns])


def type_conflicts(frames: dict[str, DataFrame]) -> DataFrame:
    """(column, frame, type) of the columns whose type isn't the same in all frames that have them."""
    seen: dict[str, dict[str, str]] = {}
    for name, df in frames.items():
        for column, kind in df.dtypes:
            seen.setdefault(column, {})[name] = kind
    rows = [(c, f, k) for c, kinds in seen.items() if len(set(kinds.values())) > 1 for f, k in kinds.items()]
    return next(iter(frames.values())).sparkSession.createDataFrame(rows, "column string, frame string, type string")


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    at = df.columns.index
    return df.columns[at(first) : at(last) + 1]


def clean_names(df: DataFrame, allow: str = "_") -> DataFrame:
    """Lower-cased names, every other character than letters, digits and `allow` replaced by the latter."""
    return df.toDF(*[re.sub(rf"[^a-z0-9{re.escape(allow)}]+", allow, c.lower()) for c in df.columns])


def without(df: DataFrame, pattern: str) -> DataFrame:
    """Without the columns whose name the pattern matches."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.search(pattern, c)])


def _ascending(order: list[str]) -> list[Column]:
    return [F.col(f"`{c}`").asc_nulls_last() for c in order]


def _sorted_parts(df: DataFrame, order: list[str]) -> DataFrame:
    """df sorted over all partitions and staged, each row with its partition's place (__part)."""
    return stage(df.orderBy(*_ascending(order)).withColumn("__part", F.spark_partition_id()), "sorted")


def numbered(df: DataFrame, order: list[str], name: str = "ordinal") -> DataFrame:
    """Rows numbered from 1 in a total order (nulls last), without bringing them into one task.

    Rows are range-partitioned; each partition numbers its own and adds what the ones before it hold.
    """
    rows = _sorted_parts(df, order)
    sizes = rows.groupBy("__part").count()
    before = F.coalesce(F.sum("count").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("__part", before.alias("__before"))  # a row for each partition
    own = F.row_number().over(Window.partitionBy("__part").orderBy(*_ascending(order)))
    return rows.join(F.broadcast(offsets), "__part").withColumn(name, (own + F.col("__before")).cast("long")).drop("__part", "__before")


def fill_down(df: DataFrame, columns: list[str], order: list[str]) -> DataFrame:
    """Each null replaced by the last value before it in a total order (nulls last).

    Each range partition fills its own rows; those before its first value take the last one of the
    partitions before it.
    """
    rows = _sorted_parts(df, order)
    down = Window.partitionBy("__part").orderBy(*_ascending(order)).rowsBetween(Window.unboundedPreceding, 0)
    filled = rows.select(*[F.last(F.col(f"`{c}`"), ignorenulls=True).over(down).alias(c) if c in columns else F.col(f"`{c}`") for c in rows.columns])
    place = F.struct(*[x for i, c in enumerate(order) for x in (F.col(f"`{c}`").isNull().alias(f"n{i}"), F.col(f"`{c}`").alias(f"v{i}"))])
    lasts = rows.groupBy("__part").agg(*[F.max_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), place)).alias(c) for c in columns])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("__part", *[F.last(F.col(f"`{c}`"), ignorenulls=True).over(before).alias(f"__{c}") for c in columns])
    out = filled.join(F.broadcast(carried), "__part")  # a row for each partition
    return out.select(*[F.coalesce(F.col(f"`{c}`"), F.col(f"`__{c}`")).alias(c) if c in columns else F.col(f"`{c}`") for c in df.columns])


def page(df: DataFrame, order: list[Column], size: int, number: int = 0) -> DataFrame:
    """One page of an ordered frame, counted from 0."""
    return df.orderBy(*order).offset(size * number).limit(size)
