"""Column functions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from limnos.schema import PARAMETER_NAMES


def case(value: Column, names: dict) -> Column:
    """The name of each value, null for others."""
    out = F.lit(None).cast("string")
    for k, v in reversed(names.items()):
        out = F.when(value == F.lit(k), F.lit(v)).otherwise(out)
    return out


def number(column: str) -> Column:
    """A column as double, null where it isn't a number."""
    return F.col(column).try_cast("double")


def parameter_name(column: str = "Parameter") -> Column:
    return case(number(column), {float(k): v for k, v in PARAMETER_NAMES.items()})


def instant(text: Column) -> Column:
    """Text as a timestamp, null where it isn't one."""
    return F.try_to_timestamp(text)


def day(column: Column) -> Column:
    return F.to_date(column)


def days_between(first: Column, last: Column) -> Column:
    return F.datediff(last, first).cast("long")


def shifted(column: Column, days: int | Column) -> Column:
    """The day so many days later, earlier for negative ones."""
    return F.date_add(column, F.lit(days) if isinstance(days, int) else days)


def stamped(prefix: str, when: Column) -> Column:
    """prefix_yyyyMMdd, null without a date."""
    return F.concat(F.lit(f"{prefix}_"), F.date_format(when, "yyyyMMdd"))


def snapshot_name(when: Column) -> Column:
    return F.date_format(when, "yyyy/MM/'snapshot_'yyyy-MM-dd")


def grouped(n: Column) -> Column:
    """A whole number with thousands separated."""
    return F.format_number(n, 0)


def chunk_of(ordinal: Column, size: int = 50) -> Column:
    """Number of the chunk that the ordinal (from 1) falls in."""
    return F.ceil(ordinal / F.lit(size)).cast("int")


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.cast("double").alias("lon"), lat.cast("double").alias("lat"))


_POINT = np.dtype([("order", "u1"), ("kind", "<u4"), ("x", "<f8"), ("y", "<f8")])


@F.arrow_udf(BinaryType())
def wkb(lon: pa.Array, lat: pa.Array) -> pa.Array:
    """Well-known binary of points, null where a coordinate is."""
    out = np.empty(len(lon), _POINT)
    out["order"], out["kind"] = 1, 1
    out["x"], out["y"] = (c.to_numpy(zero_copy_only=False) for c in (lon, lat))
    packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(_POINT.itemsize), len(out), [None, pa.py_buffer(out.tobytes())]).cast(pa.binary())
    return pc.if_else(pc.and_(lon.is_valid(), lat.is_valid()), packed, pa.scalar(None, pa.binary()))
