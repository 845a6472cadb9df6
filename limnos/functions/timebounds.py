"""Time bounds. A date means a whole day of UTC; an instant means itself."""

from __future__ import annotations

from datetime import UTC, date, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

Bound = str | date | datetime


def to_utc(x: Bound) -> datetime:
    """The instant of a bound. Dates are their midnight, text and naive instants are taken as UTC."""
    if isinstance(x, str):
        x = datetime.fromisoformat(x)
    if not isinstance(x, datetime):  # datetime is a kind of date, so it is asked for first
        x = datetime(x.year, x.month, x.day)
    return x.replace(tzinfo=UTC) if x.tzinfo is None else x.astimezone(UTC)


def days_before(days: int, as_of: Bound | None = None) -> date:
    """The day that lies so many days before the day of as_of; without it, before today's (UTC)."""
    return (datetime.now(UTC) if as_of is None else to_utc(as_of)).date() - timedelta(days=days)


def literal(x: datetime, naive: bool) -> Column:
    """An instant as a literal of the column's own kind, so that the comparison reaches the scan."""
    text = f"{x:%Y-%m-%d %H:%M:%S}.{x.microsecond:06d}"
    return F.expr(f"TIMESTAMP_NTZ '{text}'" if naive else f"TIMESTAMP '{text}+00:00'")


def within(df: DataFrame, column: str, start: Bound | None = None, end: Bound | None = None) -> Column | None:
    """start <= column <= end, where an end that is a date includes its whole day; None without bounds."""
    naive = isinstance(df.schema[column].dataType, TimestampNTZType)
    out = None
    if start is not None:
        out = F.col(column) >= literal(to_utc(start), naive)
    if end is not None:
        whole_day = isinstance(end, date) and not isinstance(end, datetime)
        last = F.col(column) < literal(to_utc(end) + timedelta(days=1), naive) if whole_day else F.col(column) <= literal(to_utc(end), naive)
        out = last if out is None else out & last
    return out
