"""The canonical reading: of overlapping snapshots, the latest version of each row.

Filters on key columns go below the deduplication, so they reach the scan; filters on values must stay above
it, which is where a caller puts them.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.functions.timebounds import Bound, days_before, within
from limnos.operators.latest import latest_by
from limnos.operators.sets import left_join, where_in
from limnos.schema import DATE, KEYS, PARAMETER, STATION, VALUE, VERSION


@dataclass(frozen=True)
class Readings:
    """Which columns of a table play which part. `keys` may be expressions' names added by the caller."""

    station: str = STATION
    parameter: str = PARAMETER
    date: str = DATE
    value: str = VALUE
    version: str = VERSION
    keys: list[str] = field(default_factory=lambda: list(KEYS))
    ties: list[str] = field(default_factory=list)

    def canonical(self, df: DataFrame) -> DataFrame:
        return latest_by(df, self.keys, self.version, self.ties)

    def query(self, df: DataFrame, parameter: list | None = None, stations: list | None = None, start: Bound | None = None, end: Bound | None = None, days_back: int | None = None, as_of: Bound | None = None) -> DataFrame:
        """Canonical readings of the parameters and stations (None: all, empty: none) from start to end.

        days_back instead of start begins so many days before the day of as_of (None: today).
        """
        if days_back is not None:
            if start is not None:
                raise ValueError("either start or days_back")
            start = days_before(days_back, as_of)
        df = where_in(where_in(df, self.parameter, parameter), self.station, stations)
        bounds = within(df, self.date, start, end)
        return self.canonical(df if bounds is None else df.filter(bounds))

    def series(self, df: DataFrame, parameter, station, start: Bound | None = None, end: Bound | None = None, columns: list[str] | None = None) -> DataFrame:
        """One station's readings of a parameter in the order of time."""
        out = self.query(df, [parameter], [station], start, end)
        return out.select(*(columns or out.columns)).orderBy(F.col(self.date).asc_nulls_last())

    def daily_mean(self, canonical: DataFrame, mean: str = "mean", count: str = "n_obs") -> DataFrame:
        """Mean and number of readings of each station and day of UTC; nulls are counted and not averaged."""
        return canonical.groupBy(self.station, F.to_date(self.date).alias("date_day")).agg(F.avg(self.value).alias(mean), F.count("*").alias(count))

    def latest(self, canonical: DataFrame) -> DataFrame:
        """The last reading of each station."""
        return latest_by(canonical, [self.station], self.date, self.ties)

    def ranges(self, df: DataFrame, by: list[str] | None = None) -> DataFrame:
        """First and last time of each station (or of other columns)."""
        return df.groupBy(*(by or [self.station])).agg(F.min(self.date).alias("min_date"), F.max(self.date).alias("max_date"))

    def station_table(self, stations: DataFrame, canonical: DataFrame, station: str) -> DataFrame:
        """All stations with the range of their readings, null where they have none."""
        return left_join(stations, self.ranges(canonical).withColumnRenamed(self.station, station), [station])

    def summary(self, df: DataFrame) -> DataFrame:
        """One row: rows, stations, first and last time."""
        return df.agg(F.count("*").alias("n_rows"), F.count_distinct(self.station).alias("stations"), F.min(self.date).alias("min_date"), F.max(self.date).alias("max_date"))

    def counts(self, df: DataFrame, dimension: DataFrame) -> DataFrame:
        """Number of rows of each parameter with the columns of the parameter dimension."""
        return left_join(df.groupBy(self.parameter).agg(F.count("*").alias("n_events")), dimension, [self.parameter])


def query_canonical(df: DataFrame, parameter: list | None = None, stations: list | None = None, start: Bound | None = None, end: Bound | None = None, days_back: int | None = None, as_of: Bound | None = None) -> DataFrame:
    """Readings.query for snapshots with the engine's own columns."""
    return Readings().query(df, parameter, stations, start, end, days_back, as_of)
