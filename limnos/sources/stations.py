"""Readings pulled station by station from a service, as a data source.

Each partition pulls a chunk of stations; a station that fails gives a row with its error and no readings, so
one failure costs neither the run nor the other stations. The transport is a function of the caller's:
``transport(station, days) -> iterable of dicts``; each station may have its own number of days. The service sees one call at a time from each task, so the
number of chunks caps the load on it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from limnos.schema import READINGS, STATION, VERSION

#: Days that a pull goes back, and stations of a chunk.
WINDOW_DAYS = 581
CHUNK = 50
ERROR = "__error"
Transport = Callable[[str, int], Iterable[dict]]


class Chunk(InputPartition):
    def __init__(self, stations: list[tuple[str, int]]) -> None:
        super().__init__(stations)


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, stations: list[tuple[str, int]], chunk: int, transport: Transport) -> None:
        self.schema, self.stations, self.chunk, self.transport = schema, stations, chunk, transport

    def partitions(self) -> list[Chunk]:
        return [Chunk(self.stations[i : i + self.chunk]) for i in range(0, len(self.stations), self.chunk)] or [Chunk([])]

    def read(self, partition: Chunk) -> Iterator[tuple]:
        names = [f.name for f in self.schema][:-1]
        for station, days in partition.value:
            try:
                rows = [tuple(r.get(n) for n in names) + (None,) for r in self.transport(station, days) or ()]
            except Exception as e:  # the service's own failures: the station's, not the run's
                rows = [tuple(station if n == STATION else None for n in names) + (f"{type(e).__name__}: {e}",)]
            yield from rows


def source_of(transport: Transport, stations: list[str], days: int | list[int] = WINDOW_DAYS, chunk: int = CHUNK, schema: StructType = READINGS) -> type[DataSource]:
    """A data source class that holds a transport, its stations and the days of all or of each."""
    pulls = list(zip(stations, [days] * len(stations) if isinstance(days, int) else days, strict=True))
    shape = StructType([f for f in schema if f.name != VERSION]).add(ERROR, "string")

    class Stations(DataSource):
        @classmethod
        def name(cls) -> str:
            return "limnos_stations"

        def schema(self) -> StructType:
            return shape

        def reader(self, schema: StructType) -> DataSourceReader:
            return _Reader(schema, pulls, chunk, transport)

    return Stations


def pull(spark: SparkSession, transport: Transport, stations: list[str], harvested_at, days: int | list[int] = WINDOW_DAYS, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """(readings, failures) of the stations. days: of all, or of each station. harvested_at is one instant for the whole run."""
    spark.dataSource.register(source_of(transport, stations, days, chunk))
    rows = spark.read.format("limnos_stations").load()
    readings = rows.filter(F.col(ERROR).isNull()).drop(ERROR).withColumn(VERSION, F.lit(harvested_at).cast("timestamp"))
    return readings, rows.filter(F.col(ERROR).isNotNull()).select(STATION, F.col(ERROR).alias("error"))
