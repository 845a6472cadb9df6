"""SQLite tables, where no JDBC driver for them is at hand: a data source over row-id ranges."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

KINDS = {"INTEGER": "long", "INT": "long", "BIGINT": "long", "REAL": "double", "DOUBLE": "double", "FLOAT": "double", "BLOB": "binary"}


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)


def _name(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


class Range(InputPartition):
    def __init__(self, first: int, last: int) -> None:
        super().__init__((first, last))


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str, schema: StructType, rows: int) -> None:
        self.path, self.table, self.schema, self.rows = path, table, schema, rows

    def partitions(self) -> list[Range]:
        with _open(self.path) as db:
            lo, hi = db.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
        return [Range(a, a + self.rows) for a in range(lo, hi + 1, self.rows)] if lo is not None else [Range(0, 0)]

    def read(self, partition: Range) -> Iterator[tuple]:
        casts = {"double": float, "bigint": int, "string": str}
        fields = [casts.get(f.dataType.simpleString(), lambda x: x) for f in self.schema]
        columns = ", ".join(_name(f.name) for f in self.schema)
        with _open(self.path) as db:
            for row in db.execute(f"SELECT {columns} FROM {_name(self.table)} WHERE rowid >= ? AND rowid < ?", partition.value):
                yield tuple(None if x is None else cast(x) for x, cast in zip(row, fields, strict=True))


class Sqlite(DataSource):
    """Options: path (on every node), table, rows of a partition."""

    @classmethod
    def name(cls) -> str:
        return "limnos_sqlite"

    def schema(self) -> str:
        with _open(self.options["path"]) as db:
            info = db.execute(f"PRAGMA table_info({_name(self.options['table'])})").fetchall()
        return ", ".join(f"`{c[1]}` {KINDS.get(c[2].upper().split('(')[0], 'string')}" for c in info)

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["table"], schema, int(self.options.get("rows", 1_000_000)))


def scan_sqlite(spark: SparkSession, path: str, table: str, rows: int = 1_000_000) -> DataFrame:
    spark.dataSource.register(Sqlite)
    return spark.read.format("limnos_sqlite").options(path=path, table=table, rows=str(rows)).load()


def sqlite_tables(path: str) -> list[str]:
    with _open(path) as db:
        return [r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]
