"""Tables of Access files, by the programs of mdbtools where a node has them."""

from __future__ import annotations

import csv
import io
import shutil
import subprocess
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from limnos.operators.tidy import clean_names


class MdbError(RuntimeError):
    """A file or table that can't be read."""


def _lines(program: str, *args: str) -> Iterator[str]:
    """The program's output as it comes."""
    if not shutil.which(program):
        raise MdbError(f"{program} is not installed: install mdbtools on all nodes, or export the tables first")
    with subprocess.Popen([program, *args], stdout=subprocess.PIPE, stderr=subprocess.PIPE) as p:
        yield from io.TextIOWrapper(p.stdout, encoding="utf-8", newline="")
        said = p.stderr.read().decode(errors="replace")
    if p.returncode:
        raise MdbError(f"{program} {' '.join(args)}: {said.strip()}")


class _Reader(DataSourceReader):
    def __init__(self, path: str, table: str) -> None:
        self.path, self.table = path, table

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]  # the program reads a table from its start

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        rows = csv.reader(_lines("mdb-export", self.path, self.table))
        next(rows, None)
        for row in rows:
            yield tuple(x if x else None for x in row)


class Mdb(DataSource):
    """Options: path (on every node) and table. All columns are text, as the program prints them."""

    @classmethod
    def name(cls) -> str:
        return "limnos_mdb"

    def schema(self) -> str:
        rows = csv.reader(_lines("mdb-export", self.options["path"], self.options["table"]))
        return ", ".join(f"`{c}` string" for c in next(rows, []))

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options["path"], self.options["table"])


def mdb_tables(path: str) -> list[str]:
    return [x.strip() for x in _lines("mdb-tables", "-1", path) if x.strip()]


def scan_mdb(spark: SparkSession, path: str, table: str, clean: bool = True) -> DataFrame:
    """A table, with lower-cased and plain names unless clean is false."""
    spark.dataSource.register(Mdb)
    df = spark.read.format("limnos_mdb").options(path=path, table=table).load()
    return clean_names(df) if clean else df
