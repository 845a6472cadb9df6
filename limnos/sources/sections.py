"""CSV files of two sections: a header block about the file, then the readings.

The first line names the block's columns and the second holds their values, of which the first three are the
station, the parameter and its code. Four lines further the readings begin with their own header. All their
columns stay text, as the files mix words with numbers; only the time becomes a timestamp.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from limnos.functions.scalars import instant, parameter_name

BODY_LINE = 6
ABOUT = ["STATION_NUMBER", "Parameter", "Code"]


def _sections(text: str) -> tuple[list[str], list[str], list[list[str]]]:
    lines = text.lstrip("﻿").splitlines()
    about = next(csv.reader(lines[1:2]), [])[:3]
    body = list(csv.reader(io.StringIO("\n".join(lines[BODY_LINE:]))))
    return [*about, *[None] * (3 - len(about))], body[0] if body else [], [r for r in body[1:] if r]


def _headers(files: DataFrame) -> list[str]:
    """Columns of all bodies, in the order of their first file and place there; only they leave the tasks."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, content in zip(frame["path"], frame["content"], strict=True):
                header = _sections(bytes(content).decode())[1]
                yield pd.DataFrame({"path": path, "place": range(len(header)), "name": header})

    rows = files.select("path", "content").mapInPandas(parse, "path string, place int, name string")
    first = rows.groupBy("name").agg(F.min(F.struct("path", "place")).alias("at"))
    return [r["name"] for r in first.orderBy("at").collect()]


def scan_sections(spark: SparkSession, path: str, columns: list[str] | None = None, time: str = "Time") -> DataFrame:
    """Readings of all such files under a path, null where a file lacks a column. columns: those of the body, else those of all files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(path)
    if columns is None:
        columns = _headers(files) or [time]
    schema = ", ".join(f"`{c}` string" for c in [*ABOUT, *columns])

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for content in frame["content"]:
                about, header, rows = _sections(bytes(content).decode())
                body = pd.DataFrame([r[: len(header)] + [None] * (len(header) - len(r)) for r in rows], columns=header, dtype=object)
                body = body.reindex(columns=columns).astype(object)
                for i, name in enumerate(ABOUT):
                    body.insert(i, name, about[i])
                yield body.where(body.notna(), None)

    rows = files.select("content").mapInPandas(parse, schema)
    rows = rows.withColumn("Name_En", parameter_name("Parameter"))
    return rows.withColumn(time, instant(F.col(f"`{time}`"))).withColumnRenamed(time, "Date")
