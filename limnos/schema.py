"""Columns, keys and codes of readings."""

from __future__ import annotations

from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

STATION, PARAMETER, DATE, VALUE, VERSION = "STATION_NUMBER", "Parameter", "Date", "Value", "harvested_at"

#: A reading's identity: of rows that share it, the latest harvested one counts.
KEYS = [STATION, PARAMETER, DATE]
#: Identity in merged tables, where a corrected value is a row of its own.
MERGE_KEYS = [STATION, DATE, VALUE, PARAMETER]

READINGS = StructType(
    [
        StructField(STATION, StringType()),
        StructField(PARAMETER, DoubleType()),
        StructField(DATE, TimestampType()),
        StructField(VALUE, DoubleType()),
        StructField("Unit", StringType()),
        StructField("Grade", DoubleType()),
        StructField("Approval", StringType()),
        StructField("Qualifier", StringType()),
        StructField("Code", StringType()),
        StructField("Name_En", StringType()),
        StructField(VERSION, TimestampType()),
    ]
)

#: Names of parameter codes.
PARAMETER_NAMES = {5: "Water temperature", 6: "Discharge (daily mean)"}
WATER_LEVEL = 46
