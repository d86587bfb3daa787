"""Delimited trip and weather files with fixed schemas."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and order of the columns of both files are fixed values.
TRIP_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in (
        "ride_id", "rideable_type", "started_at", "ended_at",
        "start_station_name", "start_station_id", "end_station_name", "end_station_id",
    )]
    + [T.StructField(name, T.DoubleType()) for name in ("start_lat", "start_lng", "end_lat", "end_lng")]
    + [T.StructField("member_casual", T.StringType())]
)

# Each measurement is followed by a column naming where it came from.
WEATHER_MEASURES = ("temp", "rhum", "prcp", "wdir", "wspd", "wpgt", "pres", "cldc", "coco")
WEATHER_SCHEMA = T.StructType(
    [T.StructField(name, T.IntegerType()) for name in ("year", "month", "day", "hour")]
    + [
        field
        for name in WEATHER_MEASURES
        for field in (T.StructField(name, T.DoubleType()), T.StructField(f"{name}_source", T.StringType()))
    ]
)


def read_trips(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """Trip rows of every file matching ``path``; times stay text until cleaning."""
    return _read_csv(spark, path, TRIP_SCHEMA, check_header)


def read_weather(spark: SparkSession, path: str, check_header: bool = True) -> DataFrame:
    """Hourly weather rows, times in UTC parts."""
    return _read_csv(spark, path, WEATHER_SCHEMA, check_header)


def read_trip_files(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Trip rows of files whose columns may differ in order and number, matched by the names in each header."""
    return _read_by_name(spark, path, TRIP_SCHEMA, missing_ok)


def read_weather_files(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """Hourly weather rows, columns matched by name as in :func:`read_trip_files`."""
    return _read_by_name(spark, path, WEATHER_SCHEMA, missing_ok)


def parse_trip_lines(lines: DataFrame) -> DataFrame:
    """Trip rows of delimited text in the ``value`` column, columns by position."""
    return _parse_lines(lines, TRIP_SCHEMA)


def parse_weather_lines(lines: DataFrame) -> DataFrame:
    """Hourly weather rows of delimited text in the ``value`` column, columns by position."""
    return _parse_lines(lines, WEATHER_SCHEMA)


def _parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    ddl = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    return lines.select(F.inline(F.array(F.from_csv("value", ddl))))


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, check_header: bool) -> DataFrame:
    # With the check, a file with re-ordered columns is an error rather than
    # silently shifted values; without it, columns are taken by position.
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", not check_header)
    return reader.csv(path)


# Headers read at the same time; each is a task that stops after a line.
_HEADERS_AT_ONCE = 16


def file_layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files matching ``path`` by the column names in their first line; files without a line are left out.

    Only names and headers reach the driver.  Names are compared without case,
    surrounding blanks and byte-order mark.
    """
    files = sorted(unquote(name) for name in spark.read.text(path).inputFiles())
    with ThreadPoolExecutor(_HEADERS_AT_ONCE) as pool:
        firsts = list(pool.map(lambda name: spark.read.text(name).first(), files))
    layouts: dict[tuple[str, ...], list[str]] = {}
    for name, first in zip(files, firsts):
        if first is not None:
            names = next(csv.reader([first["value"].removeprefix("\ufeff")]), [])
            layouts.setdefault(tuple(n.strip().lower() for n in names), []).append(name)
    return layouts


def _read_by_name(spark: SparkSession, path: str, schema: T.StructType, missing_ok: bool) -> DataFrame:
    """The schema's columns of all files: one read for each layout, further columns dropped, missing ones an error or null."""
    kinds = {field.name: field.dataType for field in schema}
    parts = []
    for names, files in file_layouts(spark, path).items():
        lost = [name for name in kinds if name not in names]
        if lost and not missing_ok:
            raise ValueError(f"{files[0]} has no column {', '.join(lost)}")
        if len(set(names)) < len(names):
            raise ValueError(f"{files[0]} has a column twice")
        # Positions are known from the header now; a place nobody asks for is read as text under a name of its own.
        layout = T.StructType([T.StructField(n if n in kinds else f"_{i}", kinds.get(n, T.StringType())) for i, n in enumerate(names)])
        rows = spark.read.schema(layout).option("header", True).csv(files)
        parts.append(rows.select(*[(F.lit(None) if n in lost else F.col(n)).cast(kind).alias(n) for n, kind in kinds.items()]))
    return reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], schema)
