"""Declared schemas. Files are never scanned to infer types."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(n, t, True) for n, t in fields])


STATIONS = _struct(
    ("station_id", StringType()),
    ("station_name", StringType()),
    ("country", StringType()),
    ("region", StringType()),
    ("latitude", DoubleType()),
    ("longitude", DoubleType()),
    ("elevation", DoubleType()),
    ("is_coastal", BooleanType()),
    ("is_active", BooleanType()),
)

OBSERVATIONS = _struct(
    ("station_id", StringType()),
    ("observation_date", DateType()),
    ("year", IntegerType()),
    ("month", IntegerType()),
    ("temp_max", DoubleType()),
    ("temp_min", DoubleType()),
    ("temp_mean", DoubleType()),
    ("precipitation", DoubleType()),
    ("humidity", DoubleType()),
    ("sea_surface_temp", DoubleType()),
    ("ocean_salinity", DoubleType()),
    ("region", StringType()),
)

CLIMATE_DATA = _struct(
    ("date", DateType()),
    ("region", StringType()),
    ("temperature", DoubleType()),
    ("rainfall", DoubleType()),
    ("humidity", DoubleType()),
)

OCEAN_DATA = _struct(
    ("date", DateType()),
    ("region", StringType()),
    ("sea_surface_temp", DoubleType()),
    ("ph_level", DoubleType()),
    ("salinity", DoubleType()),
)

REGIONS = _struct(("name", StringType()), ("code", StringType()), ("description", StringType()))

BASELINES = _struct(("region", StringType()), ("baseline_temp", DoubleType()))

SENSOR_READINGS = _struct(
    ("station_id", StringType()),
    ("year", IntegerType()),
    ("metadata", StringType()),
    ("measurements", ArrayType(DoubleType())),
)

QUERY_RUNS = _struct(
    ("run_id", LongType()),
    ("scenario", StringType()),
    ("scenario_type", StringType()),
    ("seconds", DoubleType()),
    ("rows", LongType()),
    ("status", StringType()),
    ("error", StringType()),
    ("executed_at", TimestampType()),
)

RUN_METRICS = _struct(
    ("run_id", LongType()),
    ("name", StringType()),
    ("value", DoubleType()),
    ("unit", StringType()),
    ("target", DoubleType()),
    ("direction", StringType()),
)

LOAD_LOG = _struct(
    ("entity", StringType()),
    ("source", StringType()),
    ("status", StringType()),
    ("start_time", TimestampType()),
    ("end_time", TimestampType()),
    ("created", LongType()),
    ("updated", LongType()),
    ("skipped", LongType()),
    ("errors", LongType()),
    ("load_id", StringType()),
    ("newest", DateType()),
)

MEASURES = [
    "temp_max",
    "temp_min",
    "temp_mean",
    "precipitation",
    "humidity",
    "sea_surface_temp",
    "ocean_salinity",
]


def as_text(schema: StructType) -> StructType:
    """Same columns, all strings: for loaders that must see the raw text."""
    return StructType([StructField(f.name, StringType(), True) for f in schema])
