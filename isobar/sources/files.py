"""Delimited files in, exports out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from isobar import schemas
from isobar.functions.columns import finite
from isobar.operators.filters import by_spec
from isobar.operators.ordering import newest

# Header of the observation export.
EXPORT_COLUMNS = {
    "station_id": "Station ID",
    "station_name": "Station Name",
    "country": "Country",
    "region": "Region",
    "observation_date": "Date",
    "temp_max": "Temp Max",
    "temp_min": "Temp Min",
    "temp_mean": "Temp Mean",
    "precipitation": "Precipitation",
    "humidity": "Humidity",
    "sea_surface_temp": "SST",
    "ocean_salinity": "Salinity",
}


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed scan with one header line; fields bind by position, extras are dropped.

    NaN and infinite readings are missing ones.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )
    return _finite(rows)


def _finite(rows: DataFrame) -> DataFrame:
    doubles = [c for c, kind in rows.dtypes if kind == "double"]
    return rows.withColumns({c: finite(c) for c in doubles}) if doubles else rows


def read_csv_checked(
    spark: SparkSession, path: str, schema: StructType, bad_line: str = "_bad_line"
) -> DataFrame:
    """As read_csv, keeping the text of lines that did not parse in `bad_line`."""
    full = StructType([*schema.fields, StructField(bad_line, StringType(), True)])
    rows = (
        spark.read.schema(full)
        .option("header", True)
        .option("enforceSchema", True)
        .option("columnNameOfCorruptRecord", bad_line)
        .csv(path)
    )
    return _finite(rows)


def read_text_columns(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Every column as text, for the loaders that coerce and reject row by row."""
    return read_csv(spark, path, schemas.as_text(schema))


def external_table(spark: SparkSession, name: str, schema: StructType, path: str) -> DataFrame:
    """A catalog table over existing files; dropping it keeps the files."""
    return spark.catalog.createTable(
        name, path, source="csv", schema=schema, header="true", enforceSchema="true"
    )


def run_sql(spark: SparkSession, text: str, **frames: DataFrame) -> DataFrame:
    """A SQL text as a lazy frame; `{name}` in the text stands for a given frame."""
    return spark.sql(text, **frames)


def export_rows(
    obs: DataFrame,
    spec: Mapping[str, object] | None = None,
    cap: int | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """The rows a filter spec lets through, with the export's column names.

    All of them, or the newest `cap` under (date, tie), which must be a total order.
    """
    rows = by_spec(obs, spec or {})
    if cap is not None:
        if not tie:
            raise ValueError("a capped export needs `tie` columns that tell rows of a day apart")
        rows = newest(rows, cap, tie)
    return rows.select(*[F.col(c).alias(a) for c, a in EXPORT_COLUMNS.items()])


def export(df: DataFrame, path: str, fmt: str = "json") -> None:
    if fmt == "csv":
        df.write.mode("overwrite").option("header", True).csv(path)
    elif fmt == "json":
        df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
    else:
        raise ValueError(f"unknown export format: {fmt}")
