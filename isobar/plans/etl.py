"""The observation pipeline: extract, clean, enrich, aggregate, load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.operators.aggregates import monthly_climate
from isobar.operators.clean import clean
from isobar.operators.joins import enrich
from isobar.operators.windows import rolling_precip, year_over_year
from isobar.sources.tables import (
    append_rows,
    overwrite_partitions,
    write_warehouse,
)

# Columns of the published table; the partition columns come last.
PUBLISHED = [
    "station_id",
    "station_name",
    "country",
    "latitude",
    "longitude",
    "observation_date",
    "month",
    "temp_max",
    "temp_min",
    "temp_mean",
    "precipitation",
    "humidity",
    "sea_surface_temp",
    "ocean_salinity",
    "temp_anomaly",
    "month_sin",
    "month_cos",
    "year",
    "region",
]
PARTITIONS = ("year", "region")


@dataclass
class Aggregates:
    monthly: DataFrame
    rolling: DataFrame
    yearly_change: DataFrame


def extract(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("observation_date").isNotNull())


def transform(raw: DataFrame, stations: DataFrame, baselines: DataFrame) -> DataFrame:
    """Extract, clean and enrich: one scan for the rain averages, one for the rows."""
    return enrich(clean(extract(raw)), stations, baselines)


def aggregate(enriched: DataFrame) -> Aggregates:
    return Aggregates(
        monthly_climate(enriched), rolling_precip(enriched), year_over_year(enriched)
    )


def load(
    enriched: DataFrame,
    table: str,
    path: str | None = None,
    buckets: int | None = 32,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Create the published table: ORC, snappy, partitioned by year and region, bucketed."""
    return write_warehouse(
        enriched.select(*keep, *PUBLISHED), table, PARTITIONS, buckets, "station_id", path
    )


def reload(enriched: DataFrame, table: str) -> None:
    """Publish again: partitions in the frame are replaced, others stay."""
    overwrite_partitions(enriched, table)


def append_summary(enriched: DataFrame, table: str) -> None:
    append_rows(monthly_climate(enriched), table)


def run(
    raw: DataFrame,
    stations: DataFrame,
    baselines: DataFrame,
    table: str,
    path: str | None = None,
    buckets: int | None = 32,
) -> DataFrame:
    """The whole pipeline. Returns the monthly summary of the published table."""
    published = load(transform(raw, stations, baselines), table, path, buckets)
    return monthly_climate(published)
