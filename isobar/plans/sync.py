"""Sync of regions, stations and observations into keyed tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from isobar import schemas
from isobar.functions.columns import region_code
from isobar.operators.aggregates import stations_distinct
from isobar.operators.clean import coerce_observations, coerce_stations, split_rejects
from isobar.operators.filters import date_range
from isobar.operators.joins import match_region, split_known
from isobar.operators.ordering import newest, union_all
from isobar.operators.upsert import (
    action_counts,
    completed_loads,
    defaults,
    first_per_key,
    high_water,
    log_load,
    merge_flagged,
    staged_upsert,
)
from isobar.session import work_path
from isobar.sources import tables
from isobar.sources.files import read_text_columns

OBSERVATION_KEY = ["station_id", "observation_date"]
STATION_UPDATES = ["station_name", "country", "region_code", "latitude", "longitude", "is_coastal"]
# The regions every load makes sure of.
DEFAULT_REGIONS = [
    ("East Africa", "EAST", "Eastern African region"),
    ("West Africa", "WEST", "Western African region"),
    ("North Africa", "NORTH", "Northern African region"),
    ("South Africa", "SOUTH", "Southern African region"),
    ("Central Africa", "CENTRAL", "Central African region"),
]


def _staged(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and go on from there."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_regions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(DEFAULT_REGIONS, schemas.REGIONS)


def sync_regions(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Regions merged by code, with actions."""
    order = [F.col("name")]
    rows = first_per_key(incoming, ["code"], order)
    return merge_flagged(target, rows, ["code"], ["name", "description"])


@dataclass
class StationSync:
    stations: DataFrame
    new_regions: DataFrame


def sync_stations(obs: DataFrame, target: DataFrame, regions: DataFrame) -> StationSync:
    """Stations found in the observations, merged by id into the target.

    A region text that matches neither name nor code becomes a new region.
    """
    # A row per station, read several times below.
    found = _staged(stations_distinct(obs).withColumnRenamed("region", "region_text"), "found")
    # Coastal if ever a sea reading, under whichever attributes.
    coastal = found.groupBy("station_id").agg(F.max("is_coastal").alias("is_coastal"))
    found = first_per_key(found.drop("is_coastal"), ["station_id"], [F.col("station_name"), F.col("region_text")])
    found = found.join(coastal, "station_id")
    matched = match_region(found, regions)
    unknown = matched.where(F.col("region_code").isNull())
    new_regions = (
        unknown.groupBy(region_code("region_text").alias("code"))
        .agg(F.min("region_text").alias("name"))
        .select("name", "code", F.lit(None).cast("string").alias("description"))
    )
    rows = matched.withColumn(
        "region_code", F.coalesce("region_code", region_code("region_text"))
    )
    rows = rows.select("station_id", *STATION_UPDATES)
    rows = defaults(
        rows, {"is_active": F.lit(True), "elevation": F.lit(None).cast("double")}
    )
    return StationSync(
        merge_flagged(target, rows, ["station_id"], STATION_UPDATES), new_regions
    )


def load_station_text(
    spark: SparkSession, path: str, target: DataFrame, regions: DataFrame
) -> tuple[StationSync, DataFrame]:
    """Stations of a delimited file merged by id; (result, rejected rows).

    The region is found by the code made from its name, and made if missing.
    Of equal ids the first under name and region stands.
    """
    typed = _staged(coerce_stations(read_text_columns(spark, path, schemas.STATIONS)), "stations")
    good, rejects = split_rejects(typed)
    good = good.withColumn("region_code", region_code("region"))
    new_regions = (
        good.groupBy(F.col("region_code").alias("code"))
        .agg(F.min("region").alias("name"))
        .join(regions.select("code"), "code", "left_anti")
        .select("name", "code", F.lit(None).cast("string").alias("description"))
    )
    rows = first_per_key(good, ["station_id"], [F.col("station_name"), F.col("region")])
    updates = [*STATION_UPDATES, "elevation", "is_active"]
    rows = rows.select("station_id", *updates)
    return StationSync(merge_flagged(target, rows, ["station_id"], updates), new_regions), rejects


@dataclass
class ObservationSync:
    merged: DataFrame
    skipped: DataFrame


def known_observations(rows: DataFrame, stations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of known stations with a date, all others)."""
    known, skipped = split_known(rows, stations)
    dated = F.col("observation_date").isNotNull()
    return known.where(dated), skipped.unionByName(known.where(~dated))


def sync_observations(
    source: DataFrame,
    target: DataFrame,
    stations: DataFrame,
    order: Sequence[Column],
    start=None,
    end=None,
    limit: int | None = None,
    tie: Sequence[str] = (),
) -> ObservationSync:
    """Observations merged by (station, date); those of unknown stations or without a date are skipped.

    A limit takes the newest rows; (date, tie) must then be a total order.
    """
    rows = date_range(source, start, end)
    if limit is not None:
        if not tie:
            raise ValueError("a limit needs `tie` columns that tell rows of a day apart")
        rows = newest(rows, limit, tie)
    known, skipped = known_observations(rows, stations)
    known = first_per_key(known, OBSERVATION_KEY, order)
    return ObservationSync(
        merge_flagged(target, known, OBSERVATION_KEY, schemas.MEASURES, null_keys=False), skipped
    )


def observation_counts(sync: ObservationSync) -> DataFrame:
    """created / updated / skipped of an observation sync as one row."""
    written = action_counts(sync.merged, "observations")
    skipped = sync.skipped.agg(F.count("*").alias("s"))
    # Two one-row frames folded into one row.
    stacked = written.drop("skipped").unionByName(
        skipped.select(F.col("s").alias("skipped")), allowMissingColumns=True
    )
    return stacked.agg(
        *[
            F.max(c).alias(c)
            for c in ("entity", "created", "updated", "skipped", "errors")
        ]
    )


def full_sync(
    regions: tuple[DataFrame, DataFrame],
    stations: DataFrame,
    target: DataFrame,
    source: DataFrame,
    order: Sequence[Column],
) -> DataFrame:
    """Regions, then stations, then observations: counts per entity.

    `regions` is (existing, incoming). Each merged table is written once; the
    next step and the counts read it. Observations are checked against the
    stations as they are after the station step.
    """
    merged_regions = _staged(sync_regions(*regions), "regions")
    st = sync_stations(source, stations, merged_regions.drop("action"))
    merged_stations = _staged(st.stations, "stations")
    obs = sync_observations(source, target, merged_stations.select("station_id"), order)
    obs = ObservationSync(_staged(obs.merged, "observations"), obs.skipped)
    return union_all(
        action_counts(merged_regions, "regions"),
        action_counts(merged_stations, "stations"),
        observation_counts(obs),
    )


@dataclass
class SyncTables:
    """Catalog names of what a sync keeps up to date; the log is made when missing."""

    regions: str
    stations: str
    observations: str
    log: str


#: What a load log calls these loads.
SYNC = "sync"
NO_COUNTS = "entity string, created long, updated long, skipped long, errors long"


def publish_sync(
    spark: SparkSession,
    names: SyncTables,
    regions: DataFrame,
    source: DataFrame,
    order: Sequence[Column],
    rejects: DataFrame | None = None,
    parts: Sequence[str] = ("year",),
    start: dt.date | None = None,
    end: dt.date | None = None,
    limit: int | None = None,
    tie: Sequence[str] = (),
    load_id: str | None = None,
) -> DataFrame:
    """Regions, stations and observations merged into their tables; gives the counts, which the log gets too.

    Only observations from `start` to `end` are taken, both inclusive, and of those the
    newest `limit` under (date, tie). A load whose `load_id` the log has as completed
    does nothing and counts nothing. With windows or a limit, stations stay coastal once
    they were: a window need not hold a sea reading. Windows that do not overlap then give the
    same tables in any order, as long as a station's attributes do not differ between them.

    Region texts that match no region become regions of their own before the stations
    that name them are published. Observations rewrite touched partitions only; `parts`
    must follow from the key. `rejects` are rows a loader refused, counted as errors.

    Everything is worked out and staged before the first table is replaced. A load that
    fails is logged as failed, and raises.
    """
    if load_id is not None:
        done = completed_loads(spark, names.log, SYNC)
        if done is not None and not done.where(F.col("load_id") == load_id).isEmpty():
            return spark.createDataFrame([(e, 0, 0, 0, 0) for e in ("regions", "stations", "observations")], NO_COUNTS)
    began = dt.datetime.now()
    rows = date_range(source, start, end)
    if limit is not None:
        if not tie:
            raise ValueError("a limit needs `tie` columns that tell rows of a day apart")
        rows = newest(rows, limit, tie)
    partial = (start, end, limit) != (None, None, None)
    try:
        counts, last = _publish(spark, names, regions, rows, order, rejects, parts, partial)
    except Exception:
        nothing = spark.createDataFrame([("observations", 0, 0, 0, 0)], NO_COUNTS)
        log_load(spark, names.log, nothing, SYNC, began, dt.datetime.now(), "failed", load_id)
        raise
    log_load(spark, names.log, counts, SYNC, began, dt.datetime.now(), "completed", load_id, last)
    return counts


def _publish(spark, names, regions, source, order, rejects, parts, partial) -> tuple[DataFrame, dt.date | None]:
    """(counts, newest day that arrived)."""
    merged = _staged(sync_regions(spark.table(names.regions), regions), "regions")
    before = spark.table(names.stations)
    found = sync_stations(source, before, merged.drop("action"))
    made = found.new_regions.withColumn("action", F.lit("created"))
    merged = _staged(merged.unionByName(made), "regions")
    stations = found.stations
    if partial:
        was = before.where("is_coastal").select("station_id", F.lit(True).alias("_was"))
        stations = stations.join(was, "station_id", "left")
        stations = stations.withColumn("is_coastal", F.col("is_coastal") | F.coalesce("_was", F.lit(False))).drop("_was")
    stations = _staged(stations, "stations")

    arrived = _arrived(source, stations, parts)
    touched = [row for row in arrived if row["_taken"]]
    lost = sum(row["_lost"] for row in arrived)
    last = max((row["_newest"] for row in arrived if row["_newest"] is not None), default=None)
    refused = rejects.agg(F.count("*")).first()[0] if rejects is not None else 0
    known, _ = known_observations(source, stations)
    target = spark.table(names.observations)
    # The order may name columns that the table does not have.
    known = first_per_key(known, OBSERVATION_KEY, order).select(*target.columns)
    ready = staged_upsert(
        spark, names.observations, known, OBSERVATION_KEY, schemas.MEASURES, parts, touched=touched, null_keys=False
    )

    tables.load_table(merged.drop("action"), names.regions)
    tables.load_table(stations.drop("action"), names.stations)
    tables.overwrite_partitions(ready.drop("action"), names.observations)
    written = action_counts(ready, "observations").withColumns(
        {"skipped": F.lit(lost).cast("long"), "errors": F.lit(refused).cast("long")}
    )
    # Three rows, staged so that the log and the caller see the same counts.
    counts = union_all(action_counts(merged, "regions"), action_counts(stations, "stations"), written)
    return _staged(counts, "counts"), last


def _arrived(source: DataFrame, stations: DataFrame, parts: Sequence[str]) -> list[Row]:
    """Per partition that rows arrive for: rows `_taken` and `_lost` (as known_observations has it), and the `_newest` day.

    One pass. The partitions follow from the key, so that rows need not be cut to one a key.
    """
    there = stations.select("station_id").distinct().withColumn("_known", F.lit(True))
    day = F.col("observation_date")
    taken = F.col("_known").isNotNull() & day.isNotNull()
    rows = source.select("station_id", "observation_date", *[p for p in parts if p not in OBSERVATION_KEY])
    rows = rows.join(there, "station_id", "left").groupBy(*parts)
    return rows.agg(F.count_if(taken).alias("_taken"), F.count_if(~taken).alias("_lost"), F.max(day).alias("_newest")).collect()


def sync_since(
    spark: SparkSession,
    names: SyncTables,
    regions: DataFrame,
    source: DataFrame,
    order: Sequence[Column],
    overlap_days: int = 30,
    **options,
) -> DataFrame:
    """publish_sync of what is new: from the newest day the load log knows, less an overlap.

    Readings that are delivered late lie in the overlap and are merged again; what has
    not changed is written as it is. Without a completed load everything is taken.
    """
    mark = high_water(spark, names.log, SYNC)
    start = None if mark is None else mark - dt.timedelta(days=overlap_days)
    return publish_sync(spark, names, regions, source, order, start=start, **options)


def classify_observations(
    rows: DataFrame, stations: DataFrame, target: DataFrame, order: Sequence[Column]
) -> DataFrame:
    """Coerced rows of a text load, each with its `action`.

    skipped: unknown station or blank date; error: text that does not parse;
    duplicate: the key is in the target; created: of the rows with a new key,
    the first under `order`.
    """
    known = stations.select("station_id", F.lit(True).alias("_known"))
    there = target.select(*OBSERVATION_KEY, F.lit(True).alias("_there"))
    rows = rows.join(known, "station_id", "left")
    state = (
        F.when(F.col("_known").isNull() | F.col("blank_date"), F.lit("skipped"))
        .when(F.size("errors") > 0, F.lit("error"))
        .otherwise(F.lit("created"))
    )
    rows = rows.withColumn("action", state).drop("_known", "blank_date")
    good = rows.where("action = 'created'")
    fresh = good.join(there, OBSERVATION_KEY, "left")
    fresh = fresh.withColumn(
        "action", F.when(F.col("_there"), F.lit("duplicate")).otherwise(F.lit("created"))
    ).drop("_there")
    first = first_per_key(fresh.where("action = 'created'"), OBSERVATION_KEY, order)
    return union_all(
        rows.where("action <> 'created'"),
        fresh.where("action = 'duplicate'"),
        first,
    )


def load_observation_text(
    spark: SparkSession,
    path: str,
    stations: DataFrame,
    target: DataFrame,
    order: Sequence[Column],
    schema=schemas.OBSERVATIONS,
) -> DataFrame:
    """Read a delimited file as text and classify its rows.

    The coerced rows are staged as Parquet, so the text is parsed once.
    """
    raw = read_text_columns(spark, path, schema)
    stage = work_path(spark, "coerced")
    coerce_observations(raw).write.parquet(stage)
    return classify_observations(spark.read.parquet(stage), stations, target, order)
