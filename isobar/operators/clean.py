"""Row cleaning, typed coercion and validation with rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from isobar.functions.columns import clamp, null_outside, number, parse_bool, parse_date
from isobar.operators.skew import measured

# Plausible ranges of the cleaning step.
TEMP_RANGE = (-50.0, 60.0)
HUMIDITY_RANGE = (0.0, 100.0)


def clean_range(obs: DataFrame, c: str = "temp_mean", low=TEMP_RANGE[0], high=TEMP_RANGE[1]):
    return obs.withColumn(c, null_outside(c, low, high))


def clean_clamp(obs: DataFrame, c: str = "humidity", low=HUMIDITY_RANGE[0], high=HUMIDITY_RANGE[1]):
    return obs.withColumn(c, clamp(c, low, high))


def clean_impute(obs: DataFrame, c: str = "precipitation", group: str = "region") -> DataFrame:
    """Fill NULLs with the average of the row's group.

    The averages are one row per group, aggregated map-side and measured; a
    window over the group would send a whole region to one task instead.
    """
    means = measured(obs.groupBy(F.col(group).alias("_group")).agg(F.avg(c).alias("_mean")))
    return (
        obs.join(means, F.col(group).eqNullSafe(F.col("_group")), "left")
        .withColumn(c, F.coalesce(F.col(c), F.col("_mean")))
        .select(*obs.columns)
    )


def clean(obs: DataFrame) -> DataFrame:
    """All three rules, in one pass after the group averages."""
    return clean_clamp(clean_range(clean_impute(obs)))


def _blank_to_null(c: str) -> Column:
    t = F.trim(F.col(c))
    return F.when(t != "", t)


def coerce_stations(raw: DataFrame) -> DataFrame:
    """Typed stations from text columns, with an `errors` array per row.

    Blank text is missing. Missing name, country and coordinates take defaults,
    a missing elevation stays NULL; text that is no finite number is an error.
    """
    t = {c: _blank_to_null(c) for c in raw.columns}

    def bad(c):
        return F.when(
            t[c].isNotNull() & number(t[c]).isNull(), F.lit(f"{c} is not a number")
        )

    errors = F.array_compact(
        F.array(
            F.when(t["station_id"].isNull(), F.lit("station_id is missing")),
            bad("latitude"),
            bad("longitude"),
            bad("elevation"),
        )
    )
    return raw.select(
        t["station_id"].alias("station_id"),
        F.coalesce(t["station_name"], t["station_id"]).alias("station_name"),
        F.coalesce(t["country"], F.lit("Unknown")).alias("country"),
        F.coalesce(t["region"], F.lit("Unknown")).alias("region"),
        number(F.coalesce(t["latitude"], F.lit("0"))).alias("latitude"),
        number(F.coalesce(t["longitude"], F.lit("0"))).alias("longitude"),
        number(t["elevation"]).alias("elevation"),
        parse_bool("is_coastal").alias("is_coastal"),
        # A file without the column means active.
        F.when(t["is_active"].isNull(), F.lit(True))
        .otherwise(parse_bool("is_active"))
        .alias("is_active"),
        errors.alias("errors"),
    )


def coerce_observations(raw: DataFrame) -> DataFrame:
    """Typed observations from text columns, with an `errors` array per row."""
    measures = [
        c
        for c in raw.columns
        if c not in ("station_id", "observation_date", "year", "month", "region")
    ]
    t = {c: _blank_to_null(c) for c in raw.columns}
    date = parse_date("observation_date")
    numbers = [
        F.when(t[c].isNotNull() & number(t[c]).isNull(), F.lit(f"{c} is not a number"))
        for c in measures
    ]
    errors = F.array_compact(
        F.array(
            F.when(
                t["observation_date"].isNotNull() & date.isNull(),
                F.lit("observation_date is not a date"),
            ),
            *numbers,
        )
    )
    return raw.select(
        t["station_id"].alias("station_id"),
        t["observation_date"].isNull().alias("blank_date"),
        date.alias("observation_date"),
        F.coalesce(t["year"].try_cast("int"), F.year(date)).alias("year"),
        F.coalesce(t["month"].try_cast("int"), F.month(date)).alias("month"),
        *[number(t[c]).alias(c) for c in measures],
        errors.alias("errors"),
    )


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows without errors, rows with errors)."""
    ok = F.size("errors") == 0
    return df.where(ok).drop("errors"), df.where(~ok)


def validate_dates(obs: DataFrame) -> DataFrame:
    """Adds `errors`: year and month, where given, must be those of the date."""
    d = F.col("observation_date")
    return obs.withColumn(
        "errors",
        F.array_compact(
            F.array(
                F.when(F.col("year") != F.year(d), F.lit("year does not match the date")),
                F.when(F.col("month") != F.month(d), F.lit("month does not match the date")),
            )
        ),
    )
