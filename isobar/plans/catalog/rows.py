"""Projections, filters, cleaning and functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from isobar.functions import columns as C
from isobar.operators import clean, filters, joins
from isobar.plans.adapter import r, with_views
from isobar.plans.catalog.base import query, rounded

KEYS = "k1, k2, k3, station_id"


@query(
    "project_obs",
    with_views(
        "obs",
        """
  SELECT station_id, station_name, country, region AS region_name, observation_date, year, month,
         temp_max, temp_min, temp_mean, precipitation, humidity,
         sea_surface_temp AS sst, ocean_salinity AS salinity, data_quality
  FROM obs""",
    ),
)
def project_obs(t):
    return t.obs.select(
        "station_id", "station_name", "country", F.col("region").alias("region_name"),
        "observation_date", "year", "month", "temp_max", "temp_min", "temp_mean", "precipitation",
        "humidity", F.col("sea_surface_temp").alias("sst"),
        F.col("ocean_salinity").alias("salinity"), "data_quality",
    )


@query(
    "filter_not_null",
    with_views("fact", f"SELECT {KEYS}, temp_mean, precipitation, sea_surface_temp FROM fact "
               "WHERE precipitation IS NOT NULL AND sea_surface_temp IS NOT NULL"),
)
def filter_not_null(t):
    cols = ["k1", "k2", "k3", "station_id", "temp_mean", "precipitation", "sea_surface_temp"]
    return filters.not_null(t.fact.select(*cols), "precipitation", "sea_surface_temp")


@query(
    "filter_year_range",
    with_views("fact", f"SELECT {KEYS}, year, temp_mean FROM fact WHERE year >= 1996 AND year <= 1998"),
)
def filter_year_range(t):
    return filters.year_range(t.fact, 1996, 1998).select(
        "k1", "k2", "k3", "station_id", "year", "temp_mean"
    )


@query(
    "filter_date_range",
    with_views(
        "fact",
        f"SELECT {KEYS}, observation_date FROM fact "
        "WHERE observation_date BETWEEN DATE '1996-02-10' AND DATE '1997-08-20'",
    ),
)
def filter_date_range(t):
    rows = filters.date_range(t.fact, dt.date(1996, 2, 10), dt.date(1997, 8, 20))
    return rows.select("k1", "k2", "k3", "station_id", "observation_date")


@query(
    "filter_partition",
    with_views(
        "obs",
        "SELECT station_id, temp_mean, precipitation FROM obs "
        "WHERE year = 1997 AND month = 6 AND region = 'EUROPE'",
    ),
)
def filter_partition(t):
    return filters.partition(
        filters.year_range(t.obs, 1997, 1997), 1997, 6, "EUROPE"
    ).select("station_id", "temp_mean", "precipitation")


@query(
    "filter_by_spec",
    with_views(
        "obs",
        f"SELECT {KEYS}, country, year, data_quality FROM obs WHERE region = 'ASIA' AND year >= 1996 "
        "AND observation_date <= DATE '1999-12-31' AND is_coastal = true AND data_quality = 'good'",
    ),
)
def filter_by_spec(t):
    spec = {
        "region": "ASIA",
        "year__gte": 1996,
        "observation_date__lte": dt.date(1999, 12, 31),
        "is_coastal": True,
        "data_quality": "good",
    }
    return filters.by_spec(t.obs, spec, undated=False).select(
        "k1", "k2", "k3", "station_id", "country", "year", "data_quality"
    )


@query(
    "search_stations",
    with_views(
        "stations",
        "SELECT station_id, station_name, country, region FROM stations WHERE "
        + " AND ".join(
            f"(contains(CAST(station_id AS VARCHAR), '{w}') OR contains(lower(station_name), '{w}') "
            f"OR contains(lower(country), '{w}'))"
            for w in ("nation_1", "7")
        ),
    ),
)
def search_stations(t):
    return filters.search(t.stations, "Nation_1 7").select(
        "station_id", "station_name", "country", "region"
    )


# Region texts in mixed case, as code or unknown; two regions go by another name.
MATCH_REGIONS_SQL = (
    "named AS (SELECT CASE WHEN name < 'ASIA' THEN name ELSE 'Region of ' || name END AS name, code FROM regions), "
    "texts AS (SELECT station_id, CASE station_id % 3 WHEN 0 THEN lower(region) "
    "WHEN 1 THEN region ELSE region || ' (unknown)' END AS region_text FROM stations)"
)


@query(
    "match_ci",
    with_views(
        "stations regions",
        f"""WITH {MATCH_REGIONS_SQL}
  SELECT station_id, region_text, coalesce(n.code, c.code) AS region_code
  FROM texts LEFT JOIN named n ON lower(region_text) = lower(n.name)
       LEFT JOIN named c ON replace(substr(upper(region_text), 1, 10), ' ', '_') = c.code""",
    ),
)
def match_ci(t):
    k, region = F.col("station_id"), F.col("region")
    texts = t.stations.select(
        "station_id",
        F.when(k % 3 == 0, F.lower(region))
        .when(k % 3 == 1, region)
        .otherwise(F.concat(region, F.lit(" (unknown)")))
        .alias("region_text"),
    )
    name = F.col("name")
    named = t.regions.select(
        F.when(name < "ASIA", name).otherwise(F.concat(F.lit("Region of "), name)).alias("name"),
        "code",
    )
    return joins.match_region(texts, named).select("station_id", "region_text", "region_code")


@query(
    "coastal_split",
    with_views(
        "fact",
        f"""
  SELECT CASE WHEN sea_surface_temp IS NOT NULL THEN 'Coastal' ELSE 'Inland' END AS kind,
         count(*) AS n, {r('avg(temp_mean)', 6)} AS avg_temp FROM fact GROUP BY 1""",
    ),
)
def coastal_split(t):
    kind = F.when(F.col("sea_surface_temp").isNotNull(), "Coastal").otherwise("Inland")
    rows = t.fact.groupBy(kind.alias("kind")).agg(
        F.count("*").alias("n"), F.avg("temp_mean").alias("avg_temp")
    )
    return rounded(rows, 6, "avg_temp")


@query(
    "clean_range",
    with_views("raw", f"SELECT {KEYS}, CASE WHEN temp_mean BETWEEN -50 AND 60 THEN temp_mean END AS temp_mean FROM raw"),
)
def clean_range(t):
    return clean.clean_range(t.raw).select("k1", "k2", "k3", "station_id", "temp_mean")


CLAMP_SQL = "CASE WHEN humidity < 0 THEN 0 WHEN humidity > 100 THEN 100 ELSE humidity END"


@query("clean_clamp", with_views("raw", f"SELECT {KEYS}, {CLAMP_SQL} AS humidity FROM raw"))
def clean_clamp(t):
    return clean.clean_clamp(t.raw).select("k1", "k2", "k3", "station_id", "humidity")


@query(
    "clean_impute",
    with_views(
        "obs",
        f"""
  SELECT {KEYS}, region, {r('coalesce(precipitation, avg(precipitation) OVER (PARTITION BY region))', 6)} AS precipitation
  FROM obs""",
    ),
)
def clean_impute(t):
    rows = clean.clean_impute(t.obs.select("k1", "k2", "k3", "station_id", "region", "precipitation"))
    return rounded(rows, 6, "precipitation")


@query("derive_range", with_views("fact", f"SELECT {KEYS}, temp_max - temp_min AS diurnal_range FROM fact"))
def derive_range(t):
    return t.fact.select(
        "k1", "k2", "k3", "station_id", (F.col("temp_max") - F.col("temp_min")).alias("diurnal_range")
    )


@query(
    "validate_dates",
    with_views(
        "fact",
        f"""
  SELECT {KEYS}, year + CAST(k2 = 5 AS INT) AS year, CASE WHEN k2 = 6 THEN month % 12 + 1 ELSE month END AS month,
         CASE WHEN k2 = 5 THEN 'year does not match the date'
              WHEN k2 = 6 THEN 'month does not match the date' ELSE '' END AS reason
  FROM fact""",
    ),
)
def validate_dates(t):
    k2 = F.col("k2")
    rows = t.fact.select(
        "k1", "k2", "k3", "station_id", "observation_date",
        F.when(k2 == 5, F.col("year") + 1).otherwise(F.col("year")).alias("year"),
        F.when(k2 == 6, F.col("month") % 12 + 1).otherwise(F.col("month")).alias("month"),
    )
    checked = clean.validate_dates(rows)
    return checked.select(
        "k1", "k2", "k3", "station_id", "year", "month", F.concat_ws("; ", "errors").alias("reason")
    )


@query("filter_hot", with_views("fact", f"SELECT {KEYS}, temp_mean FROM fact WHERE temp_mean > 30"))
def filter_hot(t):
    return filters.hotter_than(t.fact).select("k1", "k2", "k3", "station_id", "temp_mean")


@query(
    "filter_recent",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_day FROM orders "
    "WHERE CAST(o_orderdate AS DATE) >= DATE '2001-06-30' - 365",
)
def filter_recent(t):
    rows = t.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"))
    return filters.recent(rows, dt.date(2001, 6, 30), 365, "order_day")


@query(
    "stations_in_region",
    with_views(
        "stations fact",
        """
  SELECT s.station_id, station_name, country, region, count(f.station_id) AS observation_count
  FROM stations s LEFT JOIN fact f ON s.station_id = f.station_id
  WHERE is_active AND region = 'EUROPE' GROUP BY ALL ORDER BY country, station_name""",
    ),
)
def stations_in_region(t):
    active = filters.active_in(t.stations, region="EUROPE")
    active = active.select("station_id", "station_name", "country", "region")
    return joins.station_counts(active, t.fact).orderBy("country", "station_name")


# -- functions ---------------------------------------------------------------


@query("fn_round", with_views("fact", f"SELECT {KEYS}, {r('precipitation', 2)} AS rain_r2, {r('precipitation', 1)} AS rain_r1 FROM fact"))
def fn_round(t):
    return t.fact.select(
        "k1", "k2", "k3", "station_id",
        C.stable_round("precipitation", 2).alias("rain_r2"),
        C.stable_round("precipitation", 1).alias("rain_r1"),
    )


@query(
    "fn_clamp",
    with_views("fact", f"SELECT {KEYS}, CASE WHEN precipitation < 20 THEN 20 WHEN precipitation > 60 THEN 60 ELSE precipitation END AS clamped FROM fact"),
)
def fn_clamp(t):
    return t.fact.select("k1", "k2", "k3", "station_id", C.clamp("precipitation", 20, 60).alias("clamped"))


@query("fn_coalesce", with_views("fact", f"SELECT {KEYS}, coalesce(sea_surface_temp, temp_mean, 0) AS water_or_air FROM fact"))
def fn_coalesce(t):
    return t.fact.select(
        "k1", "k2", "k3", "station_id",
        F.coalesce("sea_surface_temp", "temp_mean", F.lit(0.0)).alias("water_or_air"),
    )


@query(
    "fn_case",
    with_views(
        "fact",
        f"SELECT {KEYS}, CASE WHEN temp_mean >= 40 THEN 'hot' WHEN temp_mean >= 20 THEN 'mild' ELSE 'cold' END AS band FROM fact",
    ),
)
def fn_case(t):
    band = F.when(F.col("temp_mean") >= 40, "hot").when(F.col("temp_mean") >= 20, "mild").otherwise("cold")
    return t.fact.select("k1", "k2", "k3", "station_id", band.alias("band"))


@query(
    "fn_season",
    with_views(
        "fact",
        f"SELECT month, {r('sin(2 * pi() * month / 12)', 9)} AS month_sin, {r('cos(2 * pi() * month / 12)', 9)} AS month_cos, "
        "count(*) AS n FROM fact GROUP BY month",
    ),
)
def fn_season(t):
    rows = t.fact.groupBy("month").agg(F.count("*").alias("n"))
    return rows.select(
        "month",
        C.stable_round(C.month_sin("month"), 9).alias("month_sin"),
        C.stable_round(C.month_cos("month"), 9).alias("month_cos"),
        "n",
    )


@query(
    "fn_year_month",
    with_views(
        "fact",
        f"SELECT {KEYS}, CAST(year(observation_date) AS INT) AS y, CAST(month(observation_date) AS INT) AS m FROM fact",
    ),
)
def fn_year_month(t):
    """Year and month given on some rows, taken from the date on the others."""
    year = F.when(F.col("k2") % 2 == 0, F.col("year"))
    month = F.when(F.col("k2") % 3 == 0, F.col("month"))
    return t.fact.select(
        "k1", "k2", "k3", "station_id",
        C.year_of(year, "observation_date").alias("y"),
        C.month_of(month, "observation_date").alias("m"),
    )


@query(
    "fn_parse_date",
    with_views(
        "fact",
        f"SELECT {KEYS}, CASE WHEN k2 IN (1, 2) THEN observation_date END AS parsed, k2 > 2 AS failed FROM fact",
    ),
)
def fn_parse_date(t):
    day = C.date_text("observation_date")
    k2 = F.col("k2")
    text = (
        F.when(k2 == 1, day)
        .when(k2 == 2, F.concat(day, F.lit(" 12:30:00")))
        .when(k2 == 3, F.lit(""))
        .when(k2 == 4, F.date_format("observation_date", "dd/MM/yyyy"))
        .otherwise(F.lit("1999-02-30"))
    )
    parsed = C.parse_date(text)
    return t.fact.select(
        "k1", "k2", "k3", "station_id", parsed.alias("parsed"), parsed.isNull().alias("failed")
    )


@query("fn_date_fmt", with_views("fact", f"SELECT {KEYS}, strftime(observation_date, '%Y-%m-%d') AS day_text FROM fact"))
def fn_date_fmt(t):
    return t.fact.select("k1", "k2", "k3", "station_id", C.date_text("observation_date").alias("day_text"))


MONTHS_SQL = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][month]"


@query("fn_month_name", with_views("fact", f"SELECT month, {MONTHS_SQL} AS month_name, count(*) AS n FROM fact GROUP BY month"))
def fn_month_name(t):
    rows = t.fact.groupBy("month").agg(F.count("*").alias("n"))
    return rows.withColumn("month_name", C.month_name("month"))


@query(
    "fn_date_arith",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) - 30 AS month_before, "
    "CAST(epoch(o_orderdate) AS BIGINT) AS seconds FROM orders",
)
def fn_date_arith(t):
    at = F.col("o_orderdate")
    day = at.cast("date")
    # The clock time is taken as UTC whatever the session's zone.
    clock = F.hour(at) * 3600 + F.minute(at) * 60 + F.second(at)
    return t.table("orders").select(
        "o_orderkey",
        F.date_sub(day, 30).alias("month_before"),
        (F.unix_date(day).cast("long") * 86400 + clock).alias("seconds"),
    )


@query(
    "fn_region_code",
    with_views(
        "stations",
        "SELECT station_id, replace(substr(upper(region), 1, 10), ' ', '_') AS code, "
        "split_part(lower(region), ' ', 1) AS region_key, "
        "CASE WHEN contains(region, 'Africa') THEN region ELSE region || ' Africa' END AS label FROM stations",
    ),
)
def fn_region_code(t):
    return t.stations.select(
        "station_id",
        C.region_code("region").alias("code"),
        C.region_key("region").alias("region_key"),
        C.with_suffix("region").alias("label"),
    )


@query(
    "fn_bool",
    with_views("fact", f"SELECT {KEYS}, k2 <= 3 AS flag FROM fact"),
)
def fn_bool(t):
    words = F.array(*[F.lit(w) for w in ("TRUE", "1", " Yes ", "no", "0", "", "false")])
    word = F.element_at(words, F.col("k2"))
    return t.fact.select("k1", "k2", "k3", "station_id", C.parse_bool(word).alias("flag"))


@query(
    "json_field",
    "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events",
)
def json_field(t):
    return t.table("events").select("event_id", C.json_field("props", "k").alias("k"))


@query("explode_array", "SELECT vec_id, label, unnest(embedding) AS measurement FROM embeddings")
def explode_array(t):
    return t.table("embeddings").select("vec_id", "label", F.explode("embedding").alias("measurement"))


@query(
    "json_explode",
    """
  SELECT event_id AS station_id, json_extract_string(metadata, '$.sensor_type') AS sensor,
         unnest(measurements) AS measurement
  FROM (SELECT event_id, CAST(year(ts) AS INT) AS year, '{"sensor_type": "' || event_type || '"}' AS metadata,
               [value, value * 2, CAST(user_id AS DOUBLE)] AS measurements FROM events)
  WHERE year = 2024""",
)
def json_explode(t):
    """Sensor readings built from the events: JSON metadata and an array of values."""
    readings = t.table("events").select(
        F.col("event_id").alias("station_id"),
        "ts",
        F.to_json(F.struct(F.col("event_type").alias("sensor_type"))).alias("metadata"),
        F.array("value", F.col("value") * 2, F.col("user_id").cast("double")).alias("measurements"),
    )
    in_year = F.col("ts").between(
        F.lit("2024-01-01").cast("timestamp_ntz"), F.lit("2024-12-31 23:59:59.999999").cast("timestamp_ntz")
    )
    return readings.where(in_year).select(
        "station_id",
        C.json_field("metadata", "sensor_type").alias("sensor"),
        F.explode("measurements").alias("measurement"),
    )
