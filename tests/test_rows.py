"""Cleaning, coercion, filters and functions on small literal frames."""

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from isobar import schemas
from isobar.functions import columns as C
from isobar.operators import clean, filters
from tests.conftest import rows


def one(spark, column, **values):
    schema = ", ".join(
        f"{k} {'string' if isinstance(v, str) or v is None else 'double'}" for k, v in values.items()
    )
    return spark.createDataFrame([tuple(values.values())], schema).select(column).first()[0]


def test_ranges(spark):
    df = spark.createDataFrame(
        [(-51.0, -1.0), (-50.0, 0.0), (60.0, 100.0), (61.0, 101.0), (None, None)],
        "temp_mean double, humidity double",
    )
    out = clean.clean_clamp(clean.clean_range(df)).collect()
    assert [r.temp_mean for r in out] == [None, -50.0, 60.0, None, None]
    assert [r.humidity for r in out] == [0.0, 0.0, 100.0, 100.0, None]


def test_impute_by_region(spark):
    df = spark.createDataFrame(
        [(1, "A", 2.0), (2, "A", None), (3, "A", 4.0), (4, "B", None), (5, None, None), (6, None, 7.0)],
        "id int, region string, precipitation double",
    )
    got = {r.id: r.precipitation for r in clean.clean_impute(df).collect()}
    assert got == {1: 2.0, 2: 3.0, 3: 4.0, 4: None, 5: 7.0, 6: 7.0}


def test_clean_of_nothing(spark):
    df = spark.createDataFrame([], schemas.OBSERVATIONS)
    assert clean.clean(df).count() == 0 and clean.clean(df).columns == df.columns


@pytest.mark.parametrize(
    "value,places,want",
    [(1.005, 2, 1.01), (2.5, 0, 3.0), (-25.125, 2, -25.13), (0.1 + 0.2, 1, 0.3), (24.9999999999, 2, 25.0)],
)
def test_half_up(spark, value, places, want):
    assert one(spark, C.stable_round("x", places), x=value) == want


def test_round_does_not_depend_on_the_order_of_sums(spark):
    values = [(float(v) / 7,) for v in range(2000)]
    a = spark.createDataFrame(values, "x double").repartition(7).agg(C.stable_round(F.sum("x"), 6))
    b = spark.createDataFrame(values[::-1], "x double").repartition(3).agg(C.stable_round(F.sum("x"), 6))
    assert a.first() == b.first()


@pytest.mark.parametrize(
    "text,want",
    [
        ("2024-02-29", dt.date(2024, 2, 29)),
        (" 2024-02-09 10:00:00", dt.date(2024, 2, 9)),
        ("2024-1-5", dt.date(2024, 1, 5)),
        ("2023-02-29", None),
        ("09/02/2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, want):
    assert one(spark, C.parse_date("t"), t=text) == want


@pytest.mark.parametrize("text,want", [("True", True), (" 1 ", True), ("YES", True), ("no", False), ("", False), (None, False)])
def test_parse_bool(spark, text, want):
    assert one(spark, C.parse_bool("t"), t=text) is want


def test_names(spark):
    assert one(spark, C.region_code("t"), t="Central African lands") == "CENTRAL_AF"
    assert one(spark, C.region_key("t"), t="East Africa") == "east"
    assert one(spark, C.region_key("t"), t=None) == "unknown"
    assert one(spark, C.with_suffix("t"), t="East") == "East Africa"
    assert one(spark, C.with_suffix("t"), t="South Africa") == "South Africa"
    months = spark.range(0, 14).select(C.month_name(F.col("id").cast("int"))).collect()
    assert [m[0] for m in months] == [None, *C.MONTH_NAMES, None]


def test_correlation_edges(spark):
    df = spark.createDataFrame(
        [("const", 1.0, float(i)) for i in range(5)]
        + [("line", float(i), 2.0 * i) for i in range(5)]
        + [("single", 1.0, 1.0), ("gap", None, 1.0), ("gap", 2.0, None)],
        "k string, x double, y double",
    )
    got = {r[0]: r[1] for r in df.groupBy("k").agg(C.safe_corr("x", "y")).collect()}
    assert got["line"] == pytest.approx(1.0)
    assert got["const"] is None and got["single"] is None and got["gap"] is None


def test_validate_dates(spark):
    day = dt.date(2020, 3, 4)
    df = spark.createDataFrame(
        [(1, day, 2020, 3), (2, day, 2021, 3), (3, day, 2020, 4), (4, day, 2019, 1), (5, day, None, None)],
        "id int, observation_date date, year int, month int",
    )
    good, bad = clean.split_rejects(clean.validate_dates(df))
    assert {r.id for r in good.collect()} == {1, 5}
    assert {r.id: len(r.errors) for r in bad.collect()} == {2: 1, 3: 1, 4: 2}


def test_coerce_stations(spark):
    raw = spark.createDataFrame(
        [
            ("s1", "", None, "East", "", "", "", "True", None),
            ("s2", "Name", "KE", "East", "1.5", "x", "10", "no", "0"),
            ("", "n", "KE", "East", "1", "2", "3", "1", "yes"),
        ],
        schemas.as_text(schemas.STATIONS),
    )
    good, bad = clean.split_rejects(clean.coerce_stations(raw))
    assert rows(good) == [("s1", "s1", "Unknown", "East", 0.0, 0.0, None, True, True)]
    assert {tuple(r.errors) for r in bad.collect()} == {
        ("longitude is not a number",),
        ("station_id is missing",),
    }


@pytest.fixture(scope="module")
def stations(spark):
    return spark.createDataFrame(
        [("KE-1", "Lake Side", "KE", "East", True), ("ZA-2", "Hill", "ZA", "South", False)],
        "station_id string, station_name string, country string, region string, is_active boolean",
    )


def test_search(stations):
    def found(text):
        return {r.station_id for r in filters.search(stations, text).collect()}

    assert found("lake") == {"KE-1"}
    assert found("ke HILL") == set()
    assert found("za hill") == {"ZA-2"}
    assert found("") == {"KE-1", "ZA-2"}


def test_active_in(stations):
    assert filters.active_in(stations, region="South").count() == 0
    assert filters.active_in(stations, country="KE").count() == 1


def test_filter_spec_rejects_unknown_fields(stations):
    for spec in ({"elevation": 1}, {"country__gte": "K"}, {"year__lt": 2000}):
        with pytest.raises(ValueError):
            filters.by_spec(stations, spec)
    assert filters.by_spec(stations, {}).count() == 2


def test_date_bounds_are_inclusive(spark):
    days = [dt.date(2020, 1, d) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame([(d,) for d in days], "observation_date date")
    assert filters.date_range(df, days[1], days[2]).count() == 2
    assert filters.date_range(df, None, days[0]).count() == 1
    assert filters.date_range(df).count() == 4
    assert filters.recent(df, days[3], 2).count() == 3


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=20))
def test_clamp_property(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(C.clamp("x", -5, 5)).collect()]
    assert got == [None if v is None else min(max(v, -5.0), 5.0) for v in values]
