"""Row predicates. Each is a plain Column, so scans get them pushed down."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fields a caller may filter observations by, with their lookups.
FILTER_FIELDS = {
    "country": {"exact"},
    "region": {"exact"},
    "is_coastal": {"exact"},
    "is_active": {"exact"},
    "year": {"exact", "gte", "lte"},
    "month": {"exact"},
    "observation_date": {"exact", "gte", "lte"},
    "data_quality": {"exact"},
}
SEARCH_FIELDS = ("station_id", "station_name", "country")


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    return df.dropna(subset=list(cols))


def year_range(
    obs: DataFrame,
    first: int | None = None,
    last: int | None = None,
    date: str | None = "observation_date",
    undated: bool = False,
) -> DataFrame:
    """first ≤ year ≤ last; either bound may be left out.

    A year computed from the date cannot be pushed to the files, a date range
    can; `date` adds the implied range (give None if year and date may differ).
    With `undated`, rows without a date go by their year alone.
    """
    dated = date in obs.columns
    loose = F.col(date).isNull() if dated and undated else F.lit(False)
    if first is not None:
        obs = obs.where(F.col("year") >= first)
        if dated:
            obs = obs.where(loose | (F.col(date) >= F.lit(dt.date(first, 1, 1))))
    if last is not None:
        obs = obs.where(F.col("year") <= last)
        if dated:
            obs = obs.where(loose | (F.col(date) <= F.lit(dt.date(last, 12, 31))))
    return obs


def date_range(
    obs: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    c: str = "observation_date",
) -> DataFrame:
    """Both bounds inclusive, either may be left out."""
    if start:
        obs = obs.where(F.col(c) >= F.lit(start))
    if end:
        obs = obs.where(F.col(c) <= F.lit(end))
    return obs


def partition(obs: DataFrame, year: int, month: int, region: str) -> DataFrame:
    return obs.where(
        (F.col("year") == year) & (F.col("month") == month) & (F.col("region") == region)
    )


def by_spec(obs: DataFrame, spec: Mapping[str, object], date: str | None = "observation_date", undated: bool = True) -> DataFrame:
    """Filters such as {'year__gte': 1996, 'country': 'KE'}; unknown ones raise.

    `date` and `undated` as in `year_range`: give None where years may differ from dates.
    """
    tests = {
        "exact": lambda c, v: c == v,
        "gte": lambda c, v: c >= v,
        "lte": lambda c, v: c <= v,
    }
    conds = []
    for name, value in spec.items():
        field, _, lookup = name.partition("__")
        lookup = lookup or "exact"
        if lookup not in FILTER_FIELDS.get(field, ()):
            raise ValueError(f"cannot filter by {name}")
        if field == "year":
            # The same bound on the date reaches the files.
            first = value if lookup in ("exact", "gte") else None
            obs = year_range(obs, first, value if lookup in ("exact", "lte") else None, date, undated)
            continue
        conds.append(tests[lookup](F.col(field), F.lit(value)))
    return obs.where(reduce(and_, conds)) if conds else obs


def search(df: DataFrame, text: str, fields: Sequence[str] = SEARCH_FIELDS) -> DataFrame:
    """Every word of the text occurs, in any case, in some field."""
    for term in text.lower().split():
        hits = [F.lower(F.col(f).cast("string")).contains(term) for f in fields]
        df = df.where(reduce(or_, hits))
    return df


def hotter_than(obs: DataFrame, limit: float = 30.0, c: str = "temp_mean") -> DataFrame:
    return obs.where(F.col(c) > limit)


def recent(df: DataFrame, as_of: dt.date, days: int = 365, c: str = "observation_date"):
    """From `days` before `as_of` on. The bound is a literal, so it is pushed down."""
    return df.where(F.col(c) >= F.date_sub(F.lit(as_of), days))


def active_in(stations: DataFrame, region: str | None = None, country: str | None = None):
    out = stations.where("is_active")
    if region is not None:
        out = out.where(F.col("region") == region)
    if country is not None:
        out = out.where(F.col("country") == country)
    return out
