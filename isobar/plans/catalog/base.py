"""Registered queries: name → (Spark function, comparison SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isobar.functions.columns import stable_round
from isobar.plans.adapter import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Callable[[Inputs], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Inputs(spark, folder))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, places: int, *cols: str) -> DataFrame:
    return df.withColumns({c: stable_round(c, places) for c in cols})
