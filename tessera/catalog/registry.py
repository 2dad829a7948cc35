"""Registry of named queries: key -> (Spark query, oracle SQL).

A query takes ``(spark, sf_dir)``, reads the test tables through the
bindings and returns a DataFrame without acting on it. Its oracle is DuckDB
SQL over the same Parquet tables; queries that SQL can't express register no
SQL and are checked by property tests instead.
"""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tessera.catalog.fixture_sql import with_fixtures
from tessera.session import ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    key: str
    fn: QueryFn
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(key: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if key in REGISTRY:
            raise KeyError(f"duplicate query key {key}")

        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        REGISTRY[key] = Entry(key, run, with_fixtures(sql) if sql else None)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    """Import every catalog module (they register on import)."""
    from tessera.catalog import (  # noqa: F401
        c_aggregates, c_crime, c_energy, c_features, c_flights, c_generic, c_ml, c_scalar, c_series, c_titles,
        c_wine,
    )
    return REGISTRY
