"""Registered queries: one per operator, over the domain views, with a SQL check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.plans.fixtures import Fixtures, duckdb_sql

QUERIES: dict[str, Callable[[Fixtures], DataFrame]] = {}
CHECKS: dict[str, str] = {}
PARTS = ("lake", "features", "gold", "history", "privacy", "models", "operations", "streams")


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Register a query. ``dates`` are compared as text: the two engines hand dates to Python
    as different types."""

    def register(fn: Callable[[Fixtures], DataFrame]):
        def as_text(fx: Fixtures) -> DataFrame:
            return fn(fx).withColumns({c: F.col(c).cast("string") for c in dates})

        QUERIES[name] = as_text if dates else fn
        if sql is not None:
            casts = ", ".join(f'CAST("{c}" AS VARCHAR) AS "{c}"' for c in dates)
            CHECKS[name] = f"SELECT * REPLACE ({casts}) FROM ({sql}) q" if dates else sql
        return fn

    return register


def load() -> None:
    for part in PARTS:
        import_module(f"ledgerlake.plans.catalog_{part}")


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    load()
    return {name: (lambda spark, sf_dir, fn=fn: fn(Fixtures(spark, sf_dir))) for name, fn in QUERIES.items()}


def sql_checks() -> dict[str, str]:
    load()
    return {name: duckdb_sql(sql) for name, sql in CHECKS.items()}
