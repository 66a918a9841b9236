"""Registry of named queries over the driver's test tables and their DuckDB
oracle SQL.

Each query takes (spark, sf_dir) and returns a DataFrame.  Doubles produced
by floating-point sums are rounded (in both the query and its SQL) because
the summation order differs between engines and between partitionings.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clipstar.plans import sql_mirror as M
from clipstar.plans.star import Star
from clipstar.session import pin_semantics, shared_dir

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(star) -> DataFrame`` under ``name`` with its oracle SQL
    (None for results that are not expressible in SQL)."""
    def wrap(fn: Callable[[Star], DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            pin_semantics(spark)
            shared_dir(spark)  # checkpoint() and scratch tables need it registered
            return fn(Star(spark, sf_dir))
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run
    return wrap


def star_sql(select: str) -> str:
    """Oracle SQL: the whole star schema as CTEs, then ``select``."""
    return M.with_ctes(*M.STAR) + select


def load_all() -> None:
    """Import every query module so its queries register."""
    from clipstar.plans import (  # noqa: F401
        ingest_queries, source_queries, star_queries, stream_queries,
    )
