"""Registered queries: one per operator in the inventory, each paired with
its DuckDB oracle SQL where SQL can express it.

Every query reads the benchmark tables (or data Spark derives from them)
in full; fixed run parameters (dates, zones, run instants) stand in for the
scheduler's clock.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import configure_session

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure_session(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLE[key] = sql
        return run

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from tidewater.plans import (  # noqa: F401
        q_curation,
        q_merge,
        q_schema,
        q_scans,
        q_semistructured,
        q_export,
        q_state,
    )
