"""Query catalogue registry: name -> Spark builder, and name -> DuckDB oracle SQL.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
driver tables; nothing is collected.  Most are lazy; those that ingest, stream
or write a shared frame once run these jobs when called.  The oracle SQL is the same question in
plain SQL, used by the correctness gate.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from punctua.tables import to_wall_clock

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return to_wall_clock(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def load_all() -> None:
    """Import every catalogue module so their ``@query`` registrations run."""
    from punctua.plans import (  # noqa: F401
        crawl_q, domain_q, gold_q, history_q, ingest_q, lookup_q, ml_q, planning_q, series_q, silver_q, star_q, stream_q, timeseries_q,
    )
