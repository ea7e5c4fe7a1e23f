"""Queries of the training-data operators: name -> builder, and name -> DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return register


def load_all() -> None:
    """Import the operator modules so that their queries register."""
    from punctua.llm import (  # noqa: F401
        decontaminate, embedding_dedup, hard_negatives, jaccard_join, language_id, line_dedup, packing, pii, quality, secrets,
        sharding, substring_dedup, vector_codes,
    )
