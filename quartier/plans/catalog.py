"""Registry of named queries: a Spark builder and (where expressible) the
equivalent DuckDB SQL over the same parquet tables.

Every builder takes ``(spark, sf_dir)`` and reads the driver tables (through
the FIXTURES.md mapping), so its work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import q_batch, q_dash, q_io, q_more, q_store, q_stream  # noqa: F401
