"""The core's registered queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query; ``sql`` is its DuckDB form, left out where SQL cannot express it on whole tables."""

    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return put


from tracewright.plans import corpus, evaluation, formats, reports, sequences, sessions, usage  # noqa: E402,F401
