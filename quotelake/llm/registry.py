"""Queries of the corpus operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return register


from quotelake.llm import queries  # noqa: E402, F401
