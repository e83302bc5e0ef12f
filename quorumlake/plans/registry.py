"""All queries over the reference's own operators, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function as a query under its name, with its SQL if it has one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return add


def load() -> None:
    """Import the modules that register queries."""
    from quorumlake.plans import budgets, corpus, documents, printed, records, relations, rest, search, sequences, streams, texts, votes  # noqa: F401
