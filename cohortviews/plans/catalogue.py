"""Registry of the named queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register


def load() -> None:
    """Import every module that registers queries."""
    from cohortviews.plans import (  # noqa: F401
        queries_boosting,
        queries_evaluation,
        queries_files,
        queries_labels,
        queries_matrix,
        queries_models,
        queries_states,
    )
