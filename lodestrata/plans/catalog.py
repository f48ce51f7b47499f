"""Registry of the engine's queries: key -> Spark plan and, where SQL can say it, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(key: str, oracle: str | None = None):
    """Decorator that files a query under ``key`` with its DuckDB statement."""

    def keep(plan: Callable[[SparkSession, str], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = plan
        if oracle is not None:
            ORACLES[key] = oracle.replace("regexp_like(", "regexp_matches(")
        return plan

    return keep


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLES


def _load() -> None:
    """Import the modules that register queries."""
    from lodestrata.plans import classification, graphs, joining, reports, reviews, rollups, sources, texts  # noqa: F401


_load()
