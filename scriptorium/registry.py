"""Named queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .sources.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with the SQL that must give the same rows."""

    def register(f: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql:
            ORACLES[name] = sql
        return f

    return register


def load() -> None:
    """Import every module that registers queries."""
    from .operators import aggregates, filters, identity_resolution, joins, sets, sorts, windows  # noqa: F401
    from .plans import audits, catalog, corpus, crawl, date_pipeline, extraction, jobs, page_rules, pages, reads  # noqa: F401
    from .functions import queries  # noqa: F401
    from .sources import queries as source_queries  # noqa: F401
    from .streaming import queries as stream_queries  # noqa: F401
