"""All queries of the analytics operators and the SQL they are held against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from playmart.sources.testdata import Data, with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable:
    """Register a function of Data under its name, with its SQL over the views it names."""

    def register(f: Callable[[Data], DataFrame]) -> Callable[[Data], DataFrame]:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Data(spark, sf_dir))
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_views(sql, *views)
        return f

    return register


def _load() -> None:
    from playmart.plans import activity, alerts, bonus, cdc, cohorts, quality, source_marts, state, streams, tables  # noqa: F401


_load()
