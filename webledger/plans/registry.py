"""Registry of named queries: a Spark builder and, where SQL can say it, the
DuckDB oracle text for the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from webledger.plans.oracle import ORACLE, oracle
from webledger.sources.fixtures import Views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(views) -> DataFrame`` under ``name`` with its oracle SQL."""

    def wrap(fn: Callable[[Views], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Views(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            oracle(name, sql)
        return fn

    return wrap


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from webledger.plans import load_all  # noqa: F401  (registers every module)

    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from webledger.plans import load_all  # noqa: F401

    return dict(ORACLE)
