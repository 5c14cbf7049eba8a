"""Every operator as a query over the given tables, with an equivalent SQL text where one exists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shoregrid.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql:
            SQL[fn.__name__] = sql
        return fn

    return register


def load_all() -> None:
    from shoregrid.queries import (  # noqa: F401
        aggregates,
        expressions,
        joins,
        lake,
        loading,
        models,
        places,
        scans,
        shaping,
        streams,
    )
