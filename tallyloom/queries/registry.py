"""The table of queries: a callable and, where the result is deterministic, the same query in SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tallyloom.sources.readers import Tables


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register ``f(tables) -> DataFrame`` under its own name."""

    def register(f: Callable[[Tables], DataFrame]) -> Callable:
        key = name or f.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(Tables(spark, sf_dir))

        REGISTRY[key] = Query(key, run, sql)
        return f

    return register
