"""Query name -> Spark callable and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tallyloom.session import check_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            check_settings(spark)
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return register
