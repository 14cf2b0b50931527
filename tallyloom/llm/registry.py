"""Query name -> Spark callable and, where SQL can say it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(spark, folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run

    return register


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def fresh(taken: list[str], *names: str) -> list[str]:
    """Names like the given ones that no column has, whatever its case."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name in used:
            name += "_"
        used.add(name)
        out.append(name)
    return out
