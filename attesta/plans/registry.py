"""The queries of the engine's own operators by name, each with its DuckDB SQL where SQL can express it.

A query binds an operator to the shared tables: `plans` modules register them with `query`.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Register a function (table reader, session) -> DataFrame under its own name."""

    def add(f: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        QUERIES[f.__name__] = run
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


for _name in ("store", "grounding", "timeline", "similarity", "reporting", "texts", "streams", "markup", "storage", "workflow"):
    importlib.import_module(f"attesta.plans.{_name}")
