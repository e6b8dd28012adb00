"""Names of queries, their Spark form and, where SQL can express them, their DuckDB form."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """Parquet tables of a folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Registers a function of Tables."""

    def add(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql:
            ORACLE[name] = sql
        return fn

    return add
