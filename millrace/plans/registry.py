"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.session import ship
from millrace.sources.files import spread

BUILD: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


class Tables:
    """Tables of one data folder by attribute; columns are pruned by the plans that use them."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def spread(self, name: str, key: str) -> DataFrame:
        """Table for work that is heavy per row; a scan of few splits uses all cores."""
        return spread(getattr(self, name), key)


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` as a named query."""

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship(spark)
            return build(Tables(spark, folder))

        BUILD[name] = run
        if sql is not None:
            SQL[name] = sql.strip()
        return build

    return register
