"""Helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Registry:
    """Collects the queries of one module with their SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Callable] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable:
        def keep(fn: Callable) -> Callable:
            self.queries[name] = fn
            if sql is not None:
                self.oracles[name] = sql
            return fn

        return keep
