"""Registration of the queries of this package next to their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm.common import shipped
from strata.session import prepare

_runners: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


class Tables:
    """Reads the tables of one data folder by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, table)``; ``table`` reads one of the folder's tables."""

    def register(fn: Callable[[SparkSession, Tables], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(shipped(prepare(spark)), Tables(spark, folder))

        run.__name__, run.__doc__ = name, fn.__doc__
        _runners[name] = run
        if sql is not None:
            _oracles[name] = sql
        return fn

    return register


def runners() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_runners)


def oracles() -> dict[str, str]:
    return dict(_oracles)
