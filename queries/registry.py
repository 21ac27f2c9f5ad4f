"""Registration of driver queries next to their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import prepare

_runners: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_oracles: dict[str, str] = {}


class Tables:
    """Parquet tables of one data folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # The entity hierarchy, with the columns the operators expect.

    @property
    def artists(self) -> DataFrame:
        return self.customer.select(
            F.col("c_custkey").alias("artist_id"),
            F.col("c_name").alias("name"),
            F.col("c_nationkey").alias("country"),
        )

    @property
    def releases(self) -> DataFrame:
        """Orders; orders of one customer with one priority are one release group."""
        return self.orders.select(
            F.col("o_orderkey").alias("release_id"),
            F.col("o_custkey").alias("artist_id"),
            F.concat_ws("-", "o_custkey", "o_orderpriority").alias("group_id"),
            F.col("o_orderpriority").alias("title"),
            F.col("o_orderdate").cast("date").alias("release_date"),
            F.col("o_orderpriority").alias("country"),
            F.col("o_orderstatus").alias("status"),
        )

    @property
    def recordings(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_partkey").alias("recording_id"),
            F.col("l_orderkey").alias("release_id"),
            F.col("l_linenumber").alias("song_name"),
        )

    @property
    def urls(self) -> DataFrame:
        """Returned line items; their supplier is the url."""
        return self.lineitem.where(F.col("l_returnflag") == "R").select(
            F.col("l_suppkey").alias("url_id"), F.col("l_orderkey").alias("release_id")
        )


def query(sql: str | None = None):
    """Register a function of the tables under its own name."""

    def register(fn: Callable[[Tables], DataFrame]):
        name = fn.__name__
        if name in _runners:
            raise ValueError(f"query {name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(Tables(prepare(spark), folder))

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
