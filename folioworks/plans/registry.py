"""Registration of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its name, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(frame: DataFrame, least_bytes: int = 64 << 20) -> DataFrame:
    """``frame``, a table as read, over all cores if its files are fewer and small; larger tables stay as they are.

    A small table in one row group is one task, however much work its rows make.
    """
    cores = frame.sparkSession.sparkContext.defaultParallelism
    small = len(frame.inputFiles()) < cores and frame._jdf.queryExecution().analyzed().stats().sizeInBytes() < least_bytes * cores
    return frame.repartition(cores) if small else frame
