"""Registered queries and the SQL stating each answer from the plain tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a function, under its own name unless given, together with its answer."""

    def register(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        ORACLES[name or function.__name__] = sql.strip()
        return function

    return register


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def read_stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """The same table as an endless source."""
    return (
        spark.readStream.schema(read(spark, sf_dir, table).schema)
        .option("pathGlobFilter", f"{table}.parquet")
        .parquet(sf_dir)
    )
