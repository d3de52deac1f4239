"""Pulls from a relational source, as declared by ingestion documents."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import parse_day


def window_query(template: str, first: str | date, last: str | date) -> str:
    """Query with its two ``%s`` filled by dates; both ends belong to the range."""
    pieces = template.split("%s")
    if len(pieces) != 3:
        raise ValueError("an incremental query needs exactly two %s")
    return pieces[0] + parse_day(first).isoformat() + pieces[1] + parse_day(last).isoformat() + pieces[2]


def document_statement(query: str, first: str | date, last: str | date) -> str:
    """What an ingestion document asks for: its window, or everything without one."""
    return window_query(query, first, last) if "%s" in query else query


def pull_options(
    url: str,
    statement: str,
    *,
    properties: Mapping[str, str] | None = None,
    partition_column: str | None = None,
    lower: str | int | date | None = None,
    upper: str | int | date | None = None,
    partitions: int | None = None,
) -> dict[str, str]:
    """Reader options; a partition column splits the pull over executors.

    Without one the whole answer comes through one connection, which only
    suits small tables.  A split needs the statement as a derived table,
    because the ``query`` option cannot be combined with it.
    """
    options = {"url": url, "fetchsize": "10000", **(properties or {})}
    if partition_column is None:
        options["query"] = statement
        return options
    if lower is None or upper is None or not partitions:
        raise ValueError("a split pull needs lower, upper and partitions")
    options.update(
        dbtable=f"({statement}) src",
        partitionColumn=partition_column,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(partitions),
    )
    return options


def read_window(
    spark: SparkSession, url: str, template: str, first: str | date, last: str | date, **split
) -> DataFrame:
    """Incremental pull; the date range runs inside the source."""
    options = pull_options(url, window_query(template, first, last), **split)
    return spark.read.format("jdbc").options(**options).load()


def read_full(spark: SparkSession, url: str, statement: str, **split) -> DataFrame:
    """Full pull, for tables written in overwrite mode."""
    return spark.read.format("jdbc").options(**pull_options(url, statement, **split)).load()
