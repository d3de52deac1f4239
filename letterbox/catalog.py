"""Table inspection and the audit trail of loads."""

from __future__ import annotations

from datetime import date, datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .model import LoadResult
from .session import small_rows
from .sinks.tables import create_table, partition_columns, quote_name

AUDIT_SCHEMA = pa.schema(
    {
        "tabela": pa.string(),
        "mode": pa.string(),
        "status": pa.string(),
        "rows": pa.int64(),
        "day": pa.date32(),
        "run_ts": pa.timestamp("us", "UTC"),
        "error": pa.string(),
    }
)


def describe(spark: SparkSession, table: str) -> DataFrame:
    """``(col_name, data_type, is_partition)``, one row per column."""
    partitions = partition_columns(spark, table)
    columns = spark.sql(f"DESCRIBE TABLE {quote_name(table)}").select("col_name", "data_type")
    # DESCRIBE lists partition columns again below a heading.
    return (
        columns.filter(~F.col("col_name").startswith("#") & (F.col("col_name") != ""))
        .distinct()
        .withColumn("is_partition", F.col("col_name").isin(partitions))
    )


def show_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES FROM {quote_name(database)}")


def show_create_table(spark: SparkSession, table: str) -> str:
    return spark.sql(f"SHOW CREATE TABLE {quote_name(table)}").first()[0]


def record(
    spark: SparkSession, audit_table: str, results: list[LoadResult], day: date, base_path: str
) -> None:
    """Append one row per table of a run; one file per run."""
    now = datetime.now(timezone.utc)
    rows = [
        {
            "tabela": r.table,
            "mode": r.mode,
            "status": r.status,
            "rows": r.rows,
            "day": day,
            "run_ts": now,
            "error": r.error,
        }
        for r in results
    ]
    entries = small_rows(spark, rows, AUDIT_SCHEMA)
    if not spark.catalog.tableExists(audit_table):
        location = f"{base_path.rstrip('/')}/_audit/{audit_table.replace('.', '/')}"
        create_table(
            spark, audit_table, entries.schema, location, database_location=f"{location}.db"
        )
    entries.coalesce(1).write.insertInto(audit_table)


def history(spark: SparkSession, audit_table: str, table: str | None = None) -> DataFrame:
    """Past loads, of one table when named."""
    past = spark.table(audit_table)
    return past if table is None else past.filter(F.col("tabela") == table)
