"""File reads with declared schemas; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import lenient_cast, quoted
from ..functions.schemas import TABLE_COLUMN, all_text, landed_schema


def read_landing(
    spark: SparkSession, path: str, table: str | None = None, fmt: str = "json"
) -> DataFrame:
    """Landed envelopes, of one table when named.

    The table is a partition column, so naming it prunes directories.  The
    schema is given because the JSON writer may leave out fields and an
    inferred schema would lose columns that are NULL all day.
    """
    landed = spark.read.format(fmt).schema(landed_schema()).load(path)
    if table is None:
        return landed
    return landed.filter(F.col(TABLE_COLUMN) == table).drop(TABLE_COLUMN)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    header: bool = False,
    legacy_cast: bool = False,
) -> DataFrame:
    """CSV as text, then every column cast to its declared type."""
    text = spark.read.option("header", header).schema(all_text(schema)).csv(path)
    return cast_columns(text, schema, legacy_cast=legacy_cast)


def cast_columns(df: DataFrame, schema: T.StructType, *, legacy_cast: bool = False) -> DataFrame:
    """Text columns to the declared schema, in one projection."""
    return df.select(
        [lenient_cast(quoted(f.name), f.dataType, legacy_cast).alias(f.name) for f in schema.fields]
    )
