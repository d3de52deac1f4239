"""Key, emptiness and cast checks; each is one aggregate over the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions.columns import lenient_cast, quoted


class NullKeyError(ValueError):
    """A key column holds NULLs."""


def key_null_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(key, null_count, status)`` per key column, from a single pass."""
    if not keys:
        return df.sparkSession.createDataFrame([], "key string, null_count bigint, status string")
    counts = df.agg(*[F.count_if(quoted(k).isNull()).alias(f"k{i}") for i, k in enumerate(keys)])
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("key"), F.col(f"k{i}").alias("null_count"))
            for i, k in enumerate(keys)
        ]
    )
    return counts.select(F.inline(rows)).withColumn(
        "status", F.when(F.col("null_count") > 0, "ERRO").otherwise("OK")
    )


def _assert_present(df: DataFrame, keys: Sequence[str]) -> None:
    present = {name.lower() for name in df.columns}
    missing = [key for key in keys if key.lower() not in present]
    if missing:
        raise NullKeyError(f"key columns not in the table: {', '.join(missing)}")


def guard_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, but a job that meets a NULL key fails.

    Checks keys within the write itself instead of reading everything twice.
    A failed job leaves the table as it was.
    """
    _assert_present(df, keys)
    wanted = {key.lower() for key in keys}
    return df.withColumns(
        {
            name: F.when(quoted(name).isNull(), F.raise_error(F.lit(f"NULL key: {name}"))).otherwise(
                quoted(name)
            )
            for name in df.columns
            if name.lower() in wanted
        }
    )


def assert_keys(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise when a key column is missing or holds NULLs; no keys is fine."""
    _assert_present(df, keys)
    # One row per key column.
    bad = [f"{r.key} ({r.null_count})" for r in key_null_report(df, keys).collect() if r.null_count]
    if bad:
        raise NullKeyError(f"NULL key values: {', '.join(bad)}")


def cast_report(text: DataFrame, schema: T.StructType, *, legacy_cast: bool = False) -> DataFrame:
    """``(field, declared_type, present, failed)`` for every field not kept as text.

    ``text`` holds the fields as text; a failure is a value that turned NULL.
    """
    fields = [f for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    if not fields:
        return text.sparkSession.createDataFrame(
            [], "field string, declared_type string, present bigint, failed bigint"
        )
    totals = []
    for i, field in enumerate(fields):
        raw = quoted(field.name)
        lost = raw.isNotNull() & lenient_cast(raw, field.dataType, legacy_cast).isNull()
        totals += [F.count(raw).alias(f"p{i}"), F.count_if(lost).alias(f"f{i}")]
    rows = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("field"),
                F.lit(field.dataType.simpleString()).alias("declared_type"),
                F.col(f"p{i}").alias("present"),
                F.col(f"f{i}").alias("failed"),
            )
            for i, field in enumerate(fields)
        ]
    )
    return text.agg(*totals).select(F.inline(rows))


def partition_counts(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """Rows per partition; on Parquet this reads no data column."""
    return df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n"))
