"""Raw tables: create, append, replace partitions, rebuild, register, compact."""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import storage
from ..functions.columns import quoted
from ..session import adaptive, small_rows

# Makes every INSERT OVERWRITE replace only the partitions it has rows for, so
# no session-wide setting has to change while several tables load at once.
# New files wait in a staging folder until the whole job is done.
_DYNAMIC = "OPTIONS (partitionOverwriteMode 'dynamic')"


def quote_name(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_table(
    spark: SparkSession,
    name: str,
    schema: T.StructType,
    location: str,
    partitions: Sequence[str] = (),
    fmt: str = "parquet",
    database_location: str | None = None,
) -> None:
    """External table and its database, created when missing; runs no job."""
    database, _, _ = name.rpartition(".")
    if database:
        where = f" LOCATION {_literal(database_location)}" if database_location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote_name(database)}{where}")
    fields = [f for f in schema.fields if f.name not in partitions]
    fields += [schema[p] for p in partitions]
    columns = T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]).toDDL()
    by = f"PARTITIONED BY ({', '.join(quote_name(p) for p in partitions)})" if partitions else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quote_name(name)} ({columns}) USING {fmt} "
        f"{_DYNAMIC if partitions else ''} {by} LOCATION {_literal(location)}"
    )


def recover_partitions(spark: SparkSession, table: str) -> None:
    """Tell the catalog about partition folders it does not know."""
    spark.sql(f"MSCK REPAIR TABLE {quote_name(table)}")


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return _described(spark, table).get("partition_columns", [])


def _described(spark: SparkSession, table: str) -> dict:
    # Collected as it is; taking the first row would start a job.
    return json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(table)} AS JSON").collect()[0][0])


def _versioned(described: Mapping) -> bool:
    return "letterbox.version" in described.get("table_properties", {})


def provider(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["provider"]


def has_log(provider: str) -> bool:
    """Whether a format keeps a transaction log and so knows ``MERGE INTO``."""
    return provider.lower() in ("delta", "iceberg", "hudi")


def ensure_partition_overwrite(spark: SparkSession, table: str) -> None:
    """Set the option on a table made elsewhere: without it an overwrite wipes all partitions."""
    described = _described(spark, table)
    if has_log(described["provider"]):
        raise ValueError(f"{table}: {described['provider']} replaces partitions in its own way")
    found = described.get("storage_properties", {})
    mode = {k.lower(): v for k, v in found.items()}.get("partitionoverwritemode", "")
    if mode.lower() != "dynamic":
        spark.sql(
            f"ALTER TABLE {quote_name(table)} SET SERDEPROPERTIES ('partitionOverwriteMode' = 'dynamic')"
        )


def spread(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Few files per partition without one task per partition.

    Adaptive execution sizes the tasks at run time and splits a partition
    that holds most of the rows.  Without it the rows of each partition are
    dealt over an eighth of the tasks by a hash of their content, which comes
    out the same when a lost task runs again.
    """
    spark = df.sparkSession
    if adaptive(spark):
        return df.hint("rebalance", *columns)
    if not columns:
        return df
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    content = [quoted(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    return df.repartition(*columns, F.pmod(F.xxhash64(*content), F.lit(max(8, tasks // 8))))


def task_bytes(spark: SparkSession) -> int:
    """The session's advisory partition size."""
    text = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    number, unit = re.match(r"(\d+)\s*([kmgtp]?)i?b?\Z", text.strip().lower()).groups()
    return max(1, int(number) << 10 * (" kmgtp".index(unit) if unit else 0))


def dealt(df: DataFrame, column: str, size: str) -> DataFrame:
    """Rows of Parquet files brought together by ``column`` in tasks of equal size.

    ``size`` is a column with each row's bytes, which is dropped.  Lined up by
    the column, the rows are cut every ``task_bytes``: small groups share a
    task, a large one gets as many as it fills.  A row's place follows from its
    place in its file, so it is the same when a lost task runs again, and rows
    that are alike spread as others do.
    """
    spark, most, before, ahead = df.sparkSession, task_bytes(df.sparkSession), 0, []
    # One row per value of the column.
    for group in df.groupBy(column).agg(F.sum(size).alias("bytes")).sort(column).toLocalIterator():
        ahead.append({"letterbox_group": group[column], "letterbox_before": before, "letterbox_size": group.bytes})
        before += group.bytes
    groups = small_rows(spark, ahead, _GROUPS)
    at = F.pmod(F.xxhash64("_metadata.file_name", "_metadata.row_index"), F.lit(1 << 24)) / F.lit(1 << 24)
    placed = df.withColumn("letterbox_at", at).join(
        F.broadcast(groups), F.col(column).eqNullSafe(F.col("letterbox_group")), "left"
    )
    start, own = F.coalesce("letterbox_before", F.lit(0)), F.coalesce("letterbox_size", F.lit(0))
    task = F.floor((start + F.col("letterbox_at") * own) / F.lit(most)).cast("int")
    return placed.repartitionById(1 + before // most, task).select(*[quoted(c) for c in df.columns if c != size])


_GROUPS = pa.schema(
    {"letterbox_group": pa.string(), "letterbox_before": pa.int64(), "letterbox_size": pa.int64()}
)


def _hashable(dtype: T.DataType) -> bool:
    return "map" not in dtype.simpleString() and "variant" not in dtype.simpleString()


def aligned(df: DataFrame, table: str) -> DataFrame:
    """Columns in table order, as inserts go by position."""
    wanted = df.sparkSession.table(table).columns
    have = {name.lower(): name for name in df.columns}
    missing = [name for name in wanted if name.lower() not in have]
    extra = sorted(set(have) - {name.lower() for name in wanted})
    if missing or extra:
        raise ValueError(f"columns of {table} differ: missing {missing}, unknown {extra}")
    return df.select([quoted(have[name.lower()]) for name in wanted])


def counts_of(counted: Observation, seconds: float = 60) -> dict | None:
    """What an observation saw, or nothing when its event got lost.

    Spark delivers it over a queue that may drop events on a very busy driver,
    and delivers an empty row for a plan that came out empty.
    """
    until = time.monotonic() + seconds
    while True:
        row = counted._jo.getRowOrEmpty()
        if row.isDefined():
            return counted.get if row.get().size() else None
        if time.monotonic() > until:
            return None
        time.sleep(0.02)


def with_constants(df: DataFrame, constants: Mapping[str, int] | None) -> DataFrame:
    return df.withColumns({name: F.lit(value).cast("int") for name, value in (constants or {}).items()})


def observed(
    out: DataFrame, counted: Observation, seen: Sequence[Column], constants: Mapping[str, int] | None = None
) -> DataFrame:
    """Rows to be written, counted on the way.

    A write by partition sorts its rows by it in memory, as many as a task reads,
    unless the plan ends in constants.  They are named once more above the count,
    which hides those below it.
    """
    rows = out.observe(counted, *seen)
    if not constants:
        return rows
    again = {name: F.lit(value).cast(out.schema[name].dataType).alias(name) for name, value in constants.items()}
    return rows.select([again[c] if c in again else quoted(c) for c in rows.columns])


def save(
    df: DataFrame,
    table: str,
    mode: str,
    metrics: Mapping[str, Column] | None = None,
    *,
    shuffle: bool = True,
    constants: Mapping[str, int] | None = None,
) -> dict:
    """Insert into an existing table; returns what was counted on the way.

    ``append`` adds rows, ``overwrite`` replaces the partitions present in
    ``df`` (the whole table when it has none).  Rows are first brought together
    by partition, unless ``shuffle`` is off.  ``constants`` are columns that ``df``
    lacks, the same in all rows (see ``observed``).  A table that keeps versions
    (see ``versions``) gets a new one and takes no appends.  The counts are taken in the
    writing stage, where each task counts once however often it is retried;
    should they get lost, the same rows are counted by a job of their own.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    spark = df.sparkSession
    described = _described(spark, table)
    parts = described.get("partition_columns", [])
    if _versioned(described):
        if mode == "append":
            raise ValueError(f"{table} keeps versions: its partitions are replaced, not appended to")
        from .versions import replace  # which builds on this module

        return replace(df, table, metrics=metrics, shuffle=shuffle, constants=constants)
    if parts and mode == "overwrite":
        ensure_partition_overwrite(spark, table)
    counted = Observation()
    out = aligned(with_constants(df, constants), table)
    if shuffle:
        out = spread(out, parts)
    seen = [F.count(F.lit(1)).alias("rows"), *[column.alias(name) for name, column in (metrics or {}).items()]]
    observed(out, counted, seen, constants).write.insertInto(table, overwrite=mode == "overwrite")
    counts = counts_of(counted)
    return out.agg(*seen).first().asDict() if counts is None else counts


def save_day(
    df: DataFrame, table: str, day: Mapping[str, int], mode: str, *, shuffle: bool = False
) -> int:
    """``save`` for one constant partition, which is emptied when ``df`` is empty.

    With a single partition to write there is nothing to bring together, so
    rows go straight from the tasks that read them to files, and columns of
    ``day`` that ``df`` lacks are added without a sort.  ``shuffle`` is
    for tasks left with few rows each, as after a narrow filter.
    """
    have = {name.lower() for name in df.columns}
    constants = {name: value for name, value in day.items() if name.lower() not in have}
    rows = save(df, table, mode, shuffle=shuffle, constants=constants)["rows"]
    if mode == "overwrite" and rows == 0:
        clear_partition(df.sparkSession, table, day)
    return rows


def clear_partition(spark: SparkSession, table: str, values: Mapping[str, object]) -> None:
    """Remove the rows of one partition."""
    if _versioned(_described(spark, table)):
        from .versions import empty_partition  # which builds on this module

        return empty_partition(spark, table, values)
    data = T.StructType([f for f in spark.table(table).schema.fields if f.name not in values])
    spec = ", ".join(f"{quote_name(k)} = {_literal(v)}" for k, v in values.items())
    spark.sql(
        f"INSERT OVERWRITE TABLE {quote_name(table)} PARTITION ({spec}) SELECT * FROM {{none}}",
        none=spark.createDataFrame([], data),
    )


def rebuild(
    df: DataFrame, table: str, location: str, partitions: Sequence[str] = (), fmt: str = "parquet"
) -> None:
    """Write the table anew from ``df`` and put it in the old one's place, old partitions included.

    The new files are complete before the old ones are touched, and those go
    last: a build that fails leaves the table as it was. A table that keeps
    versions gets one with other partitions and the same columns.
    """
    spark, run = df.sparkSession, uuid.uuid4().hex
    if spark.catalog.tableExists(table) and _versioned(_described(spark, table)):
        from .versions import replace  # which builds on this module

        replace(df, table, whole=True)
        return
    location = location.rstrip("/")
    fresh, old = f"{location}-new-{run}", f"{location}-old-{run}"
    writer = spread(df, partitions).write.format(fmt)
    if partitions:
        writer = writer.partitionBy(*partitions)
    try:
        writer.save(fresh)
    except Exception:
        storage.remove(spark, fresh)
        raise
    drop_table(spark, table)
    if storage.exists(spark, location):
        storage.rename(spark, location, old)
    storage.rename(spark, fresh, location)
    create_table(spark, table, df.schema, location, partitions, fmt)
    if partitions:
        recover_partitions(spark, table)
    spark.catalog.refreshByPath(location)
    storage.remove(spark, old)


def drop_table(spark: SparkSession, table: str) -> None:
    """Forget an external table; its files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(table)}")


def register_partitioned(
    spark: SparkSession,
    table: str,
    location: str,
    partitions: Mapping[str, str],
    fmt: str = "parquet",
    database_location: str | None = None,
) -> None:
    """Catalog table over existing partitioned files, partition types as given.

    Partition types must be declared: left to inference, ``month=01`` would
    come back as the number 1.
    """
    if fmt == "delta":
        by = ", ".join(f"{quote_name(k)} {v}" for k, v in partitions.items())
        spark.sql(f"CONVERT TO DELTA parquet.`{location}` PARTITIONED BY ({by})")
        drop_table(spark, table)
        spark.sql(f"CREATE TABLE {quote_name(table)} USING DELTA LOCATION {_literal(location)}")
        return
    # Columns that only some partitions have are part of the table.
    found = spark.read.format(fmt).option("mergeSchema", True).load(location).drop(*partitions)
    schema = T.StructType(
        found.schema.fields
        + [T.StructField(k, T.DataType.fromDDL(v)) for k, v in partitions.items()]
    )
    drop_table(spark, table)
    create_table(spark, table, schema, location, list(partitions), fmt, database_location)
    if partitions:
        recover_partitions(spark, table)


def file_counts(spark: SparkSession, table: str, where: Column | str | None = None) -> DataFrame:
    """Files and bytes of each partition: ``partition``, the partition columns, ``files``, ``bytes``."""
    parts = partition_columns(spark, table)
    if not parts:
        raise ValueError(f"{table} has no partitions")
    files = of_partitions(spark, table, parts, where).select(*parts, "_metadata.file_path", "_metadata.file_size").distinct()
    return (
        files.groupBy(*parts)
        .agg(F.count(F.lit(1)).alias("files"), F.sum("file_size").alias("bytes"))
        .withColumn("partition", partition_id(parts))
    )


def of_partitions(spark: SparkSession, table: str, parts: Sequence[str], where: Column | str | None) -> DataFrame:
    """The table's rows in partitions that fulfil a condition, which may name no other column."""
    chosen = spark.table(table)
    if where is None:
        return chosen
    condition = F.expr(where) if isinstance(where, str) else where
    # Fails here when the condition names anything but partition columns.
    values = T.StructType([f for f in chosen.schema.fields if f.name in parts])
    spark.createDataFrame([], values).filter(condition)
    return chosen.filter(condition)


def partition_id(partitions: Sequence[str]) -> Column:
    """Partition values as one text, NULL kept apart from every value."""
    values = [F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("-")) for p in partitions]
    return F.concat_ws("/", *values)


def compact(
    spark: SparkSession, table: str, where: Column | str | None = None, target_bytes: int = 128 << 20
) -> list[str]:
    """Pack small files into files of about ``target_bytes``; returns the partitions they lay in.

    See ``compaction``. ``where`` may only name partition columns.
    """
    from .compaction import pack  # which builds on this module

    if _versioned(_described(spark, table)):
        raise ValueError(f"{table} keeps versions, whose files must stay as they are")

    return pack(spark, table, where, target_bytes)
