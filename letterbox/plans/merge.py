"""Upsert by key on tables without a transaction log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import storage
from ..functions.columns import quoted
from ..operators.quality import assert_keys
from ..session import new_folder
from ..sinks.tables import (
    aligned,
    clear_partition,
    has_log,
    partition_columns,
    partition_id,
    provider,
    quote_name,
    save,
)
from .key_index import searched_rows


def latest(df: DataFrame, keys: Sequence[str], recency: Sequence[str] = ()) -> DataFrame:
    """One row per key: the most recent, ties broken by the row itself.

    A maximum rather than a window, so every task first reduces its own rows
    and a key with most of the rows never meets in one sort.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    ordered = [c for c in rest if _orderable(df.schema[c].dataType)]
    order = [*recency, *[c for c in ordered if c not in recency]]
    if len(ordered) == len(rest):
        # The row orders itself: one struct does for both.
        row = F.max(F.struct(*[quoted(c) for c in order])).alias("row")
    else:
        row = F.max_by(F.struct(*[quoted(c) for c in rest]), F.struct(*[quoted(c) for c in order])).alias("row")
    return df.groupBy(*[quoted(k) for k in keys]).agg(row).select(
        *[quoted(c) if c in keys else F.col("row").getField(c).alias(c) for c in df.columns]
    )


def _orderable(dtype: T.DataType) -> bool:
    text = dtype.simpleString()
    return "map" not in text and "variant" not in text


def merge_statement(table: str, keys: Sequence[str], recency: Sequence[str] = ()) -> str:
    """The same upsert as one statement, for formats with a transaction log."""

    def row(alias: str) -> str:
        return "struct(" + ", ".join(f"{alias}.{quote_name(c)}" for c in recency) + ")"

    same = " AND ".join(f"t.{quote_name(k)} = s.{quote_name(k)}" for k in keys)
    unless = f" AND NOT {row('t')} > {row('s')}" if recency else ""
    return (
        f"MERGE INTO {quote_name(table)} t USING {{updates}} s ON {same} "
        f"WHEN MATCHED{unless} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def upsert(
    spark: SparkSession,
    updates: DataFrame,
    table: str,
    keys: Sequence[str],
    *,
    recency: Sequence[str] = (),
    fixed_partition: bool = False,
    index: bool = False,
) -> int | None:
    """Insert ``updates`` into ``table``, replacing rows of the same key.

    With ``recency`` a stored row that is strictly newer stays.  Only the
    partitions holding a touched key, before or after, are rewritten.  They
    are found by one scan of the table's keys; ``fixed_partition`` (a key never
    changes partition) narrows it to the partitions of the updates, or spares
    it when there is no ``recency``, and ``index`` to the files whose range of
    keys meets the updates' (see ``key_index``).  Join sides are broadcast by Spark only
    below its size threshold.  Returns the rows written, or nothing where the
    format's own statement did it.
    """
    if not keys:
        raise ValueError(f"{table}: no keys to merge by")
    if has_log(provider(spark, table)):
        source = latest(aligned(updates, table), keys, recency)
        assert_keys(source.select(*[quoted(k) for k in keys]), keys)
        spark.sql(merge_statement(table, keys, recency), updates=source)
        return None
    stage = new_folder(spark, "upsert")
    try:
        return _upsert(spark, updates, table, keys, recency, fixed_partition, index, stage)
    finally:
        storage.remove(spark, stage)


def _upsert(
    spark: SparkSession,
    updates: DataFrame,
    table: str,
    keys: Sequence[str],
    recency: Sequence[str],
    fixed_partition: bool,
    index: bool,
    stage: str,
) -> int:
    parts = partition_columns(spark, table)
    target = spark.table(table)
    key_columns = [quoted(k) for k in keys]
    incoming = _staged(latest(aligned(updates, table), keys, recency), f"{stage}/incoming")
    assert_keys(incoming.select(*key_columns), keys)

    def places(df: DataFrame) -> list:
        """The partitions in ``df``: one row per partition of the table at most."""
        return df.select(*parts).distinct().withColumn("id", partition_id(parts)).collect()

    affected = {row.id: row for row in places(incoming)} if parts else {}
    searched = target
    if index and (recency or (parts and not fixed_partition)):
        searched = searched_rows(spark, table, keys, incoming)
    if parts and fixed_partition:
        searched = searched.filter(partition_id(parts).isin(list(affected)))
    outdated = None
    if recency:
        order = F.struct(*[quoted(c) for c in recency])
        stored = searched.select(*key_columns, order.alias("stored_at"), *parts)
        sent = incoming.select(*key_columns, order.alias("sent_at"))
        matched = stored.join(sent, list(keys)).withColumn("newer", F.col("stored_at") > F.col("sent_at"))
        # Read twice: for the winners and for the places of the losers.
        matched = _staged(matched.drop("stored_at", "sent_at"), f"{stage}/places")
        outdated = matched.filter("newer").select(*key_columns)
        incoming = _staged(incoming.join(outdated, list(keys), "left_anti"), f"{stage}/winners")
        if parts:
            affected = {row.id: row for row in places(incoming)}
    if parts and not fixed_partition:
        moved = (
            matched.filter(~F.col("newer"))
            if recency
            else searched.select(*key_columns, *parts).join(incoming.select(*key_columns), list(keys), "left_semi")
        )
        affected |= {row.id: row for row in places(moved)}
    kept = target.join(incoming.select(*key_columns), list(keys), "left_anti")

    if not parts:
        merged = _staged(kept.select(target.columns).unionByName(incoming), f"{stage}/merged")
        return save(merged, table, "overwrite")["rows"]
    if not affected:
        return 0
    # Reading the table while replacing its partitions is safe here: dynamic
    # overwrite keeps new files aside until the job has finished.  Merging
    # again would give the same rows.
    kept = kept.filter(partition_id(parts).isin(list(affected)))
    merged = kept.select(target.columns).unionByName(incoming.select(target.columns))
    counts = save(merged, table, "overwrite", {"written": F.collect_set(partition_id(parts))})
    for name, row in affected.items():
        if name not in counts["written"]:
            clear_partition(spark, table, {p: row[p] for p in parts})
    return counts["rows"]


def _staged(df: DataFrame, path: str) -> DataFrame:
    """Written once and read back, so later steps neither recompute nor lose it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
