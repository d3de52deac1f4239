"""Versions of a table's schema: grown in the catalog, kept beside the files.

The log lies under the table's folder, where no reader looks. A version is
written before the catalog changes, so a change that breaks off is made good by
the next load, also when the catalog has lost the table.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T

from .. import storage
from ..operators.evolution import SchemaConflict, changes, evolved
from ..session import small_rows
from . import versions
from .tables import _described, _literal, create_table, drop_table, quote_name

#: Table property that names the version in the catalog.
VERSION = "letterbox.schema.version"
#: Formats whose readers take files of the narrower type.
WIDENING = ("parquet", "json")

_HISTORY = pa.schema(
    {
        "version": pa.int64(),
        "since": pa.timestamp("us", "UTC"),
        "added": pa.list_(pa.string()),
        "widened": pa.list_(pa.string()),
        "columns": pa.string(),
    }
)


def _folder(location: str) -> str:
    return f"{location.rstrip('/')}/_schema"


def _versions(spark: SparkSession, location: str) -> list[int]:
    names = storage.children(spark, _folder(location))
    return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())


def _entry(spark: SparkSession, location: str, version: int) -> dict:
    return json.loads(storage.read_text(spark, f"{_folder(location)}/{version:06d}.json"))


def newest_schema(spark: SparkSession, location: str) -> T.StructType | None:
    """Columns without partitions of the newest version, or nothing where none was kept."""
    versions = _versions(spark, location)
    return T.StructType.fromJson(_entry(spark, location, versions[-1])["schema"]) if versions else None


def _record(spark: SparkSession, location: str, old: T.StructType | None, schema: T.StructType) -> int:
    version = (_versions(spark, location) or [0])[-1] + 1
    added, widened = changes(old, schema) if old is not None else ([], [])
    entry = {
        "schema": schema.jsonValue(),
        "since": datetime.now(timezone.utc).isoformat(),
        "added": added,
        "widened": widened,
    }
    storage.write_text(spark, f"{_folder(location)}/{version:06d}.json", json.dumps(entry))
    return version


def table_location(spark: SparkSession, table: str) -> str:
    return _described(spark, table)["location"]


def _data(schema: T.StructType, partitions: list[str]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in partitions])


def evolve_table(spark: SparkSession, table: str, sent: T.StructType) -> int | None:
    """Let a table take in rows of ``sent``; returns its new version, or nothing if it stays.

    New columns are added; a wider type replaces the table's entry in the
    catalog, never its files: old rows are read as they lie, with NULL in new
    columns. A field that would have to narrow raises and nothing changes.
    """
    described = _described(spark, table)
    location, parts = described["location"], described.get("partition_columns", [])
    stored = _data(spark.table(table).schema, parts)
    kept = newest_schema(spark, location)
    # After a change that broke off the log is ahead of the catalog.
    base = stored if kept is None else evolved(stored, kept)
    grown = evolved(base, _data(sent, parts))
    if grown.simpleString() == stored.simpleString():
        return None
    added, widened = changes(stored, grown)
    if widened and described["provider"].lower() not in WIDENING:
        raise SchemaConflict(f"{described['provider']} files can't be read with wider types: {', '.join(widened)}")
    if kept is None:
        _record(spark, location, None, stored)
    if kept is None or grown.simpleString() != kept.simpleString():
        _record(spark, location, base, grown)
    version = _versions(spark, location)[-1]
    if widened:
        _replace_entry(spark, table, described, grown, spark.table(table).schema)
    else:
        new = T.StructType([f for f in grown.fields if f.name in added])
        spark.sql(f"ALTER TABLE {quote_name(table)} ADD COLUMNS ({new.toDDL()})")
    spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ({_literal(VERSION)} = '{version}')")
    spark.catalog.refreshTable(table)
    return version


def _replace_entry(spark: SparkSession, table: str, described: dict, grown: T.StructType, before: T.StructType) -> None:
    parts = described.get("partition_columns", [])
    schema = T.StructType(grown.fields + [before[p] for p in parts])
    kept = {k: v for k, v in described.get("table_properties", {}).items() if k not in (VERSION, versions.SHOWN)}
    drop_table(spark, table)
    create_table(spark, table, schema, described["location"], parts, described["provider"])
    if kept:
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in kept.items())
        spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ({pairs})")
    if parts and storage.exists(spark, described["location"]):
        versions.recover(spark, table)


def schema_history(spark: SparkSession, location: str) -> DataFrame:
    """``version``, ``since``, ``added``, ``widened``, ``columns`` of a table's folder, one row per version."""
    rows = []
    for version in _versions(spark, location):
        entry = _entry(spark, location, version)
        rows.append(
            {
                "version": version,
                "since": datetime.fromisoformat(entry["since"]),
                "added": entry["added"],
                "widened": entry["widened"],
                "columns": T.StructType.fromJson(entry["schema"]).toDDL(),
            }
        )
    return small_rows(spark, rows, _HISTORY)
