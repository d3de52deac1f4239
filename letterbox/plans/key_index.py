"""Which files of a table may hold a key: the smallest and largest key of each file, kept beside the table.

A merge needs to know where stored rows of its keys lie. Without an index it
scans the keys of the whole table; with one, only of the files whose range a
sent key falls into, which are few when keys grow with time. Files are never
changed, only added and removed: a refresh reads the keys of files not known yet
and forgets those that are gone. A lost or half-written index costs a scan.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import storage
from ..functions.columns import quoted
from ..sinks.tables import _described

#: Disjoint ranges that the sent keys are cut into; the files are compared with so many.
RANGES = 1000
#: More candidate files than this are not worth naming in a filter: the whole table is scanned.
MOST_FILES = 10_000

FILE = "_metadata.file_path"


def _folder(spark: SparkSession, table: str, keys: Sequence[str]) -> str:
    plain = "-".join(re.sub(r"\W", "_", k) for k in keys)
    return f"{_described(spark, table)['location'].rstrip('/')}/_keys/{plain}"


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Versions of the index that were written whole, oldest first."""
    names = [n.removeprefix("v") for n in storage.children(spark, folder) if n.startswith("v")]
    return sorted(int(n) for n in names if n.isdigit() and storage.exists(spark, f"{folder}/v{n}/_SUCCESS"))


def _listed(target: DataFrame) -> list[str]:
    """The table's files, one name per file, as their metadata column has them: without an empty authority."""
    return [re.sub(r"^([a-z][\w+.-]*):///", r"\1:/", f) for f in target.inputFiles()]


def refresh_index(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame | None:
    """``file``, ``low``, ``high`` of each file the table has now; reads the keys of new files only.

    Nothing where the file system lists its files under other names than their rows tell.
    """
    target, folder = spark.table(table), _folder(spark, table, keys)
    versions = _versions(spark, folder)
    key = F.struct(*[quoted(k) for k in keys])
    ranges = target.groupBy(F.col(FILE).alias("file")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    now = _listed(target)
    listed = spark.createDataFrame([(f,) for f in now], "file string")
    kept, new = None, now
    if versions:
        known = spark.read.schema(ranges.schema).parquet(f"{folder}/v{versions[-1]}")
        kept = known.join(listed, "file", "left_semi")
        new = [r.file for r in listed.join(known, "file", "left_anti").collect()]
        if not new and kept.count() == known.count():
            return known
    if kept is None or len(new) > MOST_FILES:
        entries = ranges
    else:
        # The filter prunes the listing: other files are not opened.
        added = target.filter(F.col(FILE).isin(new)).groupBy(F.col(FILE).alias("file"))
        entries = kept.unionByName(added.agg(F.min(key).alias("low"), F.max(key).alias("high")))
    version = (versions[-1] if versions else 0) + 1
    path = f"{folder}/v{version}"
    entries.coalesce(1 + len(now) // 100_000).write.mode("overwrite").parquet(path)
    for old in versions:
        storage.remove(spark, f"{folder}/v{old}")
    written = spark.read.schema(ranges.schema).parquet(path)
    if written.join(listed, "file", "left_anti").isEmpty():
        return written
    storage.remove(spark, path)
    return None


def candidate_files(spark: SparkSession, table: str, keys: Sequence[str], sent: DataFrame) -> list[str]:
    """The files that may hold a key of ``sent``: those whose range meets one of the ranges of the sent keys."""
    index = refresh_index(spark, table, keys)
    if index is None:
        return _listed(spark.table(table))
    key = F.struct(*[quoted(k) for k in keys])
    columns = [quoted(k) for k in keys]
    ranges = (
        sent.select(*columns)
        .repartitionByRange(RANGES, *columns)
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min(key).alias("first"), F.max(key).alias("last"))
    )
    # As many rows as there are ranges, whatever was sent.
    meets = (F.col("low") <= F.col("last")) & (F.col("high") >= F.col("first"))
    return [r.file for r in index.join(F.broadcast(ranges), meets, "left_semi").select("file").collect()]


def searched_rows(spark: SparkSession, table: str, keys: Sequence[str], sent: DataFrame) -> DataFrame:
    """The rows of the table's files that may hold a key of ``sent``."""
    target = spark.table(table)
    files = candidate_files(spark, table, keys, sent)
    if len(files) > MOST_FILES or set(files) == set(_listed(target)):
        return target
    return target.filter(F.col(FILE).isin(files)) if files else target.filter(F.lit(False))
