"""Compaction by bin packing: small files of a partition are put together, good ones stay as they are.

Files under half the wanted size are packed first-fit, largest first; only those
that share a bin are read, and each bin becomes a file. New files are written
aside with a note of the old ones, then moved in, then the old ones go. A run
that breaks off in between is ended by the next one; until then readers may meet
rows twice, as they may for as long as moving and removing takes. Nothing else
may write to the partitions meanwhile. The driver holds a name per small file.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import storage
from ..functions.columns import quoted
from .staged import RENAMES, Staged, finish, left_behind, publish, stage
from .tables import _described, has_log, of_partitions, partition_id

#: Loads that compaction stages are named so.
PREFIX = "compact-"
#: Files named in one filter; more are packed in several rounds.
ROUND_FILES = 5000
_FILE, _BIN = "letterbox_file", "letterbox_bin"


def first_fit(sizes: list[tuple[str, int]], capacity: int) -> list[list[str]]:
    """Bins of at most ``capacity``, each file in the first with room, largest first; bins of one file are left out."""
    bins: list[tuple[int, list[str]]] = []
    for name, size in sorted(sizes, key=lambda f: (-f[1], f[0])):
        for i, (used, names) in enumerate(bins):
            if used + size <= capacity:
                bins[i] = (used + size, [*names, name])
                break
        else:
            bins.append((size, [name]))
    return [names for _, names in bins if len(names) > 1]


def pack(spark: SparkSession, table: str, where: Column | str | None, target_bytes: int) -> list[str]:
    """Pack the small files of the chosen partitions; returns those in which files changed."""
    described = _described(spark, table)
    if has_log(described["provider"]):
        raise ValueError(f"{table}: {described['provider']} compacts in its own way")
    location, parts = described["location"], described.get("partition_columns", [])
    for load in left_behind(spark, location, PREFIX):
        _swap(spark, table, location, load)
    chosen = of_partitions(spark, table, parts, where)
    name = partition_id(parts) if parts else F.lit("")
    files = (
        chosen.select(name.alias("partition"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"))
        .distinct()
        .filter(F.col("size") < target_bytes / 2)
    )
    small = defaultdict(list)
    for row in files.toLocalIterator():
        small[row.partition].append((row.file, row.size))
    bins = {p: first_fit(found, target_bytes) for p, found in small.items()}
    round_: list[list[str]] = []
    for found in bins.values():
        for names in found:
            if round_ and sum(map(len, round_)) + len(names) > ROUND_FILES:
                _write(spark, table, location, round_)
                round_ = []
            round_.append(names)
    if round_:
        _write(spark, table, location, round_)
    return sorted(p for p, found in bins.items() if found)


def _write(spark: SparkSession, table: str, location: str, bins: list[list[str]]) -> None:
    names = [(name, i) for i, found in enumerate(bins) for name in found]
    rows = spark.table(table)
    columns = rows.columns
    # The filter keeps other files from being opened; a bin is a task, so it becomes one file.
    rows = rows.filter(F.col("_metadata.file_path").isin([n for n, _ in names]))
    rows = rows.select(*[quoted(c) for c in columns], F.col("_metadata.file_path").alias(_FILE))
    where = spark.createDataFrame(names, f"{_FILE} string, {_BIN} int")
    dealt: DataFrame = rows.join(where, _FILE).repartitionById(len(bins), F.col(_BIN))
    load = stage(dealt.select([quoted(c) for c in columns]), table, PREFIX + uuid.uuid4().hex, [n for n, _ in names], shuffle=False)
    _swap(spark, table, location, load)


def _swap(spark: SparkSession, table: str, location: str, load: Staged) -> None:
    publish(spark, table, load)
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(lambda name: storage.remove_file(spark, name), load.contents))
    spark.catalog.refreshTable(table)
    finish(spark, location, load)
