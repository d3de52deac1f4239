"""Appends that can be run again: written aside, then published file by file under names of their own.

A load is written below the table's folder where no reader looks, and counts
once its note is there. Publishing moves its files, one rename each, to names
that carry the load's. Whatever breaks off, the next run either throws away what
was not written whole or moves what has not been moved yet; no row comes twice.
Readers may meet a load half published for as long as its renames take.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from .. import storage
from .tables import _described, _literal, _versioned, aligned, counts_of, has_log, observed, quote_name, spread, with_constants

#: What Spark calls the folder of a NULL partition value.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_NOTE = "_ready.json"
#: Renames that run at once.
RENAMES = 16


@dataclass(frozen=True)
class Staged:
    """A load written whole: its name, what it holds, its rows and its files."""

    name: str
    contents: tuple[str, ...]
    rows: int
    files: tuple[str, ...]


def _folder(location: str) -> str:
    return f"{location.rstrip('/')}/_staged"


def stage(
    df: DataFrame,
    table: str,
    name: str,
    contents: list[str],
    *,
    shuffle: bool = True,
    constants: Mapping[str, int] | None = None,
    also: Callable[[], None] | None = None,
) -> Staged:
    """Write rows for ``table`` aside; ``contents`` says what of, for whoever takes the load up again.

    ``constants`` are columns that ``df`` lacks, the same in all rows.
    ``also`` is done before the load counts as written, so it is done again with it.
    """
    spark = df.sparkSession
    described = _described(spark, table)
    if has_log(described["provider"]):
        raise ValueError(f"{table}: {described['provider']} appends in its own way")
    if _versioned(described):
        raise ValueError(f"{table} keeps versions: its partitions are replaced, not appended to")
    parts, folder = described.get("partition_columns", []), f"{_folder(described['location'])}/{name}"
    storage.remove(spark, folder)
    counted, out = Observation(), aligned(with_constants(df, constants), table)
    out = spread(out, parts) if shuffle else out
    writer = observed(out, counted, [F.count(F.lit(1)).alias("rows")], constants).write.format(described["provider"])
    (writer.partitionBy(*parts) if parts else writer).save(f"{folder}/files")
    seen = counts_of(counted)
    if seen is None:
        rows = spark.read.format(described["provider"]).schema(out.schema).load(f"{folder}/files").count()
    else:
        rows = seen["rows"]
    if also:
        also()
    files = [f for f in storage.files(spark, f"{folder}/files") if not f.rsplit("/", 1)[-1].startswith(("_", "."))]
    note = {"contents": contents, "rows": rows, "files": files}
    storage.write_text(spark, f"{folder}/{_NOTE}", json.dumps(note))
    return Staged(name, tuple(contents), rows, tuple(files))


def left_behind(spark: SparkSession, location: str, prefix: str = "") -> list[Staged]:
    """Loads of such names written whole but not finished; what was not written whole is removed."""
    found = []
    for name in storage.children(spark, _folder(location)):
        if not name.startswith(prefix):
            continue
        folder = f"{_folder(location)}/{name}"
        if storage.exists(spark, f"{folder}/{_NOTE}"):
            note = json.loads(storage.read_text(spark, f"{folder}/{_NOTE}"))
            found.append(Staged(name, tuple(note["contents"]), note["rows"], tuple(note["files"])))
        else:
            storage.remove(spark, folder)
    return found


def publish(spark: SparkSession, table: str, load: Staged) -> None:
    """Move the files of a staged load that have not been moved yet, and tell the catalog of all their partitions."""
    location = _described(spark, table)["location"].rstrip("/")
    base = f"{_folder(location)}/{load.name}/files"

    def place(name: str) -> str:
        return "/".join(p for p in (location, name) if p)

    def move(name: str) -> None:
        folder, _, file = name.rpartition("/")
        storage.rename_into(spark, f"{base}/{name}", place(f"{folder}/{load.name}-{file}" if folder else f"{load.name}-{file}"))

    leaves = sorted({f.rpartition("/")[0] for f in load.files} - {""})
    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(lambda leaf: storage.make(spark, place(leaf)), leaves))
        list(pool.map(move, load.files))
    for start in range(0, len(leaves), 100):
        specs = " ".join(f"PARTITION ({_partition(leaf)})" for leaf in leaves[start : start + 100])
        spark.sql(f"ALTER TABLE {quote_name(table)} ADD IF NOT EXISTS {specs}")
    spark.catalog.refreshTable(table)


def _partition(folder: str) -> str:
    pairs = (part.partition("=") for part in folder.split("/"))
    return ", ".join(
        f"{quote_name(unquote(k))} = {_literal(None if v == _NULL_PARTITION else unquote(v))}" for k, _, v in pairs
    )


def finish(spark: SparkSession, location: str, load: Staged) -> None:
    """Forget a published load; call it when its contents are marked as done."""
    storage.remove(spark, f"{_folder(location)}/{load.name}")
