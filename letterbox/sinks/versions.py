"""Tables whose partitions are replaced by a switch in the catalog, and can be read as of any version kept.

A replacement writes its rows to a folder of its own, then a note that says
where every partition of the table lies now, and then points the catalog there.
No file is moved. Broken off before the note, it has left a folder that nobody
reads, and ``clean`` removes it; broken off after it, the next replacement,
refresh or ``settle`` finishes the switch. A catalog that lost the table gets
its partitions back from the newest note.

Readers meet each partition whole, the old or the new one, though not all
partitions at one instant; ``as_of`` reads all of one version. A note holds one
entry per partition, as the catalog does. One writer at a time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Collection, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from .. import storage
from ..functions.columns import quoted
from ..session import small_rows
from .staged import _NULL_PARTITION, _partition
from .tables import (
    _described,
    _literal,
    _versioned,
    aligned,
    counts_of,
    has_log,
    observed,
    quote_name,
    recover_partitions,
    spread,
    with_constants,
)

#: Table properties: the version that the catalog shows, and the folder of a table without partitions.
SHOWN = "letterbox.version"
ROOT = "letterbox.root"
#: Catalog calls that run at once.
CALLS = 16

_HISTORY = pa.schema(
    {
        "version": pa.int64(),
        "since": pa.timestamp("us", "UTC"),
        "rows": pa.int64(),
        "replaced": pa.list_(pa.string()),
        "partitions": pa.int64(),
    }
)


@dataclass(frozen=True)
class Version:
    """Where each partition lies, by its folder name, within the table's folder; a table without has one named ''."""

    number: int
    since: str
    rows: int | None
    schema: dict
    places: dict[str, str]
    replaced: list[str]
    sources: dict[str, int] = field(default_factory=dict)


def _root(described: Mapping) -> str:
    return described.get("table_properties", {}).get(ROOT, described["location"]).rstrip("/")


def _notes(root: str) -> str:
    return f"{root}/_versions"


def numbers(spark: SparkSession, root: str) -> list[int]:
    """The versions noted below a table's folder, oldest first."""
    names = (n.removesuffix(".json") for n in storage.children(spark, _notes(root)) if n.endswith(".json"))
    return sorted(int(n) for n in names if n.isdigit())


def _read(spark: SparkSession, root: str, number: int) -> Version:
    return Version(**json.loads(storage.read_text(spark, f"{_notes(root)}/{number:06d}.json")))


def _write(spark: SparkSession, root: str, version: Version) -> None:
    path = f"{_notes(root)}/{version.number:06d}.json"
    if storage.exists(spark, path):
        raise RuntimeError(f"{path} is there already: another writer was faster")
    storage.make(spark, _notes(root))
    storage.write_text(spark, path, json.dumps(asdict(version)))


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def keeps_versions(spark: SparkSession, table: str) -> bool:
    return _versioned(_described(spark, table))


def enable(spark: SparkSession, table: str) -> int:
    """Let a table keep versions from now on; what it holds is the first. Its partitions must lie in its own folder."""
    described = _described(spark, table)
    if has_log(described["provider"]):
        raise ValueError(f"{table}: {described['provider']} keeps versions of its own")
    if _versioned(described):
        return int(described["table_properties"][SHOWN])
    root = described["location"].rstrip("/")
    if described.get("partition_columns"):
        # One row per partition of the catalog.
        found = [row[0] for row in spark.sql(f"SHOW PARTITIONS {quote_name(table)}").collect()]
        places = {name: name for name in found}
    else:
        places = {"": ""}
    if not numbers(spark, root):
        _write(spark, root, Version(1, _now(), None, spark.table(table).schema.jsonValue(), places, sorted(places)))
    _show(spark, table, {ROOT: root, SHOWN: "1"})
    settle(spark, table)
    return numbers(spark, root)[-1]


def _show(spark: SparkSession, table: str, properties: Mapping[str, str]) -> None:
    pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {quote_name(table)} SET TBLPROPERTIES ({pairs})")


def settle(spark: SparkSession, table: str) -> Version:
    """Point the catalog at the newest version, if a switch broke off; returns that version."""
    described = _described(spark, table)
    root, shown = _root(described), int(described["table_properties"][SHOWN])
    known = numbers(spark, root)
    newest = _read(spark, root, known[-1])
    if shown != newest.number:
        # What the catalog shows may be of several versions after a switch cut short.
        before = _read(spark, root, shown).places if shown in known else None
        _switch(spark, table, root, before, newest.places)
        _show(spark, table, {SHOWN: str(newest.number)})
        spark.catalog.refreshTable(table)
    return newest


def _switch(spark: SparkSession, table: str, root: str, before: dict[str, str] | None, places: dict[str, str]) -> None:
    name = quote_name(table)
    where = lambda place: _literal(f"{root}/{place}".rstrip("/"))
    if "" in places:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {where(places[''])}")
        return
    if before is None:
        before = {row[0]: "" for row in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    moved = sorted(p for p, place in places.items() if before.get(p) != place)
    for at in range(0, len(moved), 100):
        added = " ".join(f"PARTITION ({_partition(p)}) LOCATION {where(places[p])}" for p in moved[at : at + 100])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {added}")
    # Added ones too: a switch cut short, or an older version, may have left them elsewhere.
    with ThreadPoolExecutor(CALLS) as pool:
        list(
            pool.map(
                lambda p: spark.sql(f"ALTER TABLE {name} PARTITION ({_partition(p)}) SET LOCATION {where(places[p])}"),
                moved,
            )
        )
    gone = sorted(before.keys() - places.keys())
    for at in range(0, len(gone), 100):
        dropped = ", ".join(f"PARTITION ({_partition(p)})" for p in gone[at : at + 100])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {dropped}")


def recover(spark: SparkSession, table: str) -> None:
    """Partitions of a table that the catalog has just been told of: by its newest version, or by its folders."""
    described = _described(spark, table)
    root = _root(described)
    if numbers(spark, root):
        _show(spark, table, {ROOT: root, SHOWN: "0"})
        settle(spark, table)
    elif described.get("partition_columns") and storage.exists(spark, root):
        recover_partitions(spark, table)


def replace(
    df: DataFrame,
    table: str,
    *,
    whole: bool = False,
    emptied: Collection[str] = (),
    within: Callable[[str], bool] | None = None,
    metrics: Mapping[str, Column] | None = None,
    shuffle: bool = True,
    sources: Mapping[str, int] | None = None,
    constants: Mapping[str, int] | None = None,
) -> dict:
    """A new version with the partitions in ``df`` replaced; returns what was counted on the way.

    ``whole`` replaces all partitions and ``emptied`` those named, also by no
    rows. Rows of a partition that ``within`` refuses fail the replacement.
    ``sources`` are kept with the version. ``constants`` are columns ``df`` lacks,
    the same in all rows. ``df`` may read the table itself.
    """
    spark = df.sparkSession
    current = settle(spark, table)
    described = _described(spark, table)
    root, parts = _root(described), described.get("partition_columns", [])
    number = current.number + 1
    folder = f"_versions/{number:06d}-{uuid.uuid4().hex[:12]}"
    counted, out = Observation(), aligned(with_constants(df, constants), table)
    schema = spark.table(table).schema
    out = spread(out, parts) if shuffle else out
    seen = [F.count(F.lit(1)).alias("rows"), *[column.alias(name) for name, column in (metrics or {}).items()]]
    # Inserts cast to the table's types; files written here have to as well.
    typed = out.select([quoted(c).cast(f.dataType).alias(f.name) for c, f in zip(out.columns, schema.fields)])
    fixed = {f.name: constants[c] for c, f in zip(out.columns, schema.fields) if c in (constants or {})}
    writer = observed(typed, counted, seen, fixed).write.format(described["provider"])
    (writer.partitionBy(*parts) if parts else writer).save(f"{root}/{folder}")
    counts = counts_of(counted)
    if counts is None:
        counts = spark.read.format(described["provider"]).schema(schema).load(f"{root}/{folder}").agg(*seen).first().asDict()
    if parts:
        files = [f.rpartition("/") for f in storage.files(spark, f"{root}/{folder}")]
        found = sorted({leaf for leaf, _, file in files if leaf and not file.startswith(("_", "."))})
        stray = [leaf for leaf in found if within and not within(leaf)]
        if stray:
            storage.remove(spark, f"{root}/{folder}")
            raise ValueError(f"{table}: rows for partitions that were not to be replaced: {', '.join(stray[:5])}")
    else:
        found = [""]
    kept = {} if whole or not parts else {p: place for p, place in current.places.items() if p not in set(emptied)}
    places = kept | {p: f"{folder}/{p}".rstrip("/") for p in found}
    changed = sorted(p for p in current.places.keys() | places.keys() if current.places.get(p) != places.get(p))
    note = Version(number, _now(), counts["rows"], schema.jsonValue(), places, changed, dict(sources or current.sources))
    _write(spark, root, note)
    settle(spark, table)
    return counts


def empty_partition(spark: SparkSession, table: str, values: Mapping[str, object]) -> None:
    """A new version without the rows of one partition."""
    wanted = {k: None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for k, v in values.items()}
    gone = [p for p in settle(spark, table).places if partition_values(p) == wanted]
    if gone:
        none = spark.createDataFrame([], spark.table(table).schema)
        replace(none, table, emptied=gone, shuffle=False)


def partition_values(folder: str) -> dict[str, str | None]:
    """What a partition's folder name says, as text."""
    pairs = (piece.partition("=") for piece in folder.split("/") if piece)
    return {unquote(k): None if v == _NULL_PARTITION else unquote(v) for k, _, v in pairs}


def version(spark: SparkSession, table: str, number: int | None = None) -> Version:
    """One version, or the newest."""
    described = _described(spark, table)
    if not _versioned(described):
        raise LookupError(f"{table} keeps no versions")
    root = _root(described)
    known = numbers(spark, root)
    if number is not None and number not in known:
        raise LookupError(f"{table} has no version {number}, only {known[0]} to {known[-1]}")
    return _read(spark, root, known[-1] if number is None else number)


def as_of(
    spark: SparkSession, table: str, number: int | None = None, only: Callable[[str], bool] | None = None
) -> DataFrame:
    """The rows and columns of a version, or of the newest; of partitions that ``only`` takes by their folder name."""
    described = _described(spark, table)
    chosen, root = version(spark, table, number), _root(described)
    schema = T.StructType.fromJson(chosen.schema)
    bases: dict[str, list[str]] = {}
    for folder, place in sorted(chosen.places.items()):
        if only is None or only(folder):
            bases.setdefault(place.removesuffix(folder).rstrip("/"), []).append(f"{root}/{place}".rstrip("/"))
    reader = spark.read.format(described["provider"]).schema(schema)
    # As many reads as versions that still have partitions in use.
    frames = [reader.option("basePath", f"{root}/{b}".rstrip("/")).load(paths).select(schema.names) for b, paths in bases.items()]
    return reduce(DataFrame.unionAll, frames) if frames else spark.createDataFrame([], schema)


def changed_since(spark: SparkSession, table: str, number: int | None) -> list[str]:
    """Folder names of the partitions that differ from a version; all when it is not kept any more."""
    newest = version(spark, table)
    described = _described(spark, table)
    if number is None or number not in numbers(spark, _root(described)):
        return sorted(newest.places)
    old = _read(spark, _root(described), number).places
    return sorted(p for p in old.keys() | newest.places.keys() if old.get(p) != newest.places.get(p))


def version_history(spark: SparkSession, table: str) -> DataFrame:
    """``version``, ``since``, ``rows`` written, ``replaced`` partitions, ``partitions`` then, one row per version kept."""
    root, rows = _root(_described(spark, table)), []
    for number in numbers(spark, root):
        v = _read(spark, root, number)
        since = datetime.fromisoformat(v.since)
        rows.append({"version": number, "since": since, "rows": v.rows, "replaced": v.replaced, "partitions": len(v.places)})
    return small_rows(spark, rows, _HISTORY)


def clean(spark: SparkSession, table: str, keep: int = 2) -> list[int]:
    """Forget all but the newest versions and remove files that only those use; returns the versions forgotten.

    Folders without a note, which broken replacements left, go as well. Not
    while a replacement is running, nor a reader of an old version.
    """
    if keep < 1:
        raise ValueError("the newest version has to stay")
    settle(spark, table)
    root = _root(_described(spark, table))
    known = numbers(spark, root)
    old = [_read(spark, root, n) for n in known[:-keep]]
    used = {place for n in known[-keep:] for place in _read(spark, root, n).places.values()}
    for v in old:  # notes first: none may point at files that are gone
        storage.remove(spark, f"{_notes(root)}/{v.number:06d}.json")
    for place in {place for v in old for place in v.places.values()} - used:
        if place:
            storage.remove(spark, f"{root}/{place}")
        else:
            for name in storage.children(spark, root):
                if not name.startswith("_"):
                    storage.remove(spark, f"{root}/{name}")
    folders = {place.split("/")[1] for place in used if place.startswith("_versions/")}
    for name in storage.children(spark, _notes(root)):
        if not name.endswith(".json") and name not in folders:
            storage.remove(spark, f"{_notes(root)}/{name}")
    return [v.number for v in old]
