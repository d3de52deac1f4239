"""Derived tables kept up to date from catalog tables, over a look-back or from what changed.

The caller says how outputs follow from inputs; this module reads the inputs,
sets the window or finds the changed partitions, and writes each output.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import Window, lookback_window
from ..model import LoadResult
from ..sinks import versions
from ..sinks.tables import create_table, partition_columns, rebuild, save
from ..sources.origins import name_list, read_origins
from .merge import upsert

Build = Callable[[dict[str, DataFrame], Window], Mapping[str, DataFrame]]


@dataclass(frozen=True)
class Target:
    """Where an output goes and what identifies its rows."""

    name: str
    location: str
    keys: tuple[str, ...] = ()
    partitions: tuple[str, ...] = ()
    recency: tuple[str, ...] = ()
    database_location: str | None = None


def write(spark: SparkSession, df: DataFrame, target: Target, mode: str) -> LoadResult:
    """``merge`` upserts by key, ``drop`` rebuilds, ``append`` and ``overwrite`` insert."""
    if mode not in ("merge", "drop", "append", "overwrite"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "merge" and not target.keys:
        raise ValueError(f"{target.name} has no keys to merge by")
    create_table(
        spark,
        target.name,
        df.schema,
        target.location,
        target.partitions,
        database_location=target.database_location,
    )
    if mode == "drop":
        rebuild(df, target.name, target.location, target.partitions)
        return LoadResult(target.name, "loaded", mode, spark.table(target.name).count())
    if mode == "merge":
        rows = upsert(spark, df, target.name, target.keys, recency=target.recency)
    else:
        rows = save(df, target.name, mode)["rows"]
    return LoadResult(target.name, "loaded", mode, rows)


def refresh(
    spark: SparkSession,
    build: Build,
    targets: Mapping[str, Target],
    *,
    data_proc: str | date,
    data_proc_init: int | str | date,
    mode: str,
    origins: str,
    tables: str = "",
) -> list[LoadResult]:
    """Build the outputs over the look-back and write all of them, or those in ``tables``.

    An output that fails does not stop the others.
    """
    window = lookback_window(data_proc, data_proc_init)
    outputs = build(read_origins(spark, origins), window)
    results = []
    for name in name_list(tables) or list(targets):
        try:
            results.append(write(spark, outputs[name], targets[name], mode))
        except Exception as error:  # one output must not stop the others
            results.append(LoadResult(name, "failed", mode, error=f"{type(error).__name__}: {error}"))
    return results


Changed = Callable[[dict[str, DataFrame]], DataFrame]


def refresh_changed(spark: SparkSession, build: Changed, target: Target, origins: str) -> LoadResult:
    """Build anew only the partitions of an output whose origins changed since its last version.

    Output and origins keep versions; an output's version holds the origins'
    versions that it was made from, so a run that breaks off is simply made
    again. An origin partitioned by all of the output's partition columns (it
    may have more) is read in the partitions concerned only; ``build`` must put
    what it reads of a partition into the same partition, else the run fails.
    A change of any other origin concerns all partitions. The origins are read as
    of the versions noted. ``empty`` is the answer when nothing changed.
    """
    names = name_list(origins)
    read_origins(spark, origins)  # names all that are missing
    newest = {name: versions.version(spark, name) for name in names}
    shared = {n: _shared_partitions(spark, n, target) for n in names}
    made = spark.catalog.tableExists(target.name)
    done = versions.version(spark, target.name).sources if made else {}
    concerned: set[str] | None = set()
    for name in names:
        changed = versions.changed_since(spark, name, done.get(name))
        if name not in done or (changed and not shared[name]):
            concerned = None
            break
        concerned |= {_project(folder, target.partitions) for folder in changed}
    if concerned is not None and not concerned and set(done) == set(names):
        return LoadResult(target.name, "empty", "overwrite", 0)

    def read(name: str) -> DataFrame:
        if concerned is None or not shared[name]:
            return versions.as_of(spark, name, newest[name].number)
        return versions.as_of(
            spark, name, newest[name].number, lambda folder: _project(folder, target.partitions) in concerned
        )

    rows = build({name: read(name) for name in names})
    if not made:
        create_table(
            spark, target.name, rows.schema, target.location, target.partitions, database_location=target.database_location
        )
        versions.recover(spark, target.name)
        versions.enable(spark, target.name)
    counts = versions.replace(
        rows,
        target.name,
        whole=concerned is None,
        emptied=concerned or (),
        within=None if concerned is None else concerned.__contains__,
        sources={name: newest[name].number for name in names},
    )
    return LoadResult(target.name, "loaded", "overwrite", counts["rows"])


def _shared_partitions(spark: SparkSession, origin: str, target: Target) -> bool:
    """Whether an origin's partition columns tell the output's partitions."""
    return bool(target.partitions) and set(target.partitions) <= set(partition_columns(spark, origin))


def _project(folder: str, partitions: tuple[str, ...]) -> str:
    """The output's partition that an origin's partition, by its folder name, belongs to."""
    values = dict(piece.split("=", 1) for piece in folder.split("/"))
    return "/".join(f"{p}={values[p]}" for p in partitions)
