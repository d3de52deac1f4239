"""The load itself: land a window once, then load each destination from files.

The landing zone replaces a cache: it survives lost executors, prunes by
destination, and lets one table be loaded again on its own.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import date, timedelta

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from .. import catalog, storage
from ..functions.dates import Window, day_values, parse_day, previous_day_window
from ..functions.schemas import TABLE_COLUMN, landed_schema, pick
from ..model import DAY_PARTITIONS, LoadOptions, LoadResult, TableSpec
from ..operators.envelopes import (
    envelopes,
    has_rows,
    is_rejected,
    of_id,
    of_table,
    parse_messages,
    quarantine,
    resolve_specs,
    table_spec,
)
from ..operators.evolution import evolved, fitted
from ..operators.payload import payload_rejects, text_rows, typed_payload, typed_rows, with_day, with_rule
from ..operators.quality import assert_keys, cast_report, guard_keys
from ..session import small_rows
from ..sinks import versions
from ..sinks.landing import accepted, land
from ..sinks.schemas import evolve_table, newest_schema
from ..sinks.staged import finish, left_behind, publish, stage
from ..sinks.tables import counts_of, create_table, drop_table, save, save_day
from ..sources.files import read_landing
from ..sources.hub import read_messages, select_window
from ..sources.origins import name_list

POOL = "spark.scheduler.pool"

REPORT_SCHEMA = pa.schema(
    {
        "tabela": pa.string(),
        "status": pa.string(),
        "mode": pa.string(),
        "rows": pa.int64(),
        "error": pa.string(),
        "distinct_specs": pa.int64(),
        "lost_values": pa.int64(),
        "rejected": pa.int64(),
        "rejected_messages": pa.int64(),
    }
)


class LoadFailed(RuntimeError):
    """At least one table of a run did not load."""

    def __init__(self, results: list[LoadResult]):
        self.results = results
        failed = [f"{r.table}: {r.error}" for r in results if r.status == "failed"]
        super().__init__("; ".join(failed))


def table_rows(
    found: DataFrame,
    spec: TableSpec,
    day: date,
    options: LoadOptions,
    counted: Observation | None = None,
) -> DataFrame:
    """Final rows of one table: header, typed payload, partition columns."""
    rows = typed_rows(
        found,
        spec.schema,
        first_only=options.first_only,
        legacy_cast=options.legacy_cast,
        counted=counted,
    )
    rule = options.rule_for(spec.table)
    return with_rule(rows, rule) if rule else with_day(rows, day)


def check_keys(found: DataFrame, spec: TableSpec, day: date, options: LoadOptions) -> None:
    """Fail with counts on NULL keys, reading no more of the payload than the keys need."""
    if not spec.keys:
        return
    fields = {f.name.lower() for f in spec.schema.fields}
    if all(key.lower() in fields for key in spec.keys):
        keys = typed_payload(
            found,
            pick(spec.schema, list(spec.keys)),
            first_only=options.first_only,
            legacy_cast=options.legacy_cast,
        )
    else:
        # Keys may also be header or partition columns.
        keys = table_rows(found, spec, day, options)
    assert_keys(keys, spec.keys)


def lost_values(found: DataFrame, spec: TableSpec, options: LoadOptions) -> int:
    """Values the casts turned into NULL, over all fields."""
    text = text_rows(found, spec.schema, first_only=options.first_only)
    losses = cast_report(text, spec.schema, legacy_cast=options.legacy_cast)
    return losses.agg(F.coalesce(F.sum("failed"), F.lit(0))).first()[0]


def keep_rejects(
    found: DataFrame,
    spec: TableSpec,
    day: date,
    options: LoadOptions,
    counted: Observation,
    batch: str | None = None,
) -> int:
    """Payload elements that could not be read, to the quarantine beside the tables.

    They were counted within the load's own job; only when there are any is the
    payload read again.  A day loaded again by overwriting replaces its own, and
    batches appended again replace theirs, which lie in a folder ``batch=...``.
    """
    rejects = payload_rejects(found, spec.schema, first_only=options.first_only)
    seen = counts_of(counted)
    number = rejects.count() if seen is None else seen["rejected"]
    path = quarantine_path(spec, options, day)
    if batch:
        path = f"{path}/batch={batch}"
    if batch or options.write_mode(spec) == "overwrite":
        storage.remove(found.sparkSession, path)
    if number:
        rejects.write.mode("append").parquet(path)
    return number


def quarantine_path(spec: TableSpec, options: LoadOptions, day: date) -> str:
    """Where a table's unreadable payload elements of a day are kept, as Parquet."""
    base = options.base_path.rstrip("/")
    return f"{base}/_quarantine/{spec.database(options.database_prefix)}/{spec.table}/{day.isoformat()}"


def ensure_table(spark: SparkSession, schema: T.StructType, spec: TableSpec, options: LoadOptions) -> bool:
    """The table of a spec, created when missing or, with ``options.evolve``, grown; whether it was created."""
    name, location = spec.full_name(options.database_prefix), spec.location(options.base_path)
    if spark.catalog.tableExists(name):
        if options.evolve:
            evolve_table(spark, name, schema)
        return False
    if options.evolve:
        # Files of earlier loads may have more columns than these messages.
        schema = evolved(newest_schema(spark, location) or T.StructType(), schema)
    rule = options.rule_for(spec.table)
    create_table(
        spark,
        name,
        schema,
        location,
        rule.names if rule else DAY_PARTITIONS,
        options.fmt,
        f"{options.base_path.rstrip('/')}/{spec.database(options.database_prefix)}.db",
    )
    if storage.exists(spark, location):
        # It may hold partitions of earlier runs, known to another catalog.
        versions.recover(spark, name)
    if options.versions:
        versions.enable(spark, name)
    return True


def load_table(
    spark: SparkSession,
    found: DataFrame,
    spec: TableSpec,
    day: date,
    options: LoadOptions,
    *,
    landed: bool = True,
    batches: list[str] | None = None,
) -> LoadResult:
    """Create when missing, and write one table unless a key is NULL.

    With ``options.evolve`` a table that lacks a field, or has a narrower type,
    grows first; what the messages lack is NULL. ``landed`` envelopes lie in files of their own and need no shuffle to be
    written to a constant day.
    """
    mode = options.write_mode(spec)
    counted = Observation()
    rows = guard_keys(table_rows(found, spec, day, options, counted), spec.keys)
    rule = options.rule_for(spec.table)
    name = spec.full_name(options.database_prefix)
    created = ensure_table(spark, rows.schema, spec, options)
    if options.evolve:
        rows = fitted(rows, spark.table(name).schema)
    # Given as constants, the columns of the day need no sort in the write.
    constants = {} if rule else day_values(day)
    rows = rows.drop(*constants)
    try:
        if batches:
            rejects: list[int] = []
            keep = lambda: rejects.append(
                keep_rejects(found, spec, day, options, counted, _batch_name(batches))
            )
            staged = stage(
                rows, name, _batch_name(batches), batches, shuffle=rule is not None, constants=constants, also=keep
            )
            written = staged.rows
        elif rule:
            written = save(rows, name, mode)["rows"]
        else:
            written = save_day(rows, name, constants, mode, shuffle=not landed)
    except Exception:
        if created:
            drop_table(spark, name)
        check_keys(found, spec, day, options)  # names the keys when they were the cause
        raise
    if batches:
        publish(spark, name, staged)
    lost = lost_values(found, spec, options) if options.count_lost_values else None
    rejected = rejects[0] if batches else keep_rejects(found, spec, day, options, counted)
    return LoadResult(
        spec.table,
        "loaded",
        mode,
        written,
        distinct_specs=spec.distinct_specs,
        lost_values=lost,
        rejected=rejected,
    )


def load_landed(
    spark: SparkSession,
    landing_path: str,
    window: Window | date,
    options: LoadOptions,
    tables: str | Iterable[str] | None = None,
    *,
    landing_fmt: str = "json",
) -> list[LoadResult]:
    """Load every landed table, or the listed ones; never raises for one table.

    Specs of all tables come from one aggregate and reach the driver as one
    row per table.  Tables then load side by side, so a small table need not
    wait for a large one.  A listed table without messages is ``empty``.
    """
    # Listed once here; every table below prunes the same listing.
    landed = accepted(read_landing(spark, landing_path, fmt=landing_fmt))
    wanted = name_list(tables) if isinstance(tables, str) else list(dict.fromkeys(tables or ()))

    def one(spec: TableSpec) -> LoadResult:
        found = landed.filter(F.col(TABLE_COLUMN) == spec.table)
        return load_table(spark, found, spec, _one_day(window, spec, options), options)

    return _load_each(spark, landed, wanted, window, options, one)


def _load_each(
    spark: SparkSession,
    landed: DataFrame,
    wanted: list[str],
    window: Window | date,
    options: LoadOptions,
    one: Callable[[TableSpec], LoadResult],
) -> list[LoadResult]:
    """``one`` for the spec of each table, side by side; its errors become results."""
    if wanted:
        landed = landed.filter(F.col(TABLE_COLUMN).isin(wanted))
    # One row per destination found.
    specs = {row.tabela: row for row in resolve_specs(landed).toLocalIterator()}
    alike = Counter(_place(row) for row in specs.values())

    pools = _pool_each(spark)

    def result(table: str) -> LoadResult:
        if table not in specs:
            return LoadResult(table, "empty")
        if pools:
            spark.sparkContext.setLocalProperty(POOL, f"load-{table}")
        try:
            if alike[_place(specs[table])] > 1:
                same = sorted(t for t, row in specs.items() if _place(row) == _place(specs[table]))
                raise ValueError(f"tables {', '.join(same)} differ only in case: they would overwrite each other")
            return one(options.with_declared(table_spec(specs[table], options.schemas)))
        except Exception as error:  # one table must not stop the others
            return LoadResult(table, "failed", error=f"{type(error).__name__}: {error}")

    names = wanted or sorted(specs)
    with ThreadPoolExecutor(max_workers=max(1, options.concurrent_tables)) as pool:
        # Wrapped anew for each table: a wrapper's threads share its job properties.
        pending = [pool.submit(inheritable_thread_target(spark)(result), name) for name in names]
        results = [each.result() for each in pending]
    if options.audit_table:
        catalog.record(spark, options.audit_table, results, _first_day(window), options.base_path)
    return results


def _pool_each(spark: SparkSession) -> bool:
    """Whether tables get scheduler pools of their own.

    First in, first out, a hot table's tasks go before those of all tables that
    came later.  Where the cluster schedules fairly, pools share the cores evenly
    (those not named in its allocation file weigh the same), so small tables end
    early.  A pool that the caller chose stays: the run is one job among others.
    """
    context = spark.sparkContext
    fair = context.getConf().get("spark.scheduler.mode", "FIFO").upper() == "FAIR"
    return fair and not context.getLocalProperty(POOL)


def _place(row) -> tuple[str, str]:
    """What names a table in the catalog, which ignores case."""
    return row.origem.lower(), row.tabela.lower()


def _first_day(window: Window | date) -> date:
    return window.day if isinstance(window, Window) else window


def _one_day(window: Window | date, spec: TableSpec, options: LoadOptions) -> date:
    """The day that names a load's constant partition; a longer window has none."""
    longer = isinstance(window, Window) and window.end - window.start > timedelta(days=1)
    if longer and options.rule_for(spec.table) is None:
        raise ValueError(f"table {spec.table}: a window of more than a day needs a partition rule")
    return _first_day(window)


def load_batches(
    spark: SparkSession,
    landing_path: str,
    window: Window | date,
    options: LoadOptions,
    tables: str | Iterable[str] | None = None,
    *,
    landing_fmt: str = "parquet",
) -> list[LoadResult]:
    """Load the batches of a streaming landing zone that a table has not had yet.

    A batch counts once it is complete.  For each table, marks beside the
    landing zone tell the batches done.  Appends are written aside and then
    published; one that broke off is taken up where it stopped, so every row
    comes once however often a run is repeated.  An overwriting load is simply
    repeated.  (A ``begun`` mark, which former versions left, still fails its
    table by name, as nothing tells what that append had written.)
    """
    complete = [
        name.removeprefix("batch=")
        for name in storage.children(spark, landing_path)
        if name.startswith("batch=") and storage.exists(spark, f"{landing_path}/{name}/_SUCCESS")
    ]
    if not complete:
        return []
    schema = landed_schema().add("batch", T.LongType())
    landed = accepted(spark.read.format(landing_fmt).schema(schema).load(landing_path))
    landed = landed.filter(F.col("batch").isin([int(b) for b in complete]))
    wanted = name_list(tables) if isinstance(tables, str) else list(dict.fromkeys(tables or ()))

    def one(spec: TableSpec) -> LoadResult:
        marks = f"{landing_path.rstrip('/')}_loads/{spec.table}"
        day = _one_day(window, spec, options)
        mine = landed.filter(F.col(TABLE_COLUMN) == spec.table)
        settled = _settle(spark, table_rows(mine.drop("batch"), spec, day, options).schema, spec, options, marks)
        known = set(storage.children(spark, marks))
        new = [b for b in complete if f"{b}.done" not in known]
        if not new:
            return LoadResult(spec.table, "loaded" if settled else "empty", rows=settled)
        append = options.write_mode(spec) == "append"
        broken = [b for b in new if f"{b}.begun" in known]
        if broken and append:
            raise RuntimeError(f"table {spec.table}: batches {', '.join(broken)} broke off; see {marks}")
        found = mine.filter(F.col("batch").isin([int(b) for b in new])).drop("batch")
        loaded = load_table(spark, found, spec, day, options, batches=new if append else None)
        _mark_done(spark, marks, new)
        location = spec.location(options.base_path)
        for load in left_behind(spark, location, _BATCHES):
            finish(spark, location, load)
        return replace(loaded, rows=(loaded.rows or 0) + settled)

    return _load_each(spark, landed, wanted, window, options, one)


#: Staged loads of batches are named so.
_BATCHES = "batches-"


def _batch_name(batches: list[str]) -> str:
    return f"{_BATCHES}{batches[0]}-{batches[-1]}"


def _mark_done(spark: SparkSession, marks: str, batches: Iterable[str]) -> None:
    for b in batches:
        storage.mark(spark, f"{marks}/{b}.done")


def _settle(
    spark: SparkSession, schema: T.StructType, spec: TableSpec, options: LoadOptions, marks: str
) -> int:
    """Publish what earlier runs wrote but did not finish; returns its rows."""
    rows, name, location = 0, spec.full_name(options.database_prefix), spec.location(options.base_path)
    unfinished = left_behind(spark, location, _BATCHES)
    if unfinished:
        ensure_table(spark, schema, spec, options)
    for load in unfinished:
        publish(spark, name, load)
        _mark_done(spark, marks, load.contents)
        finish(spark, location, load)
        rows += load.rows
    return rows


def load_messages(
    spark: SparkSession,
    messages: DataFrame,
    window: Window,
    landing_path: str,
    options: LoadOptions,
    tables: str | Iterable[str] | None = None,
    *,
    landing_fmt: str = "parquet",
) -> list[LoadResult]:
    """A window of messages to all its tables in one run.

    Messages outside the window are left out; a frame without enqueue times is
    taken as read for it.
    """
    if "enqueuedTime" in messages.columns:
        messages = select_window(messages, window)
    land(messages, landing_path, landing_fmt)
    return load_landed(spark, landing_path, window, options, tables, landing_fmt=landing_fmt)


def load_one(
    spark: SparkSession,
    messages: DataFrame,
    window: Window,
    table: str,
    options: LoadOptions,
    identifier: str | None = None,
) -> LoadResult:
    """One destination straight from the hub, without a landing zone.

    Reads the hub twice, headers first, which beats landing every destination
    when only one is wanted.  ``identifier`` keeps the messages of one id.
    Messages that the landing zone would quarantine are left out here too, and
    counted as ``rejected_messages``, of whatever table.
    """
    if "enqueuedTime" in messages.columns:
        messages = select_window(messages, window)

    def chosen(found: DataFrame) -> DataFrame:
        found = of_table(found, table)
        return found if identifier is None else of_id(found, identifier)

    seen = Observation()
    headers = parse_messages(messages, payload=False, keep_rejected=True)
    headers = headers.observe(seen, F.count_if(is_rejected()).alias("rejected"))
    row = resolve_specs(chosen(headers.filter(has_rows() & ~is_rejected()))).first()
    counted = counts_of(seen)
    rejected = quarantine(messages).count() if counted is None else counted["rejected"]
    if row is None:
        return LoadResult(table, "empty", rejected_messages=rejected)
    spec = options.with_declared(table_spec(row, options.schemas))
    day = _one_day(window, spec, options)
    result = load_table(spark, chosen(envelopes(messages)), spec, day, options, landed=False)
    return replace(result, rejected_messages=rejected)


def ingest_day(
    spark: SparkSession,
    fmt: str,
    source_options: Mapping[str, str],
    data_proc: str | date,
    landing_root: str,
    options: LoadOptions,
    tables: str | Iterable[str] | None = None,
    *,
    path: str | None = None,
) -> list[LoadResult]:
    """The daily job: the day before ``data_proc`` from the hub to its tables.

    Fails at the end, after every table had its turn, when any did not load.
    """
    window = previous_day_window(data_proc)
    messages = read_messages(spark, fmt, source_options, window, path=path)
    landing = f"{landing_root.rstrip('/')}/{parse_day(data_proc).isoformat()}"
    results = load_messages(spark, messages, window, landing, options, tables)
    raise_on_failure(results)
    return results


def report(spark: SparkSession, results: list[LoadResult]) -> DataFrame:
    """The outcome of a run, one row per table."""
    rows = [
        {
            "tabela": r.table,
            "status": r.status,
            "mode": r.mode,
            "rows": r.rows,
            "error": r.error,
            "distinct_specs": r.distinct_specs,
            "lost_values": r.lost_values,
            "rejected": r.rejected,
            "rejected_messages": r.rejected_messages,
        }
        for r in results
    ]
    return small_rows(spark, rows, REPORT_SCHEMA)


def raise_on_failure(results: list[LoadResult]) -> None:
    if any(r.status == "failed" for r in results):
        raise LoadFailed(results)
