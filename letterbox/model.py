"""Small driver-side values: one per destination table or per run."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# Partition columns of every raw table, in directory order.
DAY_PARTITIONS = ("year_partition", "month_partition", "day_partition")


@dataclass(frozen=True)
class TableSpec:
    """What the messages of one destination say about their table."""

    source: str
    table: str
    mode: str
    path: str
    schema: T.StructType
    keys: tuple[str, ...] = ()
    distinct_specs: int = 1
    messages: int = 0

    def location(self, base: str) -> str:
        """Where the table lies; a message cannot lead outside ``base``."""
        path = self.path.strip("/")
        if ".." in [*path.split("/"), self.table] or "/" in self.table:
            raise ValueError(f"table {self.table}: unsafe path {self.path!r}")
        return "/".join(part for part in (base.rstrip("/"), path, self.table) if part)

    def database(self, prefix: str) -> str:
        return f"{prefix}{self.source}"

    def full_name(self, prefix: str) -> str:
        return f"{self.database(prefix)}.{self.table}"


@dataclass(frozen=True)
class PartitionRule:
    """Partition columns derived from a date column of the payload.

    ``columns`` maps each partition column to a date pattern.  Values are
    zero-padded text unless ``as_type`` asks for a number.
    """

    source: str
    columns: Mapping[str, str] = field(
        default_factory=lambda: dict(zip(DAY_PARTITIONS, ("yyyy", "MM", "dd")))
    )
    source_type: str = "timestamp"
    as_type: str = "string"

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(self.columns)


@dataclass(frozen=True)
class LoadOptions:
    """Arguments of a run that hold for all its tables."""

    base_path: str
    database_prefix: str = "raw_"
    fmt: str = "parquet"
    mode_override: str | None = None
    partition_rules: Mapping[str, PartitionRule] = field(default_factory=dict)
    default_rule: PartitionRule | None = None
    declared_keys: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    declared_modes: Mapping[str, str] = field(default_factory=dict)
    first_only: bool = False
    legacy_cast: bool = False
    count_lost_values: bool = False
    schemas: str = "union"
    evolve: bool = False
    versions: bool = False
    concurrent_tables: int = 8
    audit_table: str | None = None

    def rule_for(self, table: str) -> PartitionRule | None:
        return self.partition_rules.get(table, self.default_rule)

    def with_declared(self, spec: TableSpec) -> TableSpec:
        """The spec with the keys of the table's document, if it has one."""
        return replace(spec, keys=self.declared_keys.get(spec.table, spec.keys))

    def write_mode(self, spec: TableSpec) -> str:
        """The run's mode wins only when it is ``overwrite``; then a document's, then the messages'."""
        override = (self.mode_override or "").strip().lower()
        mode = "overwrite" if override == "overwrite" else self.declared_modes.get(spec.table, spec.mode)
        if mode not in ("append", "overwrite"):
            raise ValueError(f"table {spec.table}: unknown write mode {mode!r}")
        return mode


@dataclass(frozen=True)
class LoadResult:
    table: str
    status: str
    mode: str | None = None
    rows: int | None = 0
    error: str | None = None
    distinct_specs: int | None = None
    lost_values: int | None = None
    rejected: int | None = None
    rejected_messages: int | None = None
