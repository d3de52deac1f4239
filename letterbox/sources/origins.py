"""Named input tables of a job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def name_list(text: str | None) -> list[str]:
    """Names out of comma text; empty text means no names at all."""
    names = (name.strip() for name in (text or "").split(","))
    return list(dict.fromkeys(name for name in names if name))


def read_origins(spark: SparkSession, names: str) -> dict[str, DataFrame]:
    """A DataFrame per listed catalog table; all missing ones are named at once."""
    wanted = name_list(names)
    missing = [name for name in wanted if not spark.catalog.tableExists(name)]
    if missing:
        raise LookupError(f"origin tables not found: {', '.join(missing)}")
    return {name: spark.table(name) for name in wanted}
