"""Rows out as JSON messages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Spark's default would cut timestamps to milliseconds.
JSON_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_text(value: Column) -> Column:
    return F.to_json(value, JSON_OPTIONS)


def as_messages(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``(key, value)``: key columns joined by ``|``, and the row as JSON."""
    columns = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit(None).cast("string")
    return df.select(key.alias("key"), json_text(F.struct(*columns)).alias("value"))


def publish(
    df: DataFrame,
    fmt: str,
    options: Mapping[str, str] | None = None,
    *,
    keys: Sequence[str] = (),
    path: str | None = None,
    mode: str = "append",
) -> None:
    """Send rows to a topic (``kafka``) or to files (``text``, ``json``, ``parquet``)."""
    messages = as_messages(df, keys)
    if fmt == "text":
        messages = messages.select("value")
    writer = messages.write.format(fmt).options(**(options or {}))
    if fmt != "kafka":
        writer = writer.mode(mode)
    writer.save(path) if path else writer.save()
