"""Landing zone: a day of messages, read and parsed once, split by destination."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from .. import storage
from ..functions.schemas import REJECTED_BODY, TABLE_COLUMN
from ..operators.envelopes import has_rows, is_rejected, parse_messages
from .tables import dealt

# Landed files are read back by tasks that parse every payload; row groups
# smaller than the default let more of them share a file.
ROW_GROUP_BYTES = 8 << 20

# Alike messages take next to nothing in Parquet, so a task would read very many
# and hold them while it deals them out.  Spark counts a few megabytes for each
# file it opens, so files of few rows bound what a task reads.
_ROWS_ASIDE = 1 << 14

# What a row takes besides its long texts, roughly.
_HEADER_BYTES = 512
_BYTES = "letterbox_bytes"


def landing_rows(messages: DataFrame, body: str = "body") -> DataFrame:
    """Envelopes with rows, and rejected bodies, keyed by destination.

    Rejected bodies have no destination, so they fall into the NULL partition
    of the same write instead of costing a second read of the hub.
    """
    parsed = parse_messages(messages, body, keep_rejected=True)
    rejected = is_rejected()
    return parsed.filter(rejected | has_rows()).withColumn(
        TABLE_COLUMN, F.when(~rejected, F.col("destino.diretorio"))
    )


def _row_bytes() -> Column:
    texts = [F.octet_length(c) for c in ("conteudo", "destino.structType", REJECTED_BODY)]
    return sum((F.coalesce(t, F.lit(0)).cast("bigint") for t in texts), F.lit(_HEADER_BYTES).cast("bigint"))


def land(messages: DataFrame, path: str, fmt: str = "json", body: str = "body") -> None:
    """Write ``path`` anew, partitioned by destination.

    ``path`` belongs to one processing date, so a re-run replaces that date
    and no other.

    Files by destination need rows sorted by it, whole rows in memory, and
    messages shuffle to a small part of that, so compressed sizes tell nothing
    of what a task will hold.  Parsed rows therefore go aside first as they
    come, unsorted, and are then dealt out by their own sizes.
    """
    spark, rows = messages.sparkSession, landing_rows(messages, body)
    folder, slash, name = path.rstrip("/").rpartition("/")
    aside = f"{folder}{slash}_{name}-{uuid.uuid4().hex}"
    sized = rows.withColumn(_BYTES, _row_bytes())
    try:
        writer = sized.write.option("parquet.block.size", ROW_GROUP_BYTES)
        writer.option("maxRecordsPerFile", _ROWS_ASIDE).parquet(aside)
        parsed = spark.read.schema(sized.schema).parquet(aside)
        (
            dealt(parsed, TABLE_COLUMN, _BYTES)
            .write.mode("overwrite")
            .partitionBy(TABLE_COLUMN)
            .option("ignoreNullFields", False)
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .format(fmt)
            .save(path)
        )
    finally:
        storage.remove(spark, aside)


def accepted(landed: DataFrame) -> DataFrame:
    """Envelopes to load; prunes the partition of rejected bodies."""
    return landed.filter(F.col(TABLE_COLUMN).isNotNull())


def rejected(landed: DataFrame) -> DataFrame:
    """Rejected bodies; reads their partition only."""
    return landed.filter(F.col(TABLE_COLUMN).isNull()).select(REJECTED_BODY, "_id", "timestamp")
