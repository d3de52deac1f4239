"""Message hub reads, bounded and streaming.

``fmt`` is whatever connector the cluster has (Kafka, a hub connector, or
files holding the messages); the rest of the package sees ``body`` and the
enqueue time only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import Window, within


def kafka_bounds(window: Window) -> dict[str, str]:
    """Offsets by enqueue time, so brokers serve only the window."""
    return {
        "startingTimestamp": str(window.start_ms),
        "endingTimestamp": str(window.end_ms),
        "startingOffsetsByTimestampStrategy": "latest",
    }


def read_messages(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    window: Window,
    *,
    body: str = "body",
    time: str = "enqueuedTime",
    path: str | None = None,
    bounds: Callable[[Window], Mapping[str, str]] | None = None,
) -> DataFrame:
    """Messages enqueued in ``window`` as ``(body, enqueuedTime)``.

    ``bounds`` words the window in the connector's own options, so that no
    message outside it is read; Kafka's are known.  The time is compared again
    afterwards, which for files is the only bound and reaches the scan.
    """
    if fmt == "kafka":
        bounds, body, time = bounds or kafka_bounds, "value", "timestamp"
    reader = spark.read.format(fmt).options(**options)
    if bounds:
        reader = reader.options(**bounds(window))
    return select_window(reader.load(path) if path else reader.load(), window, body=body, time=time)


def select_window(
    messages: DataFrame, window: Window, *, body: str = "body", time: str = "enqueuedTime"
) -> DataFrame:
    return messages.filter(within(messages, time, window)).select(
        F.col(body).alias("body"), F.col(time).alias("enqueuedTime")
    )


def read_message_stream(
    spark: SparkSession,
    fmt: str,
    options: Mapping[str, str],
    *,
    body: str = "body",
    path: str | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Endless read with the body already as text."""
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    stream = reader.load(path) if path else reader.load()
    if fmt == "kafka":
        body = "value"
    return stream.withColumn("body", body_text(body))


def body_text(body: str = "body"):
    """The binary body as text."""
    return F.col(body).cast("string")
