"""Structured Streaming: line and file streams, joins, and the streaming load."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.columns import quoted
from ..functions.schemas import REJECTED_BODY, TABLE_COLUMN
from ..sinks.landing import ROW_GROUP_BYTES, landing_rows


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """New text files under ``path`` as a stream of ``value`` lines."""
    return spark.readStream.text(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> DataFrame:
    return spark.readStream.schema(schema).option("header", header).csv(path)


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """JSON lines to columns; a line that is no JSON gives NULLs."""
    return lines.select(F.from_json("value", schema).alias("names")).select("names.*")


def with_length(lines: DataFrame) -> DataFrame:
    return lines.withColumn("len", F.length("value"))


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of a record type, in its order; fails unless types match."""
    actual = {f.name: f.dataType for f in df.schema.fields}
    wrong = [
        f"{f.name}: {actual.get(f.name)} is not {f.dataType}"
        for f in schema.fields
        if actual.get(f.name) != f.dataType
    ]
    if wrong:
        raise TypeError("; ".join(wrong))
    return df.select([quoted(f.name) for f in schema.fields])


def join_streams(
    left: DataFrame,
    right: DataFrame,
    on: str,
    columns: Sequence[str],
    *,
    times: tuple[str, str] | None = None,
    delay: str | None = None,
    within: str | None = None,
    salts: int = 1,
    how: str = "inner",
    until: datetime | None = None,
) -> DataFrame:
    """Equi-join of two streams, projected to ``columns``.

    As it stands both sides stay in state for good.  ``times`` names the event
    time of each side, ``delay`` bounds lateness and ``within`` the distance
    between matching rows, which lets old state go.

    ``how="left"`` needs all three: each left row then comes out with every
    match, or once with NULLs as soon as no match can come any more, and leaves
    the state.  Left rows without a time match nothing and come out at once,
    from a scan of their own.  Rows at or past ``until`` are no data, they only
    move the clock: one on each side, with some key (rows without one may be
    filtered before the clock sees them), empties the state of a finished input.

    ``salts`` splits each key over that many state partitions by the content of
    one side's rows, with the other side's copied to each: an inner join deals
    the right rows, a left join the left ones, as a copy of a left row would
    come out unmatched wherever it lies alone.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unknown kind of join {how!r}")
    if how == "left" and not (times and delay and within):
        raise ValueError("a left join of streams needs times, delay and within")
    if until and not (times and delay):
        raise ValueError("until needs times and delay")
    timeless = left.filter(quoted(times[0]).isNull()) if how == "left" else None
    keys = [on]
    if times and delay:
        left = left.withWatermark(times[0], delay)
        right = right.withWatermark(times[1], delay)
    if how == "left":
        left, right = (df.filter(quoted(t).isNotNull()) for df, t in zip((left, right), times))
    if until:
        # Behind the watermark, so that the rows left out still move it.
        left, right = (df.filter(quoted(t) < F.lit(until)) for df, t in zip((left, right), times))
    if salts > 1:
        dealt, copied = (left, right) if how == "left" else (right, left)
        content = F.xxhash64(*[quoted(c) for c in dealt.columns])
        dealt = dealt.withColumn("salt", F.pmod(content, F.lit(salts)).cast("int"))
        copied = copied.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        left, right = (dealt, copied) if how == "left" else (copied, dealt)
        keys.append("salt")
    left, right = left.alias("l"), right.alias("r")
    condition = F.lit(True)
    for key in keys:
        condition = condition & (F.col(f"l.{key}") == F.col(f"r.{key}"))
    if times and within:
        first, second = F.col(f"l.{times[0]}"), F.col(f"r.{times[1]}")
        span = F.expr(f"INTERVAL {within}")
        condition = condition & second.between(first - span, first + span)
    joined = left.join(right, condition, how).drop(F.col(f"r.{on}")).select(*[quoted(c) for c in columns])
    if timeless is None:
        return joined
    return joined.unionByName(timeless.select(*[quoted(c) for c in columns if c in timeless.columns]), True)


def start(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    *,
    path: str | None = None,
    name: str | None = None,
    every: str | None = None,
    partition_by: Sequence[str] = (),
    options: dict[str, str] | None = None,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append-mode sink.  ``every`` is a trigger interval such as ``3 seconds``;
    without it the query takes what is there and stops.

    ``state_partitions`` is the number of tasks a join keeps its state in.  It
    is fixed by the first start of a checkpoint, so choose it for the largest
    state to come.  A stream knows no option for it but the session's setting,
    which is changed while the query starts.
    """
    if not df.isStreaming:
        raise ValueError("not a stream")
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    if name:
        writer = writer.queryName(name)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if state_partitions is None:
        return writer.start(path) if path else writer.start()
    # A query copies the session's settings when it starts.
    conf, setting = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    previous = conf.get(setting, "200")
    conf.set(setting, state_partitions)
    try:
        return writer.start(path) if path else writer.start()
    finally:
        conf.set(setting, previous)


def finish(query: StreamingQuery, timeout: float | None = None) -> None:
    """Wait for a query to end; raises its error, or when time runs out."""
    ended = query.awaitTermination(timeout) if timeout else query.awaitTermination()
    if ended is False:
        query.stop()
        raise TimeoutError(f"stream {query.name or query.id} did not end in {timeout} s")


def state_rows(query: StreamingQuery) -> int:
    """Rows that a query's operators held after its last batch."""
    return sum(operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"])


def land_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    *,
    body: str = "body",
    fmt: str = "parquet",
    every: str | None = None,
    files_per_table: int = 8,
) -> StreamingQuery:
    """Message stream to a landing zone split by batch and destination.

    A batch is written to a folder named by its number, which a batch that runs
    again replaces, so each message lands once whatever is retried.  A shuffle
    by destination comes first: a batch leaves at most ``files_per_table`` files
    for each.  ``load_batches`` then loads what a table has not had yet.
    """
    if not messages.isStreaming:
        raise ValueError("not a stream")
    content = F.xxhash64("_id", "timestamp", "conteudo", REJECTED_BODY)

    def land_batch(batch: DataFrame, number: int) -> None:
        rows = landing_rows(batch, body)
        (
            rows.repartition(TABLE_COLUMN, F.pmod(content, F.lit(files_per_table)))
            .write.mode("overwrite")
            .partitionBy(TABLE_COLUMN)
            .option("ignoreNullFields", False)
            .option("parquet.block.size", ROW_GROUP_BYTES)
            .format(fmt)
            .save(f"{path.rstrip('/')}/batch={number}")
        )

    writer = messages.writeStream.foreachBatch(land_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()
