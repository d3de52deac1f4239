"""Streaming queries; each runs to the end of its input and returns the sink."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.quality import partition_counts
from ..plans import load
from ..sources.hub import read_message_stream
from ..session import new_folder
from ..sinks.publish import json_text, publish
from ..streaming import streams
from .producer import row_messages
from .registry import query, read, read_stream
from .writing import EVENT_RULE, MONTH, all_rows, event_messages, loaded, options


def run_to_end(df: DataFrame, label: str) -> DataFrame:
    """Everything the stream has now, through an exactly-once file sink."""
    spark = df.sparkSession
    folder = new_folder(spark, label)
    streams.finish(streams.start(df, "parquet", f"{folder}/checkpoint", path=f"{folder}/out"))
    return spark.read.schema(df.schema).parquet(f"{folder}/out")


@query("SELECT c_name AS name FROM customer")
def stream_json_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = new_folder(spark, "lines")
    customers = read(spark, sf_dir, "customer")
    publish(customers.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")), "text", path=lines)
    record = T.StructType.fromDDL("id BIGINT, name STRING")
    people = streams.typed(streams.parse_lines(streams.read_lines(spark, lines), record), record)
    return run_to_end(people.select("name"), "names")


@query("SELECT c_name AS value, CAST(length(c_name) AS INT) AS len FROM customer")
def stream_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = new_folder(spark, "lines")
    read(spark, sf_dir, "customer").select("c_name").write.text(lines)
    return run_to_end(streams.with_length(streams.read_lines(spark, lines)), "lengths")


@query("SELECT s_suppkey, s_name FROM supplier")
def stream_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = new_folder(spark, "csv")
    suppliers = read(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    suppliers.write.option("header", True).csv(files)
    return run_to_end(streams.read_csv(spark, files, suppliers.schema), "csv")


def _json_stream(spark: SparkSession, sf_dir: str, table: str, **columns: str) -> DataFrame:
    """A table as a stream of JSON lines."""
    record = F.struct(*[F.col(source).alias(name) for name, source in columns.items()])
    return read_stream(spark, sf_dir, table).select(json_text(record).alias("value"))


@query("""
SELECT c_custkey AS id, c_name AS name, o_orderkey FROM customer JOIN orders ON c_custkey = o_custkey
""")
def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two JSON streams joined; a busy customer's orders are dealt over eight tasks."""
    people = streams.parse_lines(
        _json_stream(spark, sf_dir, "customer", id="c_custkey", name="c_name"),
        T.StructType.fromDDL("id BIGINT, name STRING"),
    )
    orders = streams.parse_lines(
        _json_stream(spark, sf_dir, "orders", id="o_custkey", o_orderkey="o_orderkey"),
        T.StructType.fromDDL("id BIGINT, o_orderkey BIGINT"),
    )
    joined = streams.join_streams(people, orders, "id", ["id", "name", "o_orderkey"], salts=8)
    return run_to_end(joined, "joined")


@query("""
SELECT e.event_id, p.purchase_id, CAST(0 AS BIGINT) AS state_rows
FROM events e LEFT JOIN (
    SELECT event_id AS purchase_id, user_id, ts FROM events WHERE event_type = 'purchase'
) p ON e.user_id = p.user_id AND p.ts BETWEEN e.ts - INTERVAL 1 HOUR AND e.ts + INTERVAL 1 HOUR
""")
def stream_left_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with its user's purchases within an hour, or with none once none can come.

    The events arrive in two drops, half a month each, and a closing message;
    ``state_rows`` is what the join still holds at the end.
    """
    folder = new_folder(spark, "left-join")
    events = read(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts")
    )
    closing = spark.range(1).select(
        F.lit(None).cast("long").alias("event_id"),
        F.lit(0).cast("long").alias("user_id"),
        F.lit("purchase").alias("event_type"),
        F.lit(MONTH.end + timedelta(days=1)).alias("ts"),
    )
    early = F.dayofmonth("ts") <= 15
    for drop in (events.filter(early), events.filter(~early), closing):
        drop.write.mode("append").parquet(f"{folder}/hub")
        hub = spark.readStream.schema(events.schema).parquet(f"{folder}/hub")
        bought = hub.filter("event_type = 'purchase'").selectExpr(
            "event_id AS purchase_id", "user_id", "ts AS bought_at"
        )
        joined = streams.join_streams(
            hub,
            bought,
            "user_id",
            ["event_id", "purchase_id"],
            times=("ts", "bought_at"),
            delay="1 hour",
            within="1 hour",
            salts=4,
            how="left",
            until=MONTH.end,
        )
        running = streams.start(joined, "parquet", f"{folder}/checkpoint", path=f"{folder}/out")
        streams.finish(running)
    out = spark.read.schema(joined.schema).parquet(f"{folder}/out")
    return out.withColumn("state_rows", F.lit(streams.state_rows(running)).cast("long"))


@query("SELECT event_type AS tabela, count(*) AS n FROM events GROUP BY ALL")
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages land as they stream in; their tables then load from the landing zone."""
    events = read_stream(spark, sf_dir, "events")
    sent = row_messages(events, F.col("event_type"), enqueued=F.col("ts"))
    folder, run = new_folder(spark, "stream"), options(spark)
    streams.finish(streams.land_stream(sent, f"{folder}/landing", f"{folder}/checkpoint"))
    results = load.load_batches(spark, f"{folder}/landing", MONTH.day, run)
    return partition_counts(all_rows(spark, loaded(results), run), ["tabela"])


@query("""
SELECT event_type AS tabela, event_id, value FROM events
""")
def stream_load_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of message files and three loads, the last with nothing new: each row once."""
    folder, run = new_folder(spark, "stream"), options(spark, default_rule=EVENT_RULE)
    sent = event_messages(spark, sf_dir, keys="event_id")
    early = F.dayofmonth("enqueuedTime") <= 15
    names: set[str] = set()
    for drop in (early, ~early):
        sent.filter(drop).write.mode("append").parquet(f"{folder}/hub")
        hub = read_message_stream(spark, "parquet", {}, path=f"{folder}/hub", schema=sent.schema)
        streams.finish(streams.land_stream(hub, f"{folder}/landing", f"{folder}/checkpoint"))
        names |= set(loaded(load.load_batches(spark, f"{folder}/landing", MONTH, run)))
    load.raise_on_failure(load.load_batches(spark, f"{folder}/landing", MONTH, run))
    return all_rows(spark, sorted(names), run, "event_id", "value")


@query("SELECT c_custkey, c_name FROM customer")
def stream_every(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A file stream with a trigger every three seconds, stopped once it has read everything."""
    folder = new_folder(spark, "every")
    customers = read(spark, sf_dir, "customer").select("c_custkey", "c_name")
    customers.write.option("header", True).csv(f"{folder}/in")
    stream = streams.read_csv(spark, f"{folder}/in", customers.schema)
    running = streams.start(stream, "parquet", f"{folder}/checkpoint", path=f"{folder}/out", every="3 seconds")
    running.processAllAvailable()
    running.stop()
    return spark.read.schema(customers.schema).parquet(f"{folder}/out")
