"""Time the headline queries; prints one JSON line.

Each query runs once to warm up, which also writes the messages it sends, and
then three times, or once when the bench has taken over 150 seconds already; the
median counts. Settings are Spark's own, but for the
number of shuffle partitions.

BENCH_SF_DIR  folder of the Parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local threads (default 8)
BENCH_QUERIES comma list of query names (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession

from letterbox.queries import QUERIES, parsing, producer, writing
from letterbox.session import new_folder

HEADLINE = [
    "load_multi_table",
    "merge_upsert",
    "merge_recency",
    "replace_partition",
    "key_null_report",
    "landing_by_table",
    "two_stage_load",
    "payload_round_trip",
    "text_round_trip",
    "payload_explode",
    "spec_resolution",
    "lenient_cast",
    "partition_from_column",
    "compact_partitions",
    "stream_join",
    "stream_load",
]


def session(cpus: str) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="letterbox-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    """Seconds until every row of the answer has been produced."""
    started = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


class Prepared:
    """Messages built once per query: later runs read them from files."""

    def __init__(self):
        self.build, self.paths = producer.messages, {}
        for module in (producer, parsing, writing):
            module.messages = self

    def start(self, name: str) -> None:
        self.name, self.calls = name, 0

    def __call__(self, df: DataFrame, *args, **kwargs) -> DataFrame:
        sent, key = self.build(df, *args, **kwargs), (self.name, self.calls)
        self.calls += 1
        if sent.isStreaming:
            return sent
        if key not in self.paths:
            self.paths[key] = new_folder(df.sparkSession, "messages")
            # A hub's messages lie in many files; a single one would be read by one task.
            sent.repartition(df.sparkSession.sparkContext.defaultParallelism).write.parquet(self.paths[key])
        return df.sparkSession.read.schema(sent.schema).parquet(self.paths[key])


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    seconds, prepared, began = {}, Prepared(), time.perf_counter()
    for name in names:
        times = []
        runs = 3 if time.perf_counter() - began < 150 else 1
        for _ in range(1 + runs):  # the first is the warm-up
            prepared.start(name)
            times.append(run(spark, name, sf_dir))
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
